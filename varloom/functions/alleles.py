"""Expressions over chromosome names and alleles."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import ALT_SEPARATOR


def alt_alleles(alt: str | Column, separator: str = ALT_SEPARATOR) -> Column:
    """The alternate alleles as an array.  ``split`` takes a regex, so the separator is quoted."""
    return F.split(alt, re.escape(separator))


def bare_chrom(chrom: str | Column) -> Column:
    """Chromosome name without a leading ``chr``."""
    return F.regexp_replace(chrom, "^(?i)chr", "")


def chrom_sort_keys(chrom: str | Column) -> list[Column]:
    """Sort keys for natural order: numbers by value first, then the other names as text."""
    col = F.col(chrom) if isinstance(chrom, str) else chrom
    return [col.try_cast("int").asc_nulls_last(), col.asc()]
