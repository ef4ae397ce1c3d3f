"""Row filters and ordering of variant tables.

Each one is a plain predicate, so Spark pushes it to the Parquet scan or prunes partitions with it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import chrom_sort_keys
from ..schema import TYPE_COLUMN


def of_type(df: DataFrame, variant_type: str, type_column: str = TYPE_COLUMN) -> DataFrame:
    return df.filter(F.col(type_column) == variant_type)


def on_chroms(df: DataFrame, chroms: Iterable[str]) -> DataFrame:
    return df.filter(F.col("chrom").isin(list(chroms)))


def region(df: DataFrame, first: int, last: int, chrom: str | None = None) -> DataFrame:
    """Variants that start within ``first``..``last``, both included, on one chromosome or all."""
    inside = F.col("start").between(first, last)
    return df.filter(inside if chrom is None else (F.col("chrom") == chrom) & inside)


def containing(df: DataFrame, column: str, text: str) -> DataFrame:
    """Rows whose column contains the text literally, case-sensitively."""
    return df.filter(F.col(column).contains(text))


def matching(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows in whose column the regular expression is found anywhere."""
    return df.filter(F.col(column).rlike(pattern))


def annotated_only(df: DataFrame, column: str) -> DataFrame:
    """Rows for which the reference had a value."""
    return df.filter(F.col(column).isNotNull())


def natural_order(df: DataFrame, chrom: str = "chrom", *then: str) -> DataFrame:
    """Sort by chromosome, numbers first and by value: ``1, 2, 10, MT, X``."""
    return df.orderBy(*chrom_sort_keys(chrom), *then)


def head(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows; in a given order, each task keeps only its own ``n`` best."""
    return (df.orderBy(*order) if order else df).limit(n)
