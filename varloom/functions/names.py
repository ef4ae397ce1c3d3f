"""Expressions over file paths: base names, suffixes, kinds of file and derived output names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffixes of index files that sit next to a VCF.
INDEX_SUFFIXES = (".tbi", ".csi", ".idx")

# Suffixes of VCF files, plain and compressed.
VCF_SUFFIXES = (".vcf", ".vcf.gz", ".vcf.bgz")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def base_name(path: str | Column) -> Column:
    """Text after the last slash."""
    return F.substring_index(_col(path), "/", -1)


def percent_decoded(text: str | Column) -> Column:
    """Undo the ``%XX`` escapes of file metadata and partition directories; a plus sign stays."""
    col = _col(text)
    return F.when(col.contains("%"), F.url_decode(F.replace(col, F.lit("+"), F.lit("%2B")))).otherwise(col)


def _without(name: Column, length: int | Column) -> Column:
    return F.left(name, F.length(name) - length)


def _has_suffix(name: Column) -> Column:
    """There is a dot that is neither the first nor the last character of the name."""
    tail = F.substring_index(name, ".", -1)
    return (tail != "") & (F.length(tail) < F.length(name) - 1)


def last_suffix(path: str | Column) -> Column:
    """The last suffix with its dot, or an empty string; a leading or trailing dot starts none."""
    name = base_name(path)
    return F.when(_has_suffix(name), F.concat(F.lit("."), F.substring_index(name, ".", -1))).otherwise("")


def stem(path: str | Column) -> Column:
    """Base name without its last suffix."""
    name = base_name(path)
    tail = F.length(F.substring_index(name, ".", -1)) + 1
    return F.when(_has_suffix(name), _without(name, tail)).otherwise(name)


def is_index_file(path: str | Column) -> Column:
    return last_suffix(path).isin(*INDEX_SUFFIXES)


def is_vcf_file(path: str | Column) -> Column:
    """A ``.vcf`` suffix is present and the file is not an index of one."""
    return base_name(path).rlike(r"^.+\.vcf(\.|$)") & ~is_index_file(path)


def is_parquet_file(path: str | Column) -> Column:
    return last_suffix(path) == ".parquet"


def source_name(path: str | Column) -> Column:
    """What the rows of a converted file are called: its base name without VCF suffixes.

    Any other name loses its last suffix.  Plain string functions, because rows carry this name and it
    is made for each of them.
    """
    name = base_name(path)
    bare = stem(name)
    for suffix in VCF_SUFFIXES:
        n = len(suffix)
        bare = F.when(name.endswith(suffix) & (F.length(name) > n), _without(name, n)).otherwise(bare)
    return bare


def plain_path(path: str | Column) -> Column:
    """A path with one slash after its scheme, so that paths from listings and from row metadata compare equal."""
    return F.regexp_replace(_col(path), "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def source_id(path: str | Column, root: str | None = None) -> Column:
    """What tells inputs of one name apart: a hash of the path below ``root``, or of the whole path."""
    col = plain_path(path)
    if root is not None:
        prefix = re.sub("^([A-Za-z][A-Za-z0-9+.-]*):/+", r"\1:/", root).rstrip("/") + "/"
        col = F.when(col.startswith(prefix), F.substring(col, len(prefix) + 1, 2**31 - 1)).otherwise(col)
    return F.lower(F.lpad(F.hex(F.xxhash64(col)), 16, "0"))


def default_parquet_name(path: str | Column) -> Column:
    """Output path for a VCF: ``.vcf``, ``.vcf.gz`` and ``.vcf.bgz`` give way to ``.parquet``.

    Any other name has its last suffix replaced, or ``.parquet`` added when it has none.
    """
    col = _col(path)
    return F.concat(_without(col, F.length(base_name(col))), source_name(col), F.lit(".parquet"))


def relative_path(path: str | Column, root: str) -> Column:
    """Path below ``root``; the base name when the file lies elsewhere."""
    col, prefix = _col(path), root.rstrip("/") + "/"
    return F.when(col.startswith(prefix), F.substring(col, len(prefix) + 1, 2**31 - 1)).otherwise(
        base_name(col)
    )
