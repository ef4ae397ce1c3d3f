"""Annotating variants: an equi-join of a variant table with a reference dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import alt_alleles, bare_chrom
from ..schema import KEYS
from .bloom import FILTER_BYTES, bloom_reduce, filter_segments
from .skew import ROWS_PER_SLICE, all_present, heavy_keys, profile_keys, salted_join

#: Default of ``semi_max_rows``: up to this many left rows their key hashes are sent to every executor, eight bytes
#: each, some 400 MB as a hash table.  A whole human genome has four to five million variants.
SEMI_MAX_ROWS = 6_000_000

#: Default of ``semi_min_ratio``: reducing the reference pays when it is this many times as long as the left table.
SEMI_MIN_RATIO = 4


def suffix_collisions(left: DataFrame, reference: DataFrame, on: Sequence[str], suffix: str) -> DataFrame:
    """Rename non-key reference columns whose name is taken on the left, ignoring case."""
    keys = {c.lower() for c in on}
    taken = {c.lower() for c in left.columns}
    renames = {c: c + suffix for c in reference.columns if c.lower() in taken - keys}
    out = [renames.get(c, c).lower() for c in reference.columns if c.lower() not in keys]
    clash = [c for c in out if c in taken or out.count(c) > 1]
    if clash:
        raise ValueError(f"columns {sorted(set(clash))} still collide after adding the suffix {suffix!r}")
    return reference.withColumnsRenamed(renames)


def _null_columns(left: DataFrame, schema: T.StructType, on: Sequence[str], suffix: str) -> list[Column]:
    keys = {c.lower() for c in on}
    taken = {c.lower() for c in left.columns}
    return [
        F.lit(None).cast(f.dataType).alias(f.name + suffix if f.name.lower() in taken else f.name)
        for f in schema
        if f.name.lower() not in keys
    ]


def semi_reduce(
    reference: DataFrame,
    left: DataFrame,
    on: Sequence[str],
    max_rows: int | None = SEMI_MAX_ROWS,
    rows: int | None = None,
) -> DataFrame:
    """Reference rows whose key may occur on the left, found without shuffling the reference.

    The distinct 64-bit hashes of the left keys are broadcast.  ``rows`` is the number of left rows, counted when
    it is not given; more than ``max_rows`` raise.  Keys must have the same types on both sides.  A reference row
    that shares only the hash passes too, and is sorted out by the join that follows.

    ``max_rows=None`` takes any number of left rows.  Beyond ``SEMI_MAX_ROWS`` their distinct keys then meet the
    reference in a shuffle by the keys, and the join that follows finds it dealt that way.
    """
    rows = left.count() if rows is None else rows
    if max_rows is not None and rows > max_rows:
        raise ValueError(f"{rows} left rows are too many to broadcast their keys; semi_max_rows is {max_rows}")
    if max_rows is None and rows > SEMI_MAX_ROWS:
        keys = left.filter(all_present(on)).select(*on).distinct()
        return reference.join(keys, list(on), "left_semi").select(*reference.columns)
    hashed = F.xxhash64(*on).alias("_key_hash")
    wanted = left.filter(all_present(on)).select(hashed).distinct()
    return (
        reference.select("*", hashed).join(F.broadcast(wanted), "_key_hash", "left_semi").drop("_key_hash")
    )


def _same_key_types(left: DataFrame, reference: DataFrame, on: Sequence[str]) -> bool:
    return all(left.select(c).schema[0].dataType == reference.select(c).schema[0].dataType for c in on)


def annotate(
    left: DataFrame,
    reference: DataFrame | None,
    on: Sequence[str] = KEYS,
    how: str = "left",
    suffix: str = "_ensembl",
    strategy: str = "auto",
    skew: str | None = "auto",
    unique_reference: bool = False,
    reference_rows: int | None = None,
    reference_schema: T.StructType | None = None,
    always_add_columns: bool = False,
    strip_chr_prefix: bool = False,
    explode_alt: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE,
    semi_max_rows: int | None = SEMI_MAX_ROWS,
    semi_min_ratio: float = SEMI_MIN_RATIO,
    bloom_max_bytes: int = FILTER_BYTES,
    left_rows: int | None = None,
) -> DataFrame:
    """Join ``left`` with ``reference`` on ``on``.

    ``how="left"`` keeps every left row, with nulls where nothing matches; ``how="inner"`` keeps the
    matches.  Null keys never match, and a key that occurs several times in the reference repeats the
    left row.  Reference columns whose name is taken get ``suffix``.  Left columns come first.

    ``reference=None`` stands for a reference without data: the left table comes back unchanged, or
    with typed null columns when ``always_add_columns`` is set and ``reference_schema`` given.

    ``strategy``:

    * ``"semi"`` broadcasts hashes of the left keys, reduces the reference to its hits where it is
      read, and joins only those.  The reference is never shuffled.  Right for a sample against a
      reference dataset.  A left table of more than ``semi_max_rows`` rows, or one whose key types differ from
      those of the reference, raises.  With ``semi_max_rows=None`` no length raises: the keys of left tables of more
      than ``SEMI_MAX_ROWS`` rows reduce the reference in a shuffle.
    * ``"bloom"`` broadcasts a Bloom filter of the left keys of at most ``bloom_max_bytes``, for cohorts whose hashes
      are too many.  Only reference rows that pass it are shuffled.  A left table that is too long for the filter, or
      one with other key types, raises.
    * ``"direct"`` is one shuffle join, for left tables as large as the reference.
    * ``"auto"`` takes ``"semi"``, or else ``"bloom"``, when that is possible and the reference is ``semi_min_ratio``
      times as long as the left table.

    ``left_rows`` and ``reference_rows`` are the lengths of the tables; what is not given is counted, once.

    ``skew="auto"`` measures both sides for keys above ``rows_per_slice`` rows and spreads them;
    ``None`` leaves it to adaptive execution.  ``unique_reference=True`` states that no reference key
    repeats, which saves measuring the reference.  Measuring counts the rows, which reads no column of
    a Parquet table, and then reads the key columns of a table that is long enough to have such a key.
    A streaming left table is joined directly, without measuring.

    ``strip_chr_prefix`` and ``explode_alt`` change the left table to match references that write
    ``1`` for ``chr1`` or hold one row per alternate allele.
    """
    if strategy not in ("auto", "semi", "bloom", "direct"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if skew not in ("auto", None):
        raise ValueError(f"unknown skew setting {skew!r}")
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    on = list(on)
    if strip_chr_prefix:
        left = left.withColumn("chrom", bare_chrom("chrom"))
    if explode_alt:
        left = left.withColumn("alt", F.explode_outer(alt_alleles("alt")))

    if reference is None:
        if always_add_columns and reference_schema is not None:
            left = left.select("*", *_null_columns(left, reference_schema, on, suffix))
        return left.limit(0) if how == "inner" else left

    right = suffix_collisions(left, reference, on, suffix)
    columns = left.columns + [c for c in right.columns if c.lower() not in {k.lower() for k in on}]

    if left.isStreaming or reference.isStreaming:
        return left.join(right, on, how).select(*columns)

    same_types = _same_key_types(left, reference, on)
    if strategy in ("semi", "bloom") and not same_types:
        raise ValueError("the keys have other types in the reference; cast them or use strategy='direct'")
    rows = left_rows
    if rows is None and (skew or strategy != "direct"):
        rows = left.count()
    theirs = reference_rows
    if strategy == "auto":
        strategy = "direct"
        fits = "semi" if rows <= (SEMI_MAX_ROWS if semi_max_rows is None else semi_max_rows) else "bloom" if filter_segments(rows, bloom_max_bytes) else None
        if same_types and fits:
            theirs = reference.count() if theirs is None else theirs
            strategy = fits if theirs >= semi_min_ratio * rows else "direct"
    if strategy == "semi":
        right = semi_reduce(right, left, on, semi_max_rows, rows)
    elif strategy == "bloom":
        right = bloom_reduce(right, left, on, rows, bloom_max_bytes)

    heavy, null_slices = None, 1
    if skew:
        # A table of fewer rows than a slice has no heavy key.
        mine = profile_keys(left, on, rows_per_slice, rows) if rows > rows_per_slice else None
        other = None
        if not unique_reference:
            theirs = reference.count() if theirs is None else theirs
            if theirs > rows_per_slice:
                other = profile_keys(right, on, rows_per_slice, theirs)
        heavy = heavy_keys(left, right, on, mine, other, rows_per_slice)
        if how == "left" and mine is not None:
            null_slices = max(1, -(-mine.null_rows // rows_per_slice))
    return salted_join(left, right, on, how, heavy, null_slices).select(*columns)


def match_rate(
    left: DataFrame,
    reference: DataFrame,
    on: Sequence[str] = KEYS,
    by: Sequence[str] = (),
) -> DataFrame:
    """Rows, rows with a match, joined rows and both rates in percent, in total or per ``by`` group.

    Both sides are counted per key before they meet, so repeated keys on either side cost one row in
    the join.  ``matched`` counts each input row once; ``joined`` counts the rows of the inner join.
    """
    on, by = list(on), list(by)
    groups = on + [c for c in by if c not in on]
    mine = left.groupBy(*groups).agg(F.count("*").alias("_n"))
    theirs = reference.groupBy(*on).agg(F.count("*").alias("_m"))
    both = mine.join(theirs, on, "left")
    totals = both.groupBy(*by) if by else both
    counted = totals.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("_m").isNotNull(), F.col("_n"))), F.lit(0)).alias("matched"),
        F.coalesce(F.sum(F.col("_n") * F.col("_m")), F.lit(0)).alias("joined"),
    )

    def percent(c: str) -> Column:
        share = F.col(c).cast("double") * 100 / F.nullif(F.col("total"), F.lit(0))
        return F.round(share, 2)

    return counted.withColumns({"match_rate": percent("matched"), "joined_rate": percent("joined")})
