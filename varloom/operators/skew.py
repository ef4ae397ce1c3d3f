"""Joins that stay balanced when one key holds a large share of the rows.

``profile_keys`` finds heavy keys exactly without shuffling the keys: a count-min sketch, combined before its shuffle,
tells which keys can be above the limit, and only those are counted.  ``salted_join`` then spreads the rows of those keys over many tasks.  The joined
rows are the same whatever is spread.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.storage import scratch_dir

#: Rows of one key that a single join task handles comfortably.
ROWS_PER_SLICE = 1_000_000
#: Cells of each line of the sketch for every heavy key that there can be; one light key in their square is counted too.
CELLS = 64
#: Keys or cells of a sketch that are broadcast.  More of them are stored and joined by a shuffle.
BROADCAST_KEYS = 100_000


@dataclass(frozen=True)
class KeyProfile:
    """How the rows of a table spread over its keys.

    ``null_rows`` counts rows with a null in any key; they match nothing.  ``table`` is the stored table ``hash, n`` of
    the 64-bit hashes of the ``n_heavy`` keys above the limit, at most ``rows / limit`` of them; None without any.
    """

    rows: int
    null_rows: int
    table: DataFrame | None = None
    n_heavy: int = 0

    @property
    def heavy(self) -> tuple[int, ...]:
        """The hashes of the heavy keys, all brought to the driver; joins use ``table``."""
        return () if self.table is None else tuple(r["hash"] for r in self.table.select("hash").collect())


def _stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read back."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def all_present(on: Sequence[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in on])


def _sketched(hash_column: Column, cells: int) -> list[Column]:
    """The cell of a key hash in each line of the sketch; null for a null hash."""
    halves = (hash_column.bitwiseAND(F.lit(0xFFFF_FFFF)), F.shiftrightunsigned(hash_column, 32))
    return [F.pmod(half, F.lit(cells)) for half in halves]


def sketch_keys(df: DataFrame, on: Sequence[str], cells: int) -> DataFrame:
    """A count-min sketch of the keys: ``line, cell, n``; rows with a null in a key are in the null cell of each line.

    A task hands on at most two rows for each cell, however many keys it sees.  Sketches of several tables with equal
    ``cells`` are merged by summing ``n``.
    """
    hashed = df.select(F.when(all_present(on), F.xxhash64(*on)).alias("hash"))
    places = [F.struct(F.lit(i).alias("line"), c.alias("cell")) for i, c in enumerate(_sketched(F.col("hash"), cells))]
    each = hashed.select(F.explode(F.array(*places)).alias("place")).select("place.*")
    return each.groupBy("line", "cell").agg(F.count("*").alias("n"))


def profile_keys(
    df: DataFrame, on: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE, most_rows: int | None = None
) -> KeyProfile:
    """Count rows and find keys above ``rows_per_slice``, reading only the key columns.

    A sketch with ``CELLS`` times as many cells as there can be heavy keys is taken first.  It never counts a key too
    low, so that a key is heavy only if its cells in all lines are.  Without such cells nothing more is read; else the
    keys in them are counted exactly, or all keys if the cells are too many to broadcast.  ``most_rows`` bounds the
    number of rows, which is counted when it is not given.  Sketch and heavy keys stay in stored tables.
    """
    most_rows = df.count() if most_rows is None else most_rows
    cells = max(1024, CELLS * most_rows // max(1, rows_per_slice))
    sketch = _stored(sketch_keys(df, on, cells), "key_sketch")
    null, first = F.col("cell").isNull(), F.col("line") == 0
    is_full = ~null & (F.col("n") > rows_per_slice)
    row = sketch.agg(
        F.coalesce(F.sum(F.when(first, F.col("n"))), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(first & null, F.col("n"))), F.lit(0)).alias("null_rows"),
        *[F.count_if(is_full & (F.col("line") == line)).alias(f"full_{line}") for line in (0, 1)],
    ).first()
    if not (row["full_0"] and row["full_1"]):
        return KeyProfile(row["rows"], row["null_rows"])
    hashed = df.filter(all_present(on)).select(F.xxhash64(*on).alias("hash"))
    for line, cell in enumerate(_sketched(F.col("hash"), cells)):
        if row[f"full_{line}"] <= BROADCAST_KEYS:
            few = sketch.filter(is_full & (F.col("line") == line)).select(F.col("cell").alias("_cell"))
            hashed = hashed.join(F.broadcast(few), cell == F.col("_cell"), "left_semi")
    heavy = hashed.groupBy("hash").agg(F.count("*").alias("n")).filter(F.col("n") > rows_per_slice)
    heavy = _stored(heavy, "heavy_hashes")
    n_heavy = heavy.count()
    return KeyProfile(row["rows"], row["null_rows"], heavy if n_heavy else None, n_heavy)


def _key_counts(df: DataFrame, on: Sequence[str], profile: KeyProfile, name: str) -> DataFrame:
    """Exact row counts of the keys behind the heavy hashes, pre-aggregated before the shuffle."""
    hashes = profile.table.select(F.col("hash").alias("_key_hash"))
    hashed = df.filter(all_present(on)).select(*on, F.xxhash64(*on).alias("_key_hash"))
    if profile.n_heavy <= BROADCAST_KEYS:
        hashed = hashed.join(F.broadcast(hashes), "_key_hash", "left_semi")
        return hashed.groupBy(*on).agg(F.count("*").alias(name))
    # Counted before the join, in which each key is then one row.
    counted = hashed.groupBy(*on, "_key_hash").agg(F.count("*").alias(name))
    return counted.join(hashes, "_key_hash", "left_semi").drop("_key_hash")


def heavy_keys(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_profile: KeyProfile | None,
    right_profile: KeyProfile | None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame | None:
    """A table of the heavy keys with the number of slices for each side, or None without any.

    A side without a profile is taken to have no heavy keys.  A key of n rows has ``n / rows_per_slice``
    slices, rounded up, however many that are.

    ``right_slices`` above one means that the key is known to occur on the right.
    """

    def slices(n: str) -> Column:
        return F.ceil(F.col(n) / rows_per_slice).cast("int")

    parts = []
    if left_profile is not None and left_profile.n_heavy:
        n = _key_counts(left, on, left_profile, "_n")
        parts.append(n.select(*on, slices("_n").alias("left_slices"), F.lit(1).alias("right_slices")))
    if right_profile is not None and right_profile.n_heavy:
        n = _key_counts(right, on, right_profile, "_n")
        parts.append(n.select(*on, F.lit(1).alias("left_slices"), slices("_n").alias("right_slices")))
    if not parts:
        return None
    found = (
        reduce(DataFrame.unionByName, parts)
        .groupBy(*on)
        .agg(F.max("left_slices").alias("left_slices"), F.max("right_slices").alias("right_slices"))
    )
    # Both sides of the join need the table, so it is computed once.
    return _stored(found, "heavy_keys")


#: Plan nodes above a scan that leave the order of rows as it is.
_IN_ORDER = ("Project", "Filter", "Union", "Relation", "LogicalRDD", "LocalRelation", "Range", "Generate")


def repeatable(df: DataFrame) -> DataFrame:
    """``df`` if its rows come back in the same order when a task is run again, else a written copy of it.

    Rows straight from a scan do, and so does everything if Spark repeats whatever depended on another order.
    Rows that come out of a shuffle need not; they are written to the folder in ``spark.checkpoint.dir`` first.
    """
    spark = df.sparkSession
    full_retry = "spark.sql.shuffle.orderIndependentChecksum.enableFullRetryOnMismatch"
    checksum = "spark.sql.shuffle.orderIndependentChecksum.enabled"
    if all(spark.conf.get(c, "false").lower() == "true" for c in (full_retry, checksum)):
        return df
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    names = [line.lstrip(" :+-").split(" ")[0].split("(")[0] for line in plan.splitlines() if line.strip()]
    if all(n.startswith(_IN_ORDER) for n in names):
        return df
    return _stored(df, "repeatable")


def _with_slices(df: DataFrame, heavy: DataFrame, on: list[str], place: str, wide: int | None) -> DataFrame:
    """``df`` with the other columns of ``heavy``, null for keys that it lacks.

    Without ``wide`` the table is broadcast.  Otherwise only keys of more slices than that are, and the rest is joined by
    a shuffle, through which rows that have theirs, or a null key, are dealt by ``place``.
    """
    if wide is None:
        return df.join(F.broadcast(heavy), on, "left")
    left_n, right_n = values = [c for c in heavy.columns if c not in on]
    total = F.col(left_n) + F.col(right_n)
    df = df.join(F.broadcast(heavy.filter(total > wide)), on, "left")
    new = {c: f"{c}_rest" for c in heavy.columns}
    rest = heavy.filter(total <= wide).withColumnsRenamed(new)
    same = [F.col(c) == F.col(new[c]) for c in on]
    if all(df.schema[c].dataType == heavy.schema[c].dataType for c in on):
        # Otherwise equal keys could have different hashes, and are joined as they are.
        own = F.when(all_present(on) & F.col(left_n).isNull(), F.xxhash64(*on)).otherwise(F.xxhash64(place))
        df = df.withColumn(f"{place}_hash", own)
        rest = rest.withColumn(f"{place}_rest", F.xxhash64(*[new[c] for c in on]))
        same.insert(0, F.col(f"{place}_hash") == F.col(f"{place}_rest"))
    joined = df.join(rest, reduce(and_, same), "left")
    return joined.withColumns({c: F.coalesce(c, new[c]) for c in values}).drop(*new.values(), f"{place}_hash", f"{place}_rest")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str,
    heavy: DataFrame | None = None,
    null_slices: int = 1,
) -> DataFrame:
    """Left or inner equi-join in which heavy keys are cut into slices on either side.

    A heavy key becomes a grid: its left rows are dealt over ``left_slices`` and copied once per right
    slice, its right rows the other way round, so that each pair meets in exactly one cell.  A left
    row that finds its cell's right slice empty leaves a row without a match, which is dropped when
    the key is known to exist on the right.  Left rows with a null key match nothing and are dealt
    over ``null_slices``.

    Rows are dealt by their position in the input partition, so equal rows are separated too.  A task that
    is run again must therefore see them in the same order: a side that is dealt goes through
    ``repeatable``.  Slices are hashed over the partitions of the join, so its tasks get even shares.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    on = list(on)
    if heavy is None and null_slices <= 1:
        return left.join(right, on, how)

    most = None
    if heavy is not None:
        total = F.sum((F.col("left_slices") + F.col("right_slices")).cast("bigint"))
        most = heavy.agg(
            F.max("left_slices").alias("left"), F.max("right_slices").alias("right"), F.count("*").alias("keys"), total.alias("total")
        ).first()
    if null_slices > 1 or (most and most["left"] > 1):
        left = repeatable(left)
    if most and most["right"] > 1:
        right = repeatable(right)

    tag = uuid.uuid4().hex[:8]
    ls, rs, hit, n_left, n_right, place = (f"_{n}_{tag}" for n in ("ls", "rs", "hit", "nl", "nr", "at"))
    # Taken from the input as it is read: what is joined by a shuffle comes in another order when a task is run again.
    left = left.withColumn(place, F.monotonically_increasing_id())
    right = right.withColumn(place, F.monotonically_increasing_id())
    if heavy is None:
        left = left.withColumns({n_left: F.lit(1), n_right: F.lit(1)})
        right = right.withColumns({n_left: F.lit(1), n_right: F.lit(1)})
    else:
        # Fewer than BROADCAST_KEYS keys have more than their share of all slices.
        wide = None if most["keys"] <= BROADCAST_KEYS else most["total"] // BROADCAST_KEYS
        named = heavy.withColumnsRenamed({"left_slices": n_left, "right_slices": n_right})
        ones = {n_left: F.coalesce(n_left, F.lit(1)), n_right: F.coalesce(n_right, F.lit(1))}
        left = _with_slices(left, named, on, place, wide).withColumns(ones)
        right = _with_slices(right, named, on, place, wide).withColumns(ones)

    dealt = F.when(~all_present(on), F.pmod(place, F.lit(null_slices))).otherwise(F.pmod(place, n_left))
    left = (
        left.withColumn(ls, dealt.cast("int"))
        .withColumn(rs, F.explode(F.sequence(F.lit(0), F.col(n_right) - 1)))
        .drop(place)
    )
    right = (
        right.withColumn(rs, F.pmod(place, n_right).cast("int"))
        .withColumn(ls, F.explode(F.sequence(F.lit(0), F.col(n_left) - 1)))
        .withColumn(hit, F.lit(True))
        .drop(n_left, n_right, place)
    )
    joined = left.join(right, [*on, ls, rs], how)
    if how == "left":
        joined = joined.filter(F.col(hit).isNotNull() | (F.col(n_right) == 1))
    return joined.drop(ls, rs, hit, n_left, n_right)
