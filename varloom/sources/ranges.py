"""Which parts of a reference a variant table touches, as tables that are joined and not as lists of values.

``range_table`` has a row for each stretch of ``BIN`` positions of a chromosome in which variants occur, with the first
and last of them.  ``row_groups`` has a row for each row group of Parquet files, with the statistics of its footer.  Both
are joined by bins: a row group is put into bins of the smallest size that holds it, so that it falls into two at most,
and a stretch into the two or fewer bins of every size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .catalog import partition_value
from .storage import task_opener

#: Positions of a stretch.
BIN = 1 << 16
#: Sizes of bins as powers of two.  The last holds every position of a chromosome.
LEVELS = (16, 20, 24, 28, 62)
#: Stretches that are broadcast, about 100 bytes each as a hash table; more are left to the join that follows.
BROADCAST_RANGES = 500_000
#: Files of a selection that are named one by one; with more all are read.
MOST_FILES = 20_000


def range_table(df: DataFrame) -> DataFrame:
    """``chrom, bin, lo, hi``: the stretches in which the variants begin.  Rows without either key column are in none."""
    return (
        df.filter("chrom IS NOT NULL AND start IS NOT NULL")
        .groupBy("chrom", F.floor(F.col("start") / BIN).alias("bin"))
        .agg(F.min("start").cast("long").alias("lo"), F.max("start").cast("long").alias("hi"))
    )


def within_range_table(reference: DataFrame, ranges: DataFrame) -> DataFrame:
    """Reference rows inside the stretches; a join on chromosome and position finds the same matches.

    The first and last position over all chromosomes go to the scan, which skips row groups by them.  The stretches
    (a stored table, it is read three times) are broadcast if they are few; if not, only the positions are used.
    """
    row = ranges.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count("*").alias("n")).first()
    if not row["n"]:
        return reference.filter(F.lit(False))
    reference = reference.filter(F.col("start").between(row["lo"], row["hi"]))
    if row["n"] > BROADCAST_RANGES:
        return reference
    few = F.broadcast(ranges.select(*[F.col(c).alias(f"_range_{c}") for c in ranges.columns]))
    same = (F.col("chrom") == F.col("_range_chrom")) & (F.floor(F.col("start") / BIN) == F.col("_range_bin"))
    return reference.join(few, same & F.col("start").between(F.col("_range_lo"), F.col("_range_hi")), "left_semi")


def _footers():
    opened = task_opener()

    def run(frames):
        from urllib.parse import unquote

        import pandas as pd
        from pyarrow import parquet

        for frame in frames:
            found = []
            for path in frame["path"]:
                with opened(unquote(path)) as source:
                    meta = parquet.ParquetFile(source).metadata
                    names = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
                    for g in range(meta.num_row_groups):
                        row = [path, g, meta.row_group(g).num_rows]
                        for name in ("chrom", "start"):
                            stats = meta.row_group(g).column(names[name]).statistics if name in names else None
                            known = stats is not None and stats.has_min_max
                            row += [stats.min, stats.max] if known else [None, None]
                        found.append(row)
            yield pd.DataFrame(found, columns=["path", "row_group", "n_rows", "first_chrom", "last_chrom", "lo", "hi"])

    return run


def row_groups(files: DataFrame) -> DataFrame:
    """``path, row_group, n_rows, first_chrom, last_chrom, lo, hi`` of Parquet files, from footers read in tasks.

    Paths are percent-encoded, as Spark lists them.  ``chrom`` as a partition folder counts as first and last.  What a footer does not tell is null.
    """
    schema = "path string, row_group int, n_rows long, first_chrom string, last_chrom string, lo long, hi long"
    found = files.select("path").repartition("path").mapInPandas(_footers(), schema)
    folder = partition_value("path", "chrom")
    return found.withColumns({c: F.coalesce(folder, F.col(c)) for c in ("first_chrom", "last_chrom")})


def _bins(lo: Column, hi: Column, level: int) -> Column:
    return F.sequence(F.shiftright(lo, level), F.shiftright(hi, level))


def _placed(lo: Column, hi: Column, level: int) -> Column:
    return F.transform(_bins(lo, hi, level), lambda bin: F.struct(F.lit(level).alias("level"), bin.alias("bin")))


def touched(groups: DataFrame, ranges: DataFrame) -> DataFrame:
    """The row groups that may hold a position of the stretches, each once.

    Row groups of several chromosomes, or without statistics, cannot be told apart by bins and stay.
    """
    plain = F.coalesce((F.col("first_chrom") == F.col("last_chrom")) & F.col("lo").isNotNull() & F.col("hi").isNotNull(), F.lit(False))
    length = F.col("hi") - F.col("lo")
    level = F.lit(LEVELS[-1])
    for power in reversed(LEVELS[:-1]):
        level = F.when(length < (1 << power), power).otherwise(level)
    sized = groups.filter(plain).withColumn("level", level)
    mine = F.lit(None)
    for power in LEVELS:
        mine = F.when(F.col("level") == power, _bins(F.col("lo"), F.col("hi"), power)).otherwise(mine)
    sized = sized.withColumn("bin", F.explode(mine))
    each = F.flatten(F.array(*[_placed(F.col("lo"), F.col("hi"), power) for power in LEVELS]))
    places = ranges.select(F.col("chrom").alias("first_chrom"), F.col("lo").alias("from"), F.col("hi").alias("to"), F.explode(each).alias("x"))
    places = places.select("first_chrom", "from", "to", "x.*")
    met = sized.join(places, ["first_chrom", "level", "bin"]).filter("from <= hi AND lo <= to")
    return met.select(*groups.columns).distinct().unionByName(groups.filter(~plain))


def in_touched_files(reference: DataFrame, ranges: DataFrame) -> DataFrame:
    """The rows of a reference that are in files with a position of the stretches; other files are not opened.

    Executors must be able to open the files with Arrow.  The files that stay are part of the plan, which names every
    file that it reads anyway; beyond ``MOST_FILES`` the reference is returned as it is.
    """
    spark = reference.sparkSession
    files = spark.createDataFrame([(p,) for p in reference.inputFiles()], "path string")
    hit = touched(row_groups(files), ranges).select("path").distinct().limit(MOST_FILES + 1).collect()
    if len(hit) > MOST_FILES:
        return reference
    # Spark lists local files with three slashes and names them with one in a row's metadata.
    paths = [p for r in hit for p in (r["path"], r["path"].replace("file:///", "file:/", 1))]
    return reference.filter(F.col("_metadata.file_path").isin(sorted(set(paths))))
