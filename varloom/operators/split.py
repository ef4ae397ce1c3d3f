"""Splitting variants by type, with multi-allelic SNVs turned into one row per allele."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import alt_alleles, base_name, is_parquet_file, percent_decoded, stem
from ..schema import ALT_SEPARATOR, TYPE_COLUMN

#: Column naming the input file of a row.
SOURCE_COLUMN = "source_file"


def explode_alt(
    df: DataFrame,
    types: Sequence[str] | None = ("SNV",),
    type_column: str = TYPE_COLUMN,
    separator: str = ALT_SEPARATOR,
) -> DataFrame:
    """One row per alternate allele for the given types, or for every type with ``types=None``.

    Other types keep their ``alt`` as it is.  A null ``alt`` keeps its row; empty alleles stay.
    """
    alleles = alt_alleles("alt", separator)
    if types is not None:
        alleles = F.when(F.col(type_column).isin(*types), alleles).otherwise(F.array("alt"))
    return df.withColumn("alt", F.explode_outer(alleles))


def split_variants(
    df: DataFrame,
    explode_snv_alt: bool = True,
    type_column: str = TYPE_COLUMN,
    snv_types: Sequence[str] = ("SNV",),
) -> DataFrame:
    """Rows ready for ``write_split``: SNV alternates exploded unless switched off."""
    if type_column not in df.columns:
        raise ValueError(f"no column {type_column!r} to split by; columns are {df.columns}")
    return explode_alt(df, snv_types, type_column) if explode_snv_alt else df


def write_split(
    df: DataFrame,
    out: str,
    partition_by: Sequence[str] = (TYPE_COLUMN,),
    layout: str = "rebalance",
    mode: str = "overwrite",
    compression: str = "zstd",
    replace_partitions: bool = False,
) -> None:
    """Write one directory per partition value, in one pass whatever the number of types.

    ``layout``:

    * ``"rebalance"`` lets adaptive execution gather each value's rows into files of the advisory
      size and cut a value that holds much of the data into many files.
    * ``"clustered"`` also sorts by type, chromosome and position, so that a region read skips row
      groups.  The position in the input breaks ties, so copies of one row do not share a task.
    * ``"scan"`` writes from the tasks that read the data: no shuffle, but up to one file per task and
      value.

    ``replace_partitions`` overwrites only the partitions present in ``df``.
    """
    columns = list(partition_by)
    if layout == "rebalance":
        df = df.hint("rebalance", *[F.col(c) for c in columns])
    elif layout == "clustered":
        order = columns + [c for c in ("chrom", "start", "ref", "alt") if c in df.columns and c not in columns]
        df = (
            df.withColumn("_tie", F.monotonically_increasing_id())
            .repartitionByRange(*order, "_tie")
            .sortWithinPartitions(*order)
            .drop("_tie")
        )
    elif layout != "scan":
        raise ValueError(f"unknown layout {layout!r}")
    writer = df.write.mode(mode).partitionBy(*columns).option("compression", compression)
    if replace_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(out)


def with_source(df: DataFrame) -> DataFrame:
    """Add the stem of the file each row was read from.  Only for frames read straight from files."""
    return df.select("*", stem(percent_decoded("_metadata.file_name")).alias(SOURCE_COLUMN))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of one column; only that column is read."""
    return df.select(column).distinct()


def type_counts(df: DataFrame, type_column: str = TYPE_COLUMN, source_column: str | None = None) -> DataFrame:
    """Rows per type and, with ``source_column``, the number of input files holding the type.

    Files are counted from per-file totals, so a type that dominates the data is reduced before it is
    gathered.
    """
    if source_column is None:
        return df.groupBy(type_column).agg(F.count("*").alias("n_rows"))
    per_file = df.groupBy(type_column, source_column).agg(F.count("*").alias("_n"))
    return per_file.groupBy(type_column).agg(
        F.sum("_n").alias("n_rows"), F.count(source_column).alias("n_files")
    )


def expected_splits(df: DataFrame, type_column: str = TYPE_COLUMN, source_column: str = SOURCE_COLUMN) -> DataFrame:
    """The (source, type) pairs that a split of ``df`` must produce."""
    return df.select(source_column, type_column).distinct()


def pending_sources(
    expected: DataFrame,
    existing: DataFrame,
    type_column: str = TYPE_COLUMN,
    source_column: str = SOURCE_COLUMN,
) -> DataFrame:
    """Sources to split again: those for which any of the expected types is missing.

    A null type is compared as a value of its own.
    """
    e, x = expected.alias("e"), existing.select(source_column, type_column).distinct().alias("x")
    same = (F.col(f"e.{source_column}") == F.col(f"x.{source_column}")) & F.col(f"e.{type_column}").eqNullSafe(
        F.col(f"x.{type_column}")
    )
    return e.join(x, same, "left_anti").select(source_column).distinct()


def split_completeness(
    inputs: DataFrame,
    existing_inputs: DataFrame,
    splits: DataFrame,
    existing_files: DataFrame,
) -> DataFrame:
    """Problems of a finished split, all of them, one row each.

    ``inputs(path)`` are the files that were to be split and ``existing_inputs(path)`` those that
    exist.  ``splits(path, split_path)`` are the outputs recorded per input, and
    ``existing_files(path)`` the output files found.  Inputs are matched by path; those that are not
    Parquet are ignored.
    """
    wanted = inputs.select("path").filter(is_parquet_file("path")).distinct()
    there = existing_inputs.select("path").distinct()
    found = wanted.join(there, "path", "left_semi")
    recorded = splits.select("path", "split_path").distinct()
    files = existing_files.select(F.col("path").alias("split_path")).distinct()

    def problem(df: DataFrame, kind: str, detail: str) -> DataFrame:
        return df.select(
            F.lit(kind).alias("kind"), base_name("path").alias("name"), F.col(detail).alias("detail")
        )

    missing_input = problem(wanted.join(there, "path", "left_anti"), "missing_input", "path")
    no_splits = problem(found.join(recorded.select("path").distinct(), "path", "left_anti"), "no_splits", "path")
    lost = recorded.join(found, "path", "left_semi").join(files, "split_path", "left_anti")
    return missing_input.unionByName(no_splits).unionByName(problem(lost, "missing_split", "split_path"))


def read_split(spark: SparkSession, out: str, schema: T.StructType, partition_by: Sequence[str] = (TYPE_COLUMN,)) -> DataFrame:
    """Read a written split with text partition columns, whatever their directory names look like."""
    text = T.StructType(
        [T.StructField(f.name, T.StringType()) if f.name in partition_by else f for f in schema.fields]
    )
    return spark.read.schema(text).parquet(out)
