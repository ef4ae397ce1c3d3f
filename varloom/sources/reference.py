"""Reference datasets: opening them and reading only the types and chromosomes that are needed.

Three layouts are understood: ``tsa=<type>/chrom=<chrom>/`` as written by this package,
``<type>/<file per chromosome>`` optionally below ``data/``, and a flat folder of Parquet files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import base_name
from ..schema import TYPE_COLUMN
from .catalog import file_catalog, list_paths, partition_value
from .storage import folder_names, path_exists

# Names of a chromosome's file in the folder layout, in the order they are tried.
CHROM_FILE_NAMES = ("homo_sapiens-chr{}.parquet", "chr{}.parquet", "{}.parquet")

#: Partition folders named in the predicate that prunes; with more the range join alone chooses among them.
MOST_FOLDERS = 200


def chromosomes(df: DataFrame) -> DataFrame:
    """Distinct chromosomes in natural order, with what they are sorted by.

    ``chrom_class`` is 0 for numbers, which come first and by value, and 1 for other names.
    """
    number = F.col("chrom").try_cast("int")
    return (
        df.select("chrom")
        .distinct()
        .select(
            "chrom",
            F.when(number.isNull(), 1).otherwise(0).alias("chrom_class"),
            F.coalesce(number, F.lit(0)).alias("chrom_number"),
        )
        .orderBy("chrom_class", "chrom_number", "chrom")
    )


def chromosome_list(df: DataFrame) -> list[str]:
    """The non-null chromosomes, one name per contig of the assembly."""
    rows = chromosomes(df.filter(F.col("chrom").isNotNull())).select("chrom").collect()
    return [r["chrom"] for r in rows]


def prune(
    reference: DataFrame,
    variant_type: str | None = None,
    chroms: Sequence[str] | None = None,
    type_column: str = TYPE_COLUMN,
) -> DataFrame:
    """Keep one variant type and the given chromosomes; on partition columns nothing else is read.

    The chromosome filter is a list of values because Spark prunes with it before the scan starts,
    also below a left join, where it would not prune dynamically.
    """
    if variant_type is not None:
        reference = reference.filter(F.col(type_column) == variant_type)
    if chroms is not None:
        reference = reference.filter(F.col("chrom").isin(list(chroms)))
    return reference


def match_reference_files(files: DataFrame, chroms: DataFrame) -> DataFrame:
    """``chrom, path``: for each chromosome the first of its candidate files that exists.

    ``files`` has ``path`` and ``chroms`` has ``chrom``; chromosomes without a file give no row.
    """
    candidates = chroms.select("chrom").distinct().select(
        "chrom",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("priority"), F.format_string(n.replace("{}", "%s"), "chrom").alias("name"))
                    for i, n in enumerate(CHROM_FILE_NAMES)
                ]
            )
        ).alias("candidate"),
    )
    named = files.select(base_name("path").alias("name"), "path").groupBy("name").agg(F.min("path").alias("path"))
    return (
        candidates.select("chrom", "candidate.priority", "candidate.name")
        .join(named, "name")
        .groupBy("chrom")
        .agg(F.min_by("path", "priority").alias("path"))
    )


def _text_partitions(schema: T.StructType, columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) if f.name in columns else f for f in schema.fields])


def read_partitioned(
    spark: SparkSession, path: str, schema: T.StructType | None = None, partition_by: Sequence[str] = (TYPE_COLUMN, "chrom")
) -> DataFrame:
    """Read a partitioned dataset with its partition columns as text.

    Spark would take a ``chrom`` that is all digits for a number, which never equals ``X``.
    """
    schema = schema or spark.read.parquet(path).schema
    return spark.read.schema(_text_partitions(schema, partition_by)).parquet(path)


def open_reference(
    spark: SparkSession,
    path: str,
    variant_type: str | None = "SNV",
    chroms: Sequence[str] | DataFrame | None = None,
    schema: T.StructType | None = None,
    type_column: str = TYPE_COLUMN,
) -> DataFrame | None:
    """Open a local or shared reference dataset for the given type and chromosomes.

    Chromosomes given as a table (``chrom``) never reach the driver: they are joined with the names of folders or
    files, and rows of other chromosomes may come back, for ``within_range_table`` to drop.

    Returns None when no file of the dataset covers any of the chromosomes, as its folder or file names tell; a
    dataset that does not name chromosomes is filtered by them.  A dataset without Parquet files, or without the
    variant type, raises and names the types that exist.  ``variant_type=None`` reads all ``.parquet`` files below
    the folder, whatever folders they are in.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"reference dataset not found: {path}")
    root = path.rstrip("/")
    folders = folder_names(spark, root)
    marker = f"{type_column}="
    typed = sorted(f.removeprefix(marker) for f in folders if f.startswith(marker))
    if typed:
        if variant_type is not None and variant_type not in typed:
            raise FileNotFoundError(f"no variant type {variant_type!r} in {path}; found: {typed}")
        whole = read_partitioned(spark, root, schema, (type_column, "chrom"))
        if chroms is not None:
            files = file_catalog(spark, root, name_glob="*.parquet")
            if variant_type is not None:
                files = files.filter(partition_value("path", type_column) == variant_type)
            by_chrom = files.select(partition_value("path", "chrom").alias("chrom")).distinct()
            if isinstance(chroms, DataFrame):
                named = by_chrom.filter("chrom IS NOT NULL")
                covered = [r["chrom"] for r in named.join(chroms, "chrom", "left_semi").limit(MOST_FOLDERS + 1).collect()]
                if not covered and not named.isEmpty():
                    return None
                return prune(whole, variant_type, covered if 0 < len(covered) <= MOST_FOLDERS else None, type_column)
            there = {r["chrom"] for r in by_chrom.collect()}
            if there != {None}:
                chroms = [c for c in chroms if c in there]
                if not chroms:
                    return None
        return prune(whole, variant_type, chroms, type_column)

    nested = folder_names(spark, f"{root}/data") if "data" in folders else []
    if variant_type is not None:
        if variant_type in folders:
            folder = f"{root}/{variant_type}"
        elif variant_type in nested:
            folder = f"{root}/data/{variant_type}"
        else:
            known = sorted(set(folders + nested) - {"data"})
            raise FileNotFoundError(f"no variant type {variant_type!r} in {path}; found: {known}")
        files = list_paths(spark, folder, r"\.parquet$", file_only=False)
        if chroms is not None:
            wanted = chroms if isinstance(chroms, DataFrame) else spark.createDataFrame([(c,) for c in chroms], "chrom string")
            files = match_reference_files(files, wanted)
        paths = sorted(r["path"] for r in files.select("path").collect())
        if not paths:
            if chroms is None:
                raise FileNotFoundError(f"no Parquet files below {folder}")
            return None
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(*paths)

    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    if file_catalog(spark, root, name_glob="*.parquet").isEmpty():
        raise FileNotFoundError(f"no Parquet files below {path}")
    listed = None if isinstance(chroms, DataFrame) else chroms
    return prune((reader.schema(schema) if schema else reader).parquet(root), None, listed)
