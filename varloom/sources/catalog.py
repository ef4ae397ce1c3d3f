"""File catalogs: directory listings as tables, so that file rules are filters and joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import base_name, is_parquet_file, percent_decoded
from .storage import path_exists, qualified

GLOB_CHARACTERS = "*?[]"

# Fixed value: the directory name under which Spark writes a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def file_catalog(
    spark: SparkSession,
    roots: str | Sequence[str],
    pattern: str | None = None,
    recursive: bool = True,
    name_glob: str | None = None,
) -> DataFrame:
    """``path, name, size, modified`` of the files below the roots, which may be globs.

    ``pattern`` is a regular expression searched in the base name.  File contents are not read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    paths = [roots] if isinstance(roots, str) else list(roots)
    files = reader.load(paths).select(
        "path",
        base_name("path").alias("name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )
    return files.filter(F.col("name").rlike(pattern)) if pattern else files


def list_paths(spark: SparkSession, url: str, pattern: str | None = None, file_only: bool = True) -> DataFrame:
    """``path`` of the entries of a directory, or of the matches of a glob.

    ``pattern`` is searched in the base name.  ``file_only=False`` adds the directories that sit
    directly in ``url`` and hold files.
    """
    has_glob = any(c in url for c in GLOB_CHARACTERS)
    listed = file_catalog(spark, url, recursive=False).select("path")
    if not file_only and not has_glob:
        root = qualified(spark, url).rstrip("/") + "/"
        rest = F.substring("path", len(root) + 1, 2**31 - 1)
        folder = F.concat(F.lit(root), F.substring_index(rest, "/", 1)).alias("path")
        nested = file_catalog(spark, url).filter(rest.contains("/"))
        listed = listed.unionByName(nested.select(folder).distinct())
    return listed.filter(base_name("path").rlike(pattern)) if pattern else listed


def collect_parquet_files(spark: SparkSession, source_dir: str, recursive: bool = True) -> DataFrame:
    """Catalog of the ``.parquet`` files below a directory; a missing directory raises."""
    if not path_exists(spark, source_dir):
        raise FileNotFoundError(f"directory not found: {source_dir}")
    return file_catalog(spark, source_dir, recursive=recursive).filter(is_parquet_file("path"))


def partition_value(path: str, column: str) -> Column:
    """The value of a ``column=value`` directory in a path; null for the null partition."""
    raw = F.regexp_extract(path, rf"/{column}=([^/]*)/", 1)
    return F.when((raw != "") & (raw != NULL_PARTITION), percent_decoded(raw))
