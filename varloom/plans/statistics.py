"""Statistics of a growing dataset from one row of state for each file, which are merged and never counted again.

A file's state holds its rows per variant type, its first and last position and a HyperLogLog sketch of its keys.  A
refresh reads only files without a state, or of another size or age than theirs; what the dataset no longer holds is
left out when the states are merged.  States are appended, so a refresh that fails leaves nothing, and one that is
repeated adds nothing new.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import percent_decoded, plain_path
from ..schema import KEYS, TYPE_COLUMN
from ..sources.catalog import collect_parquet_files
from ..sources.storage import path_exists

STATE = "path string, size long, modified timestamp, variant_type string, n_rows long, first_start long, last_start long, keys binary"


def file_states(files: DataFrame, on: Sequence[str] = KEYS, type_column: str = TYPE_COLUMN, precision: int = 14) -> DataFrame:
    """``path, variant_type, n_rows, first_start, last_start, keys`` of a variant table, by the file of each row.

    ``keys`` is a sketch of the distinct keys, good to about one percent at precision 14; rows with a null in a key
    count by the others.
    """
    path = plain_path(percent_decoded("_metadata.file_path")).alias("path")
    rows = files.select(path, F.col(type_column).alias("variant_type"), F.col("start").cast("long").alias("start"), F.xxhash64(*on).alias("key"))
    return rows.groupBy("path", "variant_type").agg(
        F.count("*").alias("n_rows"),
        F.min("start").alias("first_start"),
        F.max("start").alias("last_start"),
        F.hll_sketch_agg("key", precision).alias("keys"),
    )


def _listed(spark: SparkSession, dataset: str) -> DataFrame:
    return collect_parquet_files(spark, dataset).select(plain_path("path").alias("path"), "size", "modified")


def _known(spark: SparkSession, state: str) -> DataFrame:
    if not path_exists(spark, state):
        return spark.createDataFrame([], STATE)
    return spark.read.schema(STATE).parquet(state)


def refresh_statistics(
    spark: SparkSession, dataset: str, state: str, on: Sequence[str] = KEYS, type_column: str = TYPE_COLUMN
) -> int:
    """Add the states of files that are new or changed since the last refresh, and tell how many those are.

    Only these files are read; their names are the list that Spark plans the scan from.  A file without rows keeps a
    state without a type, so that it is not read again.
    """
    listed = _listed(spark, dataset)
    pending = listed.join(_known(spark, state).select("path", "size", "modified").distinct(), ["path", "size", "modified"], "left_anti")
    new = [r["path"] for r in pending.select("path").collect()]
    if not new:
        return 0
    found = file_states(spark.read.option("basePath", dataset).parquet(*new), on, type_column)
    wanted = spark.createDataFrame([(p,) for p in new], "path string")
    listed.join(F.broadcast(wanted), "path").join(found, "path", "left").select(*[c.split()[0] for c in STATE.split(", ")]).write.mode(
        "append"
    ).parquet(state)
    return len(new)


def merged_statistics(spark: SparkSession, dataset: str, state: str) -> DataFrame:
    """``variant_type, n_files, n_rows, first_start, last_start, n_keys`` of the dataset's present files, without reading them.

    ``n_keys`` estimates the distinct keys from the merged sketches.
    """
    states = _known(spark, state).join(_listed(spark, dataset), ["path", "size", "modified"], "left_semi")
    # Two refreshes at a time may both have added a file.
    once = states.filter("n_rows IS NOT NULL").dropDuplicates(["path", "variant_type"])
    return once.groupBy("variant_type").agg(
        F.count("*").alias("n_files"),
        F.sum("n_rows").alias("n_rows"),
        F.min("first_start").alias("first_start"),
        F.max("last_start").alias("last_start"),
        F.hll_sketch_estimate(F.hll_union_agg("keys")).alias("n_keys"),
    )
