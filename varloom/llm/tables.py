"""Reading the text tables and keeping intermediate ones in the folder that the cluster shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import scratch_dir

#: Most rows of one integer key each that are broadcast (about 32 MB as a hash table on each executor).
BROADCAST_IDS = 1_000_000


#: Rows of an Arrow batch on its way to a Python task.  Texts are large rows: Spark's default of 10,000 makes batches of
#: tens of megabytes, held twice for each running task.
BATCH_ROWS = 2_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables.  From here on the session's Arrow batches have at most ``BATCH_ROWS`` rows."""
    if int(spark.conf.get(_BATCH_SETTING)) > BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared folder and read them back, which cuts the lineage and survives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def only_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among ``ids`` (a stored table): filtered where they are read if the ids are few, else joined."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if few else ids, key, "left_semi")
