"""Tables by version: readers see a whole state of the table, and never one that is being written.

A write puts its files into a folder of its own below ``data`` and then a list of the folders that make up the table
now below ``versions``.  Nothing is changed or deleted that a version names, so a reader that began with a version goes
on with it, and a write that fails leaves files that no version names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .catalog import file_catalog
from .storage import _hadoop_path, path_exists, qualified

COMMIT = "_commit"


def _list_versions(spark: SparkSession, table: str) -> list[int]:
    folder = f"{table.rstrip('/')}/versions"
    if not path_exists(spark, folder):
        return []
    fs, path = _hadoop_path(spark, folder)
    names = [str(s.getPath().getName()) for s in fs.listStatus(path) if not s.isDirectory()]
    return sorted((int(n) for n in names if n.isdigit()), reverse=True)


def _read_version(spark: SparkSession, table: str, version: int) -> dict | None:
    """What a version consists of; None while its file is being written."""
    fs, path = _hadoop_path(spark, f"{table.rstrip('/')}/versions/{version:012d}")
    stream = fs.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return json.loads(text)
    except ValueError:
        return None


def newest_version(spark: SparkSession, table: str) -> tuple[int, dict] | None:
    for version in _list_versions(spark, table):
        found = _read_version(spark, table, version)
        if found is not None:
            return version, found
    return None


def _claim(spark: SparkSession, table: str, version: int, content: dict) -> bool:
    """Write the file of a version, unless another writer has made it."""
    fs, path = _hadoop_path(spark, f"{table.rstrip('/')}/versions/{version:012d}")
    if fs.exists(path):
        return False
    fs.mkdirs(path.getParent())
    try:
        stream = fs.create(path, False)
    except Exception:
        if fs.exists(path):
            return False
        raise
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    return True


def write_snapshot(df: DataFrame, table: str, partition_by: Sequence[str] = (), replace: str | None = None) -> int:
    """Write rows as a new version of the table and return its number, from 1.

    ``replace=None`` adds them, ``"partitions"`` puts them in place of the partitions that they have rows in, and
    ``"all"`` in place of the whole table.  Writers at the same time both succeed: the later one builds on the version
    of the earlier.  A version names folders, one for each write and partition that it still uses.
    """
    if replace not in (None, "partitions", "all"):
        raise ValueError(f"replace must be None, 'partitions' or 'all', not {replace!r}")
    spark, root = df.sparkSession, table.rstrip("/")
    commit = uuid.uuid4().hex
    data = f"{root}/data/{COMMIT}={commit}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(data)
    inner = F.regexp_extract("path", rf"/{COMMIT}={commit}/(.*?)[^/]*$", 1)
    files = file_catalog(spark, data, name_glob="*.parquet").select(inner.alias("folder")).distinct()
    written = sorted(r["folder"] for r in files.collect())
    while True:
        base = newest_version(spark, root)
        before = {} if base is None else base[1]["commits"]
        if replace == "all":
            before = {}
        elif replace == "partitions":
            before = {c: [f for f in folders if f not in written] for c, folders in before.items()}
        commits = {c: folders for c, folders in {**before, commit: written}.items() if folders}
        content = {"schema": json.loads(df.schema.json()), "partition_by": list(partition_by), "commits": commits}
        taken = _list_versions(spark, root)
        version = (taken[0] if taken else 0) + 1
        if _claim(spark, root, version, content):
            return version


def read_snapshot(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """A version of the table, the newest whole one if none is given."""
    root = table.rstrip("/")
    found = newest_version(spark, root) if version is None else (version, _read_version(spark, root, version))
    if found is None or found[1] is None:
        raise FileNotFoundError(f"no version {'' if version is None else version} of {table}")
    content = found[1]
    schema = T.StructType.fromJson(content["schema"])
    data = f"{qualified(spark, root)}/data"
    paths = [f"{data}/{COMMIT}={c}/{f}".rstrip("/") for c, folders in content["commits"].items() for f in folders]
    if not paths:
        return spark.createDataFrame([], schema)
    stored = T.StructType([*schema.fields, T.StructField(COMMIT, T.StringType())])
    return spark.read.schema(stored).option("basePath", data).parquet(*paths).select(*[F.col(f"`{f.name}`") for f in schema])
