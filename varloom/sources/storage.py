"""Small questions about paths, answered by the file system that Spark itself uses."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Folders that ``scratch_dir`` has given out and that still exist.
_SCRATCH: list[str] = []


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _hadoop_path(spark, path)
    return bool(fs.exists(hadoop_path))


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as it appears in ``_metadata.file_path`` and in file listings."""
    fs, hadoop_path = _hadoop_path(spark, path)
    return str(fs.makeQualified(hadoop_path).toString())


def finished(spark: SparkSession, path: str) -> bool:
    """A write to this directory was committed, or the path is a single file."""
    fs, hadoop_path = _hadoop_path(spark, path)
    return bool(fs.exists(hadoop_path)) and (
        bool(fs.isFile(hadoop_path)) or path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")
    )


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder path for an intermediate table, in the folder the cluster shares.

    ``spark.checkpoint.dir`` names that folder.  Without the setting a local session uses one temporary folder,
    which is removed when the session's process ends, and any other session raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="varloom-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/varloom/{name}-{uuid.uuid4().hex}"
    if not _SCRATCH:
        atexit.register(_remove_at_exit)
    _SCRATCH.append(path)
    return path


def remove_scratch(spark: SparkSession) -> None:
    """Delete the folders that ``scratch_dir`` has given out.  Tables that still read them are lost."""
    while _SCRATCH:
        fs, hadoop_path = _hadoop_path(spark, _SCRATCH.pop())
        fs.delete(hadoop_path, True)


def _remove_at_exit() -> None:
    """Frames are lazy, so intermediate tables live as long as the driver's process."""
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        remove_scratch(spark)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a folder."""
    fs, hadoop_path = _hadoop_path(spark, path)
    return [str(s.getPath().getName()) for s in fs.listStatus(hadoop_path) if s.isDirectory()]


def task_opener():
    """A function that opens a listed path in a Python task, for reading or, anew, for writing.

    It is made anew by every call, so that it travels to the executors by value and they need no copy
    of this package.
    """

    def opened(path, write=False):
        from urllib.parse import quote

        from pyarrow import fs as pafs

        if path.startswith("file:"):
            filesystem, inner = pafs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
        else:
            uri = quote(path.replace("s3a://", "s3://", 1), safe="/:@?=&")
            filesystem, inner = pafs.FileSystem.from_uri(uri)
        if write:
            filesystem.create_dir(inner.rsplit("/", 1)[0])
            return filesystem.open_output_stream(inner, compression=None)
        return filesystem.open_input_file(inner)

    return opened


def rename_files(spark: SparkSession, folder: str, suffix: str, form: str) -> None:
    """Give the files of a folder that end with ``suffix`` running names."""
    fs, hadoop_path = _hadoop_path(spark, folder)
    names = sorted(str(s.getPath().getName()) for s in fs.listStatus(hadoop_path))
    for i, name in enumerate(n for n in names if n.endswith(suffix)):
        fs.rename(_hadoop_path(spark, f"{folder}/{name}")[1], _hadoop_path(spark, f"{folder}/{form.format(i)}")[1])
