"""Compressed text read in many tasks: block-gzip files cut at block borders.

A block-gzip file is a chain of small gzip members, each of which states its own length.  Spark's text
source reads any ``.gz`` in one task and does not know the name ``.bgz``.  Here a table of byte ranges is
spread over the cluster and every task inflates the blocks that start within its ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import file_catalog
from .storage import task_opener

#: Compressed bytes per task; variant text unpacks to some five to ten times as much.  Pieces grow with the input, so
#: that there are at most ``MOST_PIECES`` of them.
SPLIT_BYTES = 16 * 1024**2
MOST_PIECES = 100_000


def _reader():
    """The task function.  Nested, so that executors need no copy of this package."""
    opened = task_opener()

    def read(batches):
        import zlib

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        flush_bytes = 4 * 1024**2

        def block_length(head):
            # gzip magic with an extra field of six bytes whose only entry is the block length
            good = head[:4] == b"\x1f\x8b\x08\x04" and head[10:16] == b"\x06\x00BC\x02\x00"
            return int.from_bytes(head[16:18], "little") + 1 if good else 0

        def first_block(f, at, stop, size):
            """Position of the first block at or after ``at`` and before ``stop``, or None."""
            f.seek(at)
            window = f.read(min(stop - at + 18, size - at))
            hit = window.find(b"\x1f\x8b\x08\x04")
            while 0 <= hit < stop - at:
                length = block_length(window[hit : hit + 18])
                if length:
                    f.seek(at + hit + length)
                    following = f.read(18)
                    if not following or block_length(following):
                        return at + hit
                hit = window.find(b"\x1f\x8b\x08\x04", hit + 1)
            return None

        def blocks(f, at):
            """Inflated blocks from ``at`` to the end of the file, with their positions."""
            f.seek(at)
            while head := f.read(18):
                length = block_length(head)
                if not length:
                    raise ValueError(f"no block-gzip block at byte {at}")
                body = f.read(length - 18)
                yield at, zlib.decompress(body, -15)
                at += length

        def line_chunks(path, start, stop, size, first, last):
            """Bytes of the whole lines that belong to the range, in chunks of whole lines.

            A range owns the lines that begin after the first line end in it, and the line that runs
            over its end.  The range at byte zero owns the first line too.  ``first`` says that a line begins
            at that byte of the block at ``start``, and ``last`` is the place where the last line ends: the
            block's position times 65,536 plus a byte in it.
            """
            with opened(path) as f:
                at = first_block(f, start, stop, size) if first is None else start
                if at is None:
                    if start == 0:
                        raise ValueError(f"{path} is not block-gzip compressed")
                    return
                skipping = start > 0 and first is None
                pending, pending_size = [], 0
                for position, data in blocks(f, at):
                    final = last is not None and position >= last >> 16
                    if final:
                        data = data[: last & 0xFFFF] if position == last >> 16 else b""
                    if first is not None and position == start:
                        data = data[first:]
                    if last is None and position >= stop:
                        if skipping:
                            return
                        end = data.find(b"\n")
                        if end < 0:
                            pending.append(data)
                            continue
                        pending.append(data[: end + 1])
                        break
                    if skipping:
                        end = data.find(b"\n")
                        if end < 0:
                            if final:
                                return
                            continue
                        data, skipping = data[end + 1 :], False
                    pending.append(data)
                    if final:
                        break
                    pending_size += len(data)
                    if pending_size >= flush_bytes:
                        text = b"".join(pending)
                        cut = text.rfind(b"\n") + 1
                        if cut:
                            yield text[:cut]
                            pending = [text[cut:]]
                        else:
                            pending = [text]
                        pending_size = len(pending[0])
                text = b"".join(pending)
                if text:
                    yield text

        for batch in batches:
            names = ("path", "start", "stop", "size", "first", "last")
            for piece in zip(*(batch.column(c).to_pylist() for c in names)):
                path = piece[0]
                for chunk in line_chunks(*piece):
                    # Lines end as in the text source: at LF, CR LF or CR.
                    if b"\r" in chunk:
                        chunk = chunk.replace(b"\r\n", b"\n").replace(b"\r", b"\n")
                    ends = np.flatnonzero(np.frombuffer(chunk, np.uint8) == 10) + 1
                    if not chunk.endswith(b"\n"):
                        ends = np.append(ends, len(chunk))
                    offsets = np.concatenate(([0], ends)).astype(np.int32)
                    lines = pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(chunk))
                    yield pa.RecordBatch.from_arrays(
                        [pc.ascii_rtrim(lines, characters="\r\n"), pa.repeat(path, len(lines))],
                        names=["value", "path"],
                    )

    return read


def block_gzip_files(files: DataFrame) -> DataFrame:
    """``path`` of the files that start with a block-gzip block."""
    opened = task_opener()

    def probe(batches):
        import pyarrow as pa

        for batch in batches:
            hits = []
            for path in batch.column("path").to_pylist():
                with opened(path) as f:
                    head = f.read(18)
                if head[:4] == b"\x1f\x8b\x08\x04" and head[10:16] == b"\x06\x00BC\x02\x00":
                    hits.append(path)
            yield pa.RecordBatch.from_arrays([pa.array(hits, pa.string())], names=["path"])

    return files.select("path").mapInArrow(probe, "path string")


def block_splits(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``path, start, stop, size``: byte ranges covering every file of a catalog."""
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1, F.lit(split_bytes).cast("bigint")))
    return (
        files.filter("size > 0")
        .select("path", "size", starts.alias("start"))
        .select("path", "start", F.least(F.col("start") + split_bytes, F.col("size")).alias("stop"), "size")
        .withColumns({"first": F.lit(None).cast("int"), "last": F.lit(None).cast("bigint")})
    )


def read_block_lines(spark: SparkSession, paths: str | Sequence[str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``value, path``: the lines of block-gzip files, one task per byte range.

    The files must lie on a file system that Arrow can open from the executors.
    """
    files = file_catalog(spark, paths, recursive=False).select("path", "size")
    total = files.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count("*").alias("files")).first()
    split_bytes = max(split_bytes, total["bytes"] // MOST_PIECES)
    n = max(1, min(MOST_PIECES, total["bytes"] // split_bytes + total["files"]))
    return read_pieces(block_splits(files, split_bytes), n)


def read_pieces(pieces: DataFrame, tasks: int) -> DataFrame:
    """``value, path``: the lines of ``path, start, stop, size, first, last``, as ``block_splits`` makes them."""
    # By range, so that the pieces spread evenly over the tasks.
    spread = pieces.repartitionByRange(tasks, "path", "start")
    return spread.mapInArrow(_reader(), "value string, path string")
