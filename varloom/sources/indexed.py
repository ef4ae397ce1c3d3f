"""Regions of indexed variant text: only the blocks that the index names are read.

An index (``.tbi``) beside a block-gzip file says where the records of each window of 16,384 positions lie.  Tasks read
the indexes as a table of windows, regions are joined to it by window, and what the joined windows span is cut into pieces
for the block reader.  Neither indexes nor regions pass through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import base_name, is_index_file, plain_path
from ..schema import InfoField
from .blocks import MOST_PIECES, SPLIT_BYTES, read_pieces
from .catalog import file_catalog
from .storage import qualified, scratch_dir, task_opener
from .vcf import parse_lines, resolve_info, vcf_lines

# Fixed values of the index format: its suffix, bits of a window, positions it can hold, and the first bin of windows.
INDEX = ".tbi"
WINDOW_BITS = 14
LAST_POSITION = 2**29
FIRST_LEAF = 4681

#: Rows of one file that ``write_indexed_vcf`` writes; its index is made from all of them in one task.
ROWS_PER_FILE = 1_000_000

_WINDOWS = "path string, chrom string, window bigint, first_place bigint, last_place bigint"


def region_windows(regions: DataFrame) -> DataFrame:
    """``chrom, window, first, last``: a row for each window that a region touches.

    ``regions`` has ``chrom, first, last``, both included; a null bound is open.  Regions without a chromosome, or that end
    before they begin, touch nothing.
    """
    first = F.greatest(F.coalesce(F.col("first").cast("bigint"), F.lit(1)), F.lit(1))
    last = F.least(F.coalesce(F.col("last").cast("bigint"), F.lit(LAST_POSITION)), F.lit(LAST_POSITION))
    bounded = regions.select("chrom", first.alias("first"), last.alias("last")).where("chrom IS NOT NULL AND first <= last")
    windows = F.sequence(F.shiftright(F.col("first") - 1, WINDOW_BITS), F.shiftright(F.col("last") - 1, WINDOW_BITS))
    return bounded.distinct().select("chrom", F.explode(windows).alias("window"), "first", "last")


def within_regions(df: DataFrame, regions: DataFrame) -> DataFrame:
    """Variants that start within one of the regions, each row once."""
    touched = region_windows(regions).withColumnsRenamed({"chrom": "_chrom", "window": "_window"})
    hit = (
        (F.col("chrom") == F.col("_chrom"))
        & (F.shiftright(F.col("start") - 1, WINDOW_BITS) == F.col("_window"))
        & F.col("start").between(F.col("first"), F.col("last"))
    )
    return df.join(touched, hit, "left_semi")


def index_windows(files: DataFrame) -> DataFrame:
    """The indexes of ``path`` as a table: for each window the places between which its records begin.

    A place is the position of a block times 65,536 plus a byte in the inflated block.  Records are sorted, so those that
    begin in a window lie behind those that lie in windows before, and before the first that lies in a later one.
    """
    opened = task_opener()

    def read(batches):
        import gzip
        import struct

        import numpy as np
        import pyarrow as pa

        def contigs(data, path):
            if data[:4] != b"TBI\x01":
                raise ValueError(f"{path}{INDEX} is not an index")
            n, names_size = struct.unpack_from("<i24xi", data, 4)
            names = data[36 : 36 + names_size].split(b"\0")[:n]
            at = 36 + names_size
            for name in names:
                begins, stops, low, high = {}, {}, None, 0
                (n_bins,) = struct.unpack_from("<i", data, at)
                at += 4
                for _ in range(n_bins):
                    number, n_chunks = struct.unpack_from("<Ii", data, at)
                    chunks = np.frombuffer(data, "<u8", 2 * n_chunks, at + 8).astype(np.int64)
                    at += 8 + 16 * n_chunks
                    # Numbers beyond the last window hold counts of records, not places.
                    if n_chunks and number < FIRST_LEAF + (LAST_POSITION >> WINDOW_BITS):
                        begin, stop = int(chunks[::2].min()), int(chunks[1::2].max())
                        low, high = begin if low is None else min(low, begin), max(high, stop)
                        if number >= FIRST_LEAF:
                            begins[number - FIRST_LEAF], stops[number - FIRST_LEAF] = begin, stop
                (n_windows,) = struct.unpack_from("<i", data, at)
                linear = np.frombuffer(data, "<u8", n_windows, at + 4).astype(np.int64)
                at += 4 + 8 * n_windows
                if low is None:
                    continue
                leaves = np.array(sorted(begins), np.int64)
                ends = np.array([begins[w] for w in leaves.tolist()] + [high], np.int64)
                windows = np.arange(n_windows)
                last = ends[np.searchsorted(leaves, windows, "right")]
                # Records of the windows before come before: long ones that reach here need not be read.
                done = np.array([low] + [stops[w] for w in leaves.tolist()], np.int64)
                first = np.maximum(np.maximum.accumulate(linear), done[np.searchsorted(leaves, windows)])
                some = first < last
                yield name.decode(), windows[some], first[some], last[some]

        for batch in batches:
            for path in batch.column("path").to_pylist():
                with opened(path + INDEX) as f:
                    data = gzip.decompress(f.read())
                for chrom, window, first, last in contigs(data, path):
                    columns = [pa.repeat(path, len(window)), pa.repeat(chrom, len(window)), window, first, last]
                    names = ["path", "chrom", "window", "first_place", "last_place"]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return files.select("path").mapInArrow(read, _WINDOWS)


def region_pieces(files: DataFrame, regions: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Pieces, as of ``block_splits``, of the indexed files that hold all records beginning in the regions.

    Spans that meet are read once; a long span is cut like a whole file.
    """
    wanted = region_windows(regions).select("chrom", "window").distinct()
    spans = index_windows(files).join(wanted, ["chrom", "window"], "left_semi")
    # One file's index is the largest group: at most 32,768 windows for each contig.
    order = Window.partitionBy("path").orderBy("first_place")
    before = F.max("last_place").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce((F.col("first_place") > before).cast("int"), F.lit(1))
    merged = (
        spans.withColumn("fresh", fresh)
        .withColumn("span", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("path", "span")
        .agg(F.min("first_place").alias("low"), F.max("last_place").alias("high"))
    )
    low, high = F.shiftright("low", 16), F.shiftright("high", 16)
    starts = F.explode(F.sequence(low, high, F.lit(split_bytes).cast("bigint")))
    cut = merged.join(files.select("path", "size"), "path").select("path", "size", "low", "high", starts.alias("start"))
    final = F.col("start") + split_bytes > high
    return cut.select(
        "path",
        "start",
        F.when(final, high + 1).otherwise(F.col("start") + split_bytes).alias("stop"),
        "size",
        F.when(F.col("start") == low, F.col("low").bitwiseAND(65535)).cast("int").alias("first"),
        F.when(final, F.col("high")).alias("last"),
    )


def read_vcf_regions(
    spark: SparkSession,
    paths: str | Sequence[str],
    regions: DataFrame,
    info_fields: Sequence[str | InfoField] | None = None,
    mode: str = "failfast",
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """The variants of the files that start within ``regions`` (``chrom, first, last``), as ``read_vcf`` gives them.

    Of a block-gzip file with a ``.tbi`` beside it only the blocks of the regions are read; any other file is read whole.
    The indexes must be of the files as they are now.
    """
    info = resolve_info(spark, paths, info_fields)
    found = file_catalog(spark, paths, recursive=False).select("path", "size")
    indexes = found.where(F.col("path").endswith(INDEX)).select(F.regexp_replace("path", r"\.tbi$", "").alias("path"))
    files = found.where(~is_index_file("path"))
    out = scratch_dir(spark, "region_pieces")
    region_pieces(files.join(indexes, "path", "left_semi"), regions, split_bytes).write.parquet(out)
    pieces = spark.read.parquet(out)
    n = pieces.count()
    lines = read_pieces(pieces, max(1, min(n, MOST_PIECES))).select("value", plain_path("path").alias("source_path"))
    whole = [r["path"] for r in files.join(indexes, "path", "left_anti").collect()]
    if whole:
        lines = lines.unionByName(vcf_lines(spark, whole, split_bytes=split_bytes).select("value", "source_path"))
    return within_regions(parse_lines(lines.select("value"), info, mode), regions)


def write_indexed_vcf(
    lines: DataFrame, folder: str, header: Sequence[str], rows_per_file: int = ROWS_PER_FILE
) -> DataFrame:
    """Write VCF lines as sorted block-gzip files with an index each; returns ``path, n_rows``, already written.

    Files are ranges of chromosome and position, so a task holds one range.  A line must have its eight columns.
    """
    spark = lines.sparkSession
    target, opened = qualified(spark, folder).rstrip("/"), task_opener()
    head = "".join(f"{line}\n" for line in header).encode()
    block = 65280

    def write(batches):
        import struct
        import zlib

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        def member(data):
            packer = zlib.compressobj(6, zlib.DEFLATED, -15)
            body = packer.compress(data) + packer.flush()
            fixed = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25)
            return fixed + body + struct.pack("<II", zlib.crc32(data), len(data))

        def bins(low, high):
            """The smallest bin that holds the positions from ``low`` to ``high``, counted from zero."""
            found, first = np.zeros(len(low), np.int64), 1
            for shift in range(26, WINDOW_BITS - 1, -3):
                same = low >> shift == high >> shift
                found[same] = first + (low[same] >> shift)
                first = first * 8 + 1
            return found

        def contig(low, high, begin, after):
            """Bins with the places of their runs of records, then the first place of each window."""
            number = bins(low, high)
            runs = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
            stops = np.append(runs[1:], len(number)) - 1
            chunks = {}
            for i, j in zip(runs.tolist(), stops.tolist()):
                chunks.setdefault(int(number[i]), []).append((int(begin[i]), int(after[j])))
            out = [struct.pack("<i", len(chunks))]
            for name, pairs in sorted(chunks.items()):
                out.append(struct.pack("<Ii", name, len(pairs)) + b"".join(struct.pack("<QQ", *p) for p in pairs))
            top = np.iinfo(np.int64).max
            linear = np.full(int(high.max() >> WINDOW_BITS) + 1, top)
            a, b = low >> WINDOW_BITS, high >> WINDOW_BITS
            np.minimum.at(linear, a, begin)
            for i in np.flatnonzero(b > a).tolist():
                stretch = linear[a[i] + 1 : b[i] + 1]
                np.minimum(stretch, begin[i], out=stretch)
            # A window without records takes the place of the one before.
            empty = linear == top
            linear[empty] = 0
            linear = np.maximum.accumulate(linear)
            return b"".join(out) + struct.pack("<i", len(linear)) + linear.astype("<u8").tobytes()

        kind = pa.large_string()
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        path = f"{target}/part-{TaskContext.get().partitionId():05d}.vcf.gz"
        names, codes, lows, highs, sizes, places, at = [], [], [], [], [], [], 0
        pending = bytearray(head)
        with opened(path, write=True) as f:

            def flush(least):
                nonlocal at, pending
                cut = 0
                while len(pending) - cut >= max(least, 1):
                    packed = member(bytes(pending[cut : cut + block]))
                    places.append(at)
                    at += len(packed)
                    cut += block
                    f.write(packed)
                pending = pending[cut:]

            batch = first
            while batch is not None:
                coded = batch.column("chrom").dictionary_encode()
                # Rows are sorted, so a batch begins with the last name of the one before, or with a new one.
                found = coded.dictionary.to_pylist()
                names += found[1:] if names and names[-1] == found[0] else found
                codes.append(coded.indices.to_numpy() + len(names) - len(found))
                low, n, last = (batch.column(c).to_numpy() for c in ("low", "n", "last"))
                lows.append(low)
                highs.append(np.maximum(low, np.where(last < 0, low + n, last) - 1))
                value = pc.binary_join_element_wise(batch.column("value").cast(kind), pa.scalar("", kind), pa.scalar("\n", kind))
                offsets = np.frombuffer(value.buffers()[1], np.int64, len(value) + 1, 8 * value.offset)
                sizes.append(np.diff(offsets))
                pending += memoryview(value.buffers()[2])[offsets[0] : offsets[-1]]
                if len(pending) >= 16 * block:
                    flush(block)
                batch = next(batches, None)
            flush(1)
            places.append(at)
            f.write(member(b""))
        low, high, code, size = (np.concatenate(c) for c in (lows, highs, codes, sizes))
        ends = len(head) + np.cumsum(size)
        begins = ends - size

        def place(offset):
            return (np.array(places)[offset // block] << 16) + offset % block

        begin, after = place(begins), place(ends)
        encoded = b"".join(n.encode() + b"\0" for n in names)
        # Format 2 is VCF, whose columns 1 and 2 are name and position; headers begin with "#".
        index = [b"TBI\x01" + struct.pack("<8i", len(names), 2, 1, 2, 0, ord("#"), 0, len(encoded)) + encoded]
        for c in range(len(names)):
            mine = code == c
            index.append(contig(low[mine], high[mine], begin[mine], after[mine]))
        data = b"".join(index)
        with opened(path + INDEX, write=True) as f:
            for i in range(0, len(data), block):
                f.write(member(data[i : i + block]))
            f.write(member(b""))
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(size)], pa.int64())], names=["path", "n_rows"])

    cells = F.split("value", "\t", 9)
    # ``END`` is sought only where it can stand; the end of the rest follows from the length of the reference allele.
    last = F.when(F.col("value").contains("END="), F.regexp_extract(F.concat(F.lit(";"), cells[7]), r";END=(\d+)", 1).try_cast("bigint"))
    placed = lines.select(
        "value",
        cells[0].alias("chrom"),
        (cells[1].cast("bigint") - 1).alias("low"),
        F.length(cells[3]).cast("bigint").alias("n"),
        F.coalesce(last, F.lit(-1).cast("bigint")).alias("last"),
    )
    # The lines are made and cut once; counting, choosing the ranges and dealing read what is stored.
    stored = scratch_dir(spark, "placed_lines")
    placed.write.parquet(stored)
    ranged = spark.read.schema(placed.schema).parquet(stored)
    tasks = max(1, -(-ranged.count() // rows_per_file))
    ranged = ranged.repartitionByRange(tasks, "chrom", "low", "value").sortWithinPartitions("chrom", "low")
    written = ranged.mapInArrow(write, "path string, n_rows bigint")
    # Once: the frame that is returned must not write again.
    written.write.mode("overwrite").parquet(f"{folder.rstrip('/')}-files")
    return spark.read.parquet(f"{folder.rstrip('/')}-files")
