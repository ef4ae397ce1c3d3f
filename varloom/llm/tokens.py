"""Token ids of documents in Arrow files of equal-length sequences.

Documents are dealt by ranges of doc_id, so that the files in their order hold all documents in ascending doc_id
order.  Each file is an Arrow IPC file of batches of fixed-size lists: ``ids`` and ``mask`` (false where the last
sequence is filled up).  With a fixed number of sequences per batch, sequence k is row ``k % BATCH`` of batch
``k // BATCH`` and can be mapped into memory without a copy.  An index table holds the place of every document.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.storage import scratch_dir
from .tables import BROADCAST_IDS, kept
from .text import LOWER, Remembered, Words, flat, hash_spans, slices

#: Ids of a sequence, and sequences of a batch.
SEQUENCE, BATCH = 2048, 512
#: Bytes of text of a file.
FILE_BYTES = 64 << 20
#: Files whose ids are added up by one task.
GROUP = 4096
_LEAST = -(2**63)
#: Bytes of remembered words and their ids in a task, before it forgets all.
REMEMBERED = 64 << 20

INDEX = "doc_id long, part int, path string, first long, n_tokens long"


class Encoder:
    """Ids of texts by a tokenizer that works on white-space separated words, each distinct word encoded once.

    ASCII letters are lower-cased first where the tokenizer does so itself (``lower``), and dots and commas behind an
    ASCII letter or digit are words of their own, as the tokenizer parts them there too.  Words with ``<`` stay as
    they are, as special tokens may be in them.
    """

    def __init__(self, path: str, lower: bool = True):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.lower = lower
        self.known = Remembered(REMEMBERED, np.uint32)

    def _learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = [], []
        for begin in range(0, len(words), 20_000):
            some = [e.ids for e in self.tokenizer.encode_batch(words[begin : begin + 20_000], add_special_tokens=False)]
            counts.append(np.fromiter(map(len, some), np.int64, len(some)))
            ids.append(np.fromiter((i for x in some for i in x), np.uint32, int(counts[-1].sum())))
        return np.concatenate(ids), np.concatenate(counts)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has."""
        data, offsets = flat(texts)
        words = Words(data, offsets)
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        body, start, end = words.bytes, words.start, words.end
        if self.lower:
            body = LOWER[body]
            for i in np.unique(np.searchsorted(start, np.flatnonzero(data == ord("<")), "right") - 1):
                body[start[i] : end[i]] = words.bytes[start[i] : end[i]]
        core = end.copy()
        for _ in range(4):
            last = body[core - 1]
            core -= ((last == ord(".")) | (last == ord(","))) & (core - start > 1)
        before = body[core - 1]
        plain = ((before >= 97) & (before <= 122)) | ((before >= 48) & (before <= 57))
        core = np.where(plain & (core < end), core, end)
        tail = np.flatnonzero(core < end)
        at = np.arange(len(start)) + np.searchsorted(tail, np.arange(len(start)))
        begins, ends = np.zeros(len(start) + len(tail), np.int64), np.zeros(len(start) + len(tail), np.int64)
        begins[at], ends[at] = start, core
        begins[at[tail] + 1], ends[at[tail] + 1] = core[tail], end[tail]
        text_of = np.zeros(len(begins), np.int64)
        text_of[at] = words.text_of()
        text_of[at[tail] + 1] = text_of[at[tail]]

        distinct, first, which = np.unique(hash_spans(body, begins, ends), return_index=True, return_inverse=True)
        raw = body.tobytes()

        def learn(new: np.ndarray):
            return self._learn([raw[begins[i] : ends[i]].decode() for i in first[new]])

        numbers = self.known.numbers_of(distinct, learn)
        ids, size = self.known.ids_of(numbers[which])
        return ids, np.bincount(text_of, weights=size, minlength=len(texts)).astype(np.int64)


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, lower: bool = True) -> Encoder:
    if (path, lower) not in _ENCODERS:
        _ENCODERS[path, lower] = Encoder(path, lower)
    return _ENCODERS[path, lower]


def filesystem(path: str):
    """The Arrow file system of a path, and the path inside it."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        plain = "file://" + path[len("file:") :] if path.startswith("file:/") and "://" not in path else path
        return fs.FileSystem.from_uri(plain.replace("s3a://", "s3://", 1))
    return fs.LocalFileSystem(), path


class _Writer:
    """One file: ids come in any portions and leave in full batches."""

    def __init__(self, folder: str, part: int, wide: bool):
        self.path = f"{folder}/part-{part:07d}-{uuid.uuid4().hex}.arrow"
        system, inner = filesystem(self.path)
        system.create_dir(inner.rpartition("/")[0], recursive=True)
        self.kind = pa.uint32() if wide else pa.uint16()
        self.schema = pa.schema(
            [("ids", pa.list_(self.kind, SEQUENCE)), ("mask", pa.list_(pa.bool_(), SEQUENCE))], {"sequence": str(SEQUENCE)}
        )
        self.stream = system.open_output_stream(inner)
        self.file = pa.ipc.new_file(self.stream, self.schema)
        self.held: list[np.ndarray] = []
        self.n_held = self.written = 0

    def add(self, ids: np.ndarray):
        self.held.append(ids)
        self.n_held += len(ids)
        while self.n_held >= SEQUENCE * BATCH:
            self._flush(SEQUENCE * BATCH)

    def _flush(self, n: int):
        ids = np.concatenate(self.held)
        self.held = [ids[n:]]
        self.n_held -= n
        rows = -(-n // SEQUENCE)
        body, mask = np.zeros(rows * SEQUENCE, self.kind.to_pandas_dtype()), np.zeros(rows * SEQUENCE, bool)
        body[:n], mask[:n] = ids[:n], True
        arrays = [pa.FixedSizeListArray.from_arrays(pa.array(x), SEQUENCE) for x in (body, mask)]
        self.file.write_batch(pa.RecordBatch.from_arrays(arrays, schema=self.schema))

    def close(self):
        if self.n_held:
            self._flush(self.n_held)
        self.file.close()
        self.stream.close()


def _press(bounds: np.ndarray):
    """Tasks: the file of each document, and its text compressed for the way between tasks; null is empty."""

    def run(batches):
        import zstandard

        for batch in batches:
            press = zstandard.ZstdCompressor(level=1)
            texts = [press.compress((t or "").encode()) for t in batch.column("text").to_pylist()]
            ids = batch.column("doc_id")
            part = np.searchsorted(bounds, np.array(ids.fill_null(_LEAST), np.int64), "right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([ids, pa.array(part), pa.array(texts, pa.binary())], ["doc_id", "part", "text"])

    return run


def _bounds(ids: DataFrame, files: int) -> np.ndarray:
    """The least doc_id of every file but the first: ranges of about as many rows, eight bytes for each file."""
    if files == 1:
        return np.zeros(0, np.int64)
    dealt = ids.where("doc_id IS NOT NULL").repartitionByRange(files, "doc_id")
    least = dealt.groupBy(F.spark_partition_id().alias("range")).agg(F.min("doc_id").alias("least"))
    return np.sort(np.array([r.least for r in least.collect()], np.int64))[1:]


def _opened(batch, press):
    """Portions of a batch with their texts as they were."""
    for begin in range(0, batch.num_rows, 512):
        some = batch.slice(begin, 512)
        texts = pa.array([press.decompress(t).decode() for t in some.column("text").to_pylist()], pa.large_string())
        columns = [some.column("doc_id"), some.column("part"), texts]
        yield from slices(pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "text"]), "text", 4 << 20)


def _write(folder: str, tokenizer: str, lower: bool, end_id: int):
    """Tasks: rows ordered by part and doc_id become files; a row of ``INDEX`` for each document."""

    def run(batches):
        import zstandard

        encode = encoder(tokenizer, lower)
        writer, part, first = None, None, 0
        for batch in batches:
            press = zstandard.ZstdDecompressor()
            for piece in _opened(batch, press):
                ids, counts = encode.encode(piece.column("text"))
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id)
                counts = counts + 1
                parts = np.array(piece.column("part"))
                cut = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]]))
                paths, firsts = [], []
                stops, edge = np.append(cut[1:], len(parts)), np.concatenate([[0], np.cumsum(counts)])
                for a, b in zip(cut, stops):
                    if part != parts[a]:
                        if writer:
                            writer.close()
                        part, first = parts[a], 0
                        writer = _Writer(folder, int(part), encode.wide)
                    writer.add(ids[edge[a] : edge[b]])
                    paths += [writer.path] * int(b - a)
                    firsts.append(first + edge[a:b] - edge[a])
                    first += int(edge[b] - edge[a])
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        piece.column("part"),
                        pa.array(paths),
                        pa.array(np.concatenate(firsts)),
                        pa.array(counts),
                    ],
                    ["doc_id", "part", "path", "first", "n_tokens"],
                )
        if writer:
            writer.close()

    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int, lower: bool = True) -> DataFrame:
    """Write the ids of all texts to files in ``folder``; returns the stored index (``INDEX``), a row per document.

    ``tokenizer`` is the path of a ``tokenizers`` file that every executor has.  Each document ends with ``end_id``; a
    null or empty text is that id alone.  Rows without doc_id come first; rows that repeat a doc_id follow each other.
    Only files that the index names are valid: a task that is run again writes new ones.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // FILE_BYTES))
    bounds = _bounds(texts.select("doc_id"), n)
    parted = texts.mapInArrow(_press(bounds), "doc_id long, part int, text binary")
    ordered = parted.repartition(n, "part").sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "text")
    return kept(ordered.mapInArrow(_write(folder, tokenizer, lower, end_id), INDEX), "token_index")


def _read(batches):
    """Tasks: crc32 of the ids of each indexed document, read from the files."""
    path, file, stream = None, None, None
    for batch in batches:
        paths, first, count = batch.column("path").to_pylist(), np.array(batch.column("first")), np.array(batch.column("n_tokens"))
        crc = np.zeros(len(first), np.int64)
        at, held, held_first = 0, np.zeros(0, np.uint32), 0
        for i in range(len(first)):
            if paths[i] != path:
                if stream:
                    stream.close()
                path = paths[i]
                system, inner = filesystem(path)
                stream = pa.memory_map(inner) if system.type_name == "local" else system.open_input_file(inner)
                file = pa.ipc.open_file(stream)
                at, held, held_first = 0, np.zeros(0, np.uint32), 0
            begin, end = int(first[i]), int(first[i] + count[i])
            while held_first + len(held) < end:
                at = (held_first + len(held)) // (SEQUENCE * BATCH) if len(held) else begin // (SEQUENCE * BATCH)
                if not len(held):
                    held_first = at * SEQUENCE * BATCH
                rows = file.get_batch(at)
                ids = np.array(rows.column("ids").flatten())[np.array(rows.column("mask").flatten())]
                keep = max(0, min(begin - held_first, len(held)))
                held, held_first = np.concatenate([held[keep:], ids]), held_first + keep
            crc[i] = zlib.crc32(held[begin - held_first : end - held_first].astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(crc)],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def _bases(index: DataFrame) -> DataFrame:
    """``part, base``: the ids of all files before each, as a running sum within groups of files and one over the groups."""
    sizes = index.groupBy("part").agg(F.sum("n_tokens").alias("ids"))
    sizes = kept(sizes.withColumn("files", F.expr(f"part div {GROUP}")), "file_sizes")
    ahead = Window.rowsBetween(Window.unboundedPreceding, -1)
    inside = sizes.withColumn("inside", F.sum("ids").over(ahead.partitionBy("files").orderBy("part")))
    groups = sizes.groupBy("files").agg(F.sum("ids").alias("ids"))
    groups = groups.select("files", F.sum("ids").over(ahead.orderBy("files")).alias("outside"))
    base = F.coalesce("inside", F.lit(0)) + F.coalesce("outside", F.lit(0))
    return inside.join(groups, "files").select("part", base.alias("base"))


def read_tokens(index: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document of an index, from its files.

    ``start`` counts the ids of all documents before it, over all files.
    """
    base = kept(_bases(index), "file_bases")
    files = max(1, base.count())
    placed = index.join(F.broadcast(base) if files <= BROADCAST_IDS else base, "part")
    placed = placed.withColumn("start", F.col("base") + F.col("first"))
    ordered = placed.repartition(min(files, 10_000), "part").sortWithinPartitions("part", "first")
    ordered = ordered.select("doc_id", "path", "first", "start", "n_tokens")
    return ordered.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokens_folder(spark) -> str:
    return scratch_dir(spark, "tokens")
