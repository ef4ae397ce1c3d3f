"""Exact repeats of word windows across all documents, found from fixed-block anchors.

Every window of ``window`` words holds a block of ``(window + 1) // 2`` words that begins at a multiple of that
size.  Only such blocks are indexed; every rolling block of every text probes the index.  Around each hit, and
around the indexed block it hit, the windows themselves are compared, which extends the hit to its maximal exact
repeat: the union of its repeated windows.

Blocks and windows travel as hashes, packed per piece of text and hash range, and a piece first combines its own
copies, so that a block that occurs everywhere costs a few entries per piece.  Nothing is compared pair by pair: the
earliest place of each hash decides.  Windows are compared by 64-bit hashes; among n windows a false repeat is
expected n * n / 2**65 times.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .places import (
    PLACES,
    by_document,
    covered,
    pack_entries,
    positions,
    slotted,
    unpack_places,
    with_positions,
)
from .tables import kept
from .text import Words, flat, hand_back, rolling, slices

#: Bytes of text that are hashed, and that are cut, in one step.
PIECE, CUT = 4 << 20, 2 << 20
#: Bytes of text for each hash range.
RANGE = 16 << 20

_PACKED = ["part", "index_places", "index_hashes", "places", "hashes"]
PACKED = "part int, index_places binary, index_hashes binary, places binary, hashes binary"


def hash_ranges(texts: DataFrame) -> int:
    """How many hash ranges the windows of these texts are dealt over."""
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, math.ceil(total / RANGE))


def _five(h: np.ndarray) -> bytes:
    return np.ascontiguousarray(h.view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _from_bytes(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view(np.uint64).reshape(-1)


def _part(h: np.ndarray, parts: int) -> np.ndarray:
    return ((h >> np.uint64(40)) % np.uint64(parts)).astype(np.int32)


class _Dealt:
    """Entries of one piece of text, ordered by hash range and, within one, by place."""

    def __init__(self, doc: np.ndarray, pos: np.ndarray, h: np.ndarray, parts: int, pack):
        part = _part(h, parts)
        order = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
        self.doc, self.pos, self.h, self.part, self.pack = doc[order], pos[order], h[order], part[order], pack

    def packed(self, used: np.ndarray) -> tuple[list[bytes], list[bytes]]:
        """Places and hashes of each of the ranges."""
        spans = list(zip(np.searchsorted(self.part, used), np.searchsorted(self.part, used, "right")))
        return [pack_entries(self.doc[a:b], self.pos[a:b]) for a, b in spans], [self.pack(self.h[a:b]) for a, b in spans]


def nothing(parts: int) -> _Dealt:
    none = np.zeros(0, np.int64)
    return _Dealt(none, none, np.zeros(0, np.uint64), parts, bytes)


def _rows(index: _Dealt, probe: _Dealt) -> pa.RecordBatch:
    """A row for each range that has an entry: its size goes with its entries, whatever the number of ranges."""
    used = np.union1d(index.part, probe.part)
    columns = [pa.array(c, pa.binary()) for c in (*index.packed(used), *probe.packed(used))]
    return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *columns], _PACKED)


def _local_rows(doc: np.ndarray, pos: np.ndarray, parts: int) -> pa.RecordBatch:
    """Places found inside a piece: they pass the ranges unchanged, marked by a negative part."""
    found = slotted(doc, pos, parts)
    n = found.num_rows
    none = pa.array([None] * n, pa.binary())
    part = pa.array(-1 - np.array(found.column("slot")), pa.int32())
    return pa.RecordBatch.from_arrays([part, none, none, found.column("places"), none], _PACKED)


def _piece(batch: pa.RecordBatch, shortest: int):
    """Words of a piece, hashes, document ids, positions, room to the end of the text; None if no text is long enough."""
    words = Words(*flat(batch.column("text")))
    if not (words.count >= shortest).any():
        return None
    text = words.text_of()
    ids = np.array(batch.column("doc_id"), np.int64)
    return words, words.hashes(), ids, text, np.arange(len(words)) - words.first[text]


def _anchor_pieces(window: int, parts: int):
    """Tasks: indexed blocks and probes of each piece of text, without those that the piece itself decides."""
    block = (window + 1) // 2

    def run(batches):
        for batch in batches:
            for piece in slices(batch, "text", PIECE):
                made = _piece(piece, window)
                if made is None:
                    continue
                words, h, ids, text, pos = made
                room = words.count[text] - pos
                fits = np.flatnonzero((room >= block) & (words.count[text] >= window))
                value = rolling(h, block)[fits]
                # Places compare as the document's rank in this piece and the position.
                rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
                place = (rank[text[fits]] << 32) | pos[fits]
                indexed = pos[fits] % block == 0
                at = np.flatnonzero(indexed)
                order = at[np.lexsort((place[at], value[at]))]
                first = np.concatenate([[True], value[order][1:] != value[order][:-1]])
                known, earliest = value[order][first], order[first]
                near = np.minimum(np.searchsorted(known, value), len(known) - 1)
                hit = (known[near] == value) & (place[earliest[near]] < place)
                found = hit.copy()
                found[earliest[near[hit]]] = True
                f = np.flatnonzero(found)
                if len(f):
                    yield _local_rows(ids[text[fits[f]]], pos[fits[f]], parts)
                lead = np.zeros(len(fits), bool)
                lead[earliest] = True
                lead, rest = np.flatnonzero(lead), np.flatnonzero(~hit & ~indexed)
                yield _rows(
                    *(_Dealt(ids[text[fits[i]]], pos[fits[i]], value[i], parts, _five) for i in (lead, rest))
                )

    return run


def _places(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Document ids and positions of the entries of all rows, one row after the other."""
    both = [unpack_places(raw) for raw in packed]
    return np.concatenate([b[0] for b in both]), np.concatenate([b[1] for b in both])


def _meet_anchors(parts: int):
    """One hash range: probes that an earlier indexed block equals, and those indexed blocks."""

    def run(table: pa.Table) -> pa.Table:
        if table.column("part")[0].as_py() < 0:
            return _passed(table)
        doc, pos = _places(table.column("index_places").to_pylist())
        h = _from_bytes(b"".join(table.column("index_hashes").to_pylist()), 5)
        order = np.lexsort((pos, doc, h))
        doc, pos, h = doc[order], pos[order], h[order]
        first = np.concatenate([[True], h[1:] != h[:-1]])[: len(h)]
        used = np.zeros(int(first.sum()), bool)
        later = ~first & ((doc != doc[_lead(first)]) | (pos != pos[_lead(first)]))
        used[(np.cumsum(first) - 1)[later]] = True
        out = [(doc[later], pos[later])]
        known, known_doc, known_pos = h[first], doc[first], pos[first]
        for raw, x in zip(table.column("places").to_pylist(), table.column("hashes").to_pylist()):
            value = _from_bytes(x, 5)
            if not len(value) or not len(known):
                continue
            near = np.minimum(np.searchsorted(known, value), len(known) - 1)
            same = np.flatnonzero(known[near] == value)
            if not len(same):
                continue
            pdoc, ppos = unpack_places(raw)
            near, pdoc, ppos = near[same], pdoc[same], ppos[same]
            hit = (known_doc[near] < pdoc) | ((known_doc[near] == pdoc) & (known_pos[near] < ppos))
            used[near[hit]] = True
            out.append((pdoc[hit], ppos[hit]))
        out.append((known_doc[used], known_pos[used]))
        return _as_places(out, parts)

    return run


def _lead(first: np.ndarray) -> np.ndarray:
    """For every row of an ordered table the first row of its group."""
    return np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))


def _as_places(found, parts: int) -> pa.Table:
    hand_back()
    doc, pos = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
    return pa.Table.from_batches([slotted(doc, pos, parts)])


def _passed(table: pa.Table) -> pa.Table:
    slot = [-1 - p for p in table.column("part").to_pylist()]
    return pa.table({"slot": pa.array(slot, pa.int32()), "places": table.column("places")})


def _window_pieces(window: int, parts: int):
    """Tasks: the windows around hits, the earliest of equal ones in each piece of text; the others are repeats."""
    block = (window + 1) // 2

    def run(batches):
        for batch in batches:
            for piece in slices(batch, "text", PIECE):
                made = _piece(piece, window)
                if made is None:
                    continue
                words, h, ids, text, pos = made
                near = np.zeros(len(words) + 1, np.int64)
                for i, raw in enumerate(piece.column("positions").to_pylist()):
                    at = positions(raw)
                    at = at[at < words.count[i]] + words.first[i]
                    np.add.at(near, np.maximum(at - (window - block), words.first[i]), 1)
                    np.add.at(near, at + 1, -1)
                fits = np.flatnonzero((np.cumsum(near[:-1]) > 0) & (words.count[text] - pos >= window))
                if not len(fits):
                    continue
                value = rolling(h, window)[fits]
                rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
                place = (rank[text[fits]] << 32) | pos[fits]
                order = np.lexsort((place, value))
                first = np.concatenate([[True], value[order][1:] != value[order][:-1]])
                same = place[order] == place[order][_lead(first)]
                repeat = order[~same]
                if len(repeat):
                    yield _local_rows(ids[text[fits[repeat]]], pos[fits[repeat]], parts)
                lead = np.sort(order[first])
                at = fits[lead]
                yield _rows(nothing(parts), _Dealt(ids[text[at]], pos[at], value[lead], parts, np.ndarray.tobytes))

    return run


def _meet_windows(parts: int):
    """One hash range: windows that are not the earliest of their hash."""

    def run(table: pa.Table) -> pa.Table:
        if table.column("part")[0].as_py() < 0:
            return _passed(table)
        doc, pos = _places(table.column("places").to_pylist())
        h = np.frombuffer(b"".join(table.column("hashes").to_pylist()), np.uint64)
        order = np.lexsort((pos, doc, h))
        doc, pos, h = doc[order], pos[order], h[order]
        lead = _lead(np.concatenate([[True], h[1:] != h[:-1]])[: len(h)])
        later = (doc != doc[lead]) | (pos != pos[lead])
        return _as_places([(doc[later], pos[later])], parts)

    return run


def repeated_windows(docs: DataFrame, window: int = 50) -> DataFrame:
    """``doc_id, positions``: the word positions at which a window starts whose words also start earlier.

    Earlier is a smaller doc_id, or an earlier position of the same document.  Words are runs of anything but space
    and the controls 09 to 0D; windows never cross documents.  ``positions`` is read by ``places.positions``.
    Documents without such a window, null or shorter texts and rows without doc_id have no row.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.where("doc_id IS NOT NULL AND text IS NOT NULL")
    parts = hash_ranges(texts)
    anchors = texts.mapInArrow(_anchor_pieces(window, parts), PACKED)
    hits = anchors.groupBy("part").applyInArrow(_meet_anchors(parts), PLACES)
    hits = kept(by_document(hits), "hits")
    around = with_positions(texts, hits, "inner").select("doc_id", "text", "positions")
    windows = around.mapInArrow(_window_pieces(window, parts), PACKED)
    return by_document(windows.groupBy("part").applyInArrow(_meet_windows(parts), PLACES))


def _cut(window: int):
    def run(batches):
        import hashlib

        for batch in batches:
            for piece in slices(batch, "text", CUT):
                words = Words(*flat(piece.column("text")))
                n_removed, digest, text = [], [], []
                raw = words.bytes
                joined = None
                for i, (packed, whole) in enumerate(zip(piece.column("positions"), piece.column("text"))):
                    a, b = words.first[i], words.first[i + 1]
                    at = positions(packed.as_py())
                    gone = covered(at, window, b - a)
                    keep = np.flatnonzero(~gone) + a
                    if joined is None:
                        joined = _joined(words)
                    body, begin, end = joined
                    if len(keep) == b - a:
                        kept_bytes = body[begin[a] : end[b - 1]].tobytes() if b > a else b""
                        text.append(whole.as_py())
                    else:
                        kept_bytes = b" ".join(_stretches(body, begin, end, keep))
                        text.append(b"".join(_original(raw, words, keep, b)).decode("utf-8", "replace"))
                    n_removed.append(int(gone.sum()))
                    digest.append(hashlib.sha256(kept_bytes).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("row"),
                        pa.array(text, pa.string()),
                        pa.array(words.count),
                        pa.array(n_removed, pa.int64()),
                        pa.array(digest),
                    ],
                    ["row", "kept_text", "n_words", "n_removed", "kept_sha256"],
                )

    return run


def _joined(words: Words):
    """All words with one space after each, and where each begins and ends there."""
    length = words.end - words.start
    begin = np.cumsum(length + 1) - (length + 1)
    total = int((length + 1).sum())
    out = np.full(total, 0x20, np.uint8)
    inside = np.repeat(begin - words.start, length)
    source = np.arange(int(length.sum())) + np.repeat(words.start - (np.cumsum(length) - length), length)
    out[source + inside] = words.bytes[source]
    return out, begin, begin + length


def _runs(keep: np.ndarray):
    if not len(keep):
        return []
    cut = np.flatnonzero(np.diff(keep) > 1)
    return zip(keep[np.concatenate([[0], cut + 1])], keep[np.append(cut, len(keep) - 1)])


def _stretches(body, begin, end, keep):
    return [body[begin[i] : end[j]].tobytes() for i, j in _runs(keep)]


def _original(raw, words, keep, stop):
    """The kept words with the white space that followed each in the text."""
    out = []
    for i, j in _runs(keep):
        last = words.end[j] if j + 1 >= stop else words.start[j + 1]
        out.append(raw[words.start[i] : last].tobytes())
    return out


def remove_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """``docs`` with ``text`` cut to the words outside repeated windows, and ``n_words, n_removed, kept_sha256``.

    A word goes if a window of ``window`` words that covers it also starts earlier (see ``repeated_windows``), judged
    on the input.  ``kept_sha256`` is over the kept words joined by one space.  Texts that lose nothing stay as they
    are, null included.  Rows without doc_id are kept whole.  Rows that repeat a doc_id are one document, whose
    repeats are removed from each of them.  Columns named like the three new ones are replaced; an empty table gives
    no rows.
    """
    found = kept(repeated_windows(docs, window), "repeats")
    new = ["n_words", "n_removed", "kept_sha256"]
    old = [c for c in docs.columns if c not in (*new, "text")]
    rows = docs.select(F.struct(*old).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = with_positions(rows, found, "left").select("row", F.col("text").cast("string").alias("text"), "positions")
    schema = T.StructType(list(rows.select("row").schema)).add("kept_text", "string").add("n_words", "long")
    schema = schema.add("n_removed", "long").add("kept_sha256", "string")
    out = rows.mapInArrow(_cut(window), schema)
    back = [F.col("kept_text").alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns if c not in new]
    return out.select(*back, *new)
