"""Exact repeats of byte windows, from merged Burrows-Wheeler transforms of shards.

Moving every suffix of a corpus is out of reach, so suffixes are compared only where a repeat is possible.  In every
window of ``window`` bytes the ``window // 2``-byte string of least hash is an anchor; equal windows have equal anchors
at equal places.  Anchors that occur once are dropped.  Around each other one, the bytes that a window with it can
reach are kept: up to half a window on either side.  The anchor itself counts as one symbol.

A piece of text gives, for each range of anchor hashes, one shard: the transform of its strings, that is, for every
depth the symbols that come next to the left, in the order of what stands to the right of them.  A task merges the
shards of its range without sorting suffixes anew: it begins with the shards one after the other and refines the
interleave symbol by symbol, each time dealing the merged transform stably by its symbols.  Common prefixes follow by
the same step, as one more than the least common prefix of what lay between.  At each place a window can begin, strings
whose common prefix spans the window form the repeated intervals; all but the earliest of an interval are repeats.

Equal strings of a piece are combined first, so a passage that is everywhere costs one string per piece.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .places import PLACES, by_document, pack_entries, positions, unpack_places, with_positions
from .substring import (
    PACKED,
    _as_places,
    _Dealt,
    _five,
    _from_bytes,
    _lead,
    _local_rows,
    _part,
    _passed,
    _places,
    _rows,
    hash_ranges,
    nothing,
)
from .tables import kept
from .text import flat, hash_spans, mix, rolling, slices

PIECE = 2 << 20
#: A byte that UTF-8 has no use for stands beyond the ends of a text.
_BEYOND = 0xFF
_SHARD = ["part", "places", "anchors", "symbols"]
SHARD = "part int, places binary, anchors binary, symbols binary"
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``width`` neighbours."""
    size, out = 1, x
    while size * 2 <= width:
        out = pick(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return pick(out[:-rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of all texts."""
    size = window // 2
    spread = window - size + 1
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(data) < window:
        return none
    h = rolling(_BYTE[data], size)
    least = _sliding(h, spread, np.minimum)
    n = np.diff(offsets)
    room = np.repeat(offsets[1:], n)[: len(least)] - np.arange(len(least))
    least = np.where(room >= window, least, np.uint64(0))
    padded = np.concatenate([np.zeros(spread - 1, np.uint64), least, np.zeros(spread - 1, np.uint64)])
    at = np.flatnonzero((_sliding(padded, spread, np.maximum) == h) & (h > 0))
    return at, h[at]


def _anchor_pieces(window: int, parts: int):
    """Tasks: one entry for each distinct anchor of a piece; anchors that the piece repeats are found at once."""

    def run(batches):
        for batch in batches:
            for piece in slices(batch, "text", PIECE):
                data, offsets = flat(piece.column("text"))
                at, h = anchors(data, offsets, window)
                if not len(at):
                    continue
                ids = np.array(piece.column("doc_id"), np.int64)
                order = np.argsort(h, kind="stable")
                head = np.concatenate([[True], h[order][1:] != h[order][:-1]])
                size = np.diff(np.append(np.flatnonzero(head), len(order)))
                again = np.sort(order[np.repeat(size > 1, size)])
                text = np.searchsorted(offsets, at[again], "right") - 1
                if len(again):
                    yield _local_rows(ids[text], at[again] - offsets[text], parts)
                lead = np.sort(order[head])
                text = np.searchsorted(offsets, at[lead], "right") - 1
                yield _rows(nothing(parts), _Dealt(ids[text], at[lead] - offsets[text], h[lead], parts, _five))

    return run


def _meet_anchors(parts: int):
    """One hash range: anchors that more than one piece has."""

    def run(table: pa.Table) -> pa.Table:
        if table.column("part")[0].as_py() < 0:
            return _passed(table)
        packed, hashes = (table.column(c).to_pylist() for c in ("places", "hashes"))
        h = _from_bytes(b"".join(hashes), 5)
        order = np.argsort(h, kind="stable")
        same = np.concatenate([[False], h[order][1:] == h[order][:-1]])[: len(h)]
        both = same.copy()
        both[:-1] |= same[1:]
        twice = np.zeros(len(h), bool)
        twice[order] = both
        found, at = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0
        for raw, x in zip(packed, hashes):
            n = len(x) // 5
            if twice[at : at + n].any():
                doc, pos = unpack_places(raw)
                found.append((doc[twice[at : at + n]], pos[twice[at : at + n]]))
            at += n
        return _as_places(found, parts)

    return run


def _intervals(doc: np.ndarray, pos: np.ndarray, repeat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of window starts as single numbers: ``start << 16 | length``.

    ``repeat[i, j]``: the window that begins ``j`` bytes before anchor ``i`` is a repeat.
    """
    edge = np.diff(np.pad(repeat.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(edge == 1)
    _, last = np.nonzero(edge == -1)
    return doc[row], ((pos[row] - last + 1) << 16) | (last - first)


def _usable(left: np.ndarray, right: np.ndarray, side: int) -> np.ndarray:
    """Which windows lie inside the text, by how many bytes before the anchor they begin."""
    j = np.arange(side + 1)
    return (j <= left[:, None]) & (side - j <= right[:, None])


def _shards(window: int, parts: int):
    """Tasks: the transforms of the strings around the anchors of each piece."""
    size = window // 2
    side = window - size

    def run(batches):
        for batch in batches:
            for piece in slices(batch, "text", PIECE):
                data, offsets = flat(piece.column("text"))
                ids, n = np.array(piece.column("doc_id"), np.int64), np.diff(offsets)
                found = [positions(raw) for raw in piece.column("positions").to_pylist()]
                found = [p[p + size <= m] for p, m in zip(found, n)]
                text = np.repeat(np.arange(len(n)), [len(p) for p in found])
                pos = np.concatenate(found)
                left, right = np.minimum(pos, side), np.minimum(n[text] - pos - size, side)
                fits = left + right >= side
                text, pos, left, right = text[fits], pos[fits], left[fits], right[fits]
                if not len(text):
                    continue
                at = offsets[text] + pos
                padded = np.concatenate([data, np.zeros(16, np.uint8)])
                anchor = hash_spans(padded, at, at + size, most=4096)
                k = np.arange(side)
                # Nearest to the anchor first, on either side.
                near = np.full((len(at), 2 * side), _BEYOND, np.uint8)
                index, inside = at[:, None] - 1 - k, k < left[:, None]
                near[:, :side][inside] = data[index[inside]]
                index, inside = at[:, None] + size + k, k < right[:, None]
                near[:, side:][inside] = data[index[inside]]

                rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
                place = (rank[text] << 32) | pos
                row = np.arange(len(at)) * (2 * side)
                flat_rows = np.concatenate([near.reshape(-1), np.zeros(16, np.uint8)])
                whole = mix(hash_spans(flat_rows, row, row + 2 * side, most=1 << 20) + anchor)
                order = np.lexsort((place, whole))
                lead = _lead(np.concatenate([[True], whole[order][1:] != whole[order][:-1]]))
                first = lead == np.arange(len(order))
                copy = order[~first]
                later = copy[place[copy] != place[order[lead[~first]]]]
                if len(later):
                    usable = _usable(left[later], right[later], side)
                    yield _local_rows(*_intervals(ids[text[later]], pos[later], usable), parts)

                # Strings by hash range, then by place; their order then changes symbol by symbol.
                own = np.sort(order[first])
                used, part = np.unique(_part(mix(anchor[own]), parts), return_inverse=True)
                part = part.astype(np.uint16 if len(used) <= 1 << 16 else np.int32)
                order = np.argsort(part, kind="stable")
                own, part = own[order], part[order]
                cut = np.searchsorted(part, np.arange(len(used) + 1))
                columns, strings = [], near[own]
                now = np.arange(len(own))
                for depth in range(2 * side, -1, -1):
                    if depth == side:
                        columns.append(anchor[own][now])
                        key = np.unique(columns[-1], return_inverse=True)[1]
                    else:
                        key = strings[now, depth - 1 if depth > side else side - 1 - depth]
                        columns.append(key)
                    now = now[np.argsort(key, kind="stable")]
                    now = now[np.argsort(part[now], kind="stable")]
                yield _shard_rows(used, cut, ids[text[own]], pos[own], columns, side)

    return run


def _shard_rows(used, cut, doc, pos, columns, side) -> pa.RecordBatch:
    import zlib

    symbols = np.stack([c for i, c in enumerate(columns) if i != side])
    rows = []
    for a, b in zip(cut[:-1], cut[1:]):
        packed = zlib.compress(np.ascontiguousarray(symbols[:, a:b]).tobytes(), 1)
        rows.append((pack_entries(doc[a:b], pos[a:b]), columns[side][a:b].tobytes(), packed))
    arrays = [pa.array(used, pa.int32()), *(pa.array([r[k] for r in rows], pa.binary()) for k in range(3))]
    return pa.RecordBatch.from_arrays(arrays, _SHARD)


def _dealt_local(batches):
    """Places found in a piece in the columns of ``SHARD``."""
    for batch in batches:
        if "symbols" in batch.schema.names:
            yield batch
        else:
            none = pa.array([None] * batch.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("places"), none, none], _SHARD)


class _Least:
    """Least values of spans of an array."""

    def __init__(self, x: np.ndarray):
        levels, size = [x], 1
        while size * 2 <= len(x):
            low = levels[-1].copy()
            low[: len(x) - size] = np.minimum(levels[-1][: len(x) - size], levels[-1][size:])
            levels.append(low)
            size *= 2
        self.levels = np.stack(levels)

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Least of ``x[first..last]``, both included."""
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        return np.minimum(self.levels[level, first], self.levels[level, last - (1 << level) + 1])


def merge(shards: list[list[np.ndarray]]):
    """Refine the interleave of the shards' transforms, one symbol at a time.

    ``shards``: per shard, for each depth, the symbols in the shard's own order.  After each depth this yields the
    merged order (numbers of strings, shard by shard) and the common prefixes of neighbours in it.
    """
    size = [len(s[0]) for s in shards]
    shard = np.repeat(np.arange(len(shards)), size).astype(np.uint16 if len(shards) < 1 << 16 else np.int64)
    string, total = np.arange(len(shard)), len(shard)
    common = np.zeros(total, np.uint8 if len(shards[0]) < 255 else np.uint16)
    for depth in range(len(shards[0])):
        merged = np.empty(total, shards[0][depth].dtype)
        merged[np.argsort(shard, kind="stable")] = np.concatenate([s[depth] for s in shards])
        if merged.dtype != np.uint8:
            merged = np.unique(merged, return_inverse=True)[1]
        step = np.argsort(merged, kind="stable")
        symbol = merged[step]
        longer = np.zeros_like(common)
        same = np.flatnonzero(symbol[1:] == symbol[:-1]) + 1
        if len(same):
            longer[same] = 1 + _Least(common)(step[same - 1] + 1, step[same])
        string, shard, common = string[step], shard[step], longer
        yield depth, string, common


def _repeats(window: int, parts: int):
    """One range of anchors: the windows that are not the earliest of their interval."""
    size = window // 2
    side = window - size

    def run(table: pa.Table) -> pa.Table:
        import zlib

        if table.column("part")[0].as_py() < 0:
            return _passed(table)
        packed, keys, symbols = (table.column(c).to_pylist() for c in ("places", "anchors", "symbols"))
        doc, pos = _places(packed)
        shards = []
        for key, raw in zip(keys, symbols):
            own = list(np.frombuffer(zlib.decompress(raw), np.uint8).reshape(2 * side, -1))
            shards.append([*own[:side], np.frombuffer(key, np.uint64), *own[side:]])
        order = np.lexsort((pos, doc))
        moved = np.concatenate([[False], (doc[order][1:] != doc[order][:-1]) | (pos[order][1:] != pos[order][:-1])])
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(moved[: len(order)])
        # How far each string reaches, from where the symbols beyond the text begin.
        left, right = np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64)
        repeat = np.zeros((len(doc), side + 1), bool)
        before = np.arange(len(doc))
        for depth, string, common in merge(shards):
            # The symbols of this depth belong to the strings in the order of the depth before.
            placed = _symbols_of(shards, depth, before) if depth != side else None
            if placed is not None:
                (right if depth < side else left)[before] += placed != _BEYOND
            before = string
            if depth < side:
                continue
            head = np.flatnonzero(common < side + 1)
            least = np.minimum.reduceat(rank[string], head)
            repeat[string, depth - side] = rank[string] != np.repeat(least, np.diff(np.append(head, len(string))))
        repeat &= _usable(left, right, side)
        return _as_places([_intervals(doc, pos, repeat)], parts)

    return run


def _symbols_of(shards, depth: int, strings: np.ndarray) -> np.ndarray:
    """Symbols of a depth for strings in merged order."""
    size = np.array([len(s[0]) for s in shards])
    shard = np.repeat(np.arange(len(shards)), size)[strings]
    out = np.empty(len(strings), np.uint8)
    out[np.argsort(shard, kind="stable")] = np.concatenate([s[depth] for s in shards])
    return out


def repeated_bytes(docs: DataFrame, window: int = 100) -> DataFrame:
    """``doc_id, positions``: runs of byte places (``start << 16 | length``) at which a window starts that starts earlier too.

    Earlier is a smaller doc_id, or an earlier place of the same document; windows never cross documents.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.where("doc_id IS NOT NULL AND text IS NOT NULL")
    parts = hash_ranges(texts)
    found = texts.mapInArrow(_anchor_pieces(window, parts), PACKED)
    hits = kept(by_document(found.groupBy("part").applyInArrow(_meet_anchors(parts), PLACES)), "anchors")
    around = with_positions(texts, hits, "inner").select("doc_id", "text", "positions")

    def shards(batches):
        return _dealt_local(_shards(window, parts)(batches))

    strings = around.mapInArrow(shards, SHARD)
    return by_document(strings.groupBy("part").applyInArrow(_repeats(window, parts), PLACES))


def _cut(window: int):
    def run(batches):
        for batch in batches:
            for piece in slices(batch, "text", PIECE):
                data, offsets = flat(piece.column("text"))
                removed, spans, digest, text = [], [], [], []
                for i, raw in enumerate(piece.column("positions").to_pylist()):
                    own = data[offsets[i] : offsets[i + 1]]
                    runs = positions(raw)
                    if not len(runs):
                        removed.append(0)
                        spans.append(0)
                        digest.append(hashlib.sha256(own.tobytes()).hexdigest())
                        text.append(piece.column("text")[i].as_py())
                        continue
                    start, length = runs >> 16, runs & 0xFFFF
                    edge = np.zeros(len(own) + 1, np.int64)
                    np.add.at(edge, np.minimum(start, len(own)), 1)
                    np.add.at(edge, np.minimum(start + length - 1 + window, len(own)), -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    left = own[~gone].tobytes()
                    removed.append(int(gone.sum()))
                    spans.append(int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[0]))
                    digest.append(hashlib.sha256(left).hexdigest())
                    text.append(left.decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("row"),
                        pa.array(text, pa.string()),
                        pa.array(np.diff(offsets)),
                        pa.array(removed, pa.int64()),
                        pa.array(spans, pa.int64()),
                        pa.array(digest, pa.string()),
                    ],
                    ["row", "kept_text", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
                )

    return run


def remove_repeated_bytes(docs: DataFrame, window: int = 100) -> DataFrame:
    """``docs`` with ``text`` cut to the bytes outside repeated windows, and ``n_bytes, n_removed, n_spans, kept_sha256``.

    A byte goes if a string of ``window`` bytes that covers it also starts earlier, judged on the input.  The digest is
    over the remaining bytes; in ``text``, where a cut parts a character, its rest is U+FFFD.  Texts that lose nothing
    stay as they are, null included (no bytes).  Rows without doc_id are kept whole.  Rows that repeat a doc_id are one
    document.  Columns named like the new ones are replaced; no rows give no rows.
    """
    found = kept(repeated_bytes(docs, window), "byte_repeats")
    new = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    old = [c for c in docs.columns if c not in (*new, "text")]
    rows = docs.select(F.struct(*old).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = with_positions(rows, found, "left").select("row", F.col("text").cast("string").alias("text"), "positions")
    schema = T.StructType(list(rows.select("row").schema)).add("kept_text", "string")
    for name in new[:3]:
        schema = schema.add(name, "long")
    out = rows.mapInArrow(_cut(window), schema.add("kept_sha256", "string"))
    back = [F.col("kept_text").alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns if c not in new]
    return out.select(*back, *new)
