"""Places in documents (doc_id and position) as small binary values, gathered into one value per document."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import mix

PLACES = "slot int, places binary"


def to_varints(x: np.ndarray) -> bytes:
    """Non-negative integers in as many bytes as each needs, seven bits a byte."""
    x = x.astype(np.uint64)
    size, most = np.ones(len(x), np.int64), int(x.max(initial=0))
    for bits in range(7, most.bit_length(), 7):
        size += x >= np.uint64(1 << bits)
    at = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(int(size.max(initial=0))):
        pick = np.flatnonzero(size > k)
        byte = (x[pick] >> np.uint64(7 * k)) & np.uint64(127)
        out[at[pick] + k] = byte.astype(np.uint8) | np.where(size[pick] > k + 1, 128, 0).astype(np.uint8)
    return out.tobytes()


def from_varints(raw: bytes) -> np.ndarray:
    data = np.frombuffer(raw, np.uint8)
    ends = np.flatnonzero(data < 128)
    if not len(ends):
        return np.zeros(0, np.int64)
    at = np.concatenate([[0], ends[:-1] + 1])
    size = ends - at + 1
    out = (data[at] & 127).astype(np.int64)
    for k in range(1, int(size.max())):
        pick = np.flatnonzero(size > k)
        out[pick] |= (data[at[pick] + k] & 127).astype(np.int64) << (7 * k)
    return out


def pack_runs(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """Document ids, each with a count."""
    step = np.diff(ids, prepend=np.int64(0))
    return struct.pack("<q", len(ids)) + zlib.compress(step.tobytes() + counts.astype(np.uint32).tobytes(), 1)


def unpack_runs(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = struct.unpack("<q", raw[:8])[0]
    body = zlib.decompress(raw[8:])
    return np.cumsum(np.frombuffer(body, np.int64, n)), np.frombuffer(body, np.uint32, n, 8 * n).astype(np.int64)


def in_order(doc: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Whether no place comes before the one ahead of it."""
    return bool(np.all((doc[1:] > doc[:-1]) | ((doc[1:] == doc[:-1]) & (pos[1:] >= pos[:-1]))))


def pack_places(doc: np.ndarray, pos: np.ndarray) -> bytes:
    if not in_order(doc, pos):
        order = np.lexsort((pos, doc))
        doc, pos = doc[order], pos[order]
    return pack_entries(doc, pos)


def pack_entries(doc: np.ndarray, pos: np.ndarray) -> bytes:
    """Places in the order given, which is best ascending; only documents that have one take room."""
    if not len(doc):
        return b""
    at = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (pos[1:] < pos[:-1])]))
    runs = pack_runs(doc[at], np.diff(np.append(at, len(doc))))
    step = np.diff(pos, prepend=0)
    step[at] = pos[at]
    return struct.pack("<q", len(runs)) + runs + to_varints(step)


def unpack_places(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    if not raw:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = struct.unpack("<q", raw[:8])[0]
    ids, counts = unpack_runs(raw[8 : 8 + n])
    step = from_varints(raw[8 + n :])
    return np.repeat(ids, counts), restored(step, counts)


def restored(step: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions from steps that begin anew in every run."""
    total = np.cumsum(step)
    at = np.cumsum(counts) - counts
    before = np.where(at > 0, total[at - 1], 0)
    return total - np.repeat(before, counts)


def slotted(doc: np.ndarray, pos: np.ndarray, slots: int) -> pa.RecordBatch:
    """Rows of ``PLACES``: the places dealt over slots by document."""
    slot = (mix(doc.view(np.uint64)) % np.uint64(slots)).astype(np.int32)
    order = np.argsort(slot, kind="stable")
    slot, doc, pos = slot[order], doc[order], pos[order]
    cuts = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]])) if len(slot) else np.zeros(0, np.int64)
    ends = np.append(cuts[1:], len(slot))
    rows = [pack_places(doc[a:b], pos[a:b]) for a, b in zip(cuts, ends)]
    return pa.RecordBatch.from_arrays([pa.array(slot[cuts], pa.int32()), pa.array(rows, pa.binary())], ["slot", "places"])


def _gather(table: pa.Table) -> pa.Table:
    found = [unpack_places(raw) for raw in table.column("places").to_pylist()]
    doc, pos = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
    order = np.lexsort((pos, doc))
    doc, pos = doc[order], pos[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1])])
    doc, pos = doc[new], pos[new]
    cuts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    ends = np.append(cuts[1:], len(doc))
    rows = [to_varints(np.diff(pos[a:b], prepend=0)) for a, b in zip(cuts, ends)]
    return pa.table({"doc_id": pa.array(doc[cuts]), "positions": pa.array(rows, pa.binary())})


def by_document(places: DataFrame) -> DataFrame:
    """``doc_id, positions``: all distinct positions of each document, ascending, as varints of their steps."""
    return places.groupBy("slot").applyInArrow(_gather, "doc_id long, positions binary")


def positions(raw: bytes | None) -> np.ndarray:
    return np.cumsum(from_varints(raw or b""))


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` units lie in a window of ``width`` at one of the starts."""
    starts = starts[starts < n]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + width, n), -1)
    return np.cumsum(edge[:-1]) > 0


#: Bytes of positions that are broadcast to where texts are read; beyond it they are joined by a shuffle.
BROADCAST_BYTES = 48 << 20


def with_positions(texts: DataFrame, positions_: DataFrame, how: str) -> DataFrame:
    """Join stored positions to the texts of their documents."""
    total = positions_.agg(F.sum(F.length("positions") + 64)).first()[0] or 0
    return texts.join(F.broadcast(positions_) if total <= BROADCAST_BYTES else positions_, "doc_id", how)
