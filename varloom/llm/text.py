"""Whole texts as flat arrays inside a task: bytes, words, and 64-bit hashes of words and word windows."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes that separate words: space and the controls 09 to 0D.  All are single bytes in UTF-8.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_ODD_A = np.uint64(0x9E3779B97F4A7C15)
_ODD_B = np.uint64(0xBF58476D1CE4E5B9)
_ODD_C = np.uint64(0x94D049BB133111EB)
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
#: Words of more bytes than this are hashed one by one.
_LONG_WORD = 64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all 64 bits, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * _ODD_B
    x ^= x >> np.uint64(27)
    x *= _ODD_C
    x ^= x >> np.uint64(31)
    return x


def hand_back() -> None:
    """Give freed memory back to the machine; workers live on and would keep what their largest batch needed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most ``limit`` bytes of text and ``rows`` rows; a longer text is a piece of its own."""
    if not batch.num_rows:
        return
    _, offsets = flat(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1
        end = min(max(end, begin + 1), begin + rows, batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end
    hand_back()


def flat(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after the other, and where each begins; a null text is empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("")
    array = array.cast(pa.large_string())
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = array.buffers()
    offsets = np.frombuffer(ends, np.int64)[array.offset : array.offset + len(array) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """The words of several texts: byte ``start`` and ``end`` of each, and ``first``, the first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE):
        n = len(data)
        self.bytes = np.zeros(n + 16, np.uint8)
        self.bytes[:n] = data
        inside = ~space[data]
        opens, closes = inside.copy(), inside.copy()
        if n:
            heads = offsets[:-1][offsets[:-1] < n]
            tails = offsets[1:][offsets[1:] > 0]
            opens[1:] &= ~inside[:-1]
            opens[heads] = inside[heads]
            closes[:-1] &= ~inside[1:]
            closes[tails - 1] = inside[tails - 1]
        self.start = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.start)

    def text_of(self) -> np.ndarray:
        """The number of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.count)), self.count)

    def room(self) -> np.ndarray:
        """How many words there are from each word to the end of its text."""
        return np.repeat(self.first[1:], self.count) - np.arange(len(self))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word's bytes."""
        return hash_spans(self.bytes, self.start, self.end)


def hash_spans(padded: np.ndarray, start: np.ndarray, end: np.ndarray, most: int = _LONG_WORD) -> np.ndarray:
    """A 64-bit hash of each byte span; ``padded`` has at least 8 bytes more than the last span needs.

    Spans of more than ``most`` bytes are hashed one by one.
    """
    eights = np.ndarray((len(padded) - 8,), np.uint64, padded, strides=(1,))
    length = end - start
    h = mix(length.astype(np.uint64) + _ODD_A)
    live = np.arange(len(start))
    for at in range(0, most, 8):
        if at:
            live = live[length[live] > at]
        if not len(live):
            break
        value = eights[start[live] + at] & _KEEP[np.minimum(length[live] - at, 8)]
        h[live] = mix((h[live] ^ value) * _ODD_A)
    raw = memoryview(padded)
    for i in np.flatnonzero(length > most):
        digest = hashlib.blake2b(raw[start[i] : end[i]], digest_size=8).digest()
        h[i] = np.frombuffer(digest, np.uint64)[0]
    return h


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every ``width`` consecutive hashes; shorter than ``h`` by ``width - 1``."""
    if len(h) < width:
        return np.zeros(0, np.uint64)

    def power(k: int) -> np.uint64:
        return np.uint64(pow(int(_ODD_A), k, 1 << 64))

    total, done, left, block, size = h, 0, width, h, 1
    while left:
        if left & 1:
            n = len(h) - done - size + 1
            total = total[:n] * power(size) + block[done : done + n] if done else block
            done += size
        left >>= 1
        if left:
            n = len(block) - size
            block = block[:n] * power(size) + block[size:]
            size *= 2
    return mix(total[: len(h) - width + 1] + np.array([width], np.uint64) * _ODD_C)


def signed(x: np.ndarray) -> np.ndarray:
    """Hashes as Spark's signed 64-bit integers."""
    return x.view(np.int64)


class Remembered:
    """Ids of distinct words by their hashes, in plain arrays; beyond ``most`` bytes it forgets all and begins anew."""

    def __init__(self, most: int, kind: type):
        self.most, self.kind = most, kind
        self._forget()

    def _forget(self):
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.edges = np.zeros(0, self.kind), np.zeros(1, np.int64)

    def numbers_of(self, distinct: np.ndarray, learn) -> np.ndarray:
        """The number of each of the ascending hashes; ``learn`` gives ids and counts for the places it is asked for."""
        at = np.searchsorted(self.hashes, distinct)
        hit = np.zeros(len(distinct), bool)
        inside = at < len(self.hashes)
        hit[inside] = self.hashes[at[inside]] == distinct[inside]
        new = np.flatnonzero(~hit)
        held = sum(a.nbytes for a in (self.hashes, self.numbers, self.flat, self.edges))
        if len(new) and len(self.hashes) and held + 48 * len(new) > self.most:
            self._forget()
            new, at = np.arange(len(distinct)), np.zeros(len(distinct), np.int64)
        if len(new):
            ids, counts = learn(new)
            base = len(self.edges) - 1
            self.flat = np.concatenate([self.flat, ids.astype(self.kind)])
            self.edges = np.concatenate([self.edges, self.edges[-1] + np.cumsum(counts)])
            self.hashes = np.insert(self.hashes, at[new], distinct[new])
            self.numbers = np.insert(self.numbers, at[new], base + np.arange(len(new)))
            at = np.searchsorted(self.hashes, distinct)
        return self.numbers[at]

    def ids_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the numbered words one after the other, and how many each has."""
        size = self.edges[numbers + 1] - self.edges[numbers]
        total = np.cumsum(size)
        place = np.arange(int(total[-1]) if len(total) else 0) + np.repeat(self.edges[numbers] - (total - size), size)
        return self.flat[place], size
