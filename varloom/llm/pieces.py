"""SentencePiece encoding by a batched Viterbi search in numpy, and decoding.

A text is cut before each run of spaces, which no piece crosses.  The distinct words of a portion of text are grouped
by length; for all of them at once the substrings of each length are hashed and looked up in the sorted piece keys,
and all words of a length advance together, one place at a time, keeping the best score and the piece that gave it.

The segmentation is the one with the greatest sum of piece scores; of equal sums, the one whose last piece is longer.
That is what a unigram model defines.  For a byte-pair model it is the best segmentation by its scores, which need
not be the one that its merges in order arrive at.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import Remembered, flat, hand_back, hash_spans, mix, slices

#: A character without a piece costs this much more than the worst piece.
UNKNOWN_PENALTY = 10.0
#: Words of more characters advance alone.
TOGETHER = 48
#: Bytes of remembered words and their pieces in a task, before it forgets all.
REMEMBERED = 24 << 20
#: Places times piece lengths that are looked up at once, some 40 bytes each.
CELLS = 1 << 20
_SPACE = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places ``start, start + 1, ...`` of each span, one after the other."""
    total = np.cumsum(size)
    return np.arange(int(total[-1]) if len(total) else 0) + np.repeat(start - (total - size), size)


class Model:
    """The pieces of a model file: sorted keys, scores, bytes."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.prefix = sp.normalize("x") != "x"
        if sp.normalize("A ﬁ  b\t") not in ("A▁ﬁ▁▁b\t", "▁A▁ﬁ▁▁b\t"):
            raise ValueError("models that change texts beyond their spaces are not supported")
        normal = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        names = [sp.id_to_piece(i).replace(_SPACE, " ") for i in normal]
        if any(" " in p.lstrip(" ") for p in names):
            raise ValueError("pieces that hold a space after another character are not supported")
        self.byte = np.full(256, sp.unk_id(), np.int32)
        for i in range(n):
            if sp.is_byte(i):
                self.byte[int(sp.id_to_piece(i)[3:5], 16)] = i
        self.longest = max(map(len, names))
        scores = np.array([sp.get_score(i) for i in normal], np.float64)
        self.unknown = float(scores.min()) - UNKNOWN_PENALTY
        keys = np.array([self._key(p) for p in names], np.uint64)
        order = np.argsort(keys)
        self.keys, self.scores, self.ids = keys[order], scores[order], np.array(normal, np.int32)[order]
        body = [b""] * n
        for i, p in zip(normal, names):
            body[i] = p.encode()
        for b, i in enumerate(self.byte):
            if i != sp.unk_id():
                body[i] = bytes([b])
        self.body = np.frombuffer(b"".join(body), np.uint8)
        self.begin = np.concatenate([[0], np.cumsum([len(b) for b in body])])
        self.power = np.array([pow(int(_BASE), k, 1 << 64) for k in range(self.longest + 1)], np.uint64)
        self.known = Remembered(REMEMBERED, np.int32)

    @staticmethod
    def _key(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_BASE) + ord(c) + 1) % (1 << 64)
        return int(mix(np.array([(h + len(piece)) % (1 << 64)], np.uint64))[0])

    def _matches(self, chars: np.ndarray):
        """For each piece length: score and id of the piece that begins at each place of a row of ``chars``."""
        n = chars.shape[1]
        rolled = np.zeros(chars.shape, np.uint64)
        for size in range(1, min(self.longest, n) + 1):
            wide = n - size + 1
            rolled = rolled[:, :wide] * _BASE + chars[:, size - 1 :]
            key = mix(rolled + np.uint64(size))
            near = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[near] == key
            yield np.where(hit, self.scores[near], -np.inf), np.where(hit, self.ids[near], -1)

    def best(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the best pieces of words of equal length, right-aligned; -1 is a character without a piece.

        ``chars``: one row of code points plus one for each word.  Returns the ids and how many each word has.
        """
        rows, n = chars.shape
        found = list(self._matches(chars))
        score, number = found[0]
        lone = np.isneginf(score)
        found[0] = (np.where(lone, self.unknown, score), number)
        total = np.full((rows, n + 1), -np.inf)
        total[:, 0] = 0
        back = np.zeros((rows, n + 1), np.int64)
        for end in range(1, n + 1):
            for size in range(min(len(found), end), 0, -1):
                reach = total[:, end - size] + found[size - 1][0][:, end - size]
                better = reach > total[:, end]
                total[better, end] = reach[better]
                back[better, end] = size
        out, count = np.full((rows, n), -2, np.int32), np.zeros(rows, np.int64)
        at, row = np.full(rows, n), np.arange(rows)
        number = np.full((len(found), rows, n), -1, np.int32)
        for size, (_, ids) in enumerate(found):
            number[size, :, : ids.shape[1]] = ids
        while len(row):
            size = back[row, at[row]]
            at[row] -= size
            count[row] += 1
            out[row, n - count[row]] = number[size - 1, row, at[row]]
            row = row[at[row] > 0]
        return out, count

    def best_long(self, chars: np.ndarray) -> list[int]:
        """The same for one long word: its pieces are looked up at once, then walked through."""
        n = len(chars)
        fits: list[list[tuple[int, float, int]]] = [[] for _ in range(n)]
        for size, (score, ids) in enumerate(self._matches(chars[None, :]), 1):
            for i in np.flatnonzero(ids[0] >= 0):
                fits[i].append((size, float(score[0, i]), int(ids[0, i])))
        total, back = [float("-inf")] * (n + 1), [(0, -1)] * (n + 1)
        total[0] = 0.0
        for i in range(n):
            steps = fits[i] if fits[i] and fits[i][0][0] == 1 else [(1, self.unknown, -1), *fits[i]]
            for size, score, number in steps:
                if total[i] + score > total[i + size]:
                    total[i + size], back[i + size] = total[i] + score, (size, number)
        out, at = [], n
        while at:
            size, number = back[at]
            out.append(number)
            at -= size
        return out[::-1]

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word one after the other, and how many each has; characters without a piece as their bytes."""
        length = np.array([len(w) for w in words])
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        first = np.cumsum(length) - length
        at, ids, unknown = [], [], []
        for n in np.unique(length):
            rows = np.flatnonzero(length == n)
            if n > TOGETHER:
                for r in rows:
                    best = np.array(self.best_long(chars[first[r] : first[r] + n].astype(np.uint64) + np.uint64(1)), np.int32)
                    at.append(np.full(len(best), r))
                    ids.append(best)
                continue
            step = max(1, CELLS // (int(n) * min(self.longest, int(n))))
            for k in range(0, len(rows), step):
                some = rows[k : k + step]
                block = chars[first[some][:, None] + np.arange(n)].astype(np.uint64) + np.uint64(1)
                out, count = self.best(block)
                at.append(np.repeat(some, count))
                ids.append(out[np.arange(n) >= n - count[:, None]])
        at, ids = np.concatenate(at), np.concatenate(ids)
        order = np.argsort(at, kind="stable")
        at, ids = at[order], ids[order]
        if (ids < 0).any():
            at, ids = self._with_bytes(words, at, ids)
        return ids, np.bincount(at, minlength=len(words))

    def _with_bytes(self, words, at, ids):
        """Replace each character without a piece by the ids of its bytes."""
        size = np.ones(len(ids), np.int64)
        lengths = np.diff(self.char_begin)
        cut = np.searchsorted(at, np.arange(len(words) + 1))
        fill = {}
        for w in np.unique(at[ids < 0]):
            place = 0
            for k in range(cut[w], cut[w + 1]):
                if ids[k] < 0:
                    fill[k] = self.byte[list(words[w][place].encode())]
                    size[k] = len(fill[k])
                    place += 1
                else:
                    place += int(lengths[ids[k]])
        begin = np.cumsum(size) - size
        out = np.repeat(ids, size)
        for k, raw in fill.items():
            out[begin[k] : begin[k] + len(raw)] = raw
        return np.repeat(at, size), out

    @property
    def char_begin(self) -> np.ndarray:
        """Characters of all pieces before each piece."""
        if not hasattr(self, "_chars"):
            heads = np.concatenate([[0], np.cumsum((self.body & 0xC0) != 0x80)])
            self._chars = heads[self.begin]
        return self._chars

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has."""
        data, offsets = flat(texts)
        if b"\xe2\x96\x81" in data.tobytes():
            plain = [(t or "").replace(_SPACE, " ") for t in texts.to_pylist()]
            data, offsets = flat(pa.array(plain, pa.large_string()))
        full = offsets[1:] > offsets[:-1]
        if self.prefix:
            data = np.insert(data, offsets[:-1][full], 0x20)
            offsets = offsets + np.concatenate([[0], np.cumsum(full)])
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        space = data == 0x20
        head = space & ~np.concatenate([[False], space[:-1]])
        head[offsets[:-1][full]] = True
        start = np.flatnonzero(head)
        end = np.append(start[1:], len(data))
        padded = np.zeros(len(data) + 16, np.uint8)
        padded[: len(data)] = data
        distinct, first, which = np.unique(hash_spans(padded, start, end), return_index=True, return_inverse=True)
        raw = data.tobytes()

        def learn(new: np.ndarray):
            return self.words([raw[start[i] : end[i]].decode() for i in first[new]])

        numbers = self.known.numbers_of(distinct, learn)
        ids, size = self.known.ids_of(numbers[which])
        text = np.searchsorted(offsets, start, "right") - 1
        return ids, np.bincount(text, weights=size, minlength=len(texts)).astype(np.int64)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of ids; control and unknown ids give nothing, bytes that are no UTF-8 give U+FFFD."""
        size = self.begin[ids + 1] - self.begin[ids]
        raw = self.body[_ragged(self.begin[ids], size)].tobytes()
        edge = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])]
        out = [raw[a:b].decode("utf-8", "replace") for a, b in zip(edge[:-1], edge[1:])]
        return [t[1:] if self.prefix and t.startswith(" ") else t for t in out]


_MODELS: dict[str, Model] = {}


def model(path: str) -> Model:
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


def _encode(path: str, keep: list[str]):
    def run(batches):
        own = model(path)
        for batch in batches:
            for piece in slices(batch, "text", 2 << 20):
                ids, counts = own.encode(piece.column("text"))
                cuts = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                coded = pa.ListArray.from_arrays(cuts, pa.array(ids))
                yield pa.RecordBatch.from_arrays([*[piece.column(c) for c in keep], coded], [*keep, "piece_ids"])
                hand_back()

    return run


def _decode(path: str):
    def run(batches):
        own = model(path)
        for batch in batches:
            column = batch.column("piece_ids")
            texts = []
            for i in range(0, batch.num_rows, 2048):
                part = column.slice(i, 2048).fill_null([])
                counts = np.array(part.value_lengths(), np.int64)
                texts += own.decode(np.array(part.flatten(), np.int32), counts)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "decoded"])

    return run


def encode_pieces(docs: DataFrame, path: str, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``piece_ids``, the ids of the best pieces of ``text``; without ``keep_text`` the text is left out.

    ``path`` is a model file that every executor has.  A null or empty text has no ids.  U+2581 in a text is a space.
    A column named ``piece_ids`` is replaced; rows may repeat; no rows give no rows.
    """
    old = [c for c in docs.columns if c not in ("text", "piece_ids")]
    rows = docs.select(F.struct(*old).alias("row"), F.col("text").cast("string").alias("text"))
    keep = ["row", "text"] if keep_text else ["row"]
    schema = T.StructType([rows.schema[c] for c in keep]).add("piece_ids", T.ArrayType(T.IntegerType()))
    out = rows.mapInArrow(_encode(path, keep), schema)
    names = [c for c in docs.columns if c != "piece_ids" and (keep_text or c != "text")]
    back = [F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in names]
    return out.select(*back, "piece_ids")


def decode_pieces(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``decoded``, the text of ``piece_ids``; null ids give an empty text."""
    old = [c for c in docs.columns if c != "decoded"]
    rows = docs.select(F.struct(*old).alias("row"), "piece_ids")
    schema = T.StructType(list(rows.select("row").schema)).add("decoded", "string")
    out = rows.mapInArrow(_decode(path), schema)
    return out.select(*[F.col("row").getField(c).alias(c) for c in old], "decoded")


def _digest(path: str):
    """Tasks: what a text's pieces are, and whether they give it back, in one pass."""

    def run(batches):
        own = model(path)
        for batch in batches:
            for piece in slices(batch, "text", 2 << 20):
                ids, counts = own.encode(piece.column("text"))
                edge = np.concatenate([[0], np.cumsum(counts)])
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(edge[:-1], edge[1:])]
                decoded = own.decode(ids, counts)
                given = [(t or "").replace(_SPACE, " ") for t in piece.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        pa.array(counts),
                        pa.array(crc, pa.int64()),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded], pa.string()),
                        pa.array([x == y for x, y in zip(given, decoded)], pa.bool_()),
                    ],
                    ["doc_id", "n_pieces", "ids_crc32", "decoded_sha256", "round_trip"],
                )

    return run


def piece_digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_pieces, ids_crc32, decoded_sha256, round_trip`` of every text, encoded and decoded again."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(
        _digest(path), "doc_id long, n_pieces long, ids_crc32 long, decoded_sha256 string, round_trip boolean"
    )
