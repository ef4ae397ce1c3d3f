"""Fill-in-the-middle examples: two cuts of a text between its words, found by ranks over classes of characters.

Every code point has one of four classes: white space behind white space, white space behind a word (``ENDS``), the
first character of a word (``BEGINS``), a further one.  A wavelet matrix over the classes of a portion of texts counts
any class before any place.  A text has as many units as words begin in it, and one more if white space is left at its
end; unit k ends at the k-th place of class ``ENDS``, or with the text.  Those places are found for all texts of a
portion at once, by bisection on ranks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import SPACE, flat, slices

#: Marks of the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Classes of a code point; the low bit tells whether a word stands before it, the high bit whether it is in a word.
BLANK, ENDS, BEGINS, INSIDE = 0, 1, 2, 3
ADDED = ["n", "form", "prefix_chars", "middle_chars", "output"]


class Bits:
    """A bit vector that counts its ones before any place: one count and one popcount a query."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros((len(bits) >> 6) + 1, np.uint64)
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words[:-1]), dtype=np.int64)])

    def rank(self, place: np.ndarray) -> np.ndarray:
        word = place >> 6
        mask = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Symbols of a few bits: one bit vector a level, highest bit first, zeros moved before ones from level to level."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.length, self.levels = len(symbols), []
        for level in range(levels - 1, -1, -1):
            ones = (symbols >> level & 1).astype(bool)
            self.levels.append((level, Bits(ones), len(symbols) - int(ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: int, place: np.ndarray) -> np.ndarray:
        """How often the symbol stands before each place."""
        begin, end = np.zeros_like(place), place
        for level, bits, zeros in self.levels:
            if symbol >> level & 1:
                begin, end = zeros + bits.rank(begin), zeros + bits.rank(end)
            else:
                begin, end = begin - bits.rank(begin), end - bits.rank(end)
        return end - begin

    def select(self, symbol: int, nth: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The place of the ``nth`` of the symbol (from 1), which stands at or behind ``low`` and before ``high``."""
        low, high = low.copy(), high.copy()
        while (low < high).any():
            middle = (low + high) >> 1
            enough = self.rank(symbol, middle + 1) >= nth
            high = np.where(enough & (low < high), middle, high)
            low = np.where(enough | (low >= high), low, middle + 1)
        return low


class Units:
    """The units of several texts: white space with the word behind it, and white space left at the end."""

    def __init__(self, texts: pa.Array):
        self.data, offsets = flat(texts)
        lead = (self.data & 0xC0) != 0x80
        self.byte = np.append(np.flatnonzero(lead), len(self.data))
        self.edge = np.searchsorted(self.byte, offsets)
        self.chars = np.diff(self.edge)
        in_word = ~SPACE[self.data[self.byte[:-1]]]
        after_word = np.concatenate([[False], in_word[:-1]]) if len(in_word) else in_word
        after_word[self.edge[:-1][self.chars > 0]] = False
        self.classes = WaveletMatrix(in_word.astype(np.uint8) << 1 | after_word, 2)
        begin, end = self.edge[:-1], self.edge[1:]
        self.ended_before = self.classes.rank(ENDS, begin)
        self.ended = self.classes.rank(ENDS, end) - self.ended_before
        words = self.classes.rank(BEGINS, end) - self.classes.rank(BEGINS, begin)
        left = np.zeros(len(begin), np.int64)
        left[self.chars > 0] = ~in_word[end[self.chars > 0] - 1]
        self.count = words + left

    def cut(self, k: np.ndarray) -> np.ndarray:
        """The place behind the first ``k`` units of each text, counted in code points of all texts."""
        begin, end = self.edge[:-1], self.edge[1:]
        at = np.where(k == 0, begin, end)
        some = np.flatnonzero((k > 0) & (k <= self.ended))
        at[some] = self.classes.select(ENDS, self.ended_before[some] + k[some], begin[some], end[some])
        return at


def _transform(keep: list[str], rate: int, suffix_first: int):
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for piece in slices(batch, "text", 2 << 20):
                units = Units(piece.column("text"))
                draw = np.stack([np.array(piece.column(f"draw{i}"), np.int64) for i in range(4)])
                first, second = np.sort(draw[:2] % (units.count + 1), axis=0)
                one, two = units.byte[units.cut(first)], units.byte[units.cut(second)]
                prefix, middle = units.cut(first) - units.edge[:-1], units.cut(second) - units.cut(first)
                edge, raw = units.byte[units.edge], units.data.tobytes()
                form, out = [], []
                for i, (a, b, c, d) in enumerate(zip(edge[:-1], one, two, edge[1:])):
                    text = raw[a:d]
                    if not text or draw[2, i] % 100 >= rate or any(m in text for m in marks):
                        form.append("plain")
                        out.append(text)
                    elif draw[3, i] % 100 < suffix_first:
                        form.append("spm")
                        out.append(b"".join([marks[1], raw[c:d], marks[0], raw[a:b], marks[2], raw[b:c]]))
                    else:
                        form.append("psm")
                        out.append(b"".join([marks[0], raw[a:b], marks[1], raw[c:d], marks[2], raw[b:c]]))
                plain = np.array([f == "plain" for f in form])
                columns = [
                    pa.array(units.count, pa.int64()),
                    pa.array(form, pa.string()),
                    pa.array(prefix, pa.int64(), mask=plain),
                    pa.array(middle, pa.int64(), mask=plain),
                    pa.array(out, pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*[piece.column(c) for c in keep], *columns], [*keep, *ADDED])

    return run


def draws(seed: int = 42) -> list[Column]:
    """Four numbers from the SHA-256 digest of the seed and ``doc_id``; a null id is an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(
    docs: DataFrame, rate: int = 50, suffix_first: int = 80, seed: int = 42, keep_text: bool = True
) -> DataFrame:
    """``docs`` with ``n, form, prefix_chars, middle_chars, output``.

    ``rate`` percent of the texts are cut at two places between units, and of those ``suffix_first`` percent have the
    suffix first (``spm``), the others the prefix (``psm``).  Places and forms are drawn from the digest of ``seed``
    and ``doc_id``.  A text that is null, empty or holds one of the marks stays as it is (``plain``); a null text is
    an empty one.  Rows that repeat give equal results; no rows give none; columns of the added names are replaced,
    and without ``keep_text`` the text is left out.  A text must fit into a task some twenty times over.
    """
    names = [c for c in docs.columns if c not in ADDED]
    row = F.struct(F.lit(0).alias("_"), *[F.col(c) for c in names if c != "text"]).alias("row")
    drawn = [c.alias(f"draw{i}") for i, c in enumerate(draws(seed))]
    rows = docs.select(row, F.col("text").cast("string").alias("text"), *drawn)
    keep = ["row", "text"] if keep_text else ["row"]
    schema = T.StructType([rows.schema[c] for c in keep])
    for name, kind in zip(ADDED, ("long", "string", "long", "long", "string")):
        schema = schema.add(name, kind)
    out = rows.mapInArrow(_transform(keep, rate, suffix_first), schema)
    back = [F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in names if keep_text or c != "text"]
    return out.select(*back, *ADDED)


def restored(output: Column, form: Column) -> Column:
    """The text behind an output of the form.  No text that was cut holds a mark, so each mark stands there once."""
    middle = F.substring_index(output, MIDDLE, -1)
    body = F.substring_index(output, MIDDLE, 1)
    prefix_first = F.substring_index(body, SUFFIX, 1)
    suffix_first = F.substring_index(body, PREFIX, 1)
    psm = F.concat(F.replace(prefix_first, F.lit(PREFIX), F.lit("")), middle, F.substring_index(body, SUFFIX, -1))
    spm = F.concat(F.substring_index(body, PREFIX, -1), middle, F.replace(suffix_first, F.lit(SUFFIX), F.lit("")))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
