"""Quality rules: per-text counts, and lines that recur in many documents of one host."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import BROADCAST_IDS, kept
from .text import LOWER, SPACE, Words, flat, hash_spans, mix, rolling, signed, slices

#: A text must have this many words, before and after the removal of frequent lines.
MIN_WORDS = 50
#: Most percent of words in repeated three-word windows.
MAX_REPEAT = 50
#: A line is frequent above this percent of a host's distinct documents, and above this number of them.
LINE_PERCENT, LINE_DOCUMENTS = 2, 10
#: A document is depleted if more than this percent of its words are in frequent lines.
MAX_REMOVED = 50

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

STATS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "lines array<long>, line_words array<long>"
)


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _twice(text: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values occur more than once in their text, and which are not the first there."""
    order = np.lexsort((value, text))
    t, v = text[order], value[order]
    again = np.concatenate([[False], (t[1:] == t[:-1]) & (v[1:] == v[:-1])])[: len(t)]
    both = again.copy()
    both[:-1] |= again[1:]
    twice, later = np.zeros(len(t), bool), np.zeros(len(t), bool)
    twice[order], later[order] = both, again
    return twice, later


def text_counts(piece: pa.RecordBatch) -> list[pa.Array]:
    """The columns of ``STATS`` for a piece of texts."""
    data, offsets = flat(piece.column("text"))
    n = piece.num_rows
    words = Words(data, offsets)
    of = words.text_of()
    starts_char = (data & 0xC0) != 0x80
    word_chars = _per_text(starts_char & ~SPACE[data], offsets)
    symbols = _per_text(_SYMBOL[data], offsets)

    h3 = rolling(words.hashes(), 3)
    at = np.flatnonzero(words.room()[: len(h3)] >= 3)
    # A stable order keeps equal windows of a text in their order.
    twice, _ = _twice(of[at], h3[at])
    edge = np.zeros(len(words) + 1, np.int64)
    edge[at[twice]] += 1
    np.add.at(edge, at[twice] + 3, -1)
    repeat_words = np.bincount(of, weights=np.cumsum(edge[:-1]) > 0, minlength=n).astype(np.int64)

    # Lines end at \n and at the end of their text.
    ends = np.union1d(np.flatnonzero(data == 0x0A), offsets[1:] - 1) if len(data) else np.zeros(0, np.int64)
    ends = ends[ends >= 0]
    begins = np.concatenate([[0], ends[:-1] + 1])[: len(ends)]
    stops = np.where(data[ends] == 0x0A, ends, ends + 1)
    first_word = np.searchsorted(words.start, begins)
    n_words = np.searchsorted(words.start, stops) - first_word
    real = n_words > 0
    begins, stops, first_word, n_words = begins[real], stops[real], first_word[real], n_words[real]
    line_of = of[first_word] if len(first_word) else np.zeros(0, np.int64)
    _, later = _twice(line_of, hash_spans(words.bytes, begins, stops, most=4096))
    dup_lines = np.bincount(line_of[later], minlength=n)

    # The normal form of a line is its words, lower-cased in A-Z, whatever stands between them.
    lower = Words(LOWER[data], offsets).hashes()
    within = np.arange(len(lower)) - np.repeat(first_word, n_words) if len(lower) else lower
    value = mix(lower + within.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    total = np.concatenate([[np.uint64(0)], np.cumsum(value)])
    normal = signed(mix(total[first_word + n_words] - total[first_word]))
    order = np.lexsort((normal, line_of))
    t, v, w = line_of[order], normal[order], n_words[order]
    head = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (v[1:] != v[:-1])])[: len(t)])
    sums = np.add.reduceat(w, head) if len(head) else np.zeros(0, np.int64)
    cuts = pa.array(np.searchsorted(t[head], np.arange(n + 1)).astype(np.int32))
    return [
        pa.array(words.count),
        pa.array(word_chars),
        pa.array(symbols),
        pa.array(dup_lines),
        pa.array(repeat_words),
        pa.ListArray.from_arrays(cuts, pa.array(v[head])),
        pa.ListArray.from_arrays(cuts, pa.array(sums)),
    ]


def _count(batches):
    names = ["doc_id", "host", "content", *(c.split()[0] for c in STATS.split(", "))]
    for batch in batches:
        for piece in slices(batch, "text"):
            columns = [piece.column(c) for c in ("doc_id", "host", "content")]
            yield pa.RecordBatch.from_arrays([*columns, *text_counts(piece)], names)


def quality_rules(
    docs: DataFrame,
    host: str = "source",
    line_percent: int = LINE_PERCENT,
    line_documents: int = LINE_DOCUMENTS,
) -> DataFrame:
    """Counts and the verdict for every row of ``docs`` (``doc_id, text`` and the ``host`` column).

    A line's normal form is its words, lower-cased in A-Z.  It is frequent if more than ``line_documents`` documents
    of the host have it, and more than ``line_percent`` percent of them; documents with equal texts count once.  A
    document is rejected by the base rules (under 50 words, or more than half of its words in three-word windows that
    occur twice), or if without its frequent lines it is depleted: under 50 words, or over half of them gone.

    A null text is empty and fails; a null host is a host of its own.  Rows without doc_id are judged but lend no line
    a count; rows that
    repeat a doc_id are judged each and count as one document.  Other columns are ignored; no rows give no rows.
    """
    source = F.coalesce(F.xxhash64(F.col(host).cast("string")), F.lit(0)) if host in docs.columns else F.lit(0)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        source.cast("long").alias("host"),
        F.xxhash64("text").alias("content"),
        F.col("text").cast("string").alias("text"),
    )
    counted = rows.mapInArrow(_count, f"doc_id long, host long, content long, {STATS}")
    stats = kept(counted.withColumn("row", F.monotonically_increasing_id()), "line_counts")
    copies = stats.where("doc_id IS NOT NULL").groupBy("host", "content").agg(F.min("doc_id").alias("doc_id"))
    copies = kept(copies.select("doc_id", "host"), "distinct_texts")
    size = copies.groupBy("host").agg(F.count("*").alias("documents"))
    # A document counts once towards a line: of an id with several rows the lines are made distinct first.
    ids = stats.where("doc_id IS NOT NULL").groupBy("doc_id", "host").agg((F.count("*") > 1).alias("repeated"))
    ids = ids.join(copies.distinct(), ["doc_id", "host"], "left_semi")
    lines = stats.join(ids, ["doc_id", "host"]).select("repeated", "doc_id", "host", F.explode("lines").alias("line"))
    again = lines.where("repeated").select("doc_id", "host", "line").distinct()
    lines = lines.where("NOT repeated").select("host", "line").unionByName(again.select("host", "line"))
    frequent = (
        lines.groupBy("host", "line")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > line_documents)
        .join(size, "host")
        .where(F.col("n") * 100 > F.col("documents") * line_percent)
        .select("host", "line")
    )
    frequent = kept(frequent, "frequent_lines")
    few = frequent.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    each = stats.select("row", "host", F.explode(F.arrays_zip("lines", "line_words")).alias("x"))
    each = each.select("row", "host", F.col("x.lines").alias("line"), F.col("x.line_words").alias("words"))
    gone = each.join(F.broadcast(frequent) if few else frequent, ["host", "line"])
    gone = gone.groupBy("row").agg(F.sum("words").alias("n_removed"), F.count("*").alias("n_frequent_lines"))
    out = stats.join(gone, "row", "left")
    removed = F.coalesce("n_removed", F.lit(0))
    words = F.col("n_words")
    failed = (words < MIN_WORDS) | (F.col("n_repeat_words") * 100 > words * MAX_REPEAT)
    depleted = (words - removed < MIN_WORDS) | (removed * 100 > words * MAX_REMOVED)
    return out.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"),
        removed.alias("n_removed_words"),
        F.coalesce("n_frequent_lines", F.lit(0)).alias("n_frequent_lines"),
    )
