"""Benchmark items in training texts: rare words and word pairs find candidates, Smith-Waterman alignment scores them.

An alignment with ``m`` matches in ``r`` runs has at least ``r - 1`` mismatches and gaps, so a score of ``t`` takes
``2 * m - (r - 1) >= t``.  It shares ``m`` words and ``m - r`` pairs of neighbours with the item, hence at least ``t - 1``
of the item's words and pairs, each place counted.  Leaving out the most frequent ones, up to ``t - 1 - k`` places, an
alignment still holds ``k`` of the rest, the seeds.  It is no longer than ``3 * m - t`` words of the text.  So all places
where the score can be reached are found, whatever the frequencies are; these only choose the seeds.  There the item is
aligned with the text word by word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import kept
from .text import LOWER, Words, flat, hand_back, rolling, signed, slices

#: Items of fewer words are sought as a whole only.
SEED = 3
#: Places of seeds that a stretch must hold, or as many as the item's score asks for.
NEED = 3
MATCH, MISMATCH, GAP = 2, -1, 1
#: Least alignment score of a hit, as a share of the item aligned with itself.
LEAST = 0.5
#: Pairs that are aligned side by side.
SIDE_BY_SIDE = 256
#: Bytes that are broadcast of the seeds, and of the candidates of documents; beyond it they are joined by a shuffle.
BROADCAST_BYTES = 32 << 20

#: Everything that parts the words here: ASCII other than letters and digits.
_BREAK = np.zeros(256, bool)
_BREAK[:128] = [not chr(i).isalnum() for i in range(128)]


def _words(piece: pa.RecordBatch) -> tuple[Words, np.ndarray]:
    data, offsets = flat(piece.column("text"))
    words = Words(LOWER[data], offsets, _BREAK)
    return words, words.hashes()


def _items(seed: int):
    """Tasks: the words of each item, and its words and pairs; an item shorter than ``seed`` is one n-gram."""

    def run(batches):
        for batch in batches:
            for piece in slices(batch, "text"):
                words, h = _words(piece)
                lists, grams = [], []
                for a, b in zip(words.first[:-1], words.first[1:]):
                    lists.append(signed(h[a:b]).tolist())
                    sizes = (1, 2) if b - a >= seed else [b - a] if b > a else []
                    grams.append([x for n in sizes if n <= b - a for x in signed(rolling(h[a:b], n)).tolist()])
                yield pa.RecordBatch.from_arrays(
                    [piece.column("item_id"), pa.array(lists, pa.list_(pa.int64())), pa.array(grams, pa.list_(pa.int64()))],
                    ["item_id", "words", "grams"],
                )

    return run


def _grams(sizes: list[int]):
    """Tasks: the n-grams of the given sizes of every text, that ``wanted`` holds."""

    def run(wanted):
        def find(batches):
            known = wanted.value
            for batch in batches:
                for piece in slices(batch, "text"):
                    words, h = _words(piece)
                    text = words.text_of()
                    rows = []
                    for n in sizes:
                        value = rolling(h, n)
                        if not len(value) or not len(known):
                            continue
                        near = np.minimum(np.searchsorted(known, value), len(known) - 1)
                        at = np.flatnonzero(known[near] == value)
                        at = at[text[at] == text[at + n - 1]]
                        rows.append((text[at], value[at], at - words.first[text[at]]))
                    if not rows:
                        continue
                    text, value, pos = (np.concatenate(c) for c in zip(*rows))
                    ids = piece.column("doc_id").take(pa.array(text))
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array(signed(value)), pa.array(pos, pa.int64())], ["doc_id", "gram", "pos"]
                    )

        return find

    return run


def _tallies(sizes: list[int]):
    """Tasks: how often the n-grams that ``wanted`` holds occur in a piece of text."""

    def run(wanted):
        find = _grams(sizes)(wanted)

        def count(batches):
            for found in find(batches):
                gram, n = np.unique(np.array(found.column("gram")), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(gram, pa.int64()), pa.array(n, pa.int64())], ["gram", "n"])

        return count

    return run


def _all_grams(sizes: list[int]):
    """Tasks: all n-grams of the given sizes of every text."""

    def run(batches):
        for batch in batches:
            for piece in slices(batch, "text"):
                words, h = _words(piece)
                text = words.text_of()
                for n in sizes:
                    value = rolling(h, n)
                    at = np.flatnonzero(text[: len(value)] == text[n - 1 :]) if len(value) else np.zeros(0, np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            piece.column("doc_id").take(pa.array(text[at])),
                            pa.array(signed(value[at])),
                            pa.array(at - words.first[text[at]], pa.int64()),
                        ],
                        ["doc_id", "gram", "pos"],
                    )

    return run


def _known(grams: DataFrame):
    """The stored ``grams``, ascending, as a broadcast; None if they are many."""
    if 8 * grams.limit(BROADCAST_BYTES // 8 + 1).count() > BROADCAST_BYTES:
        return None
    known = np.sort(np.array([r.gram for r in grams.toLocalIterator()], np.int64).view(np.uint64))
    return grams.sparkSession.sparkContext.broadcast(known)


def gram_counts(texts: DataFrame, grams: DataFrame, sizes: list[int]) -> DataFrame:
    """``gram, n``: how often the texts hold each of the stored ``grams`` that they hold."""
    known = _known(grams)
    if known is not None:
        return texts.mapInArrow(_tallies(sizes)(known), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    every = texts.mapInArrow(_all_grams(sizes), "doc_id long, gram long, pos long")
    return every.groupBy("gram").agg(F.count("*").alias("n")).join(grams, "gram", "left_semi")


def gram_hits(texts: DataFrame, grams: DataFrame, sizes: list[int]) -> DataFrame:
    """``doc_id, gram, pos`` wherever a text holds one of the stored ``grams``.

    Few grams are sent to where texts are read; many are joined.
    """
    schema = "doc_id long, gram long, pos long"
    known = _known(grams)
    if known is not None:
        return texts.mapInArrow(_grams(sizes)(known), schema)
    return texts.mapInArrow(_all_grams(sizes), schema).join(grams, "gram", "left_semi").select("doc_id", "gram", "pos")


def _stretches(batches):
    """Tasks: the words of each candidate stretch; ``around`` lists item, bucket and the width of buckets."""
    for batch in batches:
        for piece in slices(batch, "text"):
            words, h = _words(piece)
            doc, item, first, out = [], [], [], []
            for i, (doc_id, around) in enumerate(zip(piece.column("doc_id").to_pylist(), piece.column("around").to_pylist())):
                a, b = int(words.first[i]), int(words.first[i + 1])
                for c in around:
                    begin = min(b, a + c["bucket"] * c["width"])
                    end = min(b, begin + 2 * c["width"])
                    doc.append(doc_id)
                    item.append(c["item_id"])
                    first.append(begin - a)
                    out.append(signed(h[begin:end]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc, pa.int64()),
                    pa.array(item, pa.int64()),
                    pa.array(first, pa.int64()),
                    pa.array(out, pa.list_(pa.int64())),
                ],
                ["doc_id", "item_id", "first", "stretch"],
            )


def align(items: list[np.ndarray], texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each pair, and where in the text it ends; all pairs advance together.

    The step along a row, which depends on the cell before, is a running maximum of cells raised by their distance.
    """
    rows, width = max(map(len, items)), max(map(len, texts))
    a = np.zeros((len(items), rows), np.int64)
    b = np.zeros((len(items), width), np.int64)
    n = np.array([len(x) for x in items])
    real = np.arange(width) < np.array([len(x) for x in texts])[:, None]
    for i, (x, y) in enumerate(zip(items, texts)):
        a[i, : len(x)], b[i, : len(y)] = x, y
    ramp = GAP * np.arange(width, dtype=np.int32)
    above = np.zeros((len(items), width + 1), np.int32)
    best, end = np.zeros(len(items), np.int32), np.zeros(len(items), np.int64)
    for i in range(rows):
        step = np.where((b == a[:, i, None]) & real, MATCH, MISMATCH).astype(np.int32)
        cell = np.maximum(np.maximum(above[:, :-1] + step, above[:, 1:] - GAP), 0)
        cell = np.maximum.accumulate(cell + ramp, axis=1) - ramp
        cell[i >= n] = 0
        above[:, 1:] = cell
        at = cell.argmax(axis=1)
        top = cell[np.arange(len(cell)), at]
        better = top > best
        best[better], end[better] = top[better], at[better] + 1
    return best, end


def _score(least: float):
    """Tasks: the pairs that reach the least score, with the aligned words."""

    def run(batches):
        for batch in batches:
            doc, item = batch.column("doc_id").to_pylist(), batch.column("item_id").to_pylist()
            first = batch.column("first").to_pylist()
            words = [np.array(x.as_py() or [], np.int64) for x in batch.column("words")]
            text = [np.array(x.as_py() or [], np.int64) for x in batch.column("stretch")]
            order = sorted((i for i in range(len(doc)) if len(words[i]) and len(text[i])), key=lambda i: (len(words[i]), len(text[i])))
            out = []
            for k in range(0, len(order), SIDE_BY_SIDE):
                some = order[k : k + SIDE_BY_SIDE]
                best, end = align([words[i] for i in some], [text[i] for i in some])
                share = best / np.array([MATCH * len(words[i]) for i in some])
                good = [j for j in range(len(some)) if share[j] >= least]
                if not good:
                    continue
                # The same from behind, up to the end that was found, gives the beginning.
                back = [text[some[j]][: end[j]][::-1] for j in good]
                _, length = align([words[some[j]][::-1] for j in good], back)
                for j, n in zip(good, length):
                    i = some[j]
                    out.append((doc[i], item[i], float(share[j]), first[i] + int(end[j]) - int(n), first[i] + int(end[j])))
            columns = list(zip(*out)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], ["doc_id", "item_id", "score", "word_start", "word_end"]
            )
            hand_back()

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, seed: int = SEED, least: float = LEAST) -> DataFrame:
    """``doc_id, item_id, score, word_start, word_end``: documents that hold a benchmark item or an edited copy.

    ``score`` is the local alignment score over words as a share of the item's own (1 for an exact copy); rows have at
    least ``least``, and all such pairs are found; but an item of fewer than ``seed`` words is one hit where it stands as
    it is, and none otherwise.  One row per pair: the best place, the first of equals.  Words are runs of ASCII letters and
    digits and of all other characters beyond ASCII, lower-cased in A-Z; ``word_start`` and ``word_end`` count them.

    Null and wordless texts and items match nothing, nor do rows without their id.  Items with equal texts each get
    their rows; rows that repeat an id are one document or item, with the best score.  Other columns are ignored; an
    empty table gives no rows.
    """
    texts = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    texts = texts.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    given = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL")
    given = given.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = given.mapInArrow(_items(seed), "item_id long, words array<long>, grams array<long>")
    items = kept(items.withColumn("item", F.monotonically_increasing_id()), "items")
    n = F.size("words")
    whole = n < seed
    # Scores are whole numbers; the margin is for rounding in the product.
    score = F.greatest(F.ceil(2 * least * n - 1e-9), F.lit(1)).cast("long")
    need = F.when(whole, 1).otherwise(F.greatest(F.least(F.lit(NEED), score - 1), F.lit(1))).cast("long")
    of_item = items.select(
        "item",
        need.alias("need"),
        F.when(whole, 0).otherwise(F.greatest(score - 1 - need, F.lit(0))).alias("room"),
        F.greatest(3 * n - score, n).alias("width"),
        F.explode("grams").alias("gram"),
    )
    of_item = kept(of_item.groupBy("item", "need", "room", "width", "gram").agg(F.count("*").alias("times")), "grams")
    sizes = sorted({1, 2, *range(1, seed)})
    spread = gram_counts(texts, kept(of_item.select("gram").distinct(), "distinct_grams"), sizes)
    counted = of_item.join(spread, "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    often = Window.partitionBy("item").orderBy(F.col("n").desc(), "gram").rowsBetween(Window.unboundedPreceding, 0)
    seeds = counted.withColumn("more", F.sum("times").over(often)).where("more > room")
    seeds = kept(seeds.select("gram", "item", "need", "width", "times"), "seeds")
    hits = gram_hits(texts, kept(seeds.select("gram").distinct(), "seed_grams"), sizes)
    few = 48 * seeds.limit(BROADCAST_BYTES // 48 + 1).count() <= BROADCAST_BYTES
    near = hits.join(F.broadcast(seeds) if few else seeds, "gram")
    # An alignment that begins in a bucket ends in the next one at the latest.
    own = F.floor(F.col("pos") / F.col("width"))
    near = near.withColumn("bucket", F.explode(F.array(own, own - 1))).where("bucket >= 0")
    near = near.select("doc_id", F.col("item").alias("item_id"), "bucket", "width", "need", "gram", "times").distinct()
    around = near.groupBy("doc_id", "item_id", "bucket", "width", "need").agg(F.sum("times").alias("n")).where("n >= need")
    around = around.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "bucket", "width")).alias("around"))
    around = kept(around, "candidates")
    size = around.agg(F.sum(24 * F.size("around") + 64)).first()[0] or 0
    found = texts.join(F.broadcast(around) if size <= BROADCAST_BYTES else around, "doc_id")
    stretches = found.mapInArrow(_stretches, "doc_id long, item_id long, first long, stretch array<long>")
    pairs = stretches.join(items.select(F.col("item").alias("item_id"), "words"), "item_id")
    scored = pairs.select("doc_id", "item_id", "first", "stretch", "words").mapInArrow(
        _score(least), "doc_id long, item_id long, score double, word_start long, word_end long"
    )
    names = items.select(F.col("item").alias("number"), "item_id")
    scored = scored.withColumnRenamed("item_id", "number").join(names, "number")
    best = scored.groupBy("doc_id", "item_id").agg(
        F.max(F.struct("score", -F.col("word_start"), "word_end")).alias("m")
    )
    return best.select(
        "doc_id",
        "item_id",
        F.col("m.score").alias("score"),
        (-F.col("m").getField("col2")).alias("word_start"),
        F.col("m.word_end").alias("word_end"),
    )
