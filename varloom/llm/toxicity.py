"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

The labelled examples are a bounded sample.  Its texts give the vocabulary (words and byte n-grams inside words that
the labels depend on) and the index: examples in blocks, per block the postings of its terms and each term's largest
weight.  A query visits blocks in the order of their upper bounds and stops when no other block can hold a nearer
example, so the neighbours are exact.  Votes weighted by distance are then calibrated on the examples themselves,
each scored without itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import kept
from .text import LOWER, Words, flat, hash_spans, mix, slices

#: Most labelled texts of each class that the index is fitted on, drawn by a hash of doc_id.
TOXIC_EXAMPLES, CLEAN_EXAMPLES = 2000, 3000
#: Most terms of the vocabulary; the least dependence on the label (likelihood ratio) of a term, and how many times
#: as frequent it must be in toxic examples as in clean ones.
TERMS, DEPENDENCE, LIFT = 3000, 20.0, 4.0
NEIGHBOURS = 15
BLOCK = 64
#: Bytes of n-grams at the beginning of a word, and anywhere in it.
PREFIXES, INNER = (4, 5, 6), 5
THRESHOLD = 0.3

#: Everything that parts the words here: ASCII other than letters and digits.
_BREAK = np.zeros(256, bool)
_BREAK[:128] = [not chr(i).isalnum() for i in range(128)]


class _Terms:
    """Distinct words of a piece, which word each occurrence is, and the terms of each distinct word."""

    def __init__(self, piece: pa.RecordBatch):
        data, offsets = flat(piece.column("text"))
        words = Words(LOWER[data], offsets, _BREAK)
        h = words.hashes()
        self.text = words.text_of()
        known, first, self.word = np.unique(h, return_index=True, return_inverse=True)
        start, end = words.start[first], words.end[first]
        owner, term = [np.arange(len(known))], [mix(known)]
        for n in PREFIXES:
            long = np.flatnonzero(end - start >= n)
            owner.append(long)
            term.append(mix(hash_spans(words.bytes, start[long], start[long] + n) + np.uint64(n)))
        spare = np.maximum(end - start - INNER + 1, 0)
        each = np.repeat(np.arange(len(known)), spare)
        at = start[each] + np.arange(len(each)) - np.repeat(np.cumsum(spare) - spare, spare)
        owner.append(each)
        term.append(mix(hash_spans(words.bytes, at, at + INNER) + np.uint64(99)))
        self.owner, self.term = np.concatenate(owner), np.concatenate(term)

    def counts(self, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, term number and count, for the terms of the sorted vocabulary."""
        if not len(vocabulary) or not len(self.term):
            none = np.zeros(0, np.int64)
            return none, none, none
        near = np.minimum(np.searchsorted(vocabulary, self.term), len(vocabulary) - 1)
        hit = np.flatnonzero(vocabulary[near] == self.term)
        owner, number = self.owner[hit], near[hit]
        order = np.argsort(owner, kind="stable")
        owner, number = owner[order], number[order]
        begin = np.searchsorted(owner, np.arange(int(self.word.max()) + 2))
        use = np.flatnonzero(begin[self.word + 1] > begin[self.word])
        many = begin[self.word[use] + 1] - begin[self.word[use]]
        text = np.repeat(self.text[use], many)
        at = np.repeat(begin[self.word[use]], many) + np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
        key, count = np.unique(text * len(vocabulary) + number[at], return_counts=True)
        return key // len(vocabulary), key % len(vocabulary), count


def _term_counts(batches):
    """Tasks: for each term the number of toxic and of clean texts of a piece that hold it."""
    for batch in batches:
        for piece in slices(batch, "text", rows=1024):
            terms = _Terms(piece)
            if not len(terms.term):
                continue
            toxic = np.array(piece.column("toxic"))
            number = np.unique(terms.term, return_inverse=True)[1]
            names = terms.term[np.unique(number, return_index=True)[1]]
            order = np.argsort(terms.owner, kind="stable")
            begin = np.searchsorted(terms.owner[order], np.arange(int(terms.word.max()) + 2))
            pairs = np.unique(terms.text * (int(terms.word.max()) + 1) + terms.word)
            text, word = pairs // (int(terms.word.max()) + 1), pairs % (int(terms.word.max()) + 1)
            many = begin[word + 1] - begin[word]
            text = np.repeat(text, many)
            at = np.repeat(begin[word], many) + np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
            held = np.unique(text * len(names) + number[order][at])
            text, held = held // len(names), held % len(names)
            bad = np.bincount(held, weights=toxic[text], minlength=len(names)).astype(np.int64)
            all_ = np.bincount(held, minlength=len(names))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names.view(np.int64)), pa.array(bad), pa.array(all_ - bad)], ["term", "toxic", "clean"]
            )


def _dependence(bad, good, n_bad, n_good):
    """Likelihood ratio of the label given the term."""

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))

    held, total = bad + good, float(n_bad + n_good)
    out = part(bad, held * (n_bad / total)) + part(good, held * (n_good / total))
    rest = F.lit(total) - held
    return 2 * (out + part(n_bad - bad, rest * (n_bad / total)) + part(n_good - good, rest * (n_good / total)))


def _weights(text, term, count, idf):
    """TF-IDF weights of unit length for each text."""
    w = (1 + np.log(count)) * idf[term]
    norm = np.sqrt(np.bincount(text, weights=w * w, minlength=int(text.max(initial=-1)) + 1))
    return w / norm[text]


def _vectors(vocabulary):
    """Tasks: the counts of vocabulary terms of each text."""

    def run(batches):
        for batch in batches:
            for piece in slices(batch, "text"):
                text, term, count = _Terms(piece).counts(vocabulary)
                cuts = pa.array(np.searchsorted(text, np.arange(piece.num_rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        piece.column("toxic"),
                        pa.ListArray.from_arrays(cuts, pa.array(term, pa.int64())),
                        pa.ListArray.from_arrays(cuts, pa.array(count, pa.int64())),
                    ],
                    ["doc_id", "toxic", "terms", "counts"],
                )

    return run


class Index:
    """Examples with at least one term, in blocks of like examples, with block maxima."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], toxic: list[int], ids: list[int], terms: int):
        order = sorted(range(len(vectors)), key=lambda i: (int(vectors[i][0][np.argmax(vectors[i][1])]), ids[i]))
        self.ids = np.array([ids[i] for i in order], np.int64)
        self.toxic = np.array([toxic[i] for i in order], np.float64)
        self.blocks = []
        self.largest = np.zeros((-(-len(order) // BLOCK), terms), np.float32)
        for b in range(len(self.largest)):
            own = order[b * BLOCK : (b + 1) * BLOCK]
            used = np.unique(np.concatenate([vectors[i][0] for i in own]))
            column = np.full(terms, -1, np.int32)
            column[used] = np.arange(len(used))
            weights = np.zeros((len(own), len(used)))
            for row, i in enumerate(own):
                weights[row, column[vectors[i][0]]] = vectors[i][1]
            # Rounded up, so that the bound holds.
            self.largest[b, used] = np.nextafter(weights.max(axis=0).astype(np.float32), np.float32(2))
            self.blocks.append((column, weights))

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and cosines of the ``k`` nearest examples that share a term, nearest first; ties by number."""
        if not len(self.blocks) or not len(term):
            return np.zeros(0, np.int64), np.zeros(0)
        bound = self.largest[:, term].astype(np.float64) @ weight
        best_id, best = np.zeros(0, np.int64), np.zeros(0)
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or (len(best) == k and bound[b] < best[-1]):
                break
            column, weights = self.blocks[b]
            at = column[term]
            has = at >= 0
            score = weights[:, at[has]] @ weight[has]
            number = np.arange(b * BLOCK, b * BLOCK + len(score))
            good = (score > 0) & (number != without)
            best_id, best = np.concatenate([best_id, number[good]]), np.concatenate([best, score[good]])
            order = np.lexsort((best_id, -best))[:k]
            best_id, best = best_id[order], best[order]
        return best_id, best


def _vote(index: Index, found: np.ndarray, cosine: np.ndarray, base: float) -> float:
    """Share of toxic votes; a neighbour counts more the nearer it is, and the base rate has one weak vote."""
    weight = cosine / (1.05 - np.minimum(cosine, 1.0))
    return float((weight @ index.toxic[found] + 0.05 * base) / (weight.sum() + 0.05))


def rising(raw: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best rising fit of labels to raw scores (pooled neighbours): ends of steps and their values."""
    order = np.argsort(raw, kind="stable")
    steps: list[list[float]] = []
    for r, y, w in zip(raw[order], label[order], weight[order]):
        steps.append([r, y * w, w])
        while len(steps) > 1 and (steps[-2][0] == steps[-1][0] or steps[-2][1] / steps[-2][2] >= steps[-1][1] / steps[-1][2]):
            r, y, w = steps.pop()
            steps[-1] = [r, steps[-1][1] + y, steps[-1][2] + w]
    return np.array([s[0] for s in steps]), np.array([(s[1] + 0.02) / (s[2] + 1) for s in steps])


class Model:
    """Vocabulary, index and calibration; bounded by the numbers of examples and terms."""

    def __init__(self, rows, vocabulary: np.ndarray, share: float):
        """``rows``: doc_id, toxic, terms, counts of the examples.  ``share``: of toxic texts among all labelled."""
        self.vocabulary = vocabulary
        rows = sorted(rows, key=lambda r: (r[0], r[1]))
        held = np.zeros(len(vocabulary))
        for r in rows:
            held[r[2]] += 1
        self.idf = np.log((1 + len(rows)) / (1 + held)) + 1
        full = [r for r in rows if len(r[2])]
        vectors = [self.vector(np.array(r[2]), np.array(r[3])) for r in full]
        self.index = Index(vectors, [r[1] for r in full], [r[0] for r in full], len(vocabulary))
        n_bad = sum(r[1] for r in rows)
        n_good = len(rows) - n_bad
        # Each class counts as in the labels, not as in the sample.
        of = {1: share / max(n_bad, 1), 0: (1 - share) / max(n_good, 1)}
        empty = [r[1] for r in rows if not len(r[2])]
        weight = sum(of[y] for y in empty)
        self.base = share
        self.empty = sum(of[y] for y in empty if y) / weight if weight else share
        place = {int(i): n for n, i in enumerate(self.index.ids)}
        raw = np.array([self.raw(*v, without=place[r[0]]) for v, r in zip(vectors, full)])
        label = np.array([float(r[1]) for r in full])
        scale = len(rows) * np.array([of[r[1]] for r in full])
        self.steps, self.values = rising(raw, label, scale) if len(full) else (np.zeros(0), np.zeros(0))
        self.seen: dict[bytes, float] = {}

    def vector(self, term: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = (1 + np.log(count)) * self.idf[term]
        return term, w / np.sqrt(w @ w)

    def raw(self, term: np.ndarray, weight: np.ndarray, without: int = -1) -> float:
        return _vote(self.index, *self.index.nearest(term, weight, NEIGHBOURS, without), self.base)

    def score(self, term: np.ndarray, count: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Calibrated score, and the evidence: ids and cosines of the nearest examples."""
        if not len(term):
            return self.empty, np.zeros(0, np.int64), np.zeros(0)
        found, cosine = self.index.nearest(*self.vector(term, count), NEIGHBOURS)
        if not len(found):
            return self.empty, found, cosine
        raw = _vote(self.index, found, cosine, self.base)
        step = min(int(np.searchsorted(self.steps, raw)), len(self.values) - 1)
        return float(self.values[step]), self.index.ids[found], cosine


def fit(docs: DataFrame, labelled: DataFrame, toxic_examples: int = TOXIC_EXAMPLES, clean_examples: int = CLEAN_EXAMPLES) -> Model:
    """A model from a bounded sample of ``labelled`` (``doc_id, toxic``) and the texts of these documents.

    A document labelled more than once is toxic if any of its labels is.  Null labels and ids are left out.
    """
    labelled = labelled.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id")
    labelled = kept(labelled.agg(F.max(F.col("toxic").cast("int")).alias("toxic")), "labels")
    drawn = [
        labelled.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        for y, n in ((1, toxic_examples), (0, clean_examples))
    ]
    drawn = kept(drawn[0].union(drawn[1]), "drawn")
    counts = labelled.groupBy("toxic").count().collect()
    total = sum(r["count"] for r in counts)
    share = sum(r["count"] for r in counts if r["toxic"]) / total if total else 0.0
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = texts.join(F.broadcast(drawn), "doc_id").dropDuplicates(["doc_id"])
    sample = kept(sample.repartition(16, "doc_id"), "examples")
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_bad, n_good = n.get(1, 0), n.get(0, 0)
    vocabulary = np.zeros(0, np.uint64)
    if n_bad and n_good:
        terms = sample.mapInArrow(_term_counts, "term long, toxic long, clean long").groupBy("term")
        terms = terms.agg(F.sum("toxic").alias("bad"), F.sum("clean").alias("good"))
        terms = terms.withColumn("g", _dependence(F.col("bad"), F.col("good"), n_bad, n_good))
        lifted = F.col("bad") * float(n_good) >= F.col("good") * (LIFT * n_bad)
        chosen = terms.where(lifted & (F.col("g") >= DEPENDENCE)).orderBy(F.desc("g"), "term").limit(TERMS).select("term")
        vocabulary = np.sort(np.array([r.term for r in chosen.collect()], np.int64).view(np.uint64))
    vectors = sample.select("doc_id", "toxic", "text").mapInArrow(
        _vectors(vocabulary), "doc_id long, toxic int, terms array<long>, counts array<long>"
    )
    return Model([tuple(r) for r in vectors.collect()], vocabulary, share)


def _score(model):
    def run(batches):
        own = model.value
        for batch in batches:
            for piece in slices(batch, "text"):
                text, term, count = _Terms(piece).counts(own.vocabulary)
                cut = np.searchsorted(text, np.arange(piece.num_rows + 1))
                known, score, ids, cosines = {}, [], [], []
                for a, b in zip(cut[:-1], cut[1:]):
                    key = term[a:b].tobytes() + count[a:b].tobytes()
                    if key not in known:
                        known[key] = own.score(term[a:b], count[a:b])
                    s, i, c = known[key]
                    score.append(s)
                    ids.append(i[:5].tolist())
                    cosines.append(c[:5].tolist())
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("row"),
                        piece.column("text"),
                        pa.array(score, pa.float64()),
                        pa.array(ids, pa.list_(pa.int64())),
                        pa.array(cosines, pa.list_(pa.float64())),
                    ],
                    ["row", "text", "score", "evidence_ids", "evidence_cosines"],
                )

    return run


def toxicity(docs: DataFrame, model: Model, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``predicted`` (1 from ``THRESHOLD`` on) and the nearest examples as evidence.

    The score depends on the text alone.  Null and empty texts, and texts without a term of the vocabulary, get the
    share of toxic examples among examples without one, and no evidence.  Without labels of both classes every text
    gets the share of toxic labels.  Repeated rows get equal scores; columns named like the new ones are replaced.
    """
    spark = docs.sparkSession
    new = ["score", "predicted", "evidence_ids", "evidence_cosines"]
    old = [c for c in docs.columns if c not in (*new, "text")]
    rows = docs.select(F.struct(*old).alias("row"), F.col("text").cast("string").alias("text"))
    schema = T.StructType(list(rows.schema)).add("score", "double").add("evidence_ids", T.ArrayType(T.LongType()))
    schema = schema.add("evidence_cosines", T.ArrayType(T.DoubleType()))
    out = rows.mapInArrow(_score(spark.sparkContext.broadcast(model)), schema)
    back = [F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns if c not in new]
    back = back if keep_text else [c for c, name in zip(back, [c for c in docs.columns if c not in new]) if name != "text"]
    return out.select(
        *back, "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence_ids", "evidence_cosines"
    )
