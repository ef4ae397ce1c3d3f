"""Near-duplicate documents by one-permutation hashing.

One hash per word shingle, cut into ``bins`` ranges; the smallest hash of each range is the signature, and an empty
range borrows from a range drawn for it alike in every document (optimal densification).  Bands of signature values
are buckets.  Each bucket gives star edges from its best connected document, so the pairs of a bucket grow with its
size, not with its square.  Every edge is confirmed on the full shingle sets.

Members of a bucket that the stars leave in different components are compared once more by their signatures, in
blocks of bounded size, and confirmed in the same way, so that a bucket with several centres loses no link.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .tables import kept, only_ids
from .text import LOWER, Words, flat, hand_back, mix, rolling, signed, slices

BANDS = 32
#: Chance that two documents exactly at the threshold share no bucket.
MISS = 1e-6
#: Members of a bucket that are compared by signature in one step.
BLOCK = 512
#: Values of the signature that such comparisons use, one byte each.  They drop a pair only this many standard
#: deviations below the threshold; a first look at every ``STRIDE``-th value drops the clear cases.
SKETCH, STRIDE = 1024, 8
SIGMAS = 6.0
_SET_BITS = np.uint64(48)


def band_rows(threshold: float, bands: int = BANDS, miss: float = MISS) -> int:
    """The most signature values per band with which a pair at the threshold is still found."""
    rows = 1
    while (1 - threshold ** (rows + 1)) ** bands <= miss:
        rows += 1
    return rows


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes (48 bits, ascending) of every text, and the text each belongs to.

    Words are lower-cased in A-Z.  A text of fewer words than a shingle is one shingle; one without words has none.
    """
    words = Words(LOWER[data], offsets)
    h, text, room = words.hashes(), words.text_of(), words.room()
    parts = []
    whole = rolling(h, size)
    full = np.flatnonzero(room[: len(whole)] >= size)
    parts.append((text[full], whole[full]))
    for n in range(1, size):
        short = np.flatnonzero(words.count == n)
        if len(short):
            parts.append((short, rolling(h, n)[words.first[short]]))
    text = np.concatenate([p[0] for p in parts]).astype(np.uint64)
    value = np.concatenate([p[1] for p in parts])
    both = np.sort((text << _SET_BITS) | (value >> np.uint64(16)))
    if len(both):
        both = both[np.concatenate([[True], both[1:] != both[:-1]])]
    return (both >> _SET_BITS).astype(np.int64), both & np.uint64((1 << 48) - 1)


def signatures(text: np.ndarray, value: np.ndarray, n_texts: int, bins: int) -> np.ndarray:
    """The densified signature of every text that has a shingle; rows of others stay zero."""
    place = text * bins + ((value * np.uint64(bins)) >> _SET_BITS).astype(np.int64)
    heads = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else np.zeros(0, int)
    out = np.zeros(n_texts * bins, np.uint64)
    filled = np.zeros(n_texts * bins, bool)
    out[place[heads]], filled[place[heads]] = value[heads], True
    out, filled = out.reshape(n_texts, bins), filled.reshape(n_texts, bins)
    row, place = np.nonzero(~filled & filled.any(axis=1, keepdims=True))
    attempt = 0
    while len(row):
        attempt += 1
        draw = mix(np.arange(bins, dtype=np.uint64) + np.uint64(attempt * 1_000_003)) % np.uint64(bins)
        source = draw.astype(np.int64)[place]
        hit = filled[row, source]
        out[row[hit], place[hit]] = out[row[hit], source[hit]]
        row, place = row[~hit], place[~hit]
    return out


def _set_hashes(text: np.ndarray, value: np.ndarray, n_texts: int) -> list[np.ndarray]:
    """Two 64-bit hashes of every text's shingle set."""
    begin = np.searchsorted(text, np.arange(n_texts + 1))
    out = []
    for salt in (1, 2):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(value + np.uint64(salt << 50)))])
        out.append(signed(mix(total[begin[1:]] - total[begin[:-1]] + np.uint64(salt))))
    return out


def _describe(size: int, bins: int, rows: int, bands: int):
    """Tasks: doc_id, n_shingles, set hashes and bucket keys of every text."""

    def run(batches):
        for batch in batches:
            for piece in slices(batch, "text"):
                n = piece.num_rows
                text, value = shingle_sets(*flat(piece.column("text")), size)
                count = np.bincount(text, minlength=n)
                high, low = _set_hashes(text, value, n)
                sig = signatures(text, value, n, bins).reshape(n * bands, rows)
                key = np.tile(np.arange(bands, dtype=np.uint64), n)
                for r in range(rows):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, r])
                key = signed(key).reshape(n, bands)[count > 0]
                ends = np.concatenate([[0], np.cumsum(np.where(count > 0, bands, 0))]).astype(np.int32)
                keys = pa.ListArray.from_arrays(pa.array(ends), pa.array(key.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(count), pa.array(high), pa.array(low), keys],
                    ["doc_id", "n_shingles", "high", "low", "keys"],
                )

    return run


def _full_sets(size: int):
    """Tasks: the full shingle set of every text (6 bytes a shingle), and a long signature of one byte a value."""

    def run(batches):
        for batch in batches:
            for piece in slices(batch, "text"):
                n = piece.num_rows
                text, value = shingle_sets(*flat(piece.column("text")), size)
                high, low = _set_hashes(text, value, n)
                sig = (signatures(text, value, n, SKETCH) & np.uint64(255)).astype(np.uint8)
                packed = np.ascontiguousarray(value.view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()
                ends = np.searchsorted(text, np.arange(n + 1)) * 6
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        pa.array(high),
                        pa.array(low),
                        pa.array([packed[ends[i] : ends[i + 1]] for i in range(n)], pa.binary()),
                        pa.array([row.tobytes() for row in sig], pa.binary()),
                    ],
                    ["doc_id", "high", "low", "members", "sketch"],
                )

    return run


def _unpack(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).reshape(-1)


def _confirm(percent: int):
    """Tasks: the pairs whose full sets reach the threshold."""

    def run(batches):
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            left, right = batch.column("members_a"), batch.column("members_b")
            out = []
            last, x = None, None
            for i in range(batch.num_rows):
                if a[i] != last:
                    last, x = a[i], _unpack(left[i].as_py())
                y = _unpack(right[i].as_py())
                n, m = sorted((len(x), len(y)))
                if 100 * n < percent * m:
                    continue
                both = np.sort(np.concatenate([x, y]))
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                if 100 * common >= percent * (n + m - common):
                    out.append((a[i], b[i]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in out], pa.int64()), pa.array([p[1] for p in out], pa.int64())], ["a", "b"]
            )
            hand_back()

    return run


def least_equal(values: int, percent: int) -> float:
    """Equal values, of so many, from which a pair may be at the threshold."""
    return values * percent / 100 - SIGMAS * math.sqrt(values * percent * (100 - percent)) / 100


def _compare(percent: int, bands: int):
    """Tasks: of two blocks of a bucket, the pairs of different components whose signatures nearly reach the threshold.

    A pair counts only in the first of the buckets it shares.
    """

    def run(table: pa.Table) -> pa.Table:
        node = np.array(table.column("rep"))
        comp, count, side = (np.array(table.column(c)) for c in ("component", "n_shingles", "side"))
        keys = np.array(table.column("keys").combine_chunks().flatten()).reshape(-1, bands)
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(node), SKETCH)
        coarse = np.ascontiguousarray(sketch[:, ::STRIDE])
        band, same = int(table.column("band")[0].as_py()), bool(table.column("same")[0].as_py())
        rows = np.flatnonzero(side == 0)
        others = rows if same else np.flatnonzero(side == 1)
        out_a, out_b = [], []
        for i in rows:
            j = others[node[others] > node[i]] if same else others
            small, large = np.minimum(count[j], count[i]), np.maximum(count[j], count[i])
            j = j[(comp[j] != comp[i]) & (100 * small >= percent * large)]
            for values in (coarse, sketch):
                if len(j):
                    j = j[np.count_nonzero(values[j] == values[i], axis=1) >= least_equal(values.shape[1], percent)]
            if len(j) and band:
                j = j[~(keys[j, :band] == keys[i, :band]).any(axis=1)]
            out_a.append(np.minimum(node[i], node[j]))
            out_b.append(np.maximum(node[i], node[j]))
        empty = np.zeros(0, np.int64)
        return pa.table({"a": np.concatenate([empty, *out_a]), "b": np.concatenate([empty, *out_b])})

    return run


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("doc_id").alias("a"), F.col("members").alias("members_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("members").alias("members_b"))
    return (
        pairs.join(right, "b").join(left, "a").select("a", "b", "members_a", "members_b")
        .mapInArrow(_confirm(percent), "a long, b long")
    )


def near_duplicates(docs: DataFrame, percent: int = 80, shingle: int = 5, bands: int = BANDS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (``doc_id, text``).

    Two documents are linked if ``100 * common >= percent * union`` of their distinct ``shingle``-word shingles
    (A-Z lower-cased; a shorter text is one shingle).  ``component_id`` is the smallest doc_id that links reach,
    and ``kept`` is true where it is the document's own.  Equal sets are one class and cost one comparison.

    Null and wordless texts have no shingles and are their own component.  Rows without doc_id are kept, link
    nothing and have no component.  Rows that repeat a doc_id are judged each by its own text.  Other columns are
    ignored; an empty table gives no rows.
    """
    threshold = percent / 100
    rows = band_rows(threshold, bands)
    bins = rows * bands
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    described = kept(
        texts.mapInArrow(
            _describe(shingle, bins, rows, bands),
            "doc_id long, n_shingles long, high long, low long, keys array<long>",
        ),
        "signatures",
    )
    classes = kept(
        described.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("high", "low")
        .agg(F.min(F.struct("doc_id", "n_shingles", "keys")).alias("m"))
        .select("high", "low", F.col("m.doc_id").alias("rep"), F.col("m.n_shingles"), F.col("m.keys")),
        "classes",
    )
    spread = classes.select("rep", F.posexplode("keys").alias("band", "key"))
    shared = spread.groupBy("key").count().where("count > 1")
    buckets = kept(spread.join(shared, "key"), "buckets")

    weight = buckets.groupBy("rep").agg(F.sum("count").alias("weight"))
    weighed = buckets.join(weight, "rep")
    centre = weighed.groupBy("key").agg(F.max(F.struct("weight", -F.col("rep"))).alias("m"))
    centre = centre.select("key", (-F.col("m").getField("col2")).alias("centre"))
    member = kept(buckets.join(centre, "key").where("rep <> centre"), "stars")
    stars = member.select(F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b")).distinct()

    involved = kept(buckets.select("rep").distinct(), "involved").withColumnRenamed("rep", "doc_id")
    sets = only_ids(texts, involved, "doc_id").mapInArrow(
        _full_sets(shingle), "doc_id long, high long, low long, members binary, sketch binary"
    )
    of_class = classes.select(F.col("rep").alias("doc_id"), "high", "low")
    sets = kept(sets.join(of_class, ["doc_id", "high", "low"], "left_semi"), "sets")
    links = kept(_links(stars, sets, percent), "links")

    found = components(links)
    place = member.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "band", "rep", F.coalesce("component", "rep").alias("component")
    )
    mixed = (
        place.groupBy("key")
        .agg(F.min("component").alias("first"), F.max("component").alias("last"), F.count("*").alias("members"))
        .where("first < last")
        .select("key", F.ceil(F.col("members") / BLOCK).alias("blocks"))
    )
    block = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    rest = (
        place.join(mixed, "key")
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("side", (F.col("block") > F.col("other")).cast("int"))
        .withColumn("low_block", F.least("block", "other"))
        .withColumn("high_block", F.greatest("block", "other"))
        .withColumn("same", F.col("low_block") == F.col("high_block"))
        .join(classes.select("rep", "n_shingles", "keys"), "rep")
        .join(sets.select(F.col("doc_id").alias("rep"), "sketch"), "rep")
        .select("key", "low_block", "high_block", "band", "same", "side", "rep", "component", "n_shingles", "keys", "sketch")
    )
    late = rest.groupBy("key", "low_block", "high_block").applyInArrow(
        _compare(percent, bands), "a long, b long"
    )
    late = _links(late.distinct(), sets, percent)
    final = components(links.union(late))

    reached = classes.select("high", "low", "rep").join(final.withColumnRenamed("node", "rep"), "rep", "left")
    reached = kept(reached.select("high", "low", F.coalesce("component", "rep").alias("reached")), "reached")
    out = described.select("doc_id", "n_shingles", "high", "low").join(reached, ["high", "low"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("reached")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
