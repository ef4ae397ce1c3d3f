import math
import random

import duckdb
import numpy as np
import pytest

from varloom.llm import minhash
from varloom.llm.queries import QUERIES
from varloom.llm.text import Words, flat, rolling

from . import brute

SCHEMA = "doc_id long, text string"


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("percent", [50, 80, 85, 95])
def test_looks_at_signatures_lose_no_more_than_the_bands(percent):
    p, lost = percent / 100, 0.0
    for n in (minhash.SKETCH // minhash.STRIDE, minhash.SKETCH):
        most = math.ceil(minhash.least_equal(n, percent))
        lost += math.fsum(
            math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log(1 - p))
            for i in range(most)
        )
    assert lost < 5e-7 < minhash.MISS


def test_words_and_windows_match_plain_python():
    import pyarrow as pa

    texts = ["a b  c\td", "", None, "  x", "né e\x0bf", "y" * 200 + " y", "a b"]
    w = Words(*flat(pa.array(texts)))
    got = [bytes(w.bytes[s:e]).decode() for s, e in zip(w.start, w.end)]
    assert got == [x for t in texts for x in brute.words(t)]
    assert list(w.count) == [len(brute.words(t)) for t in texts]
    h = w.hashes()
    assert len(set(h.tolist())) == len(set(got))
    assert rolling(h, 2)[0] == rolling(h, 2)[len(h) - 2]
    for width in (1, 2, 3, 5, 7, 20):
        a = rolling(np.arange(50, dtype=np.uint64), width)
        assert len(a) == 50 - width + 1 and len(set(a.tolist())) == len(a)


@pytest.mark.parametrize("percent", [80, 85])
def test_components_match_all_pairs(spark, percent):
    rng = random.Random(percent)
    base = [[f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 8, 40, 200]))] for _ in range(12)]
    docs = []
    for i in range(400):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(0, 1 + len(w) // 12)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        docs.append((i * 3 % 401, " ".join(w)))
    got = result(minhash.near_duplicates(spark.createDataFrame(docs, SCHEMA), percent))
    assert got == brute.near_duplicates(docs, percent)


def test_odd_rows_have_defined_results(spark):
    docs = [(1, None), (2, ""), (3, " \n"), (4, "A b"), (5, "a B"), (5, "a B"), (None, "a b"), (7, "x" * 300_000)]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], SCHEMA + ", high long, keys long")
    got = sorted(minhash.near_duplicates(df).collect(), key=repr)
    want = [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (5, 1, 4, False)]
    want += [(None, 1, None, True), (7, 1, 7, True)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert not minhash.near_duplicates(df.limit(0)).count()


def test_query_matches_all_pairs(spark):
    d = "/root/testdata/sf0.001"
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{d}/documents.parquet'").fetchall()
    assert result(QUERIES["op10_minhash_near_dedup"](spark, d)) == brute.near_duplicates(docs, 85)
