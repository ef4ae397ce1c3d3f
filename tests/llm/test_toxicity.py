import random

import numpy as np

from varloom.llm import toxicity as tox
from varloom.llm.queries import QUERIES


def corpus(n, seed):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        w = [f"{rng.choice('abcdefg')}{rng.choice(['lor', 'mip', 'tan'])}{rng.randrange(40)}" for _ in range(rng.randrange(5, 120))]
        y = int(rng.random() < 0.15)
        for _ in range(3 * y):
            w[rng.randrange(len(w))] = rng.choice(["Vile,", "rotten", "zzzap" + rng.choice("xyz")])
        docs.append((i, " ".join(w)))
        labels.append((i, y))
    return docs, labels


def test_nearest_are_those_of_a_full_scan():
    rng = np.random.default_rng(3)
    vectors = []
    for _ in range(700):
        t = np.sort(rng.choice(60, rng.integers(1, 9), replace=False))
        w = rng.random(len(t))
        vectors.append((t, w / np.sqrt(w @ w)))
    index = tox.Index(vectors, [0] * 700, list(range(700)), 60)
    full = np.zeros((700, 60))
    for i, (t, w) in enumerate(vectors):
        full[i, t] = w
    for t, w in vectors[:200]:
        cosine = full[:, t] @ w
        found, got = index.nearest(t, w, 10)
        assert np.allclose(got, np.sort(cosine)[::-1][:10]) and np.allclose(cosine[index.ids[found]], got)


def test_held_out_accuracy(spark):
    docs, labels = corpus(1200, 1)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    model = tox.fit(df, spark.createDataFrame(labels[:800], "doc_id long, toxic int"))
    got = {r.doc_id: r for r in tox.toxicity(df, model).collect()}
    right = [got[i].predicted == y for i, y in labels[800:]]
    assert sum(right) >= 0.97 * len(right)
    hit = next(i for i, y in labels[800:] if y)
    assert all(dict(labels)[e] == 1 for e in got[hit].evidence_ids[:1]) and 0 <= got[hit].score <= 1


def test_odd_rows_have_defined_results(spark):
    docs, labels = corpus(300, 2)
    odd = [(1000, None), (1001, ""), (1002, "!!! ..."), (1003, "vile " * 50_000), (None, "vile"), (7, docs[7][1])]
    df = spark.createDataFrame([(*d, 5) for d in docs + odd], "doc_id long, text string, score int")
    labels += [(1, None), (None, 1), (3, labels[3][1])]
    model = tox.fit(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    rows = tox.toxicity(df, model).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == 306 and rows[0].asDict().keys() == {"doc_id", "text", "score", "predicted", "evidence_ids", "evidence_cosines"}
    assert got[1000].score == got[1001].score == got[1002].score == model.empty and not got[1000].predicted
    assert got[1003].predicted == 1 and got[None].predicted == 1
    assert not tox.toxicity(df.limit(0), model).count()
    empty = tox.fit(df, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in tox.toxicity(df, empty).collect()} == {0.0}


def test_query_separates_held_out_documents(spark):
    d = "/root/testdata/sf0.1"
    rows = QUERIES["op4_toxicity"](spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.toxic for r in rows)
    assert len(rows) > 500 and right >= 0.97 * len(rows)
    assert spark.read.parquet(f"{d}/documents.parquet").count() == QUERIES["op4_toxicity"](spark, d).count()
