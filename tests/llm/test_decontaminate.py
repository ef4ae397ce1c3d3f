import random

import duckdb
import numpy as np
import re

from varloom.llm import decontaminate as dec
from varloom.llm.queries import QUERIES


def words(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_score(a, b):
    best, above = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(max(0, above[j] + (dec.MATCH if x == y else dec.MISMATCH), above[j + 1] - dec.GAP, row[j] - dec.GAP))
        best, above = max(best, *row), row
    return best


def test_alignment_matches_the_plain_recurrence():
    rng = random.Random(5)
    a = [np.array([rng.randrange(4) for _ in range(rng.randrange(1, 12))]) for _ in range(60)]
    b = [np.array([rng.randrange(4) for _ in range(rng.randrange(1, 25))]) for _ in range(60)]
    best, end = dec.align(a, b)
    for x, y, s, e in zip(a, b, best, end):
        assert s == plain_score(x, y) == plain_score(x, y[:e])


def test_edited_copies_are_found_and_others_are_not(spark):
    rng = random.Random(7)
    items = [(i, " ".join(f"{rng.choice('abcdef')}{rng.randrange(300)}" for _ in range(rng.randrange(8, 50)))) for i in range(20)]
    docs = []
    for i in range(120):
        w = [f"{rng.choice('abcdef')}{rng.randrange(300)}" for _ in range(rng.randrange(10, 300))]
        if i % 3 == 0:
            copy = rng.choice(items)[1].title().split()
            for _ in range(len(copy) // 7):
                k = rng.randrange(len(copy))
                copy[k : k + rng.randrange(2)] = [rng.choice(["new,", "x"])]
            w[len(w) // 2 : len(w) // 2] = copy
        docs.append((i, ". ".join(w)))
    got = {(r.doc_id, r.item_id): r for r in dec.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()}
    want = {}
    for i, text in docs:
        for j, item in items:
            score = plain_score(words(item), words(text)) / (dec.MATCH * len(words(item)))
            if score >= dec.LEAST:
                want[i, j] = score
    assert set(got) == set(want) and len(want) >= 35
    for k, r in got.items():
        assert abs(r.score - want[k]) < 1e-9
        part = words(dict(docs)[k[0]])[r.word_start : r.word_end]
        assert abs(plain_score(words(dict(items)[k[1]]), part) / (dec.MATCH * len(words(dict(items)[k[1]]))) - r.score) < 1e-9


def test_hot_partial_copies_and_copies_without_long_runs_are_found(spark, monkeypatch):
    item = [f"w{i}" for i in range(20)]
    docs = [(i, " ".join([*item[:11], *(f"d{i}x{k}" for k in range(9))])) for i in range(200)]
    apart = [x for k in range(0, 20, 2) for x in (item[k], item[k + 1], f"new{k}")]
    single = [x for w in item[:19] for x in (w, "and")]
    third = [f"new{k}" if k in (2, 5, 8, 11) else w for k, w in enumerate(item)]
    docs += [(1000, " ".join(item)), (1001, "x " * 77 + " ".join(apart)), (1002, "y " * 119 + " ".join(single))]
    docs += [(1003, " ".join(third)), (1004, " ".join(item[:8]))]
    want = {i: plain_score(item, words(t)) / 40 for i, t in docs}
    want = {i: s for i, s in want.items() if s >= dec.LEAST}
    assert len(want) == 204
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    for limit in (1 << 20, 0):
        monkeypatch.setattr(dec, "BROADCAST_BYTES", limit)
        assert {r.doc_id: r.score for r in dec.contamination(d, b).collect()} == want


def test_odd_rows_have_defined_results(spark, monkeypatch):
    item = "one two three four five six seven eight"
    docs = [(1, None), (2, ""), (3, item), (3, item), (None, item), (4, "x " * 50_000 + item), (5, "only two"), (6, "!!!")]
    items = [(1, item), (1, item), (2, item.upper()), (3, None), (None, item), (4, ""), (5, "Only two.")]
    d = spark.createDataFrame([(*x, 1, 2) for x in docs], "doc_id long, text string, item_id int, score int")
    b = spark.createDataFrame([(*x, 9) for x in items], "item_id long, text string, doc_id int")
    for limit in (1 << 20, 0):
        monkeypatch.setattr(dec, "BROADCAST_BYTES", limit)
        got = {(r.doc_id, r.item_id): (r.score, r.word_start) for r in dec.contamination(d, b).collect()}
        assert got == {(3, 1): (1.0, 0), (3, 2): (1.0, 0), (4, 1): (1.0, 50_000), (4, 2): (1.0, 50_000), (5, 5): (1.0, 0)}
    assert not dec.contamination(d.limit(0), b).count() and not dec.contamination(d, b.limit(0)).count()


def test_query_finds_all_whole_copies(spark):
    d = "/root/testdata/sf0.01"
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{d}/documents.parquet'").fetchall()
    items = duckdb.sql(f"SELECT item_id, text FROM '{d}/benchmark.parquet'").fetchall()
    got = {(r.doc_id, r.item_id): r.score for r in QUERIES["op7_decontamination"](spark, d).collect()}
    whole = {(i, j) for i, t in docs for j, x in items if f" {' '.join(words(x))} " in f" {' '.join(words(t))} "}
    assert whole and whole <= set(got) and all(got[k] == 1 for k in whole)


def test_words_and_pairs_are_counted_in_every_text(spark, monkeypatch):
    """The frequencies that choose the seeds are those of all texts, joined or broadcast."""
    rng, count, seen = random.Random(11), dec.gram_counts, []
    docs = [(i, " ".join(rng.choice("abcde") for _ in range(30))) for i in range(40)]
    d = spark.createDataFrame([*docs, (99, None), (None, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")

    def counted(*args):
        seen.append(sorted(r.n for r in count(*args).collect()))
        return count(*args)

    monkeypatch.setattr(dec, "gram_counts", counted)
    texts = [t.split() for _, t in docs]
    item = "a b c d e".split()
    grams = [(w,) for w in item] + list(zip(item, item[1:]))
    want = [sum(tuple(t[i : i + len(g)]) == g for t in texts for i in range(len(t) - len(g) + 1)) for g in grams]
    for limit in (1 << 20, 0):
        monkeypatch.setattr(dec, "BROADCAST_BYTES", limit)
        dec.contamination(d, b)
    assert seen == [sorted(want), sorted(want)]
