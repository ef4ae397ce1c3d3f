import random

import duckdb
import numpy as np
import pytest

from varloom.llm import bwt, places, substring
from varloom.llm.queries import QUERIES

from . import brute


def result(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def test_merged_order_is_that_of_all_strings():
    rng = np.random.default_rng(2)
    shards, whole = [], []
    for n in (5, 1, 40, 17):
        text = rng.integers(97, 100, (n, 6)).astype(np.uint8)
        whole.append(text)
        now, columns = np.arange(n), []
        for d in range(5, -1, -1):
            columns.append(text[now, d])
            now = now[np.argsort(columns[-1], kind="stable")]
        shards.append(columns)
    whole = np.concatenate(whole)
    for depth, order, common in bwt.merge(shards):
        tails = [whole[i, 5 - depth :].tobytes() for i in order]
        assert tails == sorted(tails) and sorted(order) == list(range(len(whole)))
        for a, b, c in zip(tails, tails[1:], common[1:]):
            assert c == next((k for k in range(len(a)) if a[k] != b[k]), len(a))


@pytest.mark.parametrize("window", [10, 21, 100])
def test_removed_bytes_match_all_windows(spark, monkeypatch, window):
    monkeypatch.setattr(substring, "RANGE", 6000)
    monkeypatch.setattr(bwt, "PIECE", 5000)
    rng = random.Random(window)
    passages = ["".join(rng.choice("abcdé \0") for _ in range(rng.randrange(5, 3 * window))) for _ in range(15)]
    docs = []
    for i in range(120):
        t = ""
        while rng.random() < 0.8:
            t += rng.choice(passages) if rng.random() < 0.6 else "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(30)))
        docs.append((i * 7 % 121, t))
    docs += [(500, "x" * 700), (501, "ab" * 300), (502, "x" * (window - 1)), (503, "x" * window)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert result(bwt.remove_repeated_bytes(df, window)) == brute.byte_dedup(docs, window)


def test_varints_hold_integers_of_any_size():
    x = np.array([0, 127, 128, (1 << 35) - 1, 1 << 35, 700_000 << 16 | 300, (1 << 62) + 5])
    assert places.from_varints(places.to_varints(x)).tolist() == x.tolist()


def test_repeats_far_behind_in_a_long_text(spark):
    rng = random.Random(3)
    p = "".join(rng.choice("abcdefgh") for _ in range(300))
    text = "".join(rng.choices("ijklmnopqrst", k=1_100_000))
    docs = [(1, p + text[:2000]), (2, text[2000:1_050_000] + p + text[1_050_000:]), (3, text[2500:600_000] + p + text[1_060_000:])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert result(bwt.remove_repeated_bytes(df, 100)) == brute.byte_dedup(docs, 100)


def test_odd_rows_have_defined_results(spark):
    p = "".join(f"w{i} " for i in range(60))
    docs = [(1, None), (2, ""), (4, f"é{p}é tail"), (3, p), (3, p), (None, p), (7, "yz" + "x" * 99)]
    df = spark.createDataFrame([(*d, 9, 1) for d in docs], "doc_id long, text string, n_removed int, positions int")
    out = bwt.remove_repeated_bytes(df, 100)
    assert out.columns == ["doc_id", "text", "positions", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    n = len(p)
    got = sorted(((r.doc_id, r.text, r.n_bytes, r.n_removed, r.n_spans) for r in out.collect()), key=repr)
    want = [(1, None, 0, 0, 0), (2, "", 0, 0, 0), (4, "éé tail", n + 9, n, 1), (3, p, n, 0, 0), (3, p, n, 0, 0), (None, p, n, 0, 0)]
    assert got == sorted([*want, (7, "yz" + "x" * 99, 101, 0, 0)], key=repr)
    assert not bwt.remove_repeated_bytes(df.limit(0), 100).count()


def test_query_matches_all_windows(spark):
    d = "/root/testdata/sf0.001"
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{d}/documents.parquet'").fetchall()
    assert result(QUERIES["op2_suffix_array_dedup"](spark, d)) == brute.byte_dedup(docs, 100)
