import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from varloom.llm import trie

COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def plain(rows):
    """The definition, on Python dictionaries."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns[conv].append(((turn is not None, turn or 0), role, text[:100], hashlib.sha256(text.encode()).hexdigest(), text))
    turns = {c: [(r, t) for _, r, _, _, t in sorted(x)] for c, x in turns.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        sequence = turns.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:]
        for d in range(len(sequence) + 1):
            members[tuple(sequence[:d])].add(c)
        ends[tuple(sequence)].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    totals = {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        below = [totals[k] for k in kids[p]]
        totals[p] = (sum(x for x, _ in below) or 1, own + sum(x for _, x in below))
    return [
        (
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), *totals[p],
            hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
        )
        for p, m in members.items()
    ]


def check(spark, rows):
    given = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    given = given.withColumns({"depth": F.lit("clash"), "k1": F.lit(None).cast("string")})
    got = trie.prefix_trie(given).select(*COLUMNS).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, plain(rows)))
    return got


def test_shared_prefixes_match_the_definition(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 4)
    monkeypatch.setattr(trie, "IDS", 3)
    rng = random.Random(7)
    rows = []
    for c in rng.sample(range(-12, 140), 110):
        for t in range(rng.choice([1, 2, 3, 9, 10, 25])):
            turn = rng.choice([t, t, t, None, 3])
            rows.append((c, turn, rng.choice(["user", "user", "assistant", None]), rng.choice(["a", "é", "long " * 30, "long " * 30 + "x", "", None])))
    rows += [(None, 1, "user", "no conversation")] * 3
    check(spark, rows)


def test_one_hot_conversation_and_many_equal_ones(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 16)
    monkeypatch.setattr(trie, "IDS", 4)
    rows = [(5, t, "user", f"turn {t}") for t in range(120)]
    rows += [(c, t, "user", f"equal {t}") for c in range(10, 60) for t in range(3)]
    got = check(spark, rows)
    assert max(r["depth"] for r in got) >= 110


def test_a_node_of_one_row_and_no_rows(spark):
    check(spark, [(4, None, None, None)])
    empty = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert trie.prefix_trie(empty).columns == COLUMNS
    assert trie.prefix_trie(empty).count() == 0


@pytest.mark.parametrize("depth", [1, 2, 40])
def test_totals_of_a_chain_and_a_star(spark, depth):
    chain = [(i, 0, i - 1 if i else None, 0 if i else None, 1, i == depth) for i in range(depth + 1)]
    star = [(1000 + i, 0, depth // 2, 0, 1, True) for i in range(50)]
    nodes = spark.createDataFrame(chain + star, "k1 long, k2 long, p1 long, p2 long, size long, leaf boolean")
    if depth // 2 == depth:
        nodes = nodes.withColumn("leaf", F.col("leaf") & (F.col("k1") != depth))
    got = {r["k1"]: r["size"] for r in trie.subtree_totals(spark, nodes, ["size"]).collect()}
    for i in range(depth + 1):
        assert got[i] == depth + 1 - i + (50 if i <= depth // 2 else 0)
    assert all(got[1000 + i] == 1 for i in range(50))
