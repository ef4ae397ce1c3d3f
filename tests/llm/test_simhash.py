import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from varloom.llm import simhash
from varloom.llm.queries import QUERIES

MASK = (1 << 64) - 1


def plain(text):
    """The fingerprint of a text, vote by vote."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower())]
    votes, total = [0] * 64, 0
    for a, b in zip(words, [*words[1:], None]):
        if a == "":
            continue
        h = xxhash.xxh64_intdigest(a.encode(), seed=42)
        if b is not None:
            h = xxhash.xxh64_intdigest(b.encode(), seed=h)
        weighty = b is not None and len(a.encode()) > simhash.SHORT and len(b.encode()) > simhash.SHORT
        h = h & (MASK - 1) | weighty
        total += 1 + weighty
        for i in range(64):
            votes[i] += (h >> i & 1) * (1 + weighty)
    return sum(1 << i for i in range(64) if 2 * votes[i] > total)


def texts_of(rng, n):
    vocabulary = ["the", "of", "Häuser", "reading", "analysis", "日本語の", "x", "engine", "table", "WORDS"]
    return [rng.choice([" ", "\n", " \t "]).join(rng.choices(vocabulary, k=rng.randrange(60))) for _ in range(n)]


def test_fingerprints_match_plain_votes(spark):
    texts = [*texts_of(random.Random(1), 60), None, "", "  ", "one", " one ", "long words repeated " * 9000]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r["id"]: r["fp"] & MASK for r in simhash.fingerprints(rows, ["id"]).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("radius", [0, 1, 3, 6])
def test_search_finds_every_pair_within_the_radius_once(spark, radius):
    rng = random.Random(radius)
    fps = [0, MASK, 1 << 63]
    for _ in range(25):
        fp = rng.getrandbits(64)
        fps += [fp] * 2
        for _ in range(10):
            changed = fp
            for bit in rng.sample(range(64), rng.randrange(radius + 3)):
                changed ^= 1 << bit
            fps.append(changed)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    index = spark.createDataFrame([(f,) for f in [*signed, None]], "fp long")
    queries = spark.createDataFrame([(f,) for f in [*signed[::3], None]], "fp long")
    got = simhash.near_fingerprints(queries, index, radius).collect()
    distance = {(a, b): ((a ^ b) & MASK).bit_count() for a in signed[::3] for b in signed}
    expected = {(a, b, d) for (a, b), d in distance.items() if d <= radius}
    assert len(got) == len(expected)
    assert {tuple(r) for r in got} == expected


def test_edited_texts_and_the_next_document(spark):
    rng = random.Random(3)
    rows = [(i, t) for i, t in zip(rng.sample(range(1000), 40), texts_of(rng, 40))]
    rows += [(None, "no id"), (None, None), (5000, "same id"), (5000, "same id, other text"), (5000, ""), (7, "é" * 10)]
    docs = spark.createDataFrame(rows + rows[:3] * 20, "doc_id long, text string").withColumn("key", F.lit("clash"))
    got = simhash.edit_likeness(docs).collect()

    def order(row):
        doc_id, text = row
        key = hashlib.sha256(f"{'-' if doc_id is None else doc_id}:{text}".encode()).digest()
        return (doc_id is None, -(doc_id or 0), key)

    distinct = sorted({(i, t or "") for i, t in rows}, key=order)
    expected = []
    for (doc_id, text), (_, after) in zip(distinct, [*distinct[1:], distinct[0]]):
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        expected.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), plain(text), plain(edited), plain(after)))
    found = [(*r[:3], *(x & MASK for x in r[3:])) for r in map(tuple, got)]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))


def test_one_document_and_no_rows(spark):
    one = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    row = simhash.edit_likeness(one).first()
    assert row["fp"] == row["next_fp"]
    assert row["edited_sha256"] == hashlib.sha256(b"a b c d a b").hexdigest()
    assert simhash.edit_likeness(one.limit(0)).count() == 0


def test_query_tells_edits_from_other_documents(spark):
    df = QUERIES["op11_simhash"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan
    rows = df.collect()
    assert all(len(r["fingerprint"]) == 16 and 0 <= r["near_next"] <= 1 for r in rows)
    closer = sum(r["near_edited"] > r["near_next"] for r in rows if r["n_chars"] > 200)
    assert closer >= 0.95 * sum(r["n_chars"] > 200 for r in rows)
    fps = [int(r["fingerprint"], 16) for r in rows]
    for r in rows:
        near = sum((int(r["fingerprint"], 16) ^ f).bit_count() <= simhash.RADIUS for f in fps) - 1
        assert r["n_near"] == (near if r["doc_id"] % 20 == 0 else None)
