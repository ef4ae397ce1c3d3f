import random

import duckdb
import numpy as np
import pytest

from varloom.llm import places, substring
from varloom.llm.queries import QUERIES

from . import brute


def result(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()}


def test_places_come_back():
    rng = np.random.default_rng(1)
    doc, pos = rng.integers(-5, 40, 500), rng.integers(0, 3_000_000, 500)
    d, p = places.unpack_places(places.pack_places(doc, pos))
    assert sorted(zip(d, p)) == sorted(zip(doc, pos))
    x = np.array([0, 1, 127, 128, 16383, 16384, 2**21, 2**28, 2**34])
    assert list(places.from_varints(places.to_varints(x))) == list(x)


def test_entries_come_back_in_the_order_given():
    doc, pos = np.array([5, 5, 5, -2, 9, 9, 5]), np.array([1, 700_000, 3, 0, 4, 4, 2])
    d, p = places.unpack_places(places.pack_entries(doc, pos))
    assert list(d) == list(doc) and list(p) == list(pos)
    assert not len(places.unpack_places(places.pack_entries(doc[:0], pos[:0]))[0])


def test_rows_take_bytes_for_their_entries_whatever_the_number_of_ranges():
    rng = np.random.default_rng(4)
    n = 600_000
    doc, pos = np.repeat(np.arange(2000), n // 2000), np.tile(np.arange(n // 2000), 2000)
    h = rng.integers(0, 1 << 63, n).astype(np.uint64)
    size = {}
    for parts in (32, 2048, 1 << 15):
        rows = substring._rows(substring.nothing(parts), substring._Dealt(doc, pos, h, parts, substring._five))
        assert rows.num_rows <= parts
        size[parts] = rows.nbytes / n
        found = [places.unpack_places(raw.as_py()) for raw in rows.column("places")]
        assert sum(len(f[0]) for f in found) == n
    # Two bytes more where nearly every entry is of another document, and the frame of a row where it has few entries.
    assert size[2048] < size[32] + 3 and size[1 << 15] < size[32] + 6


@pytest.mark.parametrize("window", [4, 7, 20])
def test_removed_words_match_all_windows(spark, monkeypatch, window):
    monkeypatch.setattr(substring, "RANGE", 4000)
    rng = random.Random(window)
    passages = [[rng.choice("abcdefgh") * rng.choice([1, 2]) for _ in range(rng.randrange(3, 60))] for _ in range(20)]
    docs = []
    for i in range(150):
        w = []
        while rng.random() < 0.8:
            w += rng.choice(passages) if rng.random() < 0.5 else [f"u{rng.randrange(300)}" for _ in range(rng.randrange(12))]
        docs.append((i * 7 % 151, rng.choice([" ", "\n"]).join(w)))
    docs.append((500, "x " * 300))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert result(substring.remove_repeats(df, window)) == brute.substring_dedup(docs, window)


def test_odd_rows_have_defined_results(spark):
    p = " ".join(f"w{i}" for i in range(30))
    docs = [(1, None, 9), (2, "", 9), (4, f"é {p}\n tail ", 9), (3, p, 9), (3, p, 8), (None, p, 9), (7, "x" * 200_000, 9)]
    df = spark.createDataFrame(docs, "doc_id long, text string, n_words int")
    out = substring.remove_repeats(df, 20)
    assert out.columns == ["doc_id", "text", "n_words", "n_removed", "kept_sha256"]
    got = {(r.doc_id, r.text, r.n_words, r.n_removed) for r in out.collect()}
    assert got == {(1, None, 0, 0), (2, "", 0, 0), (4, "é tail", 32, 30), (3, p, 30, 0), (None, p, 30, 0), (7, "x" * 200_000, 1, 0)}
    assert not substring.remove_repeats(df.limit(0), 20).count()


def test_query_matches_all_windows(spark):
    d = "/root/testdata/sf0.001"
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{d}/documents.parquet'").fetchall()
    assert result(QUERIES["op8_substring_dedup"](spark, d)) == brute.substring_dedup(docs, 20)
