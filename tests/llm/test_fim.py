import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from varloom.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXTS = [
    "", " ", "\n\t ", "word", "two words", " lead", "trail ", "a  b\n\nc ", "Straße 日本語 x 😀 end", "has <P> mark", "<<S", "x" * 50,
    "a <M", "M> b c d e", None,
]


def plain(doc_id, text, rate=50, suffix_first=80):
    """The definition, unit by unit."""
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < suffix_first:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("length", [0, 1, 63, 64, 65, 1000])
def test_ranks_and_selects_match_counting(length):
    symbols = np.random.default_rng(length).integers(0, 4, length).astype(np.uint8)
    matrix = fim.WaveletMatrix(symbols, 2)
    places = np.arange(length + 1)
    for symbol in range(4):
        counts = np.concatenate([[0], np.cumsum(symbols == symbol)])
        assert (matrix.rank(symbol, places) == counts).all()
        where = np.flatnonzero(symbols == symbol)
        nth = np.arange(1, len(where) + 1)
        found = matrix.select(symbol, nth, np.zeros_like(nth), np.full_like(nth, length))
        assert (found == where).all()


def test_every_cut_of_every_text():
    texts = [t or "" for t in TEXTS]
    units = fim.Units(pa.array(texts))
    expected = [UNIT.findall(t) for t in texts]
    assert units.count.tolist() == [len(u) for u in expected]
    for k in range(12):
        at = units.cut(np.minimum(k, units.count)) - units.edge[:-1]
        assert at.tolist() == [sum(map(len, u[:k])) for u in expected]


def test_forms_match_the_definition(spark):
    rng = random.Random(4)
    texts = TEXTS * 8 + ["".join(rng.choice("ab é\n\t 日<") for _ in range(rng.randrange(40))) for _ in range(200)]
    texts.append("long text " * 200_000)
    rows = [(i if i % 7 else None, t, f"n{i}") for i, t in enumerate(texts)] + [(1, "same row", "n")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string").withColumn("row", F.lit("clash"))
    cut = fim.fill_in_middle(docs, rate=90, suffix_first=50)
    got = cut.select("doc_id", "text", *fim.ADDED, fim.restored(F.col("output"), F.col("form")).alias("back"), "row").collect()
    expected = [(i, t, *plain(i, t, 90, 50), t or "", "clash") for i, t, _ in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, more int")
    cut = fim.fill_in_middle(docs, keep_text=False)
    assert cut.columns == ["doc_id", "more", *fim.ADDED]
    assert cut.count() == 0
