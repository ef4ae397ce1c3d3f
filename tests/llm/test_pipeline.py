from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from varloom.llm import decontaminate as dec

from . import brute
from .test_decontaminate import plain_score, words
from .test_pieces import plain

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """The documents, and what each stage made of them."""
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    out.append(docs)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.kept(stage(spark, docs, SF_DIR), "step")
        out.append(docs)
    return out


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_keep_the_columns(steps):
    assert all(df.columns == steps[0].columns and df.schema == steps[0].schema for df in steps[1:-1])


def test_toxic_documents_go_and_clean_ones_stay(steps):
    toxic = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{SF_DIR}/labels.parquet'").fetchall())
    gone = {i for i, _ in texts(steps[0])} - {i for i, _ in texts(steps[1])}
    clean = [i for i, y in toxic.items() if not y]
    assert sum(i in gone for i in clean) <= 0.05 * len(clean)
    assert set(texts(steps[1])) <= set(texts(steps[0]))


def test_near_copies(steps):
    want = brute.near_duplicates(texts(steps[1]), corpus_pipeline.SIMILAR)
    assert {i for i, _ in texts(steps[2])} == {i for i, (_, component) in want.items() if i == component}


def test_repeated_passages(steps):
    docs = texts(steps[2])
    want = brute.substring_dedup(docs, corpus_pipeline.PASSAGE)
    got = dict(texts(steps[3]))
    assert set(got) == {i for i, (n, gone, _) in want.items() if n == 0 or gone < n}
    assert all(brute.sha(" ".join(brute.words(t))) == want[i][2] for i, t in got.items())
    assert all(got[i] == t for i, t in docs if want[i][1] == 0)


def test_contaminated_documents(steps):
    items = [words(t) for _, t in duckdb.sql(f"SELECT item_id, text FROM '{SF_DIR}/benchmark.parquet'").fetchall()]

    def contaminated(text):
        w = words(text)
        return any(set(w) & set(x) and plain_score(x, w) >= dec.LEAST * dec.MATCH * len(x) for x in items)

    after = {i for i, _ in texts(steps[4])}
    for i, text in texts(steps[3])[:60]:
        assert (i in after) == (not contaminated(text))


def test_decontamination_counts_words_and_pairs_in_every_document(spark, steps, monkeypatch):
    """The frequencies that choose the seeds are those of all documents that reach the stage, joined or broadcast."""
    count, seen = dec.gram_counts, []

    def counted(*args):
        out = count(*args)
        seen.append(sorted(r.n for r in out.collect()))
        return out

    def grams(x, sizes):
        return [g for n in sizes for g in zip(*(x[k:] for k in range(n)))]

    monkeypatch.setattr(dec, "gram_counts", counted)
    items = [words(t) for _, t in duckdb.sql(f"SELECT item_id, text FROM '{SF_DIR}/benchmark.parquet'").fetchall()]
    wanted = {g for x in items for g in grams(x, (1, 2) if len(x) >= dec.SEED else (len(x),))}
    want = Counter(g for _, t in texts(steps[3]) for g in grams(words(t), (1, 2)) if g in wanted)
    for limit in (dec.BROADCAST_BYTES, 0):
        monkeypatch.setattr(dec, "BROADCAST_BYTES", limit)
        corpus_pipeline.drop_contaminated(spark, steps[3], SF_DIR)
    assert want and seen == [sorted(want.values())] * 2


def test_pieces(steps):
    rows = {r.doc_id: r for r in steps[5].collect()}
    docs = dict(texts(steps[4]))
    assert set(rows) == set(docs)
    for i in sorted(docs)[:20]:
        assert list(rows[i].piece_ids) == plain(docs[i]) and rows[i].n_pieces == len(rows[i].piece_ids)


def test_odd_rows_and_extra_columns(spark):
    rows = [(None, "some words " * 30, "en", "a", 330), (1, None, "en", "a", None), (2, "", None, None, 0), (2, "", None, None, 0)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, lang string, source string, n_chars int, score int, kept int")
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), SF_DIR)
        out = stage(spark, docs, SF_DIR)
        assert empty.count() == 0 and out.count() == 4
        if name != "sentencepiece":
            assert out.columns == docs.columns
