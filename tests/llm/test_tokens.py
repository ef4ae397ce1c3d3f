import zlib

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from varloom.llm import tokens
from varloom.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


def expected(docs, end_id=1):
    t, start, out = Tokenizer.from_file(PATH), 0, []
    for i, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or "")):
        ids = t.encode(text or "", add_special_tokens=False).ids + [end_id]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[1])


@pytest.mark.parametrize("remembered", [3, 10**6])
def test_words_give_the_ids_of_whole_texts(monkeypatch, remembered):
    monkeypatch.setattr(tokens, "REMEMBERED", remembered)
    texts = [
        "Don't stop, it's A.B. 3.14... x!., <|endoftext|>. <|ENDOFTEXT|> a<|startoftext|>b",
        "é. É, I\u0307 \u00a0a\u3000b \u0301x ,., .a 'S'LL'd foo,'s",
        "",
        None,
        "İstanbul ΣΑΣ straße. \u2026. 12,5. ]]. \x1cx",
    ]
    encoder = tokens.Encoder(PATH)
    encoder.encode(pa.array(texts[::-1]))
    ids, counts = encoder.encode(pa.array(texts))
    t, at = Tokenizer.from_file(PATH), 0
    for text, n in zip(texts, counts):
        assert list(ids[at : at + n]) == t.encode(text or "", add_special_tokens=False).ids
        at += n


def test_files_hold_all_ids_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokens, "FILE_BYTES", 3000)
    monkeypatch.setattr(tokens, "GROUP", 7)
    docs = [((i * 37) % 211 - 50, f"word{i % 7} Rare{i}, " * (i % 60)) for i in range(211)]
    docs += [(None, "no id"), (400, None), (401, ""), (401, ""), (402, "long " * 60_000)]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, part int, path string").repartition(6)
    index = tokens.write_tokens(df, str(tmp_path), PATH, end_id=1)
    assert result(tokens.read_tokens(index)) == expected(docs)
    assert index.select("part").distinct().count() > 14
    plan = tokens._bases(index)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    file = pa.ipc.open_file(pa.memory_map(index.orderBy("part").first().path))
    assert pa.types.is_fixed_size_list(file.schema.field("ids").type) and file.schema.field("ids").type.list_size == tokens.SEQUENCE
    assert not tokens.read_tokens(tokens.write_tokens(df.limit(0), str(tmp_path / "none"), PATH, end_id=1)).count()


def test_query_reads_back_all_documents(spark):
    d = "/root/testdata/sf0.001"
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{d}/documents.parquet'").fetchall()
    assert result(QUERIES["op3_token_files"](spark, d)) == expected(docs)
