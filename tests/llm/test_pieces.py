import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from varloom.llm import pieces
from varloom.llm.queries import QUERIES

from . import brute

PATH = public_tokenizers.path("piece_bpe_32k.model")


def unigram():
    """The library's own search over the same pieces and scores."""
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(open(PATH, "rb").read())
    proto.trainer_spec.model_type = 1
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def plain(text):
    """The search place by place, over the whole text."""
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    table = {sp.id_to_piece(i): (sp.get_score(i), i) for i in range(259, sp.get_piece_size())}
    worst = min(s for s, _ in table.values()) - pieces.UNKNOWN_PENALTY
    text = "▁" + text.replace(" ", "▁") if text else ""
    total, back = [0.0] + [float("-inf")] * len(text), [None] * (len(text) + 1)
    for end in range(1, len(text) + 1):
        for begin in range(max(0, end - 16), end):
            score, i = table.get(text[begin:end], (worst if end - begin == 1 else float("-inf"), None))
            if total[begin] + score > total[end]:
                total[end], back[end] = total[begin] + score, (begin, i)
    out, at = [], len(text)
    while at:
        begin, i = back[at]
        out = ([i] if i is not None else [3 + b for b in text[begin:at].encode()]) + out
        at = begin
    return out


def encoded(texts):
    ids, counts = pieces.model(PATH).encode(pa.array(texts))
    cuts = np.concatenate([[0], np.cumsum(counts)])
    return [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])]


def test_pieces_match_the_library_and_the_plain_search():
    rng = random.Random(1)
    texts = ["Hello world, the cat sat.", "a", "Straße déjà vu 日本語 12345", "internationalization " * 5, "x" * 70]
    texts += ["".join(rng.choice("abcdeehistnor  ,.") for _ in range(rng.randrange(1, 90))).strip() for _ in range(200)]
    texts = [re.sub(" +", " ", t) for t in texts]
    sp = unigram()
    # The library adds up in single precision and now and then takes a path that is not the best one.
    assert encoded(texts) == [plain(t) for t in texts]
    differ = [(a, b) for a, b in zip(encoded(texts), map(sp.encode, texts)) if a != b]
    assert len(differ) <= 2 and all(sum(map(sp.get_score, a)) >= sum(map(sp.get_score, b)) for a, b in differ)
    odd = ["", " ", "  a   b ", "tab\tnew\nline", "▁x", "emoji \U0001f600\U0001f9ff!", "\x00\x01", "é" * 100 + "\U0001f600", " " * 60]
    assert encoded(odd) == [plain(t.replace("▁", " ")) for t in odd]
    assert encoded([None, *texts[:3], None])[1:4] == encoded(texts[:3])


def test_decoding_gives_texts_back(spark):
    texts = [None, "", " ", "  a  b\n", "né \U0001f600", "word " * 50_000, "x" * 100_000, "dup", "dup"]
    df = spark.createDataFrame([(i, t, 7, 8) for i, t in enumerate(texts)], "doc_id long, text string, piece_ids int, decoded int")
    out = pieces.decode_pieces(pieces.encode_pieces(df, PATH), PATH)
    assert sorted(out.columns) == ["decoded", "doc_id", "piece_ids", "text"]
    assert {r.doc_id: r.decoded for r in out.collect()} == {i: t or "" for i, t in enumerate(texts)}
    assert not pieces.piece_digests(df.limit(0), PATH).count()


def test_query_matches_the_plain_search(spark):
    d = "/root/testdata/sf0.001"
    docs = dict(duckdb.sql(f"SELECT doc_id, text FROM '{d}/documents.parquet'").fetchall())
    got = {r.doc_id: r for r in QUERIES["op6_sentencepiece"](spark, d).collect()}
    assert set(got) == set(docs) and all(r.round_trip for r in got.values())
    for i in sorted(docs)[:25]:
        ids = plain(docs[i])
        assert (got[i].n_pieces, got[i].ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert got[i].decoded_sha256 == brute.sha(docs[i])
