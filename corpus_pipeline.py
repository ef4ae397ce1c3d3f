"""From raw documents to token ids: five stages, each written as Parquet and read again by the next.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.decontaminate import contamination
from varloom.llm.minhash import near_duplicates
from varloom.llm.pieces import encode_pieces
from varloom.llm.queries import labelled
from varloom.llm.substring import remove_repeats
from varloom.llm.tables import BROADCAST_IDS, kept, table
from varloom.llm.toxicity import fit, toxicity

#: Percent of shared five-word shingles from which documents are near copies.
SIMILAR = 80
#: Words of a passage that may stand in one document only.
PASSAGE = 50
PIECES = "piece_bpe_32k.model"


def _without(docs: DataFrame, gone: DataFrame, name: str) -> DataFrame:
    """Documents whose id is not among the stored ids; rows without an id stay."""
    gone = kept(gone.select("doc_id").where("doc_id IS NOT NULL").distinct(), name)
    few = gone.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    model = fit(docs, labelled(spark, sf_dir))
    scored = toxicity(docs.withColumn("columns", F.struct(*docs.columns)).select("columns", "text"), model, keep_text=False)
    return scored.where("predicted = 0").select("columns.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    return _without(docs, near_duplicates(docs, percent=SIMILAR).where("NOT kept"), "near_copies")


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document before them holds; those that keep no word go."""
    cut = remove_repeats(docs, window=PASSAGE)
    length = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    columns = [length.cast(docs.schema["n_chars"].dataType).alias("n_chars") if c == "n_chars" else c for c in docs.columns]
    return cut.where("n_words = 0 OR n_removed < n_words").select(*columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return _without(docs, contamination(docs, table(spark, sf_dir, "benchmark")), "contaminated")


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, n_pieces, piece_ids`` of every document."""
    coded = encode_pieces(docs.select("doc_id", "source", "text"), public_tokenizers.path(PIECES), keep_text=False)
    return coded.select("doc_id", "source", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("repeated_passages", drop_repeated_passages),
    ("decontamination", drop_contaminated),
    ("sentencepiece", to_pieces),
]

#: SQL cannot express the stages; tests hold each against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), name)
    return docs
