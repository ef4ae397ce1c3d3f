"""The queries of this subpackage over the given tables, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bwt import remove_repeated_bytes
from .chat import conversation_digests, prefix_target_examples
from .decontaminate import contamination
from .fim import fill_in_middle, restored
from .minhash import near_duplicates
from .pages import main_text
from .pieces import piece_digests
from .quality import quality_rules
from .simhash import as_text, edit_likeness, likeness, near_counts
from .substring import remove_repeats
from .tables import kept, table
from .tokens import read_tokens, tokens_folder, write_tokens
from .toxicity import fit, toxicity
from .trie import prefix_trie

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


@query()
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with its component of near copies (85 percent of five-word shingles)."""
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@query()
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with what is left without its repeated 20-word windows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, window=20).select("doc_id", "n_words", "n_removed", "kept_sha256")


CONVERSATIONS_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
p AS (
  SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
    sum(length('<|im_start|>' || '<|im_end|>') + 2
        + length(regexp_replace(replace(replace(role, '\', '\b'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g'))
        + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))) OVER w AS upto
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS bigint) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (role = 'assistant' OR i = n) AS bigint) AS formatted_chars,
  count(*) FILTER (role = 'assistant') AS n_examples
FROM p GROUP BY conv_id"""


@query(CONVERSATIONS_SQL)
def op1_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the prefix-target examples of each conversation say, read back from them."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("<|im_end|><|im_start|>assistant ok").alias("text"),
    )
    return conversation_digests(prefix_target_examples(turns.union(odd)))


LINES_SQL = r"""
WITH d AS (
  SELECT doc_id, source, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
place AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3),
windows AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k FROM place),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM windows) WHERE n > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS j) GROUP BY doc_id),
raw AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM d),
line AS (
  SELECT doc_id, source, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM raw
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM line GROUP BY doc_id),
normal AS (
  SELECT doc_id, source,
    translate(array_to_string(w, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line, len(w) AS n
  FROM line),
firsts AS (SELECT source, min(doc_id) AS doc_id FROM documents GROUP BY source, text),
hosts AS (SELECT source, count(*) AS documents FROM firsts GROUP BY source),
counted AS (
  SELECT source, line, count(DISTINCT doc_id) AS n FROM normal JOIN firsts USING (source, doc_id) GROUP BY source, line),
frequent AS (SELECT source, line FROM counted c JOIN hosts USING (source) WHERE n > 10 AND n * 100 > documents * 2),
gone AS (
  SELECT doc_id, CAST(sum(n) AS bigint) AS n, count(DISTINCT line) AS lines
  FROM normal JOIN frequent USING (source, line) GROUP BY doc_id),
s AS (
  SELECT d.doc_id, len(w) AS n_words,
    CAST(length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS bigint) AS word_chars,
    CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS bigint) AS n_symbols,
    coalesce(dup.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words,
    coalesce(gone.n, 0) AS n_removed_words, coalesce(gone.lines, 0) AS n_frequent_lines
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN repeats USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR n_words - n_removed_words < 50
    OR n_removed_words * 100 > n_words * 50) AS kept,
  n_removed_words, n_frequent_lines
FROM s"""


@query(LINES_SQL)
def op9_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document, and whether it stands without the lines that recur in its source."""
    return quality_rules(table(spark, sf_dir, "documents"))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that may be learned from: those of documents outside the held-out quarter."""
    return table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", "toxic")


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


@query()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score of every document, with the nearest labelled examples as evidence."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, labelled(spark, sf_dir))
    scored = toxicity(docs.select("doc_id", "text"), model, keep_text=False)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted", "evidence_ids", "evidence_cosines")


@query()
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document's ids are in the Arrow files that were written, and their checksum as read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = write_tokens(docs, tokens_folder(spark), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_tokens(index)


@query()
def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query()
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items or edited copies of them, with the alignment score."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document and whether decoding them gives the text back."""
    return piece_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with what is left without its repeated 100-byte strings."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = remove_repeated_bytes(docs, window=100)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


MIDDLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS varchar), '')) AS s,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w
  FROM documents),
h AS (
  SELECT *, len(w) AS n, CAST('0x' || s[1:8] AS bigint) % (len(w) + 1) AS h1, CAST('0x' || s[9:16] AS bigint) % (len(w) + 1) AS h2,
    CAST('0x' || s[17:24] AS bigint) AS h3, CAST('0x' || s[25:32] AS bigint) AS h4 FROM d),
f AS (
  SELECT *, array_to_string(w[1:least(h1, h2)], '') AS p, array_to_string(w[least(h1, h2) + 1:greatest(h1, h2)], '') AS m,
    array_to_string(w[greatest(h1, h2) + 1:], '') AS e,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || e || '<M>' || m
    ELSE '<S>' || e || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM f"""


@query(MIDDLE_SQL)
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fill-in-middle form of every document, and the text rebuilt from it."""
    cut = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    return cut.select(
        *["doc_id", "n", "form", "prefix_chars", "middle_chars"],
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


TRIE_SQL = r"""
WITH t AS (
  SELECT conv_id, role, text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 100), sha256(text)) AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
crc AS (
  SELECT conv_id, xor(list_reduce(list_prepend(4294967295::bigint,
    list_transform(string_split(CAST(conv_id AS varchar), ''), lambda x: ascii(x)::bigint)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
      lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS crc
  FROM (SELECT DISTINCT conv_id FROM t)),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, crc % 9 AS h FROM crc),
heads AS (SELECT c.conv_id, t.pos, role, text FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h),
k AS (SELECT conv_id, count(*) AS k FROM heads GROUP BY conv_id),
r AS (
  SELECT * FROM heads UNION ALL
  SELECT t.conv_id, pos - h + coalesce(k, 0), role, text FROM t JOIN c USING (conv_id) LEFT JOIN k USING (conv_id) WHERE pos > h),
path AS (
  SELECT conv_id, pos AS depth, string_agg(sha256(role) || sha256(text), '') OVER w AS key, octet_length(encode(text)) AS bytes
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, '', 0 FROM c),
node AS (SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes FROM path GROUP BY depth, key),
kids AS (
  SELECT p.conv_id, p.depth, count(*) AS n_children
  FROM node n JOIN path q ON q.conv_id = n.conv_id AND q.depth = n.depth - 1
  JOIN node p ON p.depth = q.depth AND p.key = q.key GROUP BY ALL),
total AS (
  SELECT q.depth, q.key, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((n_convs - 1) * n.bytes) AS saved_tokens
  FROM node n LEFT JOIN kids USING (conv_id, depth) JOIN path q ON q.conv_id = n.conv_id AND q.depth <= n.depth GROUP BY ALL),
ends AS (
  SELECT depth, key, string_agg(CAST(conv_id AS varchar), ',' ORDER BY conv_id) AS ids FROM path
  WHERE (conv_id, depth) IN (SELECT conv_id, max(depth) FROM path GROUP BY conv_id) GROUP BY ALL)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
  CAST(saved_tokens AS bigint) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM node n JOIN total USING (depth, key) LEFT JOIN ends USING (depth, key) LEFT JOIN kids k USING (conv_id, depth)
LEFT JOIN path q ON q.conv_id = n.conv_id AND q.depth = n.depth - 1
LEFT JOIN node p ON p.depth = q.depth AND p.key = q.key"""


@query(TRIE_SQL)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations, with the totals of its subtree."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


@query()
def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts, and their likeness.

    ``n_near``: for documents whose id is divisible by 20, how many others have a fingerprint within the radius.
    """
    found = kept(edit_likeness(table(spark, sf_dir, "documents")), "edit_likeness")
    asked = F.col("doc_id") % 20 == 0
    counts = near_counts(found, found.where(asked)).withColumn("asked", F.lit(True))
    joined = found.withColumn("asked", F.when(asked, True)).join(counts, ["fp", "asked"], "left")
    return joined.select(
        *["doc_id", "n_chars", "edited_sha256"],
        as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        (F.col("n") - 1).alias("n_near"),
    )
