"""SimHash fingerprints of texts and the search for all fingerprints within a Hamming radius, in DataFrame functions only.

The terms of a text are its pairs of words that follow each other, in lower case, and its last word.  A term has a hash
of 64 bits and a weight for each time it occurs: 2 if both words are longer than ``SHORT`` bytes, else 1, because short
words mostly bind others.  Every bit is voted on by the weights of the terms that have it set against those of the
terms that have not.  Votes are counted eight bits to a long integer over at most ``LANE`` terms, four bits to one over
``GROUP`` such counts, and then bit by bit, so that texts of any length are counted exactly.

The search cuts fingerprints into ``radius + 2`` blocks.  Two fingerprints within the radius differ in at most
``radius`` blocks and so agree in two whole ones.  There is a table for each pair of blocks, the fingerprints permuted
so that the two blocks lead; its key is what leads.  A pair of fingerprints is taken only in the first table in which
it meets.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .order import first_of_part, in_order, part
from .tables import kept

BITS = 64
#: Bytes of a word up to which its pairs have weight 1.
SHORT = 4
#: Terms counted in lanes of 8 bits, and such counts of up to twice as much in lanes of 16; the top bit stays free.
LANE, GROUP = 127, 64
#: Bits that fingerprints may differ in to be near each other.
RADIUS = 3
_SPACE = r"[\x20\x09-\x0D]+"
_EIGHTS, _SIXTEENS = 0x0101_0101_0101_0101, 0x00FF_00FF_00FF_00FF


def _terms(texts: DataFrame, key: list[str]) -> DataFrame:
    """``key, place, term``: a hash for each term, whose last bit tells whether it is of weight 2."""
    words = texts.select(*key, F.split(F.lower("text"), _SPACE).alias("words"))

    def term(a: Column, b: Column) -> Column:
        weighty = (F.octet_length(a) > SHORT) & (F.octet_length(b) > SHORT)
        return F.when(a != "", F.xxhash64(a, b).bitwiseAND(F.lit(-2)).bitwiseOR(F.coalesce(weighty, F.lit(False)).cast("long")))

    pairs = F.zip_with("words", F.slice("words", F.lit(2), F.size("words")), term)
    return words.select(*key, pairs.alias("terms")).select(*key, F.posexplode_outer("terms").alias("place", "term"))


def fingerprints(texts: DataFrame, key: list[str]) -> DataFrame:
    """``key, fp`` for each row of ``texts``: the 64 bits of the fingerprint of its ``text``.

    The key columns, none of them named as a column here, identify a row.  If the rows are already dealt by some of
    them, nothing is shuffled.  A text without words, or null, has the fingerprint zero.
    """
    terms = _terms(texts, key)
    weight = F.col("term").bitwiseAND(F.lit(1)) + 1
    lanes = [F.sum(F.shiftrightunsigned("term", s).bitwiseAND(F.lit(_EIGHTS))).alias(f"e{s}") for s in range(8)]
    chunk = F.expr(f"place div {LANE}").alias("chunk")
    # Counts of one chunk and weight, then of many with their weights, then of the text.
    eights = terms.groupBy(*key, chunk, weight.alias("w")).agg(F.count("term").alias("n"), *lanes)
    wide = [
        F.sum(F.shiftrightunsigned(f"e{s}", 8 * odd).bitwiseAND(F.lit(_SIXTEENS)) * F.col("w")).alias(f"s{s + 8 * odd}")
        for s in range(8)
        for odd in (0, 1)
    ]
    group = F.expr(f"chunk div {GROUP}").alias("part")
    sixteens = eights.groupBy(*key, group).agg(F.sum(F.col("n") * F.col("w")).alias("n"), *wide)
    votes = [
        F.sum(F.shiftright(f"s{b % 16}", 16 * (b // 16)).bitwiseAND(F.lit(0xFFFF))).alias(f"b{b}") for b in range(BITS)
    ]
    counted = sixteens.groupBy(*key).agg(F.sum("n").alias("n"), *votes)
    bits = [
        F.when(2 * F.col(f"b{b}") > F.col("n"), F.lit(-(1 << 63) if b == 63 else 1 << b)).otherwise(F.lit(0))
        for b in range(BITS)
    ]
    return counted.select(*key, reduce(lambda a, b: a.bitwiseOR(b), bits).alias("fp"))


def as_text(fp: Column) -> Column:
    """A fingerprint as 16 hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), BITS // 4, "0"))


def likeness(a: Column, b: Column) -> Column:
    """The share of bits in which two fingerprints agree: 1 for equal ones, about a half for unrelated ones."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def _masks(radius: int) -> list[int]:
    """Bits of each block."""
    edges = [BITS * i // (radius + 2) for i in range(radius + 3)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges[:-1], edges[1:])]


def _signed(x: int) -> Column:
    return F.lit(x - (1 << 64) if x >> 63 else x)


def _tabled(fps: DataFrame, radius: int) -> DataFrame:
    """A row for each fingerprint and table: the blocks ``i`` and ``j``, and ``leads``, what they hold."""
    masks = _masks(radius)
    rows = [
        F.struct(
            F.lit(i).alias("i"), F.lit(j).alias("j"), F.col("fp").bitwiseAND(_signed(masks[i] | masks[j])).alias("leads")
        )
        for i, j in combinations(range(len(masks)), 2)
    ]
    return fps.select("*", F.explode(F.array(*rows)).alias("_t")).select(*fps.columns, "_t.*")


def near_fingerprints(queries: DataFrame, index: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``fp, near_fp, distance``: for each ``fp`` of ``queries`` every one of ``index`` within the radius, once.

    A fingerprint is near itself.  Both sides are made distinct first, so that copies cost nothing; nulls are near
    nothing.  What meets in a table but is no new pair leaves no row.  A key with many fingerprints, such as a group of
    edited copies has, is a skewed join of two sides that adaptive execution may cut.
    """
    if not 0 <= radius <= BITS - 2:
        raise ValueError(f"radius must be between 0 and {BITS - 2}")
    masks = _masks(radius)
    left, right = (_tabled(side.select("fp").where("fp IS NOT NULL").distinct(), radius) for side in (queries, index))
    right = right.withColumnRenamed("fp", "near_fp")
    differ = F.col("fp").bitwiseXOR(F.col("near_fp"))
    # The first table in which a pair meets is that of its two first equal blocks.
    earlier = [(F.lit(b) < F.col("j")) & (F.lit(b) != F.col("i")) & (differ.bitwiseAND(_signed(m)) == 0) for b, m in enumerate(masks)]
    met_before = reduce(lambda a, b: a | b, earlier)
    joined = left.join(right, ["i", "j", "leads"])
    return joined.where((F.bit_count(differ) <= radius) & ~met_before).select(
        "fp", "near_fp", F.bit_count(differ).alias("distance")
    )


def near_counts(documents: DataFrame, asked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``fp, n``: for each distinct ``fp`` of ``asked`` how many rows of ``documents`` are within the radius."""
    sizes = kept(documents.where("fp IS NOT NULL").groupBy("fp").agg(F.count("*").alias("n")), "fingerprint_sizes")
    near = near_fingerprints(asked, sizes, radius)
    return near.join(sizes.withColumnRenamed("fp", "near_fp"), "near_fp").groupBy("fp").agg(F.sum("n").alias("n"))


def text_key(doc_id: Column, text: Column) -> Column:
    """What identifies a document: its id and its text.  Never null."""
    return F.unhex(F.sha2(F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"), text), 256))


def following(documents: DataFrame) -> DataFrame:
    """``key, doc_id, n_chars, next_key``: each document and the one behind it, in descending order of ``doc_id``.

    Null ids come last, equal ids are ordered by key, and behind the last document comes the first.
    """
    rows = documents.select("key", "doc_id", "n_chars").distinct()
    ordered = in_order(rows, [F.col("doc_id").desc_nulls_last(), F.col("key")], "order").withColumn("part", part())
    within = F.lead("key").over(Window.partitionBy("part").orderBy("at"))
    # The last row of a part is followed by the first row of the next part; there is one row for each part here.
    firsts = ordered.where(first_of_part()).select("part", F.col("key").alias("first"))
    parts = Window.orderBy("part")
    behind = F.coalesce(F.lead("first").over(parts), F.first("first").over(parts)).alias("behind")
    behind = firsts.select("part", behind)
    return ordered.withColumn("next_key", within).join(F.broadcast(behind), "part").select(
        "key", "doc_id", "n_chars", F.coalesce("next_key", "behind").alias("next_key")
    )


def edit_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of edited ones, and how alike they are.

    The edited text is the text with its last third (``floor(n_chars / 3)`` code points) replaced by as many of the
    first code points of the next document, or all that it has.  Columns: ``doc_id, n_chars, edited_sha256, fp,
    edited_fp, next_fp``.

    A null text is an empty one.  Rows that repeat both id and text are one document; rows of one id with different
    texts are different documents.  A single document is followed by itself.  No rows give no rows; other columns are
    ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keyed = texts.withColumn("key", text_key(F.col("doc_id"), F.col("text")))
    chain = kept(following(keyed.withColumn("n_chars", F.char_length("text").cast("long"))), "following")
    # Texts are dealt by their key once; what is sent to the document before is no longer than a third of that one.
    own = keyed.groupBy("key").agg(F.first("text").alias("text"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    before = chain.select(F.col("next_key").alias("key"), F.col("key").alias("before"), third.alias("third"))
    heads = own.join(before, "key").select(F.col("before").alias("key"), F.left("text", F.col("third")).alias("head"))
    both = own.join(chain.select("key", "n_chars", third.alias("third")), "key").join(heads, "key")
    stays = F.left("text", (F.col("n_chars") - F.col("third")).cast("int"))
    both = both.select("key", "text", F.concat(stays, F.col("head")).alias("edited"))
    each = F.explode(F.array(
        F.struct(F.lit(False).alias("changed"), "text"), F.struct(F.lit(True).alias("changed"), F.col("edited").alias("text"))
    ))
    prints = fingerprints(both.select("key", each.alias("_x")).select("key", "_x.*"), ["key", "changed"])
    prints = prints.groupBy("key").agg(
        F.max(F.when(~F.col("changed"), F.col("fp"))).alias("fp"), F.max(F.when(F.col("changed"), F.col("fp"))).alias("edited_fp")
    )
    digests = both.select("key", F.sha2("edited", 256).alias("edited_sha256"))
    found = kept(prints.join(digests, "key").join(chain, "key"), "fingerprints")
    after = found.select(F.col("key").alias("next_key"), F.col("fp").alias("next_fp"))
    return found.join(after, "next_key").select("doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "next_fp")
