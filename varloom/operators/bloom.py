"""A key filter of any size: a Bloom filter kept as a table of bitmaps, applied where the reference is read.

Keys are dealt over segments by their hash, and each sets four bits in the bitmap of its segment.  A segment is one of
Spark's bitmaps (32,768 bits), so filters of several tables are combined by ``bitmap_or_agg``.  The number of segments
follows from the number of rows and a budget of bytes: the filter that is broadcast never exceeds the budget, and with
more keys than suit it, it lets more rows through that have no match.  The join that follows sorts those out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import all_present

#: Fixed value: bits of one of Spark's bitmaps.
SEGMENT_BITS = 32_768
#: Bits for each key while the budget allows; about one row in a hundred then passes without a match.
KEY_BITS = 10
#: Fewer bits a key let more than a fifth of all rows pass, and a filter does not pay.
LEAST_KEY_BITS = 4
#: Default of ``max_bytes``, what an executor holds of a filter.
FILTER_BYTES = 256 << 20
_PROBES = 4


def filter_segments(rows: int, max_bytes: int = FILTER_BYTES) -> int | None:
    """How many segments a filter of that many keys has; None if the budget is too small for one that pays."""
    wanted = max(1, -(-rows * KEY_BITS // SEGMENT_BITS))
    segments = min(wanted, max_bytes * 8 // SEGMENT_BITS)
    return segments if segments and segments * SEGMENT_BITS >= rows * LEAST_KEY_BITS else None


def _segment(key_hash: Column, segments: int) -> Column:
    return F.pmod(key_hash, F.lit(segments)).cast("int")


def _places(key_hash: Column) -> list[Column]:
    """Four places in the bitmap of a segment, 15 bits of a second hash each."""
    second = F.xxhash64(key_hash)
    return [F.shiftrightunsigned(second, 15 * i).bitwiseAND(F.lit(SEGMENT_BITS - 1)) for i in range(_PROBES)]


def key_bitmaps(df: DataFrame, on: Sequence[str], segments: int) -> DataFrame:
    """``segment, bitmap`` of the keys of a table; rows with a null in a key have none.

    Repeated keys are dropped before they are dealt by segment, so a frequent key costs nothing.
    """
    hashes = df.filter(all_present(on)).select(F.xxhash64(*on).alias("h")).distinct()
    dealt = hashes.select(_segment(F.col("h"), segments).alias("segment"), "h").repartition("segment")
    bits = dealt.select("segment", F.explode(F.array(*_places(F.col("h")))).alias("place"))
    return bits.groupBy("segment").agg(F.bitmap_construct_agg("place").alias("bitmap"))


def merge_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """One filter of several with equal segments, such as one stored for each input file."""
    return bitmaps.groupBy("segment").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def _words(bitmap: Column) -> Column:
    """A bitmap as long integers, its first eight bytes the highest of the first."""
    places = F.sequence(F.lit(0), F.lit(SEGMENT_BITS // 64 - 1))
    return F.transform(places, lambda i: F.conv(F.hex(F.substring(bitmap, i * 8 + 1, F.lit(8))), 16, -10).cast("long"))


def filter_by_bitmaps(df: DataFrame, on: Sequence[str], bitmaps: DataFrame, segments: int) -> DataFrame:
    """Rows whose key may be among those of the filter, found without shuffling them.

    The filter of at most ``segments`` rows of 4 KB is broadcast.  Rows with a null in a key are dropped, as they match
    nothing.
    """
    words = F.broadcast(bitmaps.select(F.col("segment").alias("_segment"), _words(F.col("bitmap")).alias("_words")))
    hashed = df.filter(all_present(on)).withColumn("_h", F.xxhash64(*on))
    hits = []
    for place in _places(F.col("_h")):
        # Byte b of a word holds bits 8 b to 8 b + 7 of the bitmap and is its b-th highest.
        within = (F.lit(7) - F.shiftright(place, 3).bitwiseAND(F.lit(7))) * 8 + place.bitwiseAND(F.lit(7))
        hits.append(F.getbit(F.get("_words", F.shiftright(place, 6).cast("int")), within.cast("int")) == 1)
    joined = hashed.join(words, (_segment(F.col("_h"), segments) == F.col("_segment")) & reduce(and_, hits), "inner")
    return joined.select(*df.columns)


def bloom_reduce(
    reference: DataFrame, left: DataFrame, on: Sequence[str], rows: int | None = None, max_bytes: int = FILTER_BYTES
) -> DataFrame:
    """Reference rows whose key may occur on the left, for left tables of any length that the budget suits.

    ``rows`` is the number of left rows, counted when it is not given.  Keys must have the same types on both sides.
    Raises if the filter would have fewer than ``LEAST_KEY_BITS`` bits for a row.
    """
    rows = left.count() if rows is None else rows
    segments = filter_segments(rows, max_bytes)
    if segments is None:
        raise ValueError(f"a filter of {max_bytes} bytes is too small for {rows} rows")
    return filter_by_bitmaps(reference, on, key_bitmaps(left, on, segments), segments)
