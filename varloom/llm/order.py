"""A total order of all rows without a task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import repeatable
from .tables import kept

#: Bits of ``at`` that number the rows of a part.
_ROW_BITS = 33


def in_order(df: DataFrame, by: list[Column], name: str) -> DataFrame:
    """The rows, written with ``at``: ascending in the order of ``by``, rows that are equal in all of it in any order.

    Rows are dealt by ranges of the keys and then of their place in the input, so that one key, or many rows that
    agree in all keys, spread over as many parts as they need.
    """
    placed = repeatable(df).withColumn("_place", F.monotonically_increasing_id())
    dealt = placed.repartitionByRange(*by, F.col("_place")).sortWithinPartitions(*by, F.col("_place"))
    return kept(dealt.drop("_place").withColumn("at", F.monotonically_increasing_id()), name)


def part() -> Column:
    """The part that a row of ``in_order`` is in; parts follow each other in the order."""
    return F.shiftright("at", _ROW_BITS)


def first_of_part() -> Column:
    return F.col("at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) == 0
