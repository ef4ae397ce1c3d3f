"""The variant table: core columns, INFO typing and column naming.

One row is one VCF record.  Coordinates are 1-based and inclusive.  A record with several alternate
alleles keeps them in one string joined by ``|``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import types as T

#: Columns that identify a variant; the default join keys of ``annotate``.
KEYS = ("chrom", "start", "ref", "alt")

#: The column holding the variant type, and the partition columns of a reference dataset.
TYPE_COLUMN = "tsa"

ALT_SEPARATOR = "|"

CORE_SCHEMA = T.StructType(
    [
        T.StructField("chrom", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("id", T.StringType()),
        T.StructField("ref", T.StringType()),
        T.StructField("alt", T.StringType()),
        T.StructField("qual", T.DoubleType()),
        T.StructField("filter", T.StringType()),
    ]
)


class InfoField(NamedTuple):
    """One ``##INFO`` declaration of a VCF header."""

    id: str
    number: str = "1"
    type: str = "String"
    description: str | None = None


def info_type(number: str | None, type_: str | None) -> T.DataType:
    """Spark type of an INFO field: scalar for Number 0 and 1, otherwise an array."""
    scalar = {"Integer": T.LongType(), "Float": T.DoubleType(), "Flag": T.BooleanType()}.get(
        type_ or "", T.StringType()
    )
    if isinstance(scalar, T.BooleanType) or number in ("0", "1"):
        return scalar
    return T.ArrayType(scalar)


def info_columns(fields: Iterable[InfoField]) -> dict[str, str]:
    """Map INFO ids to column names.

    Names are lower-cased.  Spark resolves names without regard to case, so an id that equals a core
    column (``END``) or an earlier id (``AF`` and ``af``) is prefixed with ``info_`` until it is free.
    """
    taken = {f.name for f in CORE_SCHEMA}
    names: dict[str, str] = {}
    for field in fields:
        name = field.id.lower()
        while name in taken:
            name = f"info_{name}"
        taken.add(name)
        names[field.id] = name
    return names


def variant_schema(fields: Sequence[InfoField] = ()) -> T.StructType:
    """Schema of a variant table with the given INFO fields."""
    names = info_columns(fields)
    extra = [T.StructField(names[f.id], info_type(f.number, f.type)) for f in fields]
    return T.StructType(CORE_SCHEMA.fields + extra)
