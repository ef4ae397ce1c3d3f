"""Reading values out of a VCF INFO string such as ``DB;AF=0.1,0.2;AN=4``.

The functions take the string framed by ``framed_info``, ``;DB;AF=0.1,0.2;AN=4;``.  Each requested key
then costs one byte search in generated code, without a regular expression or a map per row, and keys
that nobody asks for cost nothing.  A key that occurs twice yields its last value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import InfoField, info_type


def framed_info(info: str | Column) -> Column:
    """The INFO string with a separator on both sides; null and ``.`` give one without keys."""
    col = F.col(info) if isinstance(info, str) else info
    return F.concat(F.lit(";"), F.coalesce(col, F.lit("")), F.lit(";"))


def info_value(framed: str | Column, key: str) -> Column:
    """Raw text after ``key=`` up to the next ``;``; empty when the key is absent.

    Without the key the first cut leaves the whole string, whose text before the first ``;`` is empty.
    """
    return F.substring_index(F.substring_index(framed, f";{key}=", -1), ";", 1)


def info_flag(framed: str | Column, key: str) -> Column:
    """True when the key is present, with or without a value."""
    col = F.col(framed) if isinstance(framed, str) else framed
    return col.contains(f";{key};") | col.contains(f";{key}=")


def typed_info(framed: str | Column, field: InfoField) -> Column:
    """The field converted to its declared type; ``.``, nothing and unreadable numbers become null.

    Missing values are sorted out before the cast: a failing ``try_cast`` raises inside, which costs more
    than the rest of the row.
    """
    target = info_type(field.number, field.type)
    if isinstance(target, T.BooleanType):
        return info_flag(framed, field.id)
    return _converted(info_value(framed, field.id), target)


def info_variant(framed: str | Column) -> Column:
    """All keys of an INFO string as one VARIANT of texts; a key without a value holds ``true``.

    Nothing about the keys has to be known, so files whose headers differ fit into one column.  No keys give an empty
    object.  A key that occurs twice keeps its last value.
    """
    col = F.col(framed) if isinstance(framed, str) else framed
    cut = F.split(col, ";")
    cells = F.filter(cut, lambda x: (x != "") & (x != "."))
    keys = F.transform(cells, lambda x: F.substring_index(x, "=", 1))
    values = F.transform(cells, lambda x: F.when(x.contains("="), F.substring(x, F.locate("=", x) + 1, F.length(x))).otherwise("true"))
    entries = F.arrays_zip(keys.alias("key"), values.alias("value"))
    last = F.filter(entries, lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"]))
    entries = F.when(F.size(F.array_distinct(keys)) < F.size(keys), last).otherwise(entries)
    return F.to_variant_object(F.map_from_entries(entries))


def late_info(variant: str | Column, field: InfoField) -> Column:
    """The field of a VARIANT made by ``info_variant``, converted as ``typed_info`` does."""
    col = F.col(variant) if isinstance(variant, str) else variant
    value = F.try_variant_get(col, f'$["{field.id}"]', "string")
    target = info_type(field.number, field.type)
    return value.isNotNull() if isinstance(target, T.BooleanType) else _converted(value, target)


def _converted(value: Column, target: T.DataType) -> Column:
    value = _present(_present(value, ""), ".")
    if isinstance(target, T.StringType):
        return value
    if isinstance(target, T.ArrayType):
        items = F.transform(F.split(value, ","), lambda x: _present(_present(x, ""), "."))
        return items if isinstance(target.elementType, T.StringType) else items.try_cast(target)
    return value.try_cast(target)


def _present(value: Column, missing: str) -> Column:
    return F.nullif(value, F.lit(missing))
