"""Expressions that turn byte counts into text or rounded units.

``bround`` rounds exact halves to the even digit, as the formatting this reproduces does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def human_size(size: str | Column) -> Column:
    """``512 B``, ``1.5 KB``, ``5.0 GB``: steps of 1024, one decimal above bytes, nothing above TB."""
    n = _col(size).cast("double")

    def unit(power: int, name: str) -> Column:
        return F.format_string(f"%.1f {name}", F.bround(n / float(1024**power), 1))

    return (
        F.when(n < 1024.0, F.format_string("%d B", n.cast("bigint")))
        .when(n < 1024.0**2, unit(1, "KB"))
        .when(n < 1024.0**3, unit(2, "MB"))
        .when(n < 1024.0**4, unit(3, "GB"))
        .when(n.isNotNull(), unit(4, "TB"))
    )


def signed_bytes(diff: str | Column) -> Column:
    """``+10 B`` or ``-3 B``."""
    n = _col(diff)
    return F.concat(F.when(n > 0, F.lit("+")).otherwise(F.lit("")), n.cast("string"), F.lit(" B"))


def megabytes(size: str | Column) -> Column:
    return F.bround(_col(size) / float(1024**2), 2)


def gigabytes(size: str | Column) -> Column:
    return F.bround(_col(size) / float(1024**3), 2)
