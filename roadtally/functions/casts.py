"""Tolerant conversions of payload text and exact derived averages, over named columns.

Plain casts raise on bad text under ANSI mode; nothing here does, and no session setting is touched.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_int(c: str) -> Column:
    """``'30'`` and ``'30.0'`` -> 30, ``'30.7'`` -> 30, blank or bad text -> null."""
    return F.expr(f"try_cast(try_cast({c} as double) as int)")


def to_long(c: str) -> Column:
    return F.expr(f"try_cast(try_cast({c} as double) as bigint)")


def to_day(c: str) -> Column:
    """Date from ``yyyy-MM-dd`` text, else null.

    The cast alone also takes shorter and longer forms, so the shape is checked first; this is several times
    cheaper per row than parsing by pattern.
    """
    return F.expr(
        f"case when length({c}) = 10 and substr({c}, 5, 1) = '-' and substr({c}, 8, 1) = '-'"
        f" and substr({c}, 10, 1) between '0' and '9' then try_cast({c} as date) end"
    )


def to_grid(c: str) -> Column:
    """Coordinate text to a 0.1 degree cell as an exact decimal key."""
    return F.expr(f"try_cast(round(try_cast({c} as decimal(18,12)), 1) as decimal(5,2))")


def blank_to_null(c: str) -> Column:
    return F.expr(f"nullif({c}, '')")


def exact_average(total: str, count: str, places: int) -> Column:
    """``total / count`` of integer columns, rounded half away from zero; null for an empty group.

    Integer arithmetic keeps ties exact where a double quotient would already be off.
    """
    scale = 10**places
    units = f"(({2 * scale} * abs({total}) + {count}) div (2 * nullif({count}, 0)))"
    return F.expr(f"sign({total}) * {units} / {scale}")
