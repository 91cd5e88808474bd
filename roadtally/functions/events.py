"""Scalar expressions over incident events, on named columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severity classes, and the points of the two scales.
FATAL, SERIOUS, SLIGHT = "Fatal", "Serious", "Slight"
SCORE_POINTS = {FATAL: 3, SERIOUS: 2}
WEIGHT_POINTS = {FATAL: 5, SERIOUS: 3}


def _points(severity: str, points: dict[str, int]) -> Column:
    cases = " ".join(f"when '{label}' then {value}" for label, value in points.items())
    return F.expr(f"case {severity} {cases} else 1 end")


def severity_score(severity: str = "accident_severity") -> Column:
    """Scale of the conditions rollup; any other class, blank or null scores 1."""
    return _points(severity, SCORE_POINTS)


def severity_weight(severity: str = "accident_severity") -> Column:
    """Scale of the hotspot rollup; any other class, blank or null weighs 1."""
    return _points(severity, WEIGHT_POINTS)


def indicator(condition: str) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.expr(f"if({condition}, 1, 0)")


def event_time_text(*columns: str) -> Column:
    """Trimmed parts joined by a space, blanks dropped; null when nothing is left."""
    parts = ", ".join(f"nullif(trim({c}), '')" for c in columns)
    return F.expr(f"nullif(concat_ws(' ', {parts}), '')" if columns else "cast(null as string)")


def hash_bucket(c: str, buckets: int) -> Column:
    """Stable bucket from the leading 32 bits of the md5, the same in any SQL engine."""
    return F.expr(f"cast(conv(substr(md5({c}), 1, 8), 16, 10) as bigint) % {buckets}")
