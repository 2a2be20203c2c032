"""Column-expression helpers (all JVM-side; no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pct_growth(cur, prev) -> Column:
    """(cur - prev) * 100 / prev, NULL when prev is 0 or NULL."""
    prev = col_(prev)
    return F.try_divide((col_(cur) - prev).cast("double") * 100.0, F.nullif(prev, F.lit(0)).cast("double"))


def dec2_text(c) -> Column:
    """Render a number with exactly two decimals (as a DECIMAL does): 17 -> '17.00'."""
    return col_(c).cast("decimal(38,2)").cast("string")


def blank_to_null(c) -> Column:
    """Unicode-aware trim; whitespace-only text becomes NULL."""
    t = F.regexp_replace(col_(c), r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    return F.when(t == "", F.lit(None).cast("string")).otherwise(t)


def utrim(c) -> Column:
    """Trim Unicode whitespace at both ends; NULL stays NULL, blank stays ''."""
    return F.regexp_replace(col_(c), r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
