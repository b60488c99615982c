"""Numeric helpers with engine-independent results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# NUMERIC rounding goes through a wide decimal so that the result does not
# depend on how a double happens to be rounded by one engine or another.
ROUND_DECIMAL = "decimal(38,10)"


def round_numeric(col: Column | str, scale: int) -> Column:
    """``ROUND(x::NUMERIC, scale)`` returned as double (HALF_UP on decimal)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c.cast(ROUND_DECIMAL), scale).cast("double")


# Money is added up in decimal, so a total does not depend on task order.
MONEY_DECIMAL = "decimal(28,6)"


def money_sum(col: Column | str) -> Column:
    """Exact ``SUM`` of amounts, returned as double."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast(MONEY_DECIMAL)).cast("double")


def pct(part: Column, whole: Column) -> Column:
    """Guarded percentage ``part / whole * 100`` (0 when ``whole`` is 0)."""
    return F.when(whole > 0, part.cast("double") / whole * 100).otherwise(F.lit(0.0))


def flag(condition: Column) -> Column:
    """``CASE WHEN condition THEN 1 ELSE 0 END``."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))
