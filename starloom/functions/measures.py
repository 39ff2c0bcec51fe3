"""Numeric column functions: fixed-point rounding, NaN handling and exact
half-away-from-zero integer division used by the interpolation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_decimal(c: Column | str, precision: int, scale: int) -> Column:
    """Half-up rounding to ``scale`` digits in a DECIMAL(precision, scale)
    (O-64), in one step.  Doubles are rounded on their shortest decimal
    form; a value that does not fit becomes NULL (sources quarantine it, the
    gates of the loads reject it)."""
    return _c(c).try_cast(f"decimal({precision},{scale})")


def nan_to_null(c: Column | str) -> Column:
    """NaN -> NULL for floating columns (O-53)."""
    x = _c(c)
    return F.when(~F.isnan(x), x)


def to_units(c: Column | str, scale: int) -> Column:
    """Fixed-point integer units of a number at ``scale`` digits."""
    return F.round(_c(c).cast("double") * (10 ** scale)).cast("bigint")


def from_units(units: Column | str, precision: int, scale: int) -> Column:
    return (_c(units).cast("decimal(20,0)") * F.lit(10 ** -scale).cast(f"decimal(20,{scale})")) \
        .cast(f"decimal({precision},{scale})")


def div_half_away(num: Column | str, den: Column | str) -> Column:
    """round(num / den) half away from zero, in exact integer arithmetic
    (den > 0).  Both operands are bigint columns."""
    n, d = _c(num), _c(den)
    q = F.abs(n) * 2 + d
    whole = (q - F.pmod(q, d * 2)) / (d * 2)
    return (F.signum(n) * whole).cast("bigint")


def half_away_sql(num: str, den: str) -> str:
    """SQL text of ``div_half_away`` for integer expressions (den > 0)."""
    return f"(signum({num}) * ((abs({num}) * 2 + {den}) div ({den} * 2)))"


def units_to_decimal_sql(units: str, precision: int, scale: int) -> str:
    """SQL text of ``from_units``."""
    return f"CAST(CAST({units} AS DECIMAL(20,0)) / {10 ** scale} AS DECIMAL({precision},{scale}))"
