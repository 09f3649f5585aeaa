"""Numeric Column helpers: rounding, safe division, NULL-safe comparisons.

All are built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A value that is an exact half in decimal (2-decimal measures make this
# common) lands a few ULPs either side of it once averaged in binary floating
# point, and engines then round it differently.  PostgreSQL NUMERIC rounds the
# exact half away from zero; a nudge away from zero reproduces that and makes
# the result independent of summation order.  It is at most a hundred-thousandth
# of the last digit kept, so it moves no value that is not a half.
HALF_NUDGE = 1e-9


def half_nudge(scale: int) -> float:
    return min(HALF_NUDGE, 10.0 ** -(scale + 5))


def as_double(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("double")


def round_half(c: Column | str, scale: int) -> Column:
    """ROUND(x, scale) with half away from zero on double input."""
    c = as_double(c)
    return F.round(c + F.signum(c) * F.lit(half_nudge(scale)), scale)


def safe_div(num: Column, den: Column) -> Column:
    """num / NULLIF(den, 0): NULL instead of an ANSI division error."""
    return F.try_divide(num, F.nullif(den, F.lit(0)))


def pct(part: Column, whole: Column) -> Column:
    """100.0 * part / NULLIF(whole, 0)."""
    return safe_div(F.lit(100.0) * part.cast("double"), whole.cast("double"))


def is_false(c: Column | str) -> Column:
    """SQL ``c = FALSE``: NULL is neither true nor false, so it is dropped."""
    c = F.col(c) if isinstance(c, str) else c
    return c == F.lit(False)


def is_true(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c == F.lit(True)


def clamp_low(c: Column, low: float = 0.0) -> Column:
    """clip(lower=low); greatest() skips NULL, so apply after filling."""
    return F.greatest(c, F.lit(low))
