"""Time-bucket and time-grid Column helpers (session zone is pinned to UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucket(unit: str, c: Column | str, ntz: bool = True) -> Column:
    """DATE_TRUNC(unit, ts) keeping the input's timestamp flavour.

    Spark's date_trunc returns TIMESTAMP even for TIMESTAMP_NTZ input, so cast
    back; with the session zone in UTC the round trip is exact.
    """
    t = F.date_trunc(unit, _c(c))
    return t.cast(TimestampNTZType() if ntz else TimestampType())


def month_label(c: Column | str) -> Column:
    """TO_CHAR(ts, 'YYYY-MM')."""
    return F.date_format(_c(c), "yyyy-MM")


def day_label(c: Column | str) -> Column:
    """TO_CHAR(ts, 'YYYY-MM-DD')."""
    return F.date_format(_c(c), "yyyy-MM-dd")


def iso8601(c: Column | str, with_offset: bool = False) -> Column:
    """ISO-8601 text of a timestamp, as ``datetime.isoformat`` writes it:
    microseconds only when non-zero, and ``+00:00`` for zoned timestamps
    (``with_offset``; the session zone is UTC)."""
    c = _c(c)
    zone = "xxx" if with_offset else ""
    whole = F.date_format(c, f"yyyy-MM-dd'T'HH:mm:ss{zone}")
    frac = F.date_format(c, f"yyyy-MM-dd'T'HH:mm:ss.SSSSSS{zone}")
    return F.when(F.date_format(c, "SSSSSS") == F.lit("000000"), whole).otherwise(frac)


def month_key(c: Column | str) -> Column:
    """Partition value ``yyyy-MM`` of a timestamp (layout column)."""
    return F.date_format(_c(c), "yyyy-MM")


def time_grid(start: Column, stop: Column, step: str) -> Column:
    """explode(sequence(start, stop, INTERVAL step)) — regular grid rows."""
    return F.explode(F.sequence(start, stop, F.expr(f"INTERVAL {step}")))


def half_open(c: Column | str, lo, hi) -> Column:
    """lo <= c < hi (half-open range; bounds are literals or Columns).
    Text bounds are coerced to the column's timestamp type by the analyzer and
    constant-folded, so the predicate still reaches the Parquet scan."""
    c = _c(c)
    lo = lo if isinstance(lo, Column) else F.lit(lo)
    hi = hi if isinstance(hi, Column) else F.lit(hi)
    return (c >= lo) & (c < hi)
