"""A check suite that reads its fact table once and survives checks that fail at run time (Q7).

Two kinds of checks share the scan:

* row checks: aggregates of the readings.  They ride as observed metrics on the job that makes
  the summary below, so they cost no scan of their own;
* summary checks: anything that one row per (sensor, day) can tell, such as sensors without
  readings, rates by facility or days covered.  The summary is staged and is what they read.

A check whose expression raises on some row (a cast, a division, an index under ANSI rules) must
not take the others down.  The job is then repeated for halves of the checks until those that
raise stand alone: k of n checks that raise cost about k log n further scans, none cost none.

Observed metrics are accumulators: a map task that runs again after an executor was lost counts
twice.  The observed number of rows is therefore held against the summary's own count, and the
metrics are taken again by a plain aggregate when they differ.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.numeric import is_true, pct, round_half
from ..functions.timefn import bucket
from .joins import sized_broadcast
from .quality import volume_tolerance
from .stage import Scratch

ROWS = "rows_read"
_ERRORS = (PySparkException, Py4JJavaError)


@dataclass(frozen=True)
class RowCheck:
    """Aggregates over all readings, and what their values (by name) say.

    The values hold ``rows_read`` besides the check's own aggregates.  Observed aggregates may
    not be DISTINCT."""
    label: str
    aggregates: Mapping[str, Column]
    failed: Callable[[Mapping], bool]
    detail: Callable[[Mapping], object]


@dataclass(frozen=True)
class SummaryCheck:
    """A one-row frame made from the summary (sensor_id, day, n, flagged), and what it says."""
    label: str
    build: Callable[[DataFrame], DataFrame]
    failed: Callable[[Mapping], bool]
    detail: Callable[[Mapping], object]


def summarise(readings: DataFrame, ts: str = "recorded_at") -> DataFrame:
    """sensor_id, day, n, flagged: one row per sensor and UTC day, partial sums before the shuffle."""
    return readings.groupBy("sensor_id", bucket("day", ts).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_true("is_anomaly")).alias("flagged"))


def error_class(e: Exception) -> str:
    """A short name of what went wrong: Spark's error condition, else the exception's class."""
    name = e.getCondition() if isinstance(e, PySparkException) else None
    cause = getattr(e, "java_exception", None)
    while not name and cause is not None:
        name = cause.getCondition() if hasattr(cause, "getCondition") else None
        cause = cause.getCause()
    return name or type(e).__name__


def _aggregates(checks: Sequence[RowCheck]) -> list[Column]:
    return [F.count(F.lit(1)).alias(ROWS)] + [c.alias(f"m{k}_{name}") for k, check in enumerate(checks) for name, c in check.aggregates.items()]


def _values(found: Mapping, checks: Sequence[RowCheck]) -> list[dict]:
    return [{ROWS: found[ROWS], **{name: found[f"m{k}_{name}"] for name in check.aggregates}} for k, check in enumerate(checks)]


def _isolated(readings: DataFrame, checks: Sequence[RowCheck]) -> list[dict | Exception]:
    """Values of every check, or what it raises, by plain aggregates over halves of the checks."""
    try:
        return _values(readings.agg(*_aggregates(checks)).first().asDict(), checks)
    except _ERRORS as e:
        if len(checks) == 1:
            return [e]
        half = len(checks) // 2
        return _isolated(readings, checks[:half]) + _isolated(readings, checks[half:])


def _scanned(readings: DataFrame, checks: Sequence[RowCheck], scratch: Scratch, ts: str):
    """The staged summary, and values (or errors) of the row checks, from one job if none raises."""
    seen = Observation()
    try:
        summary = scratch.put(summarise(readings.observe(seen, *_aggregates(checks)), ts), "suite-summary")
        found = seen.get
    except _ERRORS:
        summary = scratch.put(summarise(readings, ts), "suite-summary")
        return summary, _isolated(readings, checks)
    if found[ROWS] != (summary.agg(F.sum("n")).first()[0] or 0):  # tasks that ran again
        return summary, _isolated(readings, checks)
    return summary, _values(found, checks)


def run_suite(readings: DataFrame, checks: Sequence[RowCheck | SummaryCheck], ts: str = "recorded_at") -> list[dict]:
    """check, passed, detail for every check, in order; a check that raises has failed, with the
    error's name as detail.  Only a table that cannot be read at all raises."""
    rows = [c for c in checks if isinstance(c, RowCheck)]
    with Scratch(readings.sparkSession) as scratch:
        summary, values = _scanned(readings, rows, scratch, ts)
        by_row = dict(zip(map(id, rows), values))
        out = []
        for c in checks:
            try:
                found = by_row[id(c)] if isinstance(c, RowCheck) else c.build(summary).first().asDict()
                if isinstance(found, Exception):
                    raise found
                passed, detail = not c.failed(found), str(c.detail(found))
            except Exception as e:  # noqa: BLE001 - the check failed; the others go on
                passed, detail = False, f"error: {error_class(e)}"
            out.append({"check": c.label, "passed": passed, "detail": detail})
    return out


def suite_frame(readings: DataFrame, checks: Sequence[RowCheck | SummaryCheck], ts: str = "recorded_at") -> DataFrame:
    """:func:`run_suite` as a frame, one row per check."""
    found = run_suite(readings, checks, ts)
    return readings.sparkSession.createDataFrame([(r["check"], r["passed"], r["detail"]) for r in found],
                                                 "`check` string, passed boolean, detail string")


# ---------------------------------------------------------------- the post-load checks

def orphans(sensors: DataFrame, facilities: DataFrame) -> SummaryCheck:
    """Q1: sensors (of a known facility) without a row in the summary."""
    def build(summary):
        alone = sensors.join(summary.select("sensor_id").distinct(), "sensor_id", "left_anti")
        return alone.join(sized_broadcast(facilities.select("facility_id")), "facility_id", "left_semi").agg(F.count(F.lit(1)).alias("n"))
    return SummaryCheck("orphan_sensors", build, lambda v: v["n"] > 0, lambda v: v["n"])


def null_values(column: str = "value") -> RowCheck:
    """Q2."""
    return RowCheck("null_values", {"nulls": F.count_if(F.col(column).isNull())}, lambda v: v["nulls"] > 0, lambda v: v["nulls"])


def rates(sensors: DataFrame, facilities: DataFrame) -> SummaryCheck:
    """Q3, for information: how many (name, type) groups of facilities have readings, and the
    highest rate among them, from sums per sensor."""
    def build(summary):
        per_sensor = summary.groupBy("sensor_id").agg(F.sum("n").alias("n"), F.sum("flagged").alias("flagged"))
        places = sensors.select("sensor_id", "facility_id").join(
            sized_broadcast(facilities.select("facility_id", "facility_name", "facility_type")), "facility_id")
        per_place = per_sensor.join(sized_broadcast(places), "sensor_id").groupBy("facility_name", "facility_type").agg(
            round_half(pct(F.sum("flagged"), F.sum("n")), 2).alias("rate"))
        return per_place.agg(F.count(F.lit(1)).alias("n"), F.max("rate").alias("highest"))
    return SummaryCheck("anomaly_rate", build, lambda v: False, lambda v: v["n"])


def days_covered(expected: int = 365) -> SummaryCheck:
    """Q4: distinct UTC days with readings."""
    return SummaryCheck("coverage", lambda s: s.where(F.col("day").isNotNull()).agg(F.count_distinct("day").alias("days")),
                        lambda v: v["days"] < expected, lambda v: v["days"])


def rate_band(low: float = 1.0, high: float = 4.0) -> RowCheck:
    """Q5: the flagged share of all readings lies within [low, high] per cent; none of none fails."""
    share = lambda v: 100.0 * v["flagged"] / v[ROWS] if v[ROWS] else None
    return RowCheck("global_rate", {"flagged": F.count_if(is_true("is_anomaly"))},
                    lambda v: share(v) is None or not low <= share(v) <= high, lambda v: None if share(v) is None else f"{share(v):.4f}")


def volume(expected: int, tolerance: float | None = None) -> RowCheck:
    """Q6: the number of rows is near the expected one."""
    most = volume_tolerance(expected) if tolerance is None else tolerance
    return RowCheck("volume", {}, lambda v: abs(v[ROWS] - expected) / expected > most, lambda v: v[ROWS])


def post_load(sensors: DataFrame, facilities: DataFrame, days_expected: int = 365, rows_expected: int | None = None) -> list:
    """The gate after a load (orphans, NULLs, rates, coverage), and with an expected volume the
    two further data tests."""
    gate = [orphans(sensors, facilities), null_values(), rates(sensors, facilities), days_covered(days_expected)]
    return gate if rows_expected is None else [*gate, rate_band(), volume(rows_expected)]
