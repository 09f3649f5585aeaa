"""Data-quality checks and declarative constraint rules.

Checks (Q1-Q7) are the post-load gate; rules (C1-C5) stand in for the
database constraints Spark's catalog cannot enforce on Parquet.  Every check
is an aggregate first: the fact table is reduced map-side (partial aggregates
keyed by sensor, key or value) before anything is shuffled or joined, so a
key holding a third of the rows costs one partial-aggregate entry per task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions.numeric import is_true, pct, round_half
from ..functions.timefn import bucket
from ..schemas import TableRules
from .joins import sized_broadcast


# ---------------------------------------------------------------- checks Q1-Q6

def orphan_sensors(readings: DataFrame, sensors: DataFrame, facilities: DataFrame) -> DataFrame:
    """Sensors without any reading, with their facility's name (inner join).

    The fact side is reduced to its distinct sensor ids first (partial
    aggregation per task), so the anti-join compares two dimension-sized sets.
    Columns: sensor_id, sensor_type, facility_name.
    """
    seen = readings.select("sensor_id").distinct()
    lonely = sensors.join(seen, "sensor_id", "left_anti")
    fac = sized_broadcast(facilities.select("facility_id", "facility_name"))
    return lonely.join(fac, "facility_id").select("sensor_id", "sensor_type", "facility_name")


def null_values(readings: DataFrame, column: str = "value", count_nan: bool = False) -> DataFrame:
    """COUNT(*) WHERE value IS NULL (optionally NaN too).  Column: null_value_count."""
    c = F.col(column)
    bad = c.isNull() | F.isnan(c) if count_nan else c.isNull()
    return readings.agg(F.count_if(bad).cast("bigint").alias("null_value_count"))


def anomaly_rate_by_facility(readings: DataFrame, sensors: DataFrame,
                             facilities: DataFrame) -> DataFrame:
    """Flagged share per facility, grouped by (name, type) as the reference does.

    Pre-aggregated per sensor before the dimension join, then re-aggregated.
    Columns: facility_name, facility_type, total_readings, anomaly_count,
    anomaly_pct (2 dp); ordered by anomaly_pct desc.
    """
    per_sensor = readings.groupBy("sensor_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_true("is_anomaly")).alias("a"))
    d = sensors.select("sensor_id", "facility_id").join(
        sized_broadcast(facilities.select("facility_id", "facility_name", "facility_type")),
        "facility_id")
    j = per_sensor.join(sized_broadcast(d), "sensor_id")
    out = j.groupBy("facility_name", "facility_type").agg(
        F.sum("n").cast("bigint").alias("total_readings"),
        F.sum("a").cast("bigint").alias("anomaly_count"))
    return (out.withColumn("anomaly_pct",
                           round_half(pct(F.col("anomaly_count"), F.col("total_readings")), 2))
            .orderBy(F.col("anomaly_pct").desc_nulls_first(), "facility_name", "facility_type"))


def coverage(readings: DataFrame, ts: str = "recorded_at") -> DataFrame:
    """earliest_reading, latest_reading, days_with_data (distinct UTC days)."""
    return readings.agg(F.min(ts).alias("earliest_reading"), F.max(ts).alias("latest_reading"),
                        F.count_distinct(bucket("day", ts)).cast("bigint").alias("days_with_data"))


def global_anomaly_rate(readings: DataFrame, low: float = 1.0, high: float = 4.0) -> DataFrame:
    """100 * flagged / total, and whether it lies within [low, high].

    Columns: anomaly_rate_pct (unrounded), within_band.
    """
    flagged = F.sum(F.when(is_true("is_anomaly"), F.lit(1)).otherwise(F.lit(0)))
    rate = pct(flagged, F.count(F.lit(1)))
    return (readings.agg(rate.alias("anomaly_rate_pct"))
            .withColumn("within_band", F.col("anomaly_rate_pct").between(low, high)))


def volume_tolerance(expected: int) -> float:
    """10 % tolerance below 100k expected rows, else 5 %."""
    return 0.10 if expected < 100_000 else 0.05


def volume_check(readings: DataFrame, expected: int, tolerance: float | None = None) -> DataFrame:
    """Row count against an expectation.  Columns: actual_rows, expected_rows,
    deviation, tolerance, within_tolerance."""
    tol = volume_tolerance(expected) if tolerance is None else tolerance
    dev = F.abs(F.col("actual_rows") - F.lit(expected)) / F.lit(float(expected))
    return (readings.agg(F.count(F.lit(1)).cast("bigint").alias("actual_rows"))
            .select("actual_rows", F.lit(expected).cast("bigint").alias("expected_rows"),
                    dev.alias("deviation"), F.lit(tol).alias("tolerance"))
            .withColumn("within_tolerance", F.col("deviation") <= F.col("tolerance")))


# ---------------------------------------------------------------- Q7 suite

@dataclass(frozen=True)
class Check:
    """A named check: a result frame and a predicate saying it FAILED.

    ``failed`` and ``detail`` are Columns evaluated over the check's result
    reduced to one row by ``reduce`` (default: row count as ``n``)."""
    label: str
    build: Callable[[], DataFrame]
    reduce: Callable[[DataFrame], DataFrame]
    failed: Column
    detail: Column


def _rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def default_checks(readings: DataFrame, sensors: DataFrame, facilities: DataFrame,
                   days_expected: int = 365) -> list[Check]:
    """The four post-load checks, in order."""
    return [
        Check("orphan_sensors", lambda: orphan_sensors(readings, sensors, facilities), _rows,
              F.col("n") > 0, F.col("n")),
        Check("null_values", lambda: null_values(readings), lambda d: d,
              F.col("null_value_count") > 0, F.col("null_value_count")),
        Check("anomaly_rate", lambda: anomaly_rate_by_facility(readings, sensors, facilities),
              _rows, F.lit(False), F.col("n")),
        Check("coverage", lambda: coverage(readings), lambda d: d,
              F.col("days_with_data") < F.lit(days_expected), F.col("days_with_data")),
    ]


def check_summary(spark: SparkSession, checks: Sequence[Check]) -> DataFrame:
    """One row per check: check, passed, detail — as one lazy plan.

    A check that cannot even be planned (missing table or column) is a
    failed row with the error as detail, not an exception.
    """
    parts = []
    for i, c in enumerate(checks):
        try:
            one = c.reduce(c.build())
            row = one.select(F.lit(i).alias("ordinal"), F.lit(c.label).alias("check"),
                             (~F.coalesce(c.failed, F.lit(True))).alias("passed"),
                             c.detail.cast("string").alias("detail"))
        except AnalysisException as e:
            row = spark.range(1).select(F.lit(i).alias("ordinal"), F.lit(c.label).alias("check"),
                                        F.lit(False).alias("passed"),
                                        F.lit(f"error: {e}"[:500]).alias("detail"))
        parts.append(row)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("ordinal").drop("ordinal")


def run_checks(checks: Sequence[Check]) -> tuple[bool, list[dict]]:
    """Evaluate checks one by one; an erroring check counts as failed and
    the remaining checks still run.  Returns (all_passed, per-check rows)."""
    results, ok = [], True
    for c in checks:
        try:
            r = c.reduce(c.build()).select(
                (~F.coalesce(c.failed, F.lit(True))).alias("passed"),
                c.detail.cast("string").alias("detail")).first()
            passed, detail = bool(r["passed"]), r["detail"]
        except Exception as e:  # noqa: BLE001 — a failing check must not stop the suite
            passed, detail = False, f"error: {type(e).__name__}: {e}"[:500]
        ok = ok and passed
        results.append({"check": c.label, "passed": passed, "detail": detail})
    return ok, results


# ---------------------------------------------------------------- rules C1-C5

def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their count (dup_count)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("dup_count"))
            .filter(F.col("dup_count") > 1))


def foreign_key_violations(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child key values with no parent row, with how many child rows carry them.

    NULL keys are not violations (a NULL reference is a NOT NULL question).
    The child is reduced to distinct keys first; the parent side is only
    its key column.  Columns: <fk>, n_rows.
    """
    keys = (child.filter(F.col(fk).isNotNull()).groupBy(fk)
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")))
    par = parent.select(F.col(pk).alias(fk)).distinct()
    return keys.join(par, fk, "left_anti")


def domain_violations(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Values outside the allowed list (NULL passes), with row counts.
    Columns: value, n_rows."""
    c = F.col(column)
    return (df.filter(c.isNotNull() & ~c.isin(list(allowed)))
            .groupBy(c.alias("value")).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")))


def column_rule_violations(df: DataFrame, rules: TableRules) -> DataFrame:
    """NOT NULL, max length and decimal-precision violations, counted in one
    aggregate and returned long: rule, column, violations.

    Precision is tested with try_cast (ANSI cast would raise on overflow)."""
    exprs: list[tuple[str, str, Column]] = []
    cols = set(df.columns)
    for c in rules.not_null:
        if c in cols:
            exprs.append(("not_null", c, F.count_if(F.col(c).isNull())))
    for c, n in rules.max_length.items():
        if c in cols:
            exprs.append(("max_length", c, F.count_if(F.length(F.col(c)) > F.lit(n))))
    for c, (p, s) in rules.decimals.items():
        if c in cols:
            bad = F.col(c).isNotNull() & F.expr(f"try_cast(`{c}` AS DECIMAL({p},{s}))").isNull()
            exprs.append(("decimal", c, F.count_if(bad)))
    if not exprs:
        raise ValueError(f"no rule applies to the columns of {rules.name}")
    wide = df.agg(*[e.cast("bigint").alias(f"_{i}") for i, (_, _, e) in enumerate(exprs)])
    stack = ", ".join(f"'{r}', '{c}', _{i}" for i, (r, c, _) in enumerate(exprs))
    return wide.selectExpr(f"stack({len(exprs)}, {stack}) AS (rule, `column`, violations)")
