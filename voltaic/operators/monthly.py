"""Monthly statistics per sensor that are kept, not recomputed.

Every batch contributes one row per (sensor, month) it touches: counts, exact sums, the moments
(count, mean, M2) of its clean values, and the days it covers as a bit mask.  All of these merge,
so the state of a month is the fold of its contributions, and a load costs a pass over what it
brings, not over what is stored:

* counts and decimal sums add up; days unite by ``bit_or``; times by min and max;
* moments merge by Chan's rule, pairwise, in the order of the batches, so that the same
  contributions give the same bits however the rows were dealt.

Storage: ``<root>/<version>/batch=<name>``, sorted by month and sensor, so that a reader of some
months skips row groups.  A batch that is contributed again overwrites its own partition, so a
retry does not count twice.  :func:`compact` folds everything into
a new version and then switches a pointer, so a reader sees the old or the new, never both.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import as_double, is_false, is_true, pct, round_half
from ..functions.timefn import bucket
from .layout import MONTH, current_copy, point_to
from .load import path_exists
from .reports import SUM_TYPE

BATCH = "batch"
_POINTER = "current"
_SUM = "decimal(38,4)"


def contributions(readings: DataFrame, ts: str = "recorded_at") -> DataFrame:
    """One row per (sensor_id, month) of ``readings``: n, valued, flagged, total (exact), clean_n, mean
    and m2 of the clean values, days (bit k: day k + 1 of the month), first and last time.

    Rows without a time belong to no month and are left out; clean means ``is_anomaly = FALSE``.
    Partial aggregates before the one shuffle, so a hot sensor is one row per task and month.
    """
    v = F.when(is_false("is_anomaly"), as_double("value"))
    day = F.expr(f"shiftleft(1, day(`{ts}`) - 1)")
    return (readings.where(F.col(ts).isNotNull()).groupBy("sensor_id", F.date_format(ts, "yyyy-MM").alias(MONTH)).agg(
        F.count(F.lit(1)).alias("n"), F.count("value").alias("valued"), F.count_if(is_true("is_anomaly")).alias("flagged"),
        F.sum(F.col("value").cast(SUM_TYPE)).cast(_SUM).alias("total"), F.count(v).alias("clean_n"), F.avg(v).alias("mean"),
        (F.var_pop(v) * F.count(v)).alias("m2"), F.bit_or(day).alias("days"), F.min(ts).alias("first"), F.max(ts).alias("last")))


def _chan(a: Column, b: Column) -> Column:
    """The moments of two disjoint sets of values together; sets without a value change nothing."""
    n = a["clean_n"] + b["clean_n"]
    apart = b["mean"] - a["mean"]
    both = F.struct(n.alias("clean_n"), (a["mean"] + apart * b["clean_n"] / n).alias("mean"),
                    (a["m2"] + b["m2"] + apart * apart * a["clean_n"] * b["clean_n"] / n).alias("m2"))
    return F.when(b["clean_n"] == 0, a).when(a["clean_n"] == 0, b).otherwise(both)


def merged(parts: DataFrame) -> DataFrame:
    """The fold of contributions (with a column ``batch``) into one row per (sensor_id, month).

    The moments of one sensor-month are gathered: one small struct per batch since the last
    compaction, whatever the number of readings."""
    moments = F.struct("batch", "clean_n", F.coalesce("mean", F.lit(0.0)).alias("mean"), F.coalesce("m2", F.lit(0.0)).alias("m2"))
    zero = F.struct(F.lit(0).cast("long").alias("clean_n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    g = parts.groupBy("sensor_id", MONTH).agg(
        *[F.sum(c).alias(c) for c in ("n", "valued", "flagged")], F.sum("total").cast(_SUM).alias("total"),
        F.sort_array(F.collect_list(moments)).alias("moments"), F.bit_or("days").alias("days"), F.min("first").alias("first"), F.max("last").alias("last"))
    fold = F.aggregate("moments", zero, lambda a, x: _chan(a, x.dropFields("batch")))
    return (g.withColumn("fold", fold).withColumn("clean_n", F.col("fold.clean_n"))
            .withColumn("mean", F.when(F.col("clean_n") > 0, F.col("fold.mean"))).withColumn("m2", F.when(F.col("clean_n") > 0, F.col("fold.m2")))
            .select("sensor_id", MONTH, "n", "valued", "flagged", "total", "clean_n", "mean", "m2", "days", "first", "last"))


# ---------------------------------------------------------------- storage

def _current(spark: SparkSession, root: str) -> str:
    pointer = f"{root}/{_POINTER}"
    return current_copy(spark, pointer) if path_exists(spark, pointer) else f"{root}/v0"


def _write(stats: DataFrame, path: str) -> None:
    """Sorted by month and sensor; a month of many sensors still spreads over tasks."""
    order = [MONTH, "sensor_id"]
    stats.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def contribute(readings: DataFrame, root: str, batch: str, ts: str = "recorded_at") -> None:
    """Add the statistics of newly stored ``readings`` under the name ``batch`` (letters, digits, ``_``
    and ``-``).  The same batch again replaces itself; its rows must then be the same, and every
    reading must belong to one batch.  Not to be run beside :func:`compact`."""
    if not re.fullmatch(r"[A-Za-z0-9_-]+", batch):
        raise ValueError(f"not a batch name: {batch!r}")
    spark = readings.sparkSession
    _write(contributions(readings, ts), f"{_current(spark, root)}/{BATCH}={batch}")


def _stored(spark: SparkSession, root: str) -> DataFrame:
    data = spark.read.parquet(_current(spark, root))
    return data.withColumn(BATCH, F.col(BATCH).cast("string"))  # names may look like numbers


def state(spark: SparkSession, root: str, months: tuple[str, str] | None = None) -> DataFrame:
    """One row per (sensor_id, month) with everything contributed so far; with ``months`` (first and
    last as 'yyyy-MM') the row groups of others are skipped."""
    parts = _stored(spark, root)
    return merged(parts if months is None else parts.where(F.col(MONTH).between(*months)))


def compact(spark: SparkSession, root: str) -> None:
    """Fold all contributions into one per sensor-month, in a new version that then becomes the
    current one.  The old version stays until the next compaction's caller deletes it."""
    old = _current(spark, root)
    new = f"{root}/v{int(old.rsplit('/v', 1)[1]) + 1}"
    _write(state(spark, root), f"{new}/{BATCH}=0")
    point_to(spark, f"{root}/{_POINTER}", new)


# ---------------------------------------------------------------- answers

def _month_start() -> Column:
    return F.to_timestamp_ntz(F.concat(F.col(MONTH), F.lit("-01")), F.lit("yyyy-MM-dd")).alias(MONTH)


def baseline(stats: DataFrame) -> DataFrame:
    """sensor_id, month (its first instant), mean_val, stddev_val: what the z-score compares with."""
    sd = F.when(F.col("clean_n") > 1, F.sqrt(F.col("m2") / (F.col("clean_n") - 1)))
    return stats.where("clean_n > 0").select("sensor_id", _month_start(), F.col("mean").alias("mean_val"), sd.alias("stddev_val"))


def sensor_months(stats: DataFrame) -> DataFrame:
    """The input of :func:`voltaic.operators.reports.report_of`."""
    return stats.select("sensor_id", _month_start(), F.col("valued").alias("_nv"), F.col("total").alias("_sum"), F.col("flagged").alias("_a"),
                        F.col("n").alias("_n"))


def trend(stats: DataFrame) -> DataFrame:
    """Month, anomaly_rate_pct."""
    return (stats.groupBy(_month_start()).agg(round_half(pct(F.sum("flagged"), F.sum("n")), 2).alias("anomaly_rate_pct"))
            .orderBy("month"))


def coverage(stats: DataFrame) -> DataFrame:
    """Q4: earliest_reading, latest_reading, days_with_data, from the united day masks of each month."""
    by_month = stats.groupBy(MONTH).agg(F.bit_or("days").alias("days"), F.min("first").alias("first"), F.max("last").alias("last"))
    return by_month.agg(F.min("first").alias("earliest_reading"), F.max("last").alias("latest_reading"),
                        F.coalesce(F.sum(F.bit_count("days")), F.lit(0)).cast("bigint").alias("days_with_data"))
