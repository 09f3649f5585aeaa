"""Facility rankings and per-sensor top-N.

Aggregations run on the narrow key (facility_id, month) and facility
attributes are joined back afterwards, so the shuffle carries ids, not names.
Whole-set ranks (global RANK, NTILE, PERCENT_RANK) are computed by range
partitioning with per-partition offsets (:mod:`voltaic.operators.rank`), at any
number of facilities.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import as_double, is_false, round_half, safe_div
from ..functions.timefn import bucket, half_open
from .joins import dims, enrich, sized_broadcast
from .rank import distributed_ranks

FACILITY_COLS = ["facility_id", "facility_name", "facility_type", "country", "capacity_mw"]


def _facility_means(readings: DataFrame, sensors: DataFrame, facilities: DataFrame,
                    sensor_type: str, *by) -> DataFrame:
    """Mean clean value per facility_id and ``by`` (avg_output_mw).  Fact rows are reduced per
    sensor first; only ids move."""
    d = dims(sensors, facilities, sensor_filter=F.col("sensor_type") == F.lit(sensor_type),
             columns=["facility_id"])
    v = as_double("value")
    per_sensor = (readings.filter(is_false("is_anomaly")).groupBy("sensor_id", *by)
                  .agg(F.sum(v).alias("_s"), F.count(v).alias("_n")))
    names = [c for c in per_sensor.columns if c not in ("sensor_id", "_s", "_n")]
    return (enrich(per_sensor, d).groupBy("facility_id", *names)
            .agg(F.try_divide(F.sum("_s"), F.sum("_n")).alias("avg_output_mw")))


def facility_ranking(readings: DataFrame, sensors: DataFrame, facilities: DataFrame,
                     sensor_type: str = "power_output") -> DataFrame:
    """Efficiency = mean over months of (monthly mean output / capacity * 100).

    Ranks are taken on the value rounded to 2 dp (ties share a rank).  NULL
    efficiency (capacity 0) sorts first under DESC and last under ASC, as in
    PostgreSQL.  Columns: facility_name, facility_type, country, capacity_mw,
    avg_efficiency_pct, overall_rank, rank_within_type, performance_quartile,
    percentile.
    """
    monthly = _facility_means(readings, sensors, facilities, sensor_type, bucket("month", "recorded_at").alias("month"))
    # capacity is one value per facility, so the mean of the ratios is the ratio of the mean
    mean = monthly.groupBy("facility_id").agg(F.avg("avg_output_mw").alias("_mean"))
    eff = (mean.join(sized_broadcast(facilities.select(*FACILITY_COLS)), "facility_id")
           .withColumn("avg_efficiency_pct", round_half(safe_div(F.col("_mean"), as_double("capacity_mw")) * F.lit(100.0), 2))
           .drop("_mean"))
    cols = ["facility_name", "facility_type", "country",
            as_double("capacity_mw").alias("capacity_mw"), "avg_efficiency_pct"]
    r = distributed_ranks(eff, "avg_efficiency_pct", "facility_id", "facility_type", 4)
    return (r.select(*cols, F.col("_rank").cast("bigint").alias("overall_rank"),
                     F.col("_rank_in_group").cast("bigint").alias("rank_within_type"),
                     F.col("_tile").cast("bigint").alias("performance_quartile"),
                     round_half(F.col("_pct_rank") * F.lit(100.0), 1).alias("percentile"),
                     "facility_id")
            .orderBy("overall_rank", "facility_id").drop("facility_id"))


def ranking_direct(readings: DataFrame, sensors: DataFrame, facilities: DataFrame,
                   sensor_type: str = "power_output") -> DataFrame:
    """Mean over all clean readings / capacity, ranked on the unrounded ratio.

    Columns: facility_name, facility_type, country, capacity_mw (2 dp),
    avg_efficiency_pct (2 dp), overall_rank.
    """
    j = (_facility_means(readings, sensors, facilities, sensor_type)
         .join(sized_broadcast(facilities.select(*FACILITY_COLS)), "facility_id"))
    ratio = safe_div(F.col("avg_output_mw"), as_double("capacity_mw"))
    cols = ["facility_name", "facility_type", "country",
            round_half("capacity_mw", 2).alias("capacity_mw"),
            round_half(F.col("_ratio") * F.lit(100.0), 2).alias("avg_efficiency_pct")]
    j = j.withColumn("_ratio", ratio)
    r = distributed_ranks(j, "_ratio", "facility_id")
    return (r.select(*cols, F.col("_rank").cast("bigint").alias("overall_rank"), "facility_id")
            .orderBy("overall_rank", "facility_id").drop("facility_id"))


def top_efficiency(readings: DataFrame, sensors: DataFrame, facilities: DataFrame,
                   sensor_type: str = "power_output", n: int = 10) -> DataFrame:
    """Dashboard top-n: mean of per-reading value / capacity * 100.

    No clean filter and grouped by (facility_name, capacity_mw) as in the
    dashboard.  Capacity 0 gives NULL here (PostgreSQL would raise); NULL
    sorts first under DESC.  Columns: facility_name, capacity_mw,
    avg_efficiency_pct.
    """
    d = dims(sensors, facilities, sensor_filter=F.col("sensor_type") == F.lit(sensor_type),
             columns=["facility_name", "capacity_mw"])
    # Capacity is one value in a group, so the mean of the ratios is the ratio of the mean, and
    # readings are reduced per sensor before the join.
    v = as_double("value")
    per_sensor = readings.groupBy("sensor_id").agg(F.sum(v).alias("_s"), F.count(v).alias("_n"))
    agg = (enrich(per_sensor, d).groupBy("facility_name", "capacity_mw")
           .agg(F.try_divide(F.sum("_s"), F.sum("_n")).alias("_mean"))
           .withColumn("eff", safe_div(F.col("_mean"), as_double("capacity_mw")) * F.lit(100.0)))
    return (agg.select("facility_name", as_double("capacity_mw").alias("capacity_mw"),
                       round_half("eff", 2).alias("avg_efficiency_pct"))
            .orderBy(F.col("avg_efficiency_pct").desc_nulls_first(), "facility_name", "capacity_mw")
            .limit(n))


def top_readings_per_sensor(readings: DataFrame, sensors: DataFrame, facilities: DataFrame,
                            start: str = "2023-12-01", stop: str = "2024-01-01",
                            n: int = 3) -> DataFrame:
    """Top-n clean readings per sensor within [start, stop), by value desc.

    ``row_number() <= n`` over (sensor) plans as WindowGroupLimit before and
    after the shuffle, so each map task forwards at most n rows per sensor —
    a hot sensor is cut down before it is moved.  Sensors without rows in
    the range do not appear.  Columns: facility_id, facility_name,
    sensor_id, sensor_type, recorded_at, value.
    """
    r = readings.filter(half_open("recorded_at", start, stop) & is_false("is_anomaly"))
    w = Window.partitionBy("sensor_id").orderBy(
        F.col("value").desc_nulls_first(), F.col("recorded_at").desc(), F.col("reading_id"))
    top = r.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= F.lit(n))
    d = dims(sensors, facilities, columns=["facility_id", "facility_name", "sensor_type"])
    return (enrich(top, d)
            .select("facility_id", "facility_name", "sensor_id", "sensor_type", "recorded_at",
                    "value", "_rn")
            .orderBy("sensor_id", "_rn").drop("_rn"))
