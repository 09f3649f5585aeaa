"""Time-series pipelines: rolling means, hourly resampling, gap filling.

Every window here runs *after* an aggregate to a regular grain (hour), so a
window partition holds one series' buckets — bounded by the time span, not
by how many raw readings a hot sensor or facility produced.  The raw rows
only pass through partial (map-side) aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.interp import interpolate_linear, interpolate_linear_chunked
from ..functions.numeric import as_double, clamp_low, is_false, round_half
from ..functions.timefn import bucket, time_grid
from .joins import dims, enrich


def rolling_24h(readings: DataFrame, sensors: DataFrame, facilities: DataFrame,
                sensor_type: str = "power_output", rows: int = 24) -> DataFrame:
    """Hourly mean of clean power readings per facility, then the mean of the
    trailing ``rows`` hourly rows (not hours: missing hours are not filled).

    Columns: facility_name, hour, avg_power_mw (4 dp), rolling_24h_avg_mw (4 dp).
    """
    d = dims(sensors, facilities, sensor_filter=F.col("sensor_type") == F.lit(sensor_type),
             columns=["facility_id", "facility_name"])
    j = enrich(readings.filter(is_false("is_anomaly")), d)
    hourly = (j.groupBy("facility_id", "facility_name", bucket("hour", "recorded_at").alias("hour"))
              .agg(F.avg(as_double("value")).alias("avg_power_mw")))
    w = Window.partitionBy("facility_id").orderBy("hour").rowsBetween(-(rows - 1), 0)
    return (hourly.select("facility_name", "hour",
                          round_half("avg_power_mw", 4).alias("avg_power_mw"),
                          round_half(F.avg("avg_power_mw").over(w), 4).alias("rolling_24h_avg_mw"),
                          "facility_id")
            .orderBy("facility_name", "hour", "facility_id").drop("facility_id"))


def rolling_by_type(readings: DataFrame, sensors: DataFrame, facilities: DataFrame,
                    sensor_type: str = "power_output", rows: int = 24) -> DataFrame:
    """Dashboard variant: hourly SUM per facility type (flagged rows
    included), trailing ``rows``-row mean, unrounded.

    Columns: hour, facility_type, rolling_24h_avg.
    """
    d = dims(sensors, facilities, sensor_filter=F.col("sensor_type") == F.lit(sensor_type),
             columns=["facility_type"])
    j = enrich(readings, d)
    hourly = (j.groupBy(bucket("hour", "recorded_at").alias("hour"), "facility_type")
              .agg(F.sum(F.col("value").cast("decimal(20,4)")).cast("double").alias("total_power")))
    w = Window.partitionBy("facility_type").orderBy("hour").rowsBetween(-(rows - 1), 0)
    return (hourly.select("hour", "facility_type", F.avg("total_power").over(w).alias("rolling_24h_avg"))
            .orderBy("hour", "facility_type"))


# ---------------------------------------------------------------- external series

SERIES_KEYS = ("dataset_id", "metric", "country")


def resample(series: DataFrame, keys: Sequence[str] = SERIES_KEYS, ts: str = "recorded_at",
             value: str = "value", unit: str = "hour", chunk_unit: str = "month") -> DataFrame:
    """Mean per (series, time bucket), including the empty buckets between a
    series' own first and last bucket (value NULL there).

    The grid is generated in two steps — the series' [min, max] span into
    chunks (months), spread over tasks, then each chunk into buckets — so a
    long or fine-grained series is generated by many tasks; it is then
    left-joined to the bucket means.  Rows with a NULL key are dropped
    (pandas groupby does the same).
    """
    keys = list(keys)
    nonnull = F.lit(True)
    for k in keys:
        nonnull = nonnull & F.col(k).isNotNull()
    b = series.filter(nonnull).withColumn("_b", bucket(unit, ts))
    means = b.groupBy(*keys, "_b").agg(F.avg(as_double(value)).alias(value))
    span = means.groupBy(*keys).agg(F.min("_b").alias("_lo"), F.max("_b").alias("_hi"))
    lo, hi = F.col("_lo"), F.col("_hi")
    chunks = (span.select(*keys, "_lo", "_hi",
                          time_grid(bucket(chunk_unit, lo), bucket(chunk_unit, hi),
                                    f"1 {chunk_unit}").alias("_m"))
              .repartition(*keys, "_m"))
    end = F.col("_m") + F.expr(f"INTERVAL 1 {chunk_unit}") - F.expr(f"INTERVAL 1 {unit}")
    grid = chunks.select(*keys, time_grid(F.greatest(lo, F.col("_m")), F.least(hi, end),
                                          f"1 {unit}").alias("_b"))
    return (grid.join(means, keys + ["_b"], "left")
            .withColumnRenamed("_b", ts)
            .select(*keys, ts, value))


STEP_SECONDS = {"minute": 60, "hour": 3600, "day": 86400}


def _interpolate(resampled: DataFrame, value: str, keys: Sequence[str], ts: str, limit: int,
                 out: str, unit: str | None, chunk_unit: str | None) -> DataFrame:
    """Chunked interpolation on a regular grid (window partitions bounded by
    ``chunk_unit``), or whole-series windows when no grid/chunk is given."""
    if unit in STEP_SECONDS and chunk_unit:
        return interpolate_linear_chunked(resampled, value, list(keys), ts, limit, out,
                                          STEP_SECONDS[unit], chunk_unit)
    return interpolate_linear(resampled, value, list(keys), ts, limit, out)


def fill_gaps(resampled: DataFrame, keys: Sequence[str] = SERIES_KEYS, ts: str = "recorded_at",
              value: str = "value", limit: int = 3, fill: float = 0.0,
              lower: float | None = 0.0, unit: str | None = "hour",
              chunk_unit: str | None = "month") -> DataFrame:
    """Linear interpolation (at most ``limit`` steps from either side), then
    remaining gaps := ``fill``, then clamp below at ``lower``.

    The input is a resampled grid of ``unit``; windows run per (series,
    ``chunk_unit``) with the neighbours across chunk edges carried in, so a
    long series is not one task.  Column order and names are kept.
    """
    d = _interpolate(resampled, value, keys, ts, limit, "_int", unit, chunk_unit)
    filled = F.coalesce(F.col("_int"), F.lit(fill))
    if lower is not None:
        filled = clamp_low(filled, lower)
    return d.withColumn(value, filled).drop("_int")


def gap_counts(resampled: DataFrame, keys: Sequence[str] = SERIES_KEYS, ts: str = "recorded_at",
               value: str = "value", limit: int = 3, unit: str | None = "hour",
               chunk_unit: str | None = "month") -> DataFrame:
    """One row: gaps before interpolation, gaps left after it (filled with
    0), negatives clamped.  Counts come from one aggregate."""
    t = _interpolate(resampled, value, keys, ts, limit, "_int", unit, chunk_unit)
    t = t.select(F.col(value).alias("_raw"), F.col("_int"))
    return t.agg(F.count_if(F.col("_raw").isNull()).alias("nan_before"),
                  F.count_if(F.col("_int").isNull()).alias("nan_after"),
                  F.count_if(F.coalesce(F.col("_int"), F.lit(0.0)) < F.lit(0)).alias("negatives"))


def normalize_hourly(series: DataFrame, keys: Sequence[str] = SERIES_KEYS, limit: int = 3,
                     source: str = "fingrid") -> DataFrame:
    """Payload rows -> clean hourly grid_data rows: resample to the hour,
    interpolate gaps, fill the rest with 0, clamp negatives, stamp source.

    Columns: dataset_id, country, recorded_at, value, metric, source.
    """
    r = resample(series, keys, unit="hour")
    f = fill_gaps(r, keys, limit=limit, unit="hour", chunk_unit="month")
    return f.select("dataset_id", "country", "recorded_at", "value", "metric",
                    F.lit(source).alias("source"))

