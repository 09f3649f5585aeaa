"""Statistical scoring: z-score anomalies, two-series comparison, Pearson test.

Plans, at scale:
* z-score: baseline = partial/final aggregate per (sensor, month) over clean
  rows — map-side combine, so a hot sensor costs nothing extra.  It is joined
  back to every reading on (sensor, month): broadcast when the baseline's
  size estimate is small, otherwise a shuffle join whose hot keys AQE's skew
  handling splits.  The threshold filter runs before the dimension join and
  the top-k is a TakeOrderedAndProject (per-partition top-k, then merge).
* series comparison: both series are first reduced to one row per calendar
  day (distributed aggregates), so the whole-set statistics run over a set
  bounded by the date span, never by the data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import as_double, is_false, round_half, safe_div
from ..functions.stats import with_pearson_p_value
from ..functions.timefn import bucket, day_label
from .joins import BROADCAST_LIMIT_BYTES, COMPRESSION_ALLOWANCE, dims, enrich, estimated_bytes, sized_broadcast
from .stage import stage


def monthly_baseline(readings: DataFrame) -> DataFrame:
    """Mean and sample stddev per (sensor, month) over clean readings.

    Clean means ``is_anomaly = FALSE``: NULL flags are excluded, as in SQL.
    A sensor-month with one clean row has a NULL stddev.
    """
    v = as_double("value")
    return (readings.filter(is_false("is_anomaly"))
            .groupBy("sensor_id", bucket("month", "recorded_at").alias("month"))
            .agg(F.avg(v).alias("mean_val"), F.stddev_samp(v).alias("stddev_val")))


def z_expr(value: Column, mean: Column, sd: Column) -> Column:
    """|v - mean| / sd, and 0 when sd is 0 or NULL (flat or single-row month)."""
    return F.when(sd > F.lit(0), F.abs(value - mean) / sd).otherwise(F.lit(0.0))


def score_readings(readings: DataFrame) -> DataFrame:
    """Every reading with its z-score against its sensor-month baseline.

    Inner join: readings of a sensor-month without clean rows get no score.
    """
    # The baseline has one row per sensor-month.  When the optimizer's
    # estimate (the input's compressed size at the output's row width, with an
    # allowance for compression) is already small it is broadcast as is; otherwise it is staged first,
    # so its real size is known before the join is planned: broadcast if
    # small, else a shuffle join whose hot sensor-months AQE splits.
    base = monthly_baseline(readings)
    est = estimated_bytes(base)
    if est is not None and est * COMPRESSION_ALLOWANCE <= BROADCAST_LIMIT_BYTES:
        base = F.broadcast(base)
    else:
        base = sized_broadcast(stage(base, "zscore-baseline"))
    return score_against(readings, base)


def score_against(readings: DataFrame, base: DataFrame) -> DataFrame:
    """Every reading with its z-score against a baseline: sensor_id, month, mean_val, stddev_val."""
    r = readings.withColumn("month", bucket("month", "recorded_at"))
    scored = r.join(base, ["sensor_id", "month"])
    return scored.withColumn(
        "z_score", z_expr(as_double("value"), F.col("mean_val"), F.col("stddev_val")))


def zscore_anomalies(readings: DataFrame, sensors: DataFrame, facilities: DataFrame,
                     threshold: float = 3.0, limit: int = 200, baseline: DataFrame | None = None) -> DataFrame:
    """Readings whose z-score exceeds ``threshold``, highest first; against a stored ``baseline``
    (:func:`voltaic.operators.monthly.baseline`) when given.

    Columns: reading_id, sensor_id, recorded_at, value (4 dp), z_score (2 dp),
    was_flagged_in_source, facility_name, sensor_type, unit.
    """
    scored = score_readings(readings) if baseline is None else score_against(readings, sized_broadcast(baseline))
    hits = scored.filter(F.col("z_score") > F.lit(threshold))
    d = dims(sensors, facilities, columns=["facility_name", "sensor_type", "unit"])
    out = enrich(hits, d)
    return (out.orderBy(F.col("z_score").desc(), F.col("reading_id"), F.col("recorded_at"))
            .limit(limit)
            .select("reading_id", "sensor_id", "recorded_at",
                    round_half("value", 4).alias("value"),
                    round_half("z_score", 2).alias("z_score"),
                    F.col("is_anomaly").alias("was_flagged_in_source"),
                    "facility_name", "sensor_type", "unit"))


def validate_anomaly_params(z_threshold: float, limit: int) -> None:
    """The service's bounds: 1 <= z_threshold <= 10, 1 <= limit <= 1000."""
    if not (1.0 <= float(z_threshold) <= 10.0):
        raise ValueError(f"z_threshold must be within [1, 10], got {z_threshold}")
    if not (1 <= int(limit) <= 1000):
        raise ValueError(f"limit must be within [1, 1000], got {limit}")


def anomalies(readings: DataFrame, sensors: DataFrame, facilities: DataFrame,
              z_threshold: float = 3.0, limit: int = 100,
              facility_type: str | None = None) -> DataFrame:
    """Parameterised anomalies (unrounded), optionally for one facility type.

    With a type, the filtered dimension is joined to the readings once, up
    front: baselines are then computed only for the sensors that can appear in
    the answer (they are per sensor, so the result is unchanged).  Without
    one, only the hits are joined.
    """
    validate_anomaly_params(z_threshold, limit)
    ffilter = None if facility_type is None else (F.col("facility_type") == F.lit(facility_type))
    d = dims(sensors, facilities, facility_filter=ffilter,
             columns=["facility_name", "facility_type", "sensor_type", "unit"])
    r = readings if facility_type is None else enrich(readings, d)
    hits = score_readings(r).filter(F.col("z_score") > F.lit(float(z_threshold)))
    out = enrich(hits, d) if facility_type is None else hits
    return (out.orderBy(F.col("z_score").desc(), F.col("reading_id"), F.col("recorded_at"))
            .limit(int(limit))
            .select("reading_id", "sensor_id", "recorded_at", as_double("value").alias("value"),
                    F.col("is_anomaly").alias("pre_labelled"), "z_score",
                    "facility_name", "facility_type", "sensor_type", "unit"))


# ---------------------------------------------------------------- two series

def daily_mean(df: DataFrame, name: str, ts: str = "recorded_at", value: str = "value") -> DataFrame:
    return df.groupBy(bucket("day", ts).alias("day")).agg(F.avg(as_double(value)).alias(name))


def synthetic_power(readings: DataFrame, sensors: DataFrame, facilities: DataFrame,
                    facility_type: str, sensor_type: str) -> DataFrame:
    """Readings of one sensor type at facilities of one type (all rows)."""
    d = dims(sensors, facilities,
             sensor_filter=F.col("sensor_type") == F.lit(sensor_type),
             facility_filter=F.col("facility_type") == F.lit(facility_type),
             columns=[])
    return readings.join(sized_broadcast(d), "sensor_id", "left_semi")


def series_comparison(series: DataFrame, readings: DataFrame, sensors: DataFrame,
                      facilities: DataFrame, metric: str = "wind_production",
                      facility_type: str = "wind", sensor_type: str = "power_output",
                      method: str = "window") -> DataFrame:
    """Daily external series vs. own power, z-standardised, with Pearson r.

    Columns: day_label, real_avg, synthetic_avg, real_z, synthetic_z,
    correlation_coefficient (all 4 dp); ordered by day.

    The whole-set mean/stddev/corr are windows over the joined daily set,
    which has one row per calendar day (bounded by the date span).
    """
    real = daily_mean(series.filter(F.col("metric") == F.lit(metric)), "real_avg")
    syn = daily_mean(synthetic_power(readings, sensors, facilities, facility_type, sensor_type),
                     "synthetic_avg")
    daily = real.join(syn, "day")
    if method == "scalar":
        return _series_comparison_scalar(daily)
    whole = Window.partitionBy()  # one row per day: bounded input
    rz = safe_div(F.col("real_avg") - F.avg("real_avg").over(whole),
                  F.stddev_samp("real_avg").over(whole))
    sz = safe_div(F.col("synthetic_avg") - F.avg("synthetic_avg").over(whole),
                  F.stddev_samp("synthetic_avg").over(whole))
    z = daily.select("day", "real_avg", "synthetic_avg", rz.alias("real_z"), sz.alias("synthetic_z"))
    r = corr_expr(F.col("synthetic_z"), F.col("real_z"), whole)
    return (z.select("day", day_label("day").alias("day_label"),
                     round_half("real_avg", 4).alias("real_avg"),
                     round_half("synthetic_avg", 4).alias("synthetic_avg"),
                     round_half("real_z", 4).alias("real_z"),
                     round_half("synthetic_z", 4).alias("synthetic_z"),
                     round_half(r, 4).alias("correlation_coefficient"))
            .orderBy("day").drop("day"))


def _series_comparison_scalar(daily: DataFrame) -> DataFrame:
    """The same output without a single-partition window: the daily pairs
    are staged, their five whole-set statistics are one aggregate row read
    back as literals, and the z columns are a plain projection.  Pearson r
    of the z columns equals r of the raw columns when both deviations are
    non-zero (z is an increasing affine map); otherwise the z columns are
    NULL and so is r."""
    daily = stage(daily, "daily-pairs")
    st = daily.agg(F.avg("real_avg").alias("mr"), F.stddev_samp("real_avg").alias("sr"),
                   F.avg("synthetic_avg").alias("ms"), F.stddev_samp("synthetic_avg").alias("ss"),
                   corr_expr(F.col("synthetic_avg"), F.col("real_avg")).alias("r")).first()

    def lit(v):
        return F.lit(v).cast("double")
    rz = safe_div(F.col("real_avg") - lit(st["mr"]), lit(st["sr"]))
    sz = safe_div(F.col("synthetic_avg") - lit(st["ms"]), lit(st["ss"]))
    ok = all(st[k] not in (None, 0.0) for k in ("sr", "ss"))
    r = lit(st["r"] if ok else None)
    return (daily.select("day", day_label("day").alias("day_label"),
                         round_half("real_avg", 4).alias("real_avg"),
                         round_half("synthetic_avg", 4).alias("synthetic_avg"),
                         round_half(rz, 4).alias("real_z"),
                         round_half(sz, 4).alias("synthetic_z"),
                         round_half(r, 4).alias("correlation_coefficient"))
            .orderBy("day").drop("day"))


def corr_expr(x: Column, y: Column, over=None) -> Column:
    """Pearson r that is NULL (not an error) for zero variance.

    Only pairs where both sides are non-NULL take part, as in SQL CORR.
    """
    both = x.isNotNull() & y.isNotNull()
    xx = F.when(both, x)
    yy = F.when(both, y)
    cov, sx, sy = F.covar_samp(xx, yy), F.stddev_samp(xx), F.stddev_samp(yy)
    if over is not None:
        cov, sx, sy = cov.over(over), sx.over(over), sy.over(over)
    return F.try_divide(cov, F.nullif(sx * sy, F.lit(0.0)))


def normalized_monthly(series: DataFrame, readings: DataFrame, sensors: DataFrame,
                       facilities: DataFrame, metric: str = "wind_production",
                       facility_type: str = "wind", sensor_type: str = "power_output",
                       method: str = "window") -> DataFrame:
    """Monthly mean of each series as a % of its own largest monthly mean.

    Columns: month, real_normalized_pct, synthetic_normalized_pct (1 dp).
    The max over months is a window over a per-month aggregate (bounded);
    ``method="scalar"`` stages the monthly means and reads each maximum back
    as one aggregate value instead.
    """
    real = (series.filter(F.col("metric") == F.lit(metric))
            .groupBy(bucket("month", "recorded_at").alias("month"))
            .agg(F.avg(as_double("value")).alias("real_avg")))
    syn = (synthetic_power(readings, sensors, facilities, facility_type, sensor_type)
           .groupBy(bucket("month", "recorded_at").alias("month"))
           .agg(F.avg(as_double("value")).alias("synthetic_avg")))
    if method == "scalar":
        real, syn = stage(real, "monthly-real"), stage(syn, "monthly-synthetic")
        mr = real.agg(F.max("real_avg")).first()[0]
        ms = syn.agg(F.max("synthetic_avg")).first()[0]
        real = real.withColumn("max_real_avg", F.lit(mr).cast("double"))
        syn = syn.withColumn("max_synthetic_avg", F.lit(ms).cast("double"))
    else:
        whole = Window.partitionBy()
        real = real.withColumn("max_real_avg", F.max("real_avg").over(whole))
        syn = syn.withColumn("max_synthetic_avg", F.max("synthetic_avg").over(whole))
    j = real.join(syn, "month")
    return (j.select("month",
                     round_half(safe_div(F.col("real_avg"), F.col("max_real_avg")) * F.lit(100.0), 1)
                     .alias("real_normalized_pct"),
                     round_half(safe_div(F.col("synthetic_avg"), F.col("max_synthetic_avg")) * F.lit(100.0), 1)
                     .alias("synthetic_normalized_pct"))
            .orderBy("month"))


# ---------------------------------------------------------------- Pearson test

def pearson_test(pairs: DataFrame, x: str = "real_avg", y: str = "synthetic_avg",
                 alpha: float = 0.05) -> DataFrame:
    """n, df = n - 2, Pearson r, two-sided p, verdict at ``alpha``.

    One distributed aggregate gives n and r; the p-value of the resulting
    row comes from the t distribution (t = r * sqrt(df / (1 - r^2))), as a
    JVM-side expression (:func:`voltaic.functions.stats.pearson_p_value`).
    """
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    agg = pairs.agg(F.count(F.when(both, F.lit(1))).alias("n"),
                    corr_expr(as_double(x), as_double(y)).alias("r"))
    agg = with_pearson_p_value(agg, "r", "n", "p_value")
    return (agg.select(F.col("n").cast("bigint").alias("n"),
                       (F.col("n") - F.lit(2)).cast("bigint").alias("df"),
                       "r", "p_value")
            .withColumn("verdict",
                        F.when(F.col("p_value") < F.lit(alpha), F.lit("Statistically Significant"))
                        .otherwise(F.lit("Not Statistically Significant"))))
