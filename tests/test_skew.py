"""A key holding a large share of the rows: results stay whole and exact,
and the heavy operators reduce the hot key before the shuffle."""

import datetime as dt

from pyspark.sql import functions as F

from voltaic.operators import load, ranking, scoring

D = dt.datetime
RS = ("reading_id long, sensor_id long, recorded_at timestamp_ntz, value double, "
      "is_anomaly boolean")


def _skewed(spark, n=30000):
    # sensor 1 holds a third of all rows; the rest spread over 200 sensors
    rows = spark.range(n).select(
        F.col("id").alias("reading_id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 200 + 2)
        .cast("long").alias("sensor_id"),
        (F.lit(D(2023, 12, 1)).cast("timestamp_ntz")
         + F.make_interval(mins=F.col("id").cast("int"))).alias("recorded_at"),
        ((F.col("id") * 7919) % 1000 / F.lit(10.0)).alias("value"),
        (F.col("id") % 50 == 0).alias("is_anomaly"))
    return rows


def _dims(spark):
    s = spark.range(1, 202).select(F.col("id").alias("sensor_id"), F.col("id").alias("facility_id"),
                                    F.lit("power_output").alias("sensor_type"), F.lit("MW").alias("unit"))
    f = spark.range(1, 202).select(F.col("id").alias("facility_id"),
                                    F.concat(F.lit("F"), F.col("id")).alias("facility_name"),
                                    F.lit("wind").alias("facility_type"), F.lit("FI").alias("country"),
                                    F.lit(100.0).alias("capacity_mw"))
    return s, f


def test_top3_with_hot_sensor_matches_brute_force(spark):
    r = _skewed(spark)
    s, f = _dims(spark)
    got = ranking.top_readings_per_sensor(r, s, f, "2023-12-01", "2024-01-01", 3)
    pdf = r.toPandas()
    pdf = pdf[(~pdf.is_anomaly) & (pdf.recorded_at < D(2024, 1, 1))]
    want = (pdf.sort_values(["sensor_id", "value", "recorded_at"], ascending=[True, False, False])
            .groupby("sensor_id").head(3))
    assert got.count() == len(want)
    hot = [x.value for x in got.filter("sensor_id = 1").collect()]
    assert hot == list(want[want.sensor_id == 1].value)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_zscore_with_hot_sensor_matches_pandas(spark):
    r = _skewed(spark)
    z = scoring.score_readings(r).select("reading_id", "z_score").toPandas()
    pdf = r.toPandas()
    pdf["month"] = pdf.recorded_at.dt.to_period("M")
    base = pdf[~pdf.is_anomaly].groupby(["sensor_id", "month"])["value"].agg(["mean", "std"])
    m = pdf.join(base, on=["sensor_id", "month"], how="inner")
    m["z"] = ((m.value - m["mean"]).abs() / m["std"]).where(m["std"] > 0, 0.0)
    merged = z.merge(m[["reading_id", "z"]], on="reading_id")
    assert len(merged) == len(z) == len(m)
    assert (merged.z_score - merged.z).abs().max() < 1e-9


def test_first_wins_with_hot_duplicate_key(spark):
    # one key repeated 10,000 times, plus 1,000 distinct keys
    hot = spark.range(10000).select(F.lit(7).cast("long").alias("reading_id"),
                                    F.lit(D(2024, 1, 1)).cast("timestamp_ntz").alias("recorded_at"),
                                    F.col("id").cast("double").alias("value"),
                                    (F.col("id") + 5).alias("o"))
    rest = spark.range(1000).select((F.col("id") + 100).alias("reading_id"),
                                    F.lit(D(2024, 1, 1)).cast("timestamp_ntz").alias("recorded_at"),
                                    F.lit(1.0).alias("value"), F.col("id").alias("o"))
    batch = hot.unionByName(rest)
    first = load.first_per_key(batch, ["reading_id", "recorded_at"], "o")
    assert first.count() == 1001
    assert first.filter("reading_id = 7").first().value == 0.0
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2      # cut down map-side, before the shuffle, and after
