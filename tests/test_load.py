"""Idempotent load semantics with real writes to a scratch folder."""

import datetime as dt

from pyspark.sql import functions as F

from voltaic.operators import load

D = dt.datetime
RS = "reading_id long, sensor_id long, recorded_at timestamp_ntz, value double, is_anomaly boolean, n long"
GS = ("dataset_id int, country string, recorded_at timestamp_ntz, value double, metric string, "
      "source string")


def test_watermark_strictly_newer(spark):
    t = spark.createDataFrame([(1, 1, D(2024, 1, 1, 10), 1.0, False, 0)], RS).drop("n")
    b = spark.createDataFrame([(i, 1, D(2024, 1, 1, 10) + dt.timedelta(hours=h), 1.0, False, i)
                               for i, h in [(2, -1), (3, 0), (4, 1)]], RS)
    wm = load.high_watermark(t)
    kept = load.watermark_filter(b, wm).collect()
    assert [r.reading_id for r in kept] == [4]


def test_watermark_empty_target_no_filter(spark):
    b = spark.createDataFrame([(1, 1, D(2024, 1, 1), 1.0, False, 1)], RS)
    assert load.high_watermark(None) is None
    assert load.watermark_filter(b, None).count() == 1
    empty = b.limit(0)
    assert load.high_watermark(empty) is None


def test_insert_if_absent_first_wins(spark):
    t = spark.createDataFrame([(9, 1, D(2024, 1, 2), 0.0, False, 0)], RS).drop("n")
    b = spark.createDataFrame([(1, 1, D(2024, 1, 1), 1.0, False, 1),   # a
                               (1, 1, D(2024, 1, 1), 2.0, False, 2),   # b, same key later
                               (9, 1, D(2024, 1, 2), 5.0, False, 3)],  # exists in target
                              RS)
    ins = load.insert_if_absent(b, t, ["reading_id", "recorded_at"], "n").collect()
    assert [(r.reading_id, r.value) for r in ins] == [(1, 1.0)]


def test_upsert_duplicate_in_batch_and_existing_key(spark):
    t = spark.createDataFrame([(75, "X", D(2024, 1, 1), 1.0, "m0", "old")], GS)
    b = spark.createDataFrame([
        (75, "Y", D(2024, 1, 1), 2.0, "m1", "new", 1),     # existing key
        (75, "X", D(2024, 1, 2), 3.0, "m1", "new", 2),     # new key, first
        (75, "Y", D(2024, 1, 2), 4.0, "m2", "mock", 3)],   # same new key, last
        GS + ", o long")
    out = {r.recorded_at.day: r for r in
           load.upsert(b, t, ["dataset_id", "recorded_at"], ["value", "metric", "source"], "o").collect()}
    assert (out[1].country, out[1].value, out[1].metric, out[1].source) == ("X", 2.0, "m1", "new")
    assert (out[2].country, out[2].value, out[2].metric, out[2].source) == ("X", 4.0, "m2", "mock")


def test_idempotency_triple(spark, tmp_dir):
    """load; reload (watermark); reload without watermark -> >0, 0, 0 rows added."""
    target = f"{tmp_dir}/readings"
    base = spark.createDataFrame([(i, 1 + i % 3, D(2023, 12, 31) + dt.timedelta(minutes=10 * i),
                                   float(i), i % 50 == 0, i) for i in range(200)], RS)
    first = load.load(spark, base.filter("reading_id < 100"), target, ["reading_id", "recorded_at"], "n")
    assert first["inserted"] == 100
    inc = base.filter("reading_id >= 100")
    c1 = load.load(spark, inc, target, ["reading_id", "recorded_at"], "n")
    n1 = spark.read.parquet(target).count()
    c2 = load.load(spark, inc, target, ["reading_id", "recorded_at"], "n")
    n2 = spark.read.parquet(target).count()
    c3 = load.load(spark, inc, target, ["reading_id", "recorded_at"], "n", use_watermark=False)
    n3 = spark.read.parquet(target).count()
    assert c1["inserted"] == 100 and n1 == 200
    assert c2["inserted"] == 0 and c2["late"] == 100 and n2 == 200
    assert c3["inserted"] == 0 and c3["conflict"] == 100 and n3 == 200
    months = {r.month for r in spark.read.parquet(target).select("month").distinct().collect()}
    assert months == {"2023-12", "2024-01"}


def test_upsert_table_and_range_delete(spark, tmp_dir):
    path = f"{tmp_dir}/grid"
    b1 = spark.createDataFrame([(1, "FI", D(2023, 1, 1, h), float(h), "wind", "fingrid", h)
                                for h in range(24)], GS + ", o long")
    load.upsert_table(spark, b1, path, ["dataset_id", "recorded_at"], ["value", "metric", "source"], "o")
    b2 = spark.createDataFrame([(1, "SE", D(2023, 1, 1, 23), 99.0, "wind", "mock", 1),
                                (1, "SE", D(2023, 2, 1, 0), 7.0, "wind", "mock", 2)], GS + ", o long")
    load.upsert_table(spark, b2, path, ["dataset_id", "recorded_at"], ["value", "metric", "source"], "o")
    t = spark.read.parquet(path)
    assert t.count() == 25
    r = t.filter(F.col("recorded_at") == D(2023, 1, 1, 23)).first()
    assert (r.country, r.value, r.source) == ("FI", 99.0, "mock")
    deleted = load.range_delete(spark, path, "recorded_at", D(2023, 1, 1, 12), D(2023, 2, 1))
    assert deleted == 12
    t = spark.read.parquet(path)
    assert t.count() == 13
    assert t.filter(F.col("month") == "2023-02").count() == 1


def test_per_sensor_watermark_resumes_unfinished_sensors(spark, tmp_dir):
    """A sensor-major file loaded half-way: sensor 1 complete, sensor 2 not
    started.  The global watermark skips sensor 2 on the rerun; the
    per-sensor watermark loads it."""
    target = f"{tmp_dir}/readings"
    rows = [(s * 100 + i, s, D(2024, 1, 1) + dt.timedelta(minutes=5 * i), 1.0, False, s * 100 + i)
            for s in (1, 2) for i in range(10)]
    full = spark.createDataFrame(rows, RS)
    keys = ["reading_id", "recorded_at"]
    other = f"{tmp_dir}/readings-global"
    for path in (target, other):
        load.load(spark, full.filter("sensor_id = 1"), path, keys, "n")
    skipped = load.load(spark, full, other, keys, "n")             # table-wide watermark
    assert skipped["inserted"] == 0 and skipped["late"] == 20
    again = load.load(spark, full, target, keys, "n", watermark_by="sensor_id")
    assert again["inserted"] == 10 and again["late"] == 10
    assert spark.read.parquet(target).count() == 20


def test_load_loses_nothing_and_counts_add_up(spark, tmp_dir):
    """NULL keys and times are refused with and without a watermark; a replay adds no row."""
    keys, path = ["reading_id", "recorded_at"], f"{tmp_dir}/readings"
    rows = [(1, 1, D(2024, 1, 1), 1.0, False, 1), (1, 1, D(2024, 1, 1), 2.0, False, 2), (None, 1, D(2024, 1, 2), 1.0, False, 3),
            (3, 1, None, 1.0, False, 4), (4, 1, D(2023, 5, 1), None, None, 5)]
    b = spark.createDataFrame(rows, RS)
    for k, wm in enumerate([True, False, True, False]):
        c = load.load(spark, b, path, keys, "n", use_watermark=wm, rejects_path=f"{tmp_dir}/rejects")
        assert c["read"] == 5 == sum(c[s] for s in ("rejected", "late", "duplicate", "conflict", "inserted"))
        assert c["rejected"] == 2 and c["inserted"] == (2 if k == 0 else 0)
        assert spark.read.parquet(path).count() == 2
        assert spark.read.parquet(f"{tmp_dir}/rejects").count() == 2 * (k + 1)


def test_load_is_idempotent_in_any_driver_zone(tmp_dir):
    """Month bounds come from Spark in UTC: a driver elsewhere must not miss stored keys."""
    import os
    import subprocess
    import sys
    code = f"""
import datetime as dt, sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from pyspark.sql import functions as F
from voltaic.session import build_session
from voltaic.operators import load
spark = build_session("local[2]", shuffle_partitions=2, extra={{"spark.checkpoint.dir": {tmp_dir!r} + "/ck"}})
b = spark.range(60).select(F.col("id").alias("reading_id"), F.lit(1).alias("sensor_id"),
    (F.lit("2024-02-01 00:00:00").cast("timestamp") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("recorded_at"),
    F.lit(1.0).alias("value"), F.col("id").alias("n"))
for wm in (False, False, True):
    load.load(spark, b, {tmp_dir!r} + "/t", ["reading_id", "recorded_at"], "n", use_watermark=wm)
gone = load.range_delete(spark, {tmp_dir!r} + "/t", "recorded_at", dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 1, 0, 10))
print("ROWS", spark.read.parquet({tmp_dir!r} + "/t").count(), gone)
"""
    out = subprocess.run([sys.executable, "-c", code], env=os.environ | {"TZ": "America/Los_Angeles"}, capture_output=True, text=True, timeout=300)
    assert "ROWS 50 10" in out.stdout, out.stderr[-2000:]


def test_scratch_is_deleted(spark, tmp_dir):
    import os

    from voltaic.operators.stage import Scratch
    with Scratch(spark) as s:
        df = s.put(spark.range(5), "x")
        path = s.paths[0]
        assert df.count() == 5 and os.path.exists(path)
    assert not os.path.exists(path)


def test_long_gap_series_is_linear(spark):
    """40,000 rows in one series and month: seconds, not minutes."""
    import time

    from voltaic.operators import timeseries
    s = spark.range(40_000).select(F.lit(1).alias("dataset_id"), F.lit("m").alias("metric"), F.lit("FI").alias("country"),
                                   (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("recorded_at"),
                                   F.when(F.col("id") % 7 != 3, F.col("id").cast("double")).alias("value"))
    t = time.time()
    out = timeseries.fill_gaps(s, unit="minute").agg(F.sum("value")).first()[0]
    assert out == sum(range(40_000)) and time.time() - t < 30
