"""Kept monthly statistics: any split into batches equals one pass; retries; compaction."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from voltaic.operators import monthly, quality, reports, scoring

READ = "reading_id long, sensor_id long, recorded_at timestamp_ntz, value double, is_anomaly boolean"


def rows(seed, n=400):
    rng = random.Random(seed)
    t = dt.datetime(2024, 1, 30)
    return [(k, rng.choice([1, 1, 1, 2, 3]), None if rng.random() < 0.02 else t + dt.timedelta(hours=rng.randrange(1500)),
             None if rng.random() < 0.05 else round(rng.gauss(1000, 5), 2), rng.choice([False, False, False, True, None])) for k in range(n)]


def brute(data):
    out = {}
    for _, s, t, v, bad in data:
        if t is not None:
            out.setdefault((s, f"{t:%Y-%m}"), []).append((t, v, bad))
    want = {}
    for key, xs in out.items():
        clean = [v for _, v, bad in xs if v is not None and bad is False]
        want[key] = (len(xs), sum(v is not None for _, v, _ in xs), sum(bad is True for *_, bad in xs), len(clean),
                     statistics.fmean(clean) if clean else None, statistics.stdev(clean) if len(clean) > 1 else None,
                     sorted({t.day for t, _, _ in xs}), min(t for t, _, _ in xs), max(t for t, _, _ in xs))
    return want


def stored(stats):
    sd = F.when(F.col("clean_n") > 1, F.sqrt(F.col("m2") / (F.col("clean_n") - 1)))
    got = {}
    for r in stats.withColumn("sd", sd).collect():
        got[r["sensor_id"], r["month"]] = (r["n"], r["valued"], r["flagged"], r["clean_n"], r["mean"], r["sd"],
                                           [d + 1 for d in range(31) if r["days"] >> d & 1], r["first"], r["last"])
    return got


def same(a, b):
    assert a.keys() == b.keys()
    for k in a:
        for x, y in zip(a[k], b[k], strict=True):
            assert x == y or x == pytest.approx(y, rel=1e-9), (k, x, y)


@pytest.mark.parametrize("cuts", [[400], [1, 399], [50, 50, 300], [100] * 4])
def test_any_split_equals_one_pass(spark, tmp_dir, cuts):
    data, at = rows(len(cuts)), 0
    for k, n in enumerate(cuts):
        part = spark.createDataFrame(data[at:at + n], READ).repartition(3)
        monthly.contribute(part, tmp_dir, f"b{k}")
        if k == 0:
            monthly.contribute(part, tmp_dir, "b0")  # a retry
        if k == 1:
            monthly.compact(spark, tmp_dir)
        at += n
    same(stored(monthly.state(spark, tmp_dir)), brute(data))
    monthly.compact(spark, tmp_dir)
    same(stored(monthly.state(spark, tmp_dir)), brute(data))
    only = monthly.state(spark, tmp_dir, ("2024-02", "2024-02"))
    assert {r["month"] for r in only.collect()} == {"2024-02"}
    assert "GreaterThanOrEqual(month" in only._jdf.queryExecution().executedPlan().toString()


def test_answers_equal_the_full_ones(spark, tmp_dir):
    data = [r for r in rows(9) if r[2] is not None]
    r = spark.createDataFrame(data, READ)
    s = spark.createDataFrame([(k, k % 2, "power_output", "MW") for k in range(1, 4)], "sensor_id long, facility_id long, sensor_type string, unit string")
    f = spark.createDataFrame([(0, "a", "wind", "FI", 10.0), (1, "b", "solar", "FI", 5.0)],
                              "facility_id long, facility_name string, facility_type string, country string, capacity_mw double")
    for k in range(3):
        monthly.contribute(r.where(F.col("reading_id") % 3 == k), tmp_dir, str(k))  # batches named like numbers
    stats = monthly.state(spark, tmp_dir)
    assert monthly.trend(stats).collect() == reports.anomaly_trend(r).collect()
    assert monthly.coverage(stats).collect() == quality.coverage(r).collect()
    assert reports.report_of(monthly.sensor_months(stats), s, f).collect() == reports.monthly_report(r, s, f).collect()
    assert scoring.zscore_anomalies(r, s, f, 2.0, 50, monthly.baseline(stats)).collect() == scoring.zscore_anomalies(r, s, f, 2.0, 50).collect()


def test_the_order_of_rows_changes_no_bit(spark, tmp_dir):
    data = rows(3)
    out = []
    for k, parts in enumerate((1, 1)):
        r = spark.createDataFrame(data, READ).coalesce(parts)
        for n, name in enumerate(("x", "y") if k == 0 else ("y", "x")):  # contributed in either order
            cut = F.col("reading_id") < 200
            monthly.contribute(r.where(cut if name == "x" else ~cut), f"{tmp_dir}/{k}", name)
        out.append(sorted(map(tuple, monthly.state(spark, f"{tmp_dir}/{k}").collect())))
    assert out[0] == out[1]


def test_empty_and_named(spark, tmp_dir):
    monthly.contribute(spark.createDataFrame([(1, 1, dt.datetime(2024, 1, 31), None, None)], READ), tmp_dir, "a")
    monthly.contribute(spark.createDataFrame([], READ), tmp_dir, "none")
    r = monthly.state(spark, tmp_dir).first()
    assert (r["n"], r["valued"], r["clean_n"], r["mean"], r["m2"], r["days"]) == (1, 0, 0, None, None, 1 << 30)
    assert monthly.baseline(monthly.state(spark, tmp_dir)).count() == 0
    with pytest.raises(ValueError):
        monthly.contribute(spark.createDataFrame([], READ), tmp_dir, "a/b")
