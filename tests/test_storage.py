"""Report sink, catalog defaults, bucketed tables, rejects of retried loads, open time bounds."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from voltaic.operators import layout, load, ranking
from voltaic.operators.rules import REJECT, with_rejects
from voltaic.plans.runner import run_reports
from voltaic.sources.defaults import add_column, create_table
from voltaic.sources.sinks import commit_report

READ = "reading_id long, sensor_id long, recorded_at timestamp, value double"
T = dt.datetime(2024, 1, 1)


def readings(spark, n, first=0):
    return spark.createDataFrame([(k, k % 3, T + dt.timedelta(hours=k), float(k)) for k in range(first, first + n)], READ)


def test_a_report_is_whole_or_absent(spark, tmp_dir):
    path, n = commit_report(readings(spark, 10).repartition(3), tmp_dir, "r", "1")
    assert n == 10 and spark.read.csv(path, header=True).count() == 10 and path == f"{tmp_dir}/r_1"
    half = readings(spark, 100).repartition(8).select(F.lit(1) / (F.col("reading_id") - 50))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        commit_report(half, tmp_dir, "half", "1")
    with pytest.raises(FileExistsError):
        commit_report(readings(spark, 1), tmp_dir, "r", "1")
    assert [x for x in os.listdir(tmp_dir) if not x.startswith(".")] == ["r_1"]
    assert spark.read.csv(path, header=True).count() == 10
    assert commit_report(readings(spark, 0), tmp_dir, "none", "1")[1] == 0


def test_reports_run_in_order_and_go_on(spark, tmp_dir):
    done = run_reports(spark, {"b": lambda s: s.range(3).select(F.lit(1) / F.col("id")), "c": lambda s: s.range(2), "a": lambda s: s.table("no_such")}, tmp_dir, "x")
    assert [(r["name"], r["ok"], r["rows"]) for r in done] == [("a", False, None), ("b", False, None), ("c", True, 2)]
    assert sorted(x for x in os.listdir(tmp_dir) if not x.startswith(".")) == ["c_x"]


def test_catalog_defaults(spark, tmp_dir):
    create_table(spark.createDataFrame([(1, None)], "k int, v string"), "grid_t", f"{tmp_dir}/t")
    add_column(spark, "grid_t", "source", "string", "'fingrid'")
    add_column(spark, "grid_t", "SOURCE", "string", "'other'")
    add_column(spark, "grid_t", "n", "long", "7")
    spark.sql("INSERT INTO grid_t VALUES (2, 'a', NULL, 8)")
    spark.sql("INSERT INTO grid_t (k) VALUES (3)")
    assert sorted(map(tuple, spark.table("grid_t").collect())) == [(1, None, "fingrid", 7), (2, "a", None, 8), (3, None, "fingrid", 7)]
    assert spark.table("grid_t").where("source = 'fingrid' AND n = 7").count() == 2  # also when pushed down
    spark.sql("DROP TABLE grid_t")


def test_bucketed_tables_need_no_shuffle_of_readings(spark, tmp_dir):
    sensors = spark.createDataFrame([(k, 0, "p", "u") for k in range(3)], "sensor_id long, facility_id long, sensor_type string, unit string")
    facilities = spark.createDataFrame([(0, "f", "w")], "facility_id long, facility_name string, facility_type string")
    r = readings(spark, 300).withColumn("is_anomaly", F.lit(False))
    layout.write_bucketed(r, "readings_b", f"{tmp_dir}/b", 4, sort_by=["recorded_at"])
    top = ranking.top_readings_per_sensor(spark.table("readings_b"), sensors, facilities, "2024-01-01", "2024-02-01", 2)
    assert sorted(x["value"] for x in top.collect()) == [294.0, 295.0, 296.0, 297.0, 298.0, 299.0]
    window = spark.table("readings_b").groupBy("sensor_id").agg(F.max("value")).join(spark.table("readings_b"), "sensor_id", "left_anti")
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning\(sensor_id", plan), plan
    spark.sql("DROP TABLE readings_b")


def test_rejects_of_a_retried_load_are_kept_once(spark, tmp_dir, monkeypatch):
    batch = readings(spark, 6).withColumn("_ord", F.col("reading_id"))
    bad = batch.where("reading_id < 2").withColumn("sensor_id", F.lit(None).cast("long")).withColumn("recorded_at", F.lit(None).cast("timestamp"))
    given = batch.unionByName(bad)
    how = dict(keys=["reading_id", "recorded_at"], order="_ord", use_watermark=False, rejects_path=f"{tmp_dir}/rejects", batch_id="b1")
    layout_of = load.prepare_layout
    monkeypatch.setattr(load, "prepare_layout", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):  # fails between rejects and inserts
        load.load(spark, given, f"{tmp_dir}/t", **how)
    monkeypatch.setattr(load, "prepare_layout", layout_of)
    for want in (6, 0):
        got = load.load(spark, given, f"{tmp_dir}/t", **how)
        assert (got["rejected"], got["inserted"]) == (2, want)
    assert spark.read.parquet(f"{tmp_dir}/rejects").count() == 2
    load.load(spark, bad.limit(1), f"{tmp_dir}/t", **how | {"batch_id": None})
    assert spark.read.parquet(f"{tmp_dir}/rejects").count() == 3


@pytest.mark.parametrize("bounds,refused", [(("2024-01-01 02:00:00", None), 2), ((None, "2024-01-01 04:00:00"), 2), (("2024-01-01 01:00:00", "2024-01-01 05:00:00"), 2), ((None, None), 0)])
def test_one_end_of_the_range_may_be_open(spark, bounds, refused):
    r = with_rejects(readings(spark, 6), ts="recorded_at", bounds=bounds)
    assert r.where(F.col(REJECT) == "outside the range recorded_at").count() == refused


@pytest.mark.parametrize("parts", [1, 4])
def test_upsert_ends_of_a_hot_key(spark, parts):
    old = spark.createDataFrame([(1, 0, "FI", 1.0), (2, 0, "FI", 2.0)], "k int, t int, country string, value double")
    rows = [(1, 0, f"c{k}", float(k), k) for k in range(50)] + [(3, 0, "first", None, 1), (3, 0, None, 9.0, 2)]
    new = spark.createDataFrame(rows, "k int, t int, country string, value double, o int").repartition(parts)
    assert sorted(map(tuple, load.upsert(new, old, ["k", "t"], ["value"], "o").collect())) == [(1, 0, "FI", 49.0), (2, 0, "FI", 2.0), (3, 0, "first", 9.0)]


def test_ranks_in_one_part_and_many(spark):
    from voltaic.operators.rank import distributed_ranks
    df = spark.createDataFrame([(k, None if k % 11 == 0 else float(k % 7), "ab"[k % 2]) for k in range(100)], "id long, v double, g string")
    one, many = (sorted(map(tuple, distributed_ranks(df, "v", "id", "g", 4, p).collect())) for p in (None, 5))
    assert one == many
