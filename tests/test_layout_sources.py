"""Layout (pruning, routing, verified rewrite), typed sources and sinks."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from voltaic import adapters as A
from voltaic.operators import layout
from voltaic.plans.runner import run_reports
from voltaic.schemas import FACILITIES, GRID_DATA, READINGS
from voltaic.sources import csv as csvsrc
from voltaic.sources import payload, sinks
from voltaic.sources.defaults import evolve_union, with_defaults

from .conftest import SF_SMALL

D = dt.datetime


def test_pruned_read_equals_unpruned_and_prunes(spark, tmp_dir):
    r = A.shipments_domain(spark, SF_SMALL).readings
    path = f"{tmp_dir}/layout"
    layout.write_layout(r, path)
    pruned = layout.range_read(spark, path, 5, "1998-06-01", "1998-06-30")
    plain = r.filter((F.col("sensor_id") == 5)
                     & F.col("recorded_at").between(F.lit("1998-06-01").cast("timestamp_ntz"),
                                                    F.lit("1998-06-30").cast("timestamp_ntz")))
    assert sorted(pruned.drop("month").collect()) == sorted(plain.collect())
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    assert "PushedFilters" in plan and "EqualTo(sensor_id,5)" in plan


def test_verified_rewrite_keeps_multiset(spark, tmp_dir):
    r = A.events_domain(spark, SF_SMALL).readings
    src = f"{tmp_dir}/src"
    r.write.parquet(src)
    res = layout.verified_rewrite(spark, src, f"{tmp_dir}/dst", pointer=f"{tmp_dir}/current")
    assert res["ok"] and res["old_rows"] == res["new_rows"] == r.count()
    assert spark.read.parquet(layout.current_copy(spark, f"{tmp_dir}/current")).count() == r.count()


def test_route_bounds(spark):
    df = spark.createDataFrame([(D(2023, 1, 1),), (D(2024, 2, 1),), (D(2023, 6, 1),)],
                               "recorded_at timestamp_ntz")
    acc, rej = layout.split_route(df, D(2023, 1, 1), D(2024, 2, 1))
    assert acc.count() == 2 and [r.recorded_at for r in rej.collect()] == [D(2024, 2, 1)]


def test_csv_typed_with_corrupt_rows(spark, tmp_dir):
    p = os.path.join(tmp_dir, "readings.csv")
    with open(p, "w") as fh:
        fh.write("reading_id,sensor_id,recorded_at,value,is_anomaly\n")
        fh.write("1,5,2023-06-01 00:00:00,12.5,False\n")
        fh.write("2,5,2023-06-01 00:05:00,,True\n")
        fh.write("x,5,not-a-time,1,False\n")
    df = csvsrc.read_csv_typed(spark, p, READINGS)
    good, bad = csvsrc.split_corrupt(df)
    rows = good.orderBy("reading_id").collect()
    assert [r.reading_id for r in rows] == [1, 2]
    assert rows[1].value is None and rows[1].is_anomaly is True
    assert float(rows[0].value) == 12.5
    assert rows[0].recorded_at == D(2023, 6, 1)
    assert len(bad.collect()) == 1  # whole rows: Spark refuses corrupt-column-only queries


def test_default_column_only_when_absent(spark):
    old = spark.createDataFrame([(1, "FI")], "dataset_id int, country string")
    new = spark.createDataFrame([(2, "FI", None), (3, "FI", "mock")],
                                "dataset_id int, country string, source string")
    u = {r.dataset_id: r.source for r in evolve_union(old, new, {"source": "fingrid"}).collect()}
    assert u == {1: "fingrid", 2: None, 3: "mock"}
    assert with_defaults(new, {"source": "x"}).filter("source IS NULL").count() == 1


def test_payload_rows_and_completeness_gate(spark, tmp_dir):
    p = os.path.join(tmp_dir, "payload.json")
    with open(p, "w") as fh:
        json.dump({"data": [{"startTime": "2023-01-01T00:00:00.000Z", "value": 1.5},
                            {"startTime": "2023-01-01T00:15:00.000Z", "value": "2.5"},
                            {"startTime": "2023-03-01T00:00:00.000Z", "value": "junk"}],
                   "other": 1}, fh)
    rows = payload.payload_rows(payload.read_payload(spark, p), 75, "wind_production")
    got = rows.orderBy("recorded_at").collect()
    assert [r.value for r in got] == [1.5, 2.5, None]
    assert got[0].recorded_at == D(2023, 1, 1)
    series = spark.createDataFrame([("wind_production",)], "metric string")
    missing = payload.missing_slices(rows.withColumn("recorded_at",
                                                     F.col("recorded_at").cast("timestamp_ntz")),
                                     series, "2023-01-01", "2023-04-01")
    assert [r.period.month for r in missing.collect()] == [2]
    with pytest.raises(payload.IncompletePayload):
        payload.assert_complete(missing)


def test_report_runner_continues_after_failure(spark, tmp_dir):
    reports = {
        "b_ok": lambda s: s.range(3),
        "a_bad": lambda s: s.sql("SELECT * FROM no_such_table"),
    }
    out = run_reports(spark, reports, tmp_dir, stamp="20240101_000000")
    assert [r["name"] for r in out] == ["a_bad", "b_ok"]
    assert out[0]["ok"] is False and out[1]["rows"] == 3
    assert out[1]["path"].endswith("b_ok_20240101_000000")


def test_json_envelope(spark):
    df = spark.createDataFrame([(2, D(2023, 1, 1, 12), 1.5), (1, D(2023, 1, 2), 3.0)],
                               "id long, ts timestamp_ntz, z double")
    env = sinks.json_envelope(df, {"z_threshold": 3.0, "facility_type": None}, "anomalies",
                              order_by=[-F.col("z")]).first().json
    doc = json.loads(env)
    assert doc["count"] == 2 and doc["z_threshold"] == 3.0
    assert [a["id"] for a in doc["anomalies"]] == [1, 2]
    assert doc["anomalies"][1]["ts"] == "2023-01-01T12:00:00"


def test_schemas_declared():
    assert [f.name for f in FACILITIES.fields][0] == "facility_id"
    assert GRID_DATA["value"].dataType.precision == 12


def test_iso8601_like_python_isoformat(spark):
    import datetime as _dt
    from voltaic.functions.timefn import iso8601
    vals = [_dt.datetime(2024, 1, 1, 0, 0, 7, 179575), _dt.datetime(2023, 6, 1, 12, 0, 0)]
    df = spark.createDataFrame([(v,) for v in vals], "t timestamp_ntz")
    got = [r.s for r in df.select(iso8601("t").alias("s")).collect()]
    assert got == [v.isoformat() for v in vals]
    tz = df.select(F.col("t").cast("timestamp").alias("t"))
    got = [r.s for r in tz.select(iso8601("t", with_offset=True).alias("s")).collect()]
    assert got == [v.replace(tzinfo=_dt.timezone.utc).isoformat() for v in vals]


def test_payload_documents_are_bounded(spark):
    rows = spark.sql("SELECT CASE WHEN id < 3000 THEN 1L WHEN id < 3005 THEN 2L END AS g, CASE WHEN id % 2 = 0 THEN 7L ELSE id END AS v FROM range(3010)")
    docs = [[r.v for r in d.data] for d in payload.payload_documents(rows, F.col("g"), F.struct("v"), size=100).collect()]
    assert max(map(len, docs)) < 200 and 30 <= len(docs) <= 32
    assert sorted(v for d in docs for v in d) == sorted(r.v for r in rows.collect())


def test_registered_payload_documents_are_bounded(spark, tmp_dir, monkeypatch):
    from voltaic.plans import catalog

    sizes = []
    monkeypatch.setattr(catalog, "read_payload", lambda s, path, **k: sizes.append(
        payload.read_payload(s, path, **k).agg(F.max(F.size("data"))).first()[0]) or payload.read_payload(s, path, **k))
    spark.sql("SELECT id AS event_id, 'error' AS event_type, CAST(id AS double) AS value,"
              " TIMESTAMP_NTZ '2024-01-01 05:00:00' AS ts FROM range(30000)").write.parquet(f"{tmp_dir}/hot/events.parquet")
    assert catalog.REGISTRY["payload_rows"](spark, f"{tmp_dir}/hot").agg(F.sum("value")).first()[0] == sum(range(30000))
    assert sizes[0] < 11_000
