"""The check suite: one scan, checks that raise, re-executed tasks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltaic.operators import quality, suite

READ = "reading_id long, sensor_id long, recorded_at timestamp_ntz, value double, is_anomaly boolean"


@pytest.fixture(scope="module")
def tables(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(k, k % 3, t + dt.timedelta(hours=k), None if k == 7 else float(k), k % 25 == 0) for k in range(100)]
    sensors = spark.createDataFrame([(k, k % 2, "power_output") for k in range(5)] + [(9, 77, "x")], "sensor_id long, facility_id long, sensor_type string")
    facilities = spark.createDataFrame([(0, "a", "wind"), (1, "b", "solar")], "facility_id long, facility_name string, facility_type string")
    return spark.createDataFrame(rows, READ).repartition(4), sensors, facilities


def raises(label, column):
    return suite.RowCheck(label, {"x": column}, lambda v: False, lambda v: v["x"])


BAD = [lambda: F.count_if(F.lit(1) / (F.col("sensor_id") - 2) > 0), lambda: F.max(F.concat(F.lit("w"), F.col("sensor_id")).cast("int")),
       lambda: F.sum(F.element_at(F.array(F.lit(1)), F.col("sensor_id").cast("int") + 1))]


def test_agrees_with_the_checks_one_by_one(spark, tables):
    r, s, f = tables
    got = suite.run_suite(r, suite.post_load(s, f, 5))
    _, want = quality.run_checks(quality.default_checks(r, s, f, 5))
    assert got == want
    more = {x["check"]: (x["passed"], x["detail"]) for x in suite.run_suite(r, suite.post_load(s, f, 5, 100))}
    assert more["global_rate"] == (True, "4.0000") and more["volume"] == (True, "100")
    assert suite.run_suite(r, [suite.volume(200)])[0]["passed"] is False


@pytest.mark.parametrize("at", [[0], [3], [0, 2, 4], [1, 1, 1]])
def test_checks_that_raise_leave_the_others(spark, tables, at):
    r, s, f = tables
    checks = suite.post_load(s, f, 5, 100)
    want = suite.run_suite(r, checks)
    for n, (k, bad) in enumerate(zip(at, BAD)):
        checks.insert(k + n, raises(f"bad{n}", bad()))
    got = suite.run_suite(r, checks)
    assert [x for x in got if not x["check"].startswith("bad")] == want
    bad = {x["check"]: x["detail"] for x in got if x["check"].startswith("bad")}
    names = ["error: DIVIDE_BY_ZERO", "error: CAST_INVALID_INPUT", "error: INVALID_ARRAY_INDEX_IN_ELEMENT_AT"]
    assert bad == {f"bad{n}": names[n] for n in range(len(at))} and not any(x["passed"] for x in got if x["check"] in bad)


def test_errors_in_planning_and_in_predicates(spark, tables):
    r, s, f = tables
    checks = [suite.RowCheck("no_column", {"x": F.max("not_there")}, lambda v: False, lambda v: v["x"]),
              suite.SummaryCheck("no_table", lambda d: d.select("nothing"), lambda v: False, lambda v: 0),
              suite.RowCheck("bad_predicate", {}, lambda v: v["missing"], lambda v: 0), suite.null_values()]
    got = suite.run_suite(r, checks)
    assert [x["passed"] for x in got] == [False, False, False, False]
    assert got[3]["detail"] == "1" and all(x["detail"].startswith("error: ") for x in got[:3])


def test_no_scan_beside_the_summary(spark, tables):
    """With no check that raises, the readings are scanned by one job."""
    r, s, f = tables
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    suite.run_suite(r.mapInArrow(count, r.schema), suite.post_load(s, f, 5, 100))
    assert seen.value == 100


def test_metrics_counted_twice_are_taken_again(spark, tables, monkeypatch):
    r, s, f = tables
    want = suite.run_suite(r, suite.post_load(s, f, 5, 100))

    class Twice(suite.Observation):
        @property
        def get(self):
            return {k: 2 * v if isinstance(v, int) else v for k, v in super().get.items()}
    monkeypatch.setattr(suite, "Observation", Twice)
    assert suite.run_suite(r, suite.post_load(s, f, 5, 100)) == want


def test_empty_table(spark, tables):
    r, s, f = tables
    got = {x["check"]: (x["passed"], x["detail"]) for x in suite.run_suite(r.limit(0), suite.post_load(s, f, 5, 100))}
    assert got == {"orphan_sensors": (False, "5"), "null_values": (True, "0"), "anomaly_rate": (True, "0"), "coverage": (False, "0"),
                   "global_rate": (False, "None"), "volume": (False, "0")}
    assert suite.suite_frame(r, [suite.null_values()]).dtypes == [("check", "string"), ("passed", "boolean"), ("detail", "string")]
