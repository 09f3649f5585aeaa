"""Hand-made frames for the edge cases of the analytical pipelines."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaic.functions.interp import interpolate_linear
from voltaic.operators import quality, ranking, reports, scoring, timeseries

D = dt.datetime

R_SCHEMA = T.StructType([
    T.StructField("reading_id", T.LongType()), T.StructField("sensor_id", T.LongType()),
    T.StructField("recorded_at", T.TimestampNTZType()), T.StructField("value", T.DoubleType()),
    T.StructField("is_anomaly", T.BooleanType())])
S_SCHEMA = "sensor_id long, facility_id long, sensor_type string, unit string"
F_SCHEMA = ("facility_id long, facility_name string, facility_type string, country string, "
            "capacity_mw double")


def readings(spark, rows):
    return spark.createDataFrame(rows, R_SCHEMA)


@pytest.fixture()
def dims(spark):
    s = spark.createDataFrame([(1, 1, "power_output", "MW"), (2, 2, "power_output", "MW"),
                               (3, 3, "power_output", "MW")], S_SCHEMA)
    f = spark.createDataFrame([(1, "A", "wind", "FI", 10.0), (2, "B", "solar", "SE", 10.0),
                               (3, "C", "wind", "NO", 0.0)], F_SCHEMA)
    return s, f


def test_interpolation_limit_both_ways(spark):
    vals = [None] * 5 + [1.0] + [None] * 8 + [10.0] + [None] * 5
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(vals)], "k int, i int, v double")
    out = interpolate_linear(df, "v", ["k"], "i", 3, "f").orderBy("i").collect()
    got = [None if r.f is None else round(r.f, 9) for r in out]
    assert got == [None, None, 1, 1, 1, 1, 2, 3, 4, None, None, 7, 8, 9, 10, 10, 10, 10, None, None]


def test_resample_two_groups(spark):
    df = spark.createDataFrame(
        [(1, "g1", "FI", D(2023, 1, 1, 0, 15), 1.0), (1, "g1", "FI", D(2023, 1, 1, 3, 0), 2.0),
         (1, "g2", "FI", D(2023, 1, 1, 5, 0), 3.0), (1, "g2", "FI", D(2023, 1, 1, 6, 30), 4.0)],
        "dataset_id int, metric string, country string, recorded_at timestamp_ntz, value double")
    out = timeseries.resample(df).orderBy("metric", "recorded_at").collect()
    assert [(r.metric, r.recorded_at.hour, r.value) for r in out] == [
        ("g1", 0, 1.0), ("g1", 1, None), ("g1", 2, None), ("g1", 3, 2.0),
        ("g2", 5, 3.0), ("g2", 6, 4.0)]


def test_gap_fill_zero_and_clamp(spark):
    rows = [(1, "m", "FI", D(2023, 1, 1, h), v) for h, v in [(0, -1.0), (9, 5.0)]]
    df = spark.createDataFrame(rows, "dataset_id int, metric string, country string, "
                                     "recorded_at timestamp_ntz, value double")
    out = timeseries.normalize_hourly(df).orderBy("recorded_at").collect()
    vals = [r.value for r in out]
    # hours 1..3 interpolate (clamped below 0 where negative), 4,5 stay gaps -> 0
    assert len(vals) == 10 and vals[0] == 0.0 and vals[9] == 5.0
    assert vals[4] == 0.0 and vals[5] == 0.0
    assert all(v >= 0 for v in vals)
    assert out[0].source == "fingrid"
    c = timeseries.gap_counts(timeseries.resample(df)).first()
    assert (c.nan_before, c.nan_after) == (8, 2)


def test_zscore_single_clean_row_gives_zero(spark, dims):
    s, f = dims
    r = readings(spark, [(1, 1, D(2023, 1, 1), 5.0, False), (2, 1, D(2023, 1, 2), 500.0, True)])
    z = scoring.score_readings(r).select("reading_id", "z_score").orderBy("reading_id").collect()
    assert [x.z_score for x in z] == [0.0, 0.0]


def test_zscore_zero_variance(spark):
    r = readings(spark, [(i, 1, D(2023, 1, i), 5.0, False) for i in (1, 2, 3)]
                 + [(4, 1, D(2023, 1, 4), 9.0, True)])
    assert {x.z_score for x in scoring.score_readings(r).collect()} == {0.0}


def test_zscore_only_flagged_rows_vanish(spark):
    r = readings(spark, [(1, 1, D(2023, 1, 1), 5.0, True), (2, 1, D(2023, 1, 2), 7.0, True)])
    assert scoring.score_readings(r).count() == 0


def test_rolling_counts_rows_not_hours(spark, dims):
    s, f = dims
    hours = list(range(0, 10)) + list(range(20, 40))
    r = readings(spark, [(h, 1, D(2023, 1, 1) + dt.timedelta(hours=h), float(h), False)
                         for h in hours])
    out = timeseries.rolling_24h(r, s, f).collect()
    last = [x for x in out if x.hour == D(2023, 1, 1) + dt.timedelta(hours=39)][0]
    frame = list(range(6, 10)) + list(range(20, 40))
    assert last.rolling_24h_avg_mw == round(sum(frame) / 24, 4)


def test_lag_over_missing_month_and_severity(spark, dims):
    s, f = dims
    r = readings(spark, [(1, 1, D(2023, 1, 5), 10.0, False), (2, 1, D(2023, 3, 5), 25.0, False)])
    out = reports.monthly_report(r, s, f).orderBy("month").collect()
    assert [x.month for x in out] == ["2023-01", "2023-03"]
    assert out[0].mom_energy_change_mwh is None
    assert out[1].mom_energy_change_mwh == 15.0
    rates = spark.createDataFrame([(3.0,), (3.01,), (1.5,), (1.51,), (0.0,)], "r double")
    got = [x.s for x in rates.select(reports.severity(F.col("r")).alias("s")).collect()]
    assert got == ["MEDIUM", "HIGH", "LOW", "MEDIUM", "LOW"]


def test_ranking_ties_on_rounded_value_and_zero_capacity(spark):
    s = spark.createDataFrame([(i, i, "power_output", "MW") for i in (1, 2, 3, 4)], S_SCHEMA)
    f = spark.createDataFrame([(1, "A", "wind", "FI", 100.0), (2, "B", "wind", "FI", 100.0),
                               (3, "C", "solar", "FI", 100.0), (4, "Z", "solar", "FI", 0.0)],
                              F_SCHEMA)
    r = readings(spark, [(1, 1, D(2023, 1, 1), 50.001, False), (2, 2, D(2023, 1, 1), 50.004, False),
                         (3, 3, D(2023, 1, 1), 49.0, False), (4, 4, D(2023, 1, 1), 1.0, False)])
    out = {x.facility_name: x for x in ranking.facility_ranking(r, s, f).collect()}
    assert out["Z"].avg_efficiency_pct is None and out["Z"].overall_rank == 1
    assert out["A"].overall_rank == out["B"].overall_rank == 2
    assert out["C"].overall_rank == 4
    assert out["Z"].percentile == 100.0


def test_correlation_of_constant_series_is_null(spark):
    df = spark.createDataFrame([(1.0, float(i)) for i in range(5)], "x double, y double")
    assert df.select(scoring.corr_expr(F.col("x"), F.col("y")).alias("r")).first().r is None


def test_top3_month_bounds_and_absent_sensor(spark, dims):
    s, f = dims
    r = readings(spark, [
        (1, 1, D(2023, 11, 30, 23, 59, 59, 999000), 100.0, False),
        (2, 1, D(2023, 12, 1), 1.0, False),
        (3, 1, D(2024, 1, 1), 100.0, False),
        (4, 2, D(2023, 12, 5), 7.0, True)])
    out = ranking.top_readings_per_sensor(r, s, f, "2023-12-01", "2024-01-01", 3).collect()
    assert [(x.sensor_id, x.value) for x in out] == [(1, 1.0)]


def test_top3_keeps_three_highest(spark, dims):
    s, f = dims
    r = readings(spark, [(i, 1, D(2023, 12, i), float(i), False) for i in range(1, 8)])
    out = ranking.top_readings_per_sensor(r, s, f, "2023-12-01", "2024-01-01", 3).collect()
    assert [x.value for x in out] == [7.0, 6.0, 5.0]


def test_domain_check_null_passes(spark):
    df = spark.createDataFrame([("wind",), ("hydro",), (None,)], "facility_type string")
    out = quality.domain_violations(df, "facility_type", ("wind", "solar", "substation")).collect()
    assert [(x.value, x.n_rows) for x in out] == [("hydro", 1)]


def test_column_rules_use_try_cast(spark):
    from voltaic.schemas import RULES
    df = spark.createDataFrame([(1, 1, D(2023, 1, 1), 123456789.0, False),
                                (None, 1, D(2023, 1, 1), 1.0, None)], R_SCHEMA)
    out = {(x.rule, x.column): x.violations
           for x in quality.column_rule_violations(df, RULES["readings"]).collect()}
    assert out[("decimal", "value")] == 1
    assert out[("not_null", "reading_id")] == 1


def test_pearson_p_value_known_values(spark):
    import math
    from voltaic.functions.stats import pearson_p_value
    from ._tdist import t_two_sided_p
    # t = 2.0 with 10 degrees of freedom: two-sided p = 0.07338803
    assert t_two_sided_p(2.0, 10.0) == pytest.approx(0.0733880, abs=1e-6)
    # t = 1.0, df = 1 (Cauchy): p = 0.5
    assert t_two_sided_p(1.0, 1.0) == pytest.approx(0.5, abs=1e-12)
    cases = [(0.0135, 1688), (0.5, 10), (-0.3, 50), (0.99, 5), (0.2, 3), (0.0, 100)]
    df = spark.createDataFrame(cases, "r double, n long")
    got = [x.p for x in df.select(pearson_p_value(F.col("r"), F.col("n")).alias("p")).collect()]
    for (r, n), p in zip(cases, got):
        dof = n - 2
        want = t_two_sided_p(r * math.sqrt(dof / (1 - r * r)), dof)
        assert p == pytest.approx(want, rel=1e-9, abs=1e-12)
    edge = spark.createDataFrame([(None, 10), (1.0, 20), (0.5, 2)], "r double, n long")
    assert [x.p for x in edge.select(pearson_p_value(F.col("r"), F.col("n")).alias("p"))
            .collect()] == [None, 0.0, None]
    from voltaic.functions.stats import with_pearson_p_value
    staged = [x.p for x in with_pearson_p_value(df.unionByName(edge), "r", "n", "p").collect()]
    assert staged[-3:] == [None, 0.0, None]
    assert staged[:len(got)] == pytest.approx(got, rel=1e-12)


def test_pearson_test_frame(spark):
    pairs = spark.createDataFrame([(float(i), float(i) * 2 + (i % 3)) for i in range(20)],
                                  "real_avg double, synthetic_avg double")
    r = scoring.pearson_test(pairs).first()
    assert r.n == 20 and r.df == 18
    assert r.r > 0.99 and r.p_value < 1e-10 and r.verdict == "Statistically Significant"


def test_anomaly_parameter_bounds(spark, dims):
    s, f = dims
    r = readings(spark, [(1, 1, D(2023, 1, 1), 1.0, False)])
    with pytest.raises(ValueError):
        scoring.anomalies(r, s, f, z_threshold=0.5)
    with pytest.raises(ValueError):
        scoring.anomalies(r, s, f, limit=1001)


def test_recommended_conf_scales_with_input():
    from voltaic.session import recommended_conf
    c = recommended_conf(100 * 1024 ** 4, 8000)
    n = int(c["spark.sql.shuffle.partitions"])
    assert n % 8000 == 0 and n * 256 * 1024 ** 2 >= 100 * 1024 ** 4
    assert int(recommended_conf(10, 8)["spark.sql.shuffle.partitions"]) == 8


def test_check_suite_error_counts_as_failed(spark, dims):
    s, f = dims
    r = readings(spark, [(1, 1, D(2023, 1, 1), 1.0, False), (2, 2, D(2023, 1, 2), None, False)])
    checks = quality.default_checks(r, s, f, days_expected=2)
    broken = quality.Check("broken", lambda: spark.sql("SELECT * FROM no_such_table_x"),
                           lambda d: d, F.lit(False), F.lit("x"))
    ok, rows = quality.run_checks(checks + [broken])
    by = {x["check"]: x for x in rows}
    assert not ok
    assert by["orphan_sensors"]["passed"] is False and by["orphan_sensors"]["detail"] == "1"
    assert by["null_values"]["passed"] is False and by["null_values"]["detail"] == "1"
    assert by["anomaly_rate"]["passed"] is True
    assert by["coverage"]["passed"] is True
    assert by["broken"]["passed"] is False and by["broken"]["detail"].startswith("error")
    summary = {x.check: x.passed for x in quality.check_summary(spark, checks + [broken]).collect()}
    assert summary == {"orphan_sensors": False, "null_values": False, "anomaly_rate": True,
                       "coverage": True, "broken": False}


def test_volume_tolerance_bands(spark):
    assert quality.volume_tolerance(99_999) == 0.10 and quality.volume_tolerance(100_000) == 0.05
    df = spark.range(95)
    r = quality.volume_check(df, 100).first()
    assert r.actual_rows == 95 and r.within_tolerance
    assert not quality.volume_check(spark.range(80), 100).first().within_tolerance


def _window_ranks(df):
    from pyspark.sql import Window
    e = F.col("v")
    desc, asc = e.desc_nulls_first(), e.asc_nulls_last()
    return df.select("id", F.rank().over(Window.orderBy(desc)).alias("_rank"),
                     F.rank().over(Window.partitionBy("g").orderBy(desc)).alias("_rank_in_group"),
                     F.ntile(4).over(Window.orderBy(desc, F.col("id"))).alias("_tile"),
                     F.percent_rank().over(Window.orderBy(asc)).alias("_pct_rank"))


@pytest.mark.parametrize("n,parts", [(1, 3), (7, 4), (500, 6)])
def test_distributed_ranks_equal_window_ranks(spark, n, parts):
    """Heavy ties, NULL values and NULL groups."""
    import random

    from voltaic.operators.rank import distributed_ranks
    r = random.Random(n)
    rows = [(k, r.choice([None, 1.0, 1.0, 1.0, 2.5, float(r.randint(0, 40))]), r.choice([None, "a", "b"])) for k in range(n)]
    df = spark.createDataFrame(rows, "id long, v double, g string").repartition(3)
    got = distributed_ranks(df, "v", "id", "g", 4, parts)
    cols = ["id", "_rank", "_rank_in_group", "_tile", "_pct_rank"]
    assert sorted(tuple(x[c] for c in cols) for x in got.collect()) == sorted(tuple(x[c] for c in cols) for x in _window_ranks(df).collect())


def test_monthly_energy_weighting(spark, dims):
    s, f = dims
    r = readings(spark, [(i, 1, D(2023, 1, 1) + dt.timedelta(minutes=5 * i), 12.0, False)
                         for i in range(12)])
    plain = reports.monthly_report(r, s, f).first()
    weighted = reports.monthly_report(r, s, f, sample_hours=5 / 60).first()
    assert plain.total_energy_mwh == 144.0 and weighted.total_energy_mwh == 12.0


def test_series_comparison_scalar_form_equals_window_form(spark):
    from voltaic import adapters as A
    from .conftest import SF_ORACLE
    d = A.shipments_domain(spark, SF_ORACLE)
    s = A.orders_series(spark, SF_ORACLE)
    args = (s, d.readings, d.sensors, d.facilities, "1-URGENT", "EUROPE", "power_output")
    a = scoring.series_comparison(*args).collect()
    b = scoring.series_comparison(*args, method="scalar").collect()
    assert a == b and len(a) > 100


def test_normalized_monthly_scalar_form_equals_window_form(spark):
    from voltaic import adapters as A
    from .conftest import SF_ORACLE
    d = A.shipments_domain(spark, SF_ORACLE)
    s = A.orders_series(spark, SF_ORACLE)
    args = (s, d.readings, d.sensors, d.facilities, "1-URGENT", "EUROPE", "power_output")
    a = scoring.normalized_monthly(*args).collect()
    b = scoring.normalized_monthly(*args, method="scalar").collect()
    assert a == b and len(a) > 50
