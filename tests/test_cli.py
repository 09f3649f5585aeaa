"""End-to-end command line flow on hand-made CSV files."""

import datetime as dt
import os

from voltaic import cli


def _write_raw(raw, days=3, incremental_day=None):
    os.makedirs(raw, exist_ok=True)
    with open(f"{raw}/facilities.csv", "w") as fh:
        fh.write("facility_id,facility_name,facility_type,country,capacity_mw,commissioned_year\n")
        fh.write("1,WindFarm_North_01,wind,Finland,100.00,2010\n")
        fh.write("2,SolarPark_South_02,solar,Sweden,50.00,2015\n")
        fh.write("1,Duplicate_Name,wind,Finland,999.00,2011\n")
    with open(f"{raw}/sensors.csv", "w") as fh:
        fh.write("sensor_id,facility_id,sensor_type,unit\n")
        fh.write("1,1,power_output,MW\n2,1,wind_speed,m/s\n3,2,power_output,MW\n")
    t0 = dt.datetime(2023, 12, 29)
    with open(f"{raw}/readings.csv", "w") as fh:
        fh.write("reading_id,sensor_id,recorded_at,value,is_anomaly\n")
        i = 0
        for h in range(days * 24):
            for s in (1, 2, 3):
                i += 1
                ts = (t0 + dt.timedelta(hours=h)).strftime("%Y-%m-%d %H:%M:%S")
                fh.write(f"{i},{s},{ts},{(h % 24) + s}.5,{'True' if i % 40 == 0 else 'False'}\n")
    with open(f"{raw}/readings_incremental.csv", "w") as fh:
        fh.write("reading_id,sensor_id,recorded_at,value,is_anomaly\n")
        for j in range(24):
            ts = (dt.datetime(2024, 1, 1) + dt.timedelta(hours=j)).strftime("%Y-%m-%d %H:%M:%S")
            fh.write(f"{j + 1},1,{ts},{j}.25,False\n")


def test_cli_load_check_report_migrate(spark, tmp_dir):
    raw, tables, out = f"{tmp_dir}/raw", f"{tmp_dir}/tables", f"{tmp_dir}/out"
    _write_raw(raw)
    assert cli.main(["load", "--raw", raw, "--tables", tables, "--days-expected", "3"]) == 0
    n0 = spark.read.parquet(f"{tables}/readings").count()
    assert n0 == 3 * 24 * 3
    fac = spark.read.parquet(f"{tables}/facilities").orderBy("facility_id").collect()
    assert [f.facility_name for f in fac] == ["WindFarm_North_01", "SolarPark_South_02"]
    # incremental: first run adds 24 rows, second (watermark) and third
    # (no watermark, key conflicts) add none
    for args, added in ((["--incremental"], 24), (["--incremental"], 0),
                        (["--incremental", "--no-watermark"], 0)):
        before = spark.read.parquet(f"{tables}/readings").count()
        cli.main(["load", "--raw", raw, "--tables", tables, "--days-expected", "3", *args])
        assert spark.read.parquet(f"{tables}/readings").count() - before == added
    assert cli.main(["check", "--tables", tables, "--days-expected", "365"]) == 1
    # data tests: 4 days (incl. the incremental one), 240 rows; flagged share 1.9 %
    assert cli.main(["verify", "--tables", tables, "--days-expected", "4",
                     "--rows-expected", "240"]) == 0
    assert cli.main(["verify", "--tables", tables, "--days-expected", "5",
                     "--rows-expected", "240"]) == 1
    assert cli.main(["report", "--tables", tables, "--out", out]) == 0
    names = sorted(d.rsplit("_", 2)[0] for d in os.listdir(out))
    assert names == ["facility_ranking", "monthly_report", "rolling_24h", "top3_per_sensor",
                     "zscore_anomalies"]
    assert cli.main(["migrate", "--src", f"{tables}/readings", "--dst", f"{tmp_dir}/moved", "--pointer", f"{tmp_dir}/current"]) == 0
    from voltaic.operators.layout import current_copy, point_to
    assert current_copy(spark, f"{tmp_dir}/current") == f"{tmp_dir}/moved"
    point_to(spark, f"{tmp_dir}/current", "elsewhere")
    assert current_copy(spark, f"{tmp_dir}/current") == "elsewhere" and spark.read.parquet(f"{tables}/readings").count() > 0


def test_cli_load_refuses_and_keeps_bad_rows(spark, tmp_dir):
    """Every bad line is stored with its reason, counted, and fails the exit status; a replay
    adds nothing."""
    raw, tables = f"{tmp_dir}/raw", f"{tmp_dir}/tables"
    _write_raw(raw)
    with open(f"{raw}/facilities.csv", "a") as fh:
        fh.write("7,Odd,banana,Finland,1.00,2010\n8,Big,wind,Finland,12345678.00,2010\n9,Cut,wind\n")
    with open(f"{raw}/sensors.csv", "a") as fh:
        fh.write("50,99,power_output,MW\n")
    with open(f"{raw}/readings.csv", "a") as fh:
        fh.write("9001,777,2023-12-29 00:00:00,1.0,False\n9002,1,not a time,1.0,False\n9003,1,,1.0,False\n"
                 "9004,1,2023-12-29 00:00:00,abc,False\nx,1,2023-12-29 00:00:00,1.0,False\n9006,1,1999-01-01 00:00:00,1.0,False\n")
    args = ["load", "--raw", raw, "--tables", tables, "--days-expected", "3", "--time-from", "2023-01-01", "--time-to", "2025-01-01"]
    assert cli.main(args) == 1
    why = lambda t: sorted(r["_reject"] for r in spark.read.parquet(f"{tables}/rejects/{t}").collect())
    assert why("facilities") == ["bad capacity_mw", "malformed line", "not in domain facility_type"]
    assert why("sensors") == ["no such facility_id"]
    assert why("readings") == ["bad reading_id", "bad recorded_at", "bad value", "missing recorded_at", "no such sensor_id", "outside the range recorded_at"]
    n = spark.read.parquet(f"{tables}/readings").count()
    assert n == 3 * 24 * 3
    assert cli.main([*args, "--no-watermark"]) == 1
    assert spark.read.parquet(f"{tables}/readings").count() == n


def test_cli_grid_payloads(spark, tmp_dir):
    import json
    pay, tables = f"{tmp_dir}/payloads", f"{tmp_dir}/tables"
    for ds, metric in ((124, "consumption"), (75, "wind_production")):
        d = f"{pay}/{ds}_{metric}"
        os.makedirs(d)
        t0 = dt.datetime(2023, 1, 1)
        recs = [{"startTime": (t0 + dt.timedelta(minutes=15 * k)).strftime("%Y-%m-%dT%H:%M:%S.000Z"),
                 "value": (k % 7) - 1.0} for k in range(4 * 24 * 31) if not (40 <= k < 60)]
        with open(f"{d}/jan.json", "w") as fh:
            json.dump({"data": recs}, fh)
    assert cli.main(["grid", "--payloads", pay, "--tables", tables, "--datasets", "124_consumption,75_wind_production",
                     "--start", "2023-01-01", "--stop", "2023-02-01"]) == 0
    g = spark.read.parquet(f"{tables}/grid_data")
    assert g.count() == 2 * 24 * 31
    assert g.filter("value < 0").count() == 0
    assert {r.source for r in g.select("source").distinct().collect()} == {"fingrid"}
    # a month without data fails the completeness gate
    import pytest
    from voltaic.sources.payload import IncompletePayload
    with pytest.raises(IncompletePayload):
        cli.main(["grid", "--payloads", pay, "--tables", tables, "--datasets", "124_consumption,75_wind_production",
                  "--start", "2023-01-01", "--stop", "2023-03-01"])
    # so does a declared dataset without any payload
    with pytest.raises(IncompletePayload, match="99"):
        cli.main(["grid", "--payloads", pay, "--tables", tables, "--datasets", "124_consumption,99_solar",
                  "--start", "2023-01-01", "--stop", "2023-02-01"])
