"""Command line: load, check, report, migrate, grid.

    python -m voltaic.cli load    --raw DIR --tables DIR [--incremental] [--no-watermark]
    python -m voltaic.cli check   --tables DIR [--days-expected N]
    python -m voltaic.cli verify  --tables DIR [--days-expected N] [--rows-expected N]
    python -m voltaic.cli report  --tables DIR --out DIR
    python -m voltaic.cli migrate --src DIR --dst DIR
    python -m voltaic.cli grid    --payloads DIR --tables DIR --datasets ID_METRIC,... [--start ... --stop ...]

Tables live under ``--tables``: facilities/, sensors/, readings/ (month
layout) and grid_data/ (month layout), all Parquet; rows that a load refuses
go to rejects/<table>/ with their reason.  Exit status is 1 when the quality
gate fails or a load refused any row.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import layout, load, quality, ranking, reports, scoring, timeseries
from .operators.stage import Scratch
from .plans.runner import run_reports
from .schemas import FACILITIES, READINGS, RULES, SENSORS
from .session import build_session, ensure_defaults
from .sources.csv import read_csv_checked
from .sources.defaults import with_defaults
from .sources.payload import assert_complete, declared_series, missing_slices, payload_rows, read_payload

KEYS = {"facilities": ["facility_id"], "sensors": ["sensor_id"],
        "readings": ["reading_id", "recorded_at"], "grid_data": ["dataset_id", "recorded_at"]}


def _tables(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    out = {}
    for name in ("facilities", "sensors", "readings", "grid_data"):
        path = f"{base.rstrip('/')}/{name}"
        if load.path_exists(spark, path):
            out[name] = spark.read.parquet(path)
    return out


def _references(spark: SparkSession, base: str, table: str) -> dict[str, DataFrame]:
    """Frames of the tables that a table's foreign keys point to."""
    out = {}
    for col, (other, key) in RULES[table].references.items():
        path = f"{base}/{other}"
        out[col] = (spark.read.parquet(path).select(key) if load.path_exists(spark, path)
                    else spark.createDataFrame([], f"{key} int"))
    return out


def _load_table(spark: SparkSession, batch: DataFrame, base: str, table: str, **how) -> dict:
    """Load a checked CSV scan: declared defaults and rules apply, rejects are stored."""
    filled = with_defaults(batch, RULES[table].defaults) if RULES[table].defaults else batch
    counts = load.load(spark, filled, f"{base}/{table}", KEYS[table], "_ord", rules=RULES[table],
                       references=_references(spark, base, table), rejects_path=f"{base}/rejects/{table}", **how)
    print(json.dumps({"table": table} | counts))
    return counts


def cmd_load(spark: SparkSession, a) -> int:
    base = a.tables.rstrip("/")
    refused = 0
    if not a.incremental:
        for name, schema in (("facilities", FACILITIES), ("sensors", SENSORS)):
            refused += _load_table(spark, read_csv_checked(spark, f"{a.raw}/{name}.csv", schema), base, name,
                                   ts=None, use_watermark=False, partition_by=None)["rejected"]
    fname = "readings_incremental.csv" if a.incremental else "readings.csv"
    bounds = (a.time_from, a.time_to) if a.time_from or a.time_to else None  # one end may be open
    refused += _load_table(spark, read_csv_checked(spark, f"{a.raw}/{fname}", READINGS), base, "readings",
                           use_watermark=not a.no_watermark, bounds=bounds,
                           watermark_by="sensor_id" if a.per_sensor_watermark else None)["rejected"]
    status = cmd_check(spark, a)
    if refused:
        print(f"{refused} rows refused, see {base}/rejects")
    return max(status, int(refused > 0))


def cmd_check(spark: SparkSession, a) -> int:
    t = _tables(spark, a.tables)
    checks = quality.default_checks(t["readings"], t["sensors"], t["facilities"],
                                    getattr(a, "days_expected", 365))
    ok, rows = quality.run_checks(checks)
    for r in rows:
        print(f"{'PASS' if r['passed'] else 'FAIL'}  {r['check']}: {r['detail']}")
    return 0 if ok else 1


def cmd_verify(spark: SparkSession, a) -> int:
    """The data tests: no orphan sensors, no NULL values, global flagged rate
    within [1, 4] %, at least ``days_expected`` days, row count within
    tolerance of ``rows_expected`` (all overridable by environment:
    DAYS_EXPECTED, ROWS_EXPECTED, ROWS_TOLERANCE)."""
    import os
    t = _tables(spark, a.tables)
    r, s, f = t["readings"], t["sensors"], t["facilities"]
    days = int(os.environ.get("DAYS_EXPECTED", a.days_expected))
    rows = int(os.environ.get("ROWS_EXPECTED", a.rows_expected))
    tol = os.environ.get("ROWS_TOLERANCE")
    checks = [
        quality.Check("no_orphan_sensors", lambda: quality.orphan_sensors(r, s, f),
                      lambda d: d.agg(F.count(F.lit(1)).alias("n")), F.col("n") > 0, F.col("n")),
        quality.Check("no_null_values", lambda: quality.null_values(r), lambda d: d,
                      F.col("null_value_count") > 0, F.col("null_value_count")),
        quality.Check("anomaly_rate_band", lambda: quality.global_anomaly_rate(r), lambda d: d,
                      ~F.col("within_band"), F.round("anomaly_rate_pct", 3)),
        quality.Check("days_covered", lambda: quality.coverage(r), lambda d: d,
                      F.col("days_with_data") < F.lit(days), F.col("days_with_data")),
        quality.Check("row_volume",
                      lambda: quality.volume_check(r, rows, float(tol) if tol else None),
                      lambda d: d, ~F.col("within_tolerance"), F.col("actual_rows")),
    ]
    ok, res = quality.run_checks(checks)
    for x in res:
        print(f"{'PASS' if x['passed'] else 'FAIL'}  {x['check']}: {x['detail']}")
    return 0 if ok else 1


def analysis_reports(t: dict[str, DataFrame]):
    r, s, f = t["readings"], t["sensors"], t["facilities"]
    reps = {
        "rolling_24h": lambda _s: timeseries.rolling_24h(r, s, f),
        "zscore_anomalies": lambda _s: scoring.zscore_anomalies(r, s, f),
        "facility_ranking": lambda _s: ranking.facility_ranking(r, s, f),
        "monthly_report": lambda _s: reports.monthly_report(r, s, f),
        "top3_per_sensor": lambda _s: ranking.top_readings_per_sensor(r, s, f),
    }
    if "grid_data" in t:
        reps["series_comparison"] = lambda _s: scoring.series_comparison(t["grid_data"], r, s, f)
    return reps


def cmd_report(spark: SparkSession, a) -> int:
    t = _tables(spark, a.tables)
    results = run_reports(spark, analysis_reports(t), a.out)
    for res in results:
        print(f"{res['name']}: {res['rows']} rows -> {res['path']}" if res["ok"]
              else f"{res['name']}: FAILED {res['error']}")
        if res["ok"] and res["name"] == "series_comparison":
            pairs = spark.read.option("header", "true").csv(res["path"]).select(
                F.col("real_avg").cast("double"), F.col("synthetic_avg").cast("double"))
            print(json.dumps(scoring.pearson_test(pairs).first().asDict()))
    return 0 if all(r["ok"] for r in results) else 1


def cmd_migrate(spark: SparkSession, a) -> int:
    res = layout.verified_rewrite(spark, a.src, a.dst, pointer=a.pointer)
    print(json.dumps(res))
    return 0 if res["ok"] else 1


def cmd_grid(spark: SparkSession, a) -> int:
    """Payload files of the declared datasets (``<payloads>/<dataset_id>_<metric>/*.json``)
    -> completeness gate per (dataset, month) -> hourly clean series -> upsert into grid_data."""
    declared = [d.split("_", 1) for d in a.datasets.split(",")]
    rows = None
    for ds, metric in declared:
        path = f"{a.payloads.rstrip('/')}/{ds}_{metric}"
        if load.path_exists(spark, path):  # a folder that is missing shows up in the gate
            own = payload_rows(read_payload(spark, path), int(ds), metric)
            rows = own if rows is None else rows.unionByName(own)
    if rows is None:
        raise FileNotFoundError(f"no payloads of {a.datasets} under {a.payloads}")
    rows = rows.withColumn("recorded_at", F.col("recorded_at").cast("timestamp_ntz"))
    with Scratch(spark) as scratch:
        rows = scratch.put(rows, "payload-rows")
        expected = declared_series(spark, [int(ds) for ds, _ in declared], "dataset_id")
        assert_complete(missing_slices(rows, expected, a.start, a.stop, key="dataset_id"), key="dataset_id")
        # the grid has one row per key, so any order is the input order
        hourly = timeseries.normalize_hourly(rows).withColumn("_ord", F.col("recorded_at"))
        n = load.upsert_table(spark, hourly, f"{a.tables.rstrip('/')}/grid_data", KEYS["grid_data"],
                              ["value", "metric", "source"], "_ord")
    print(f"grid_data: {n} keys upserted")
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="voltaic")
    sub = p.add_subparsers(dest="cmd", required=True)
    lp = sub.add_parser("load")
    lp.add_argument("--raw", required=True)
    lp.add_argument("--tables", required=True)
    lp.add_argument("--incremental", action="store_true")
    lp.add_argument("--no-watermark", action="store_true")
    lp.add_argument("--per-sensor-watermark", action="store_true")
    lp.add_argument("--days-expected", type=int, default=365)
    lp.add_argument("--time-from", help="refuse readings before this time")
    lp.add_argument("--time-to", help="refuse readings from this time on")
    cp = sub.add_parser("check")
    cp.add_argument("--tables", required=True)
    cp.add_argument("--days-expected", type=int, default=365)
    vp = sub.add_parser("verify")
    vp.add_argument("--tables", required=True)
    vp.add_argument("--days-expected", type=int, default=365)
    vp.add_argument("--rows-expected", type=int, default=60 * 365 * 288)
    rp = sub.add_parser("report")
    rp.add_argument("--tables", required=True)
    rp.add_argument("--out", required=True)
    mp = sub.add_parser("migrate")
    mp.add_argument("--src", required=True)
    mp.add_argument("--dst", required=True)
    mp.add_argument("--pointer", help="file that names the table's current copy")
    gp = sub.add_parser("grid")
    gp.add_argument("--payloads", required=True)
    gp.add_argument("--tables", required=True)
    gp.add_argument("--datasets", required=True, help="expected datasets, as 124_consumption,75_wind_production")
    gp.add_argument("--start", default="2023-01-01")
    gp.add_argument("--stop", default="2024-01-01")
    a = p.parse_args(argv)
    spark = SparkSession.getActiveSession() or build_session()
    ensure_defaults(spark)
    fn = {"load": cmd_load, "check": cmd_check, "verify": cmd_verify, "report": cmd_report,
          "migrate": cmd_migrate, "grid": cmd_grid}[a.cmd]
    return fn(spark, a)


if __name__ == "__main__":
    sys.exit(main())
