"""The registered queries: one callable (spark, sf_dir) -> DataFrame per key.

Each wires an adapter (driver tables -> domain frames) to a library
pipeline with the reference's parameters.  Parameters that name domain
values the driver tables do not have (sensor type, facility type, metric)
are mapped to the adapter's equivalents here, in one place.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import adapters as A
from ..functions.numeric import round_half
from ..operators import layout, load, lookup, monthly, quality, ranking, reports, scoring, suite, timeseries
from ..schemas import RULES
from ..sources.csv import read_csv_typed, split_corrupt
from ..sources.defaults import add_column, create_table, evolve_union
from ..sources.payload import declared_series, json_field, missing_slices, payload_documents, payload_rows, read_payload
from ..sources.sinks import json_envelope
from ..session import ensure_defaults, scratch_path
from ..streaming import stateful
from .runner import run_reports

Query = Callable[[SparkSession, str], DataFrame]

# Adapter equivalents of the reference's domain values.
EVENTS_POWER_SENSOR = "BUILDING"      # sensor_type = 'power_output'
EVENTS_WIND_TYPE = "EUROPE"           # facility_type = 'wind'
SHIP_POWER_SENSOR = "power_output"
SHIP_WIND_TYPE = "EUROPE"
SERIES_METRIC = "1-URGENT"            # metric = 'wind_production'

REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_defaults(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return run
    return deco


@register("zscore_anomalies")
def q_zscore(spark, sf):
    """P2 on the events adapter: z > 3 against the sensor-month baseline, top 200."""
    d = A.events_domain(spark, sf)
    return scoring.zscore_anomalies(d.readings, d.sensors, d.facilities, 3.0, 200)


@register("anomalies_by_type")
def q_anomalies_by_type(spark, sf):
    """A1: parameterised anomalies (z > 3, limit 100) for one facility type."""
    d = A.events_domain(spark, sf)
    out = scoring.anomalies(d.readings, d.sensors, d.facilities, 3.0, 100, EVENTS_WIND_TYPE)
    # unrounded in the library; the comparison needs a fixed precision
    return out.withColumn("z_score", round_half("z_score", 8))


@register("anomalies_by_type_sql")
def q_anomalies_by_type_sql(spark, sf):
    """A1/F11 through the SQL API: temp views + spark.sql with bound parameters."""
    from .sql import anomalies_sql, register_views
    d = A.events_domain(spark, sf)
    register_views(spark, d.readings, d.sensors, d.facilities, prefix="voltaic_ev_")
    out = anomalies_sql(spark, 3.0, 100, EVENTS_WIND_TYPE, prefix="voltaic_ev_")
    return out.withColumn("z_score", round_half("z_score", 8))


@register("rolling_24h")
def q_rolling_24h(spark, sf):
    """P1 on the events adapter: hourly facility means, trailing 24-row mean."""
    d = A.events_domain(spark, sf)
    return timeseries.rolling_24h(d.readings, d.sensors, d.facilities, EVENTS_POWER_SENSOR)


@register("dash_rolling_type")
def q_dash_rolling_type(spark, sf):
    """D3 on the events adapter: hourly sums per facility type, trailing 24-row mean."""
    d = A.events_domain(spark, sf)
    out = timeseries.rolling_by_type(d.readings, d.sensors, d.facilities, EVENTS_POWER_SENSOR)
    return out.withColumn("rolling_24h_avg", round_half("rolling_24h_avg", 6))


@register("facility_ranking")
def q_facility_ranking(spark, sf):
    """P3 on the shipments adapter: two-level efficiency, RANK/NTILE/PERCENT_RANK."""
    d = A.shipments_domain(spark, sf)
    return ranking.facility_ranking(d.readings, d.sensors, d.facilities, SHIP_POWER_SENSOR)


@register("ranking_direct")
def q_ranking_direct(spark, sf):
    """A2 on the shipments adapter: one-level efficiency ranked unrounded."""
    d = A.shipments_domain(spark, sf)
    return ranking.ranking_direct(d.readings, d.sensors, d.facilities, SHIP_POWER_SENSOR)


@register("dash_top10")
def q_dash_top10(spark, sf):
    """D1 on the shipments adapter: top 10 by mean per-reading efficiency."""
    d = A.shipments_domain(spark, sf)
    return ranking.top_efficiency(d.readings, d.sensors, d.facilities, SHIP_POWER_SENSOR, 10)


@register("top3_per_sensor")
def q_top3(spark, sf):
    """P7 on the shipments adapter: top 3 clean readings per sensor in Dec 1998."""
    d = A.shipments_domain(spark, sf)
    return ranking.top_readings_per_sensor(d.readings, d.sensors, d.facilities,
                                           "1998-12-01", "1999-01-01", 3)


@register("monthly_report")
def q_monthly_report(spark, sf):
    """P4 on the shipments adapter: per country/type/month with LAG and severity."""
    d = A.shipments_domain(spark, sf)
    return reports.monthly_report(d.readings, d.sensors, d.facilities, SHIP_POWER_SENSOR)


@register("dash_anomaly_trend")
def q_dash_anomaly_trend(spark, sf):
    """D2 on the shipments adapter: monthly flagged share of all readings."""
    d = A.shipments_domain(spark, sf)
    return reports.anomaly_trend(d.readings)


@register("series_comparison")
def q_series_comparison(spark, sf):
    """P5: daily orders series vs. daily shipments of one facility type."""
    d = A.shipments_domain(spark, sf)
    s = A.orders_series(spark, sf)
    return scoring.series_comparison(s, d.readings, d.sensors, d.facilities,
                                     SERIES_METRIC, SHIP_WIND_TYPE, SHIP_POWER_SENSOR, method="scalar")


@register("pearson_test")
def q_pearson_test(spark, sf):
    """Significance of the Pearson r on P5's rounded daily means."""
    pairs = q_series_comparison(spark, sf)
    out = scoring.pearson_test(pairs, "real_avg", "synthetic_avg")
    return out.select("n", "df", round_half("r", 8).alias("r"),
                      round_half("p_value", 8).alias("p_value"), "verdict")


@register("dash_normalized")
def q_dash_normalized(spark, sf):
    """Monthly means of both series as % of their own maximum."""
    d = A.shipments_domain(spark, sf)
    s = A.orders_series(spark, sf)
    return scoring.normalized_monthly(s, d.readings, d.sensors, d.facilities,
                                      SERIES_METRIC, SHIP_WIND_TYPE, SHIP_POWER_SENSOR, method="scalar")


@register("resample_hourly")
def q_resample_hourly(spark, sf):
    """G1: hourly means per event-type series, empty hours kept as NULL."""
    s = A.events_series(spark, sf)
    out = timeseries.resample(s)
    return out.withColumn("value", round_half("value", 6))


@register("gap_interpolate")
def q_gap_interpolate(spark, sf):
    """Hourly series with gaps interpolated (limit 3), filled, clamped."""
    s = A.events_series(spark, sf)
    out = timeseries.normalize_hourly(s, limit=3, source="fingrid")
    return out.withColumn("value", round_half("value", 6))


# ---------------------------------------------------------------- quality

QUALITY_DAYS_EXPECTED = 30          # the events table spans 30 days
VOLUME_EXPECTED = 10_000            # design volume of events at sf0.01
FACILITY_TYPES = ("AFRICA", "AMERICA", "ASIA", "EUROPE")   # declared domain


@register("dq_orphan_sensors")
def q_dq_orphan(spark, sf):
    """Q1: customers (sensors) without events, with their nation (facility)."""
    d = A.events_domain(spark, sf)
    return quality.orphan_sensors(d.readings, d.sensors, d.facilities)


@register("dq_null_values")
def q_dq_null(spark, sf):
    """Q2: readings with a NULL value."""
    return quality.null_values(A.events_domain(spark, sf).readings)


@register("dq_anomaly_rate")
def q_dq_rate(spark, sf):
    """Q3: flagged share per facility (name, type)."""
    d = A.events_domain(spark, sf)
    return quality.anomaly_rate_by_facility(d.readings, d.sensors, d.facilities)


@register("dq_coverage")
def q_dq_coverage(spark, sf):
    """Q4: earliest, latest, distinct days."""
    return quality.coverage(A.events_domain(spark, sf).readings)


@register("dq_global_rate")
def q_dq_global(spark, sf):
    """Q5: global flagged share and whether it is within [1, 4] %."""
    out = quality.global_anomaly_rate(A.events_domain(spark, sf).readings, 1.0, 4.0)
    return out.withColumn("anomaly_rate_pct", round_half("anomaly_rate_pct", 8))


@register("dq_volume")
def q_dq_volume(spark, sf):
    """Q6: row count against the expected volume with the size-based tolerance."""
    out = quality.volume_check(A.events_domain(spark, sf).readings, VOLUME_EXPECTED)
    return out.withColumn("deviation", round_half("deviation", 8))


@register("dq_summary")
def q_dq_summary(spark, sf):
    """Q7: the four post-load checks as one row each (check, passed, detail)."""
    d = A.events_domain(spark, sf)
    checks = quality.default_checks(d.readings, d.sensors, d.facilities, QUALITY_DAYS_EXPECTED)
    return quality.check_summary(spark, checks)


@register("dq_suite")
def q_dq_suite(spark, sf):
    """Q7 (with Q1-Q6): the suite over one scan, with two checks that raise on some rows: they are
    failed rows and the others stand."""
    d = A.events_domain(spark, sf)
    checks = suite.post_load(d.sensors, d.facilities, QUALITY_DAYS_EXPECTED, VOLUME_EXPECTED)
    broken = suite.RowCheck("raises_on_a_row", {"n": F.count_if(F.lit(1) / (F.col("sensor_id") - 5) > 0)}, lambda v: False, lambda v: v["n"])
    cast = suite.RowCheck("raises_on_a_cast", {"n": F.max(F.when(F.col("is_anomaly"), F.lit("many")).otherwise(F.lit("1")).cast("int"))},
                          lambda v: False, lambda v: v["n"])
    return suite.suite_frame(d.readings, [*checks[:3], broken, *checks[3:], cast])


@register("rule_unique")
def q_rule_unique(spark, sf):
    """Repeated (l_orderkey, l_linenumber) pairs in lineitem."""
    return quality.unique_violations(A.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("rule_foreign_key")
def q_rule_fk(spark, sf):
    """Event user ids without a customer, and line suppliers without a supplier."""
    ev = quality.foreign_key_violations(A.table(spark, sf, "events"), "user_id",
                                        A.table(spark, sf, "customer"), "c_custkey")
    li = quality.foreign_key_violations(A.table(spark, sf, "lineitem"), "l_suppkey",
                                        A.table(spark, sf, "supplier"), "s_suppkey")
    return (ev.select(F.lit("events.user_id").alias("rule"), F.col("user_id").alias("key"), "n_rows")
            .unionByName(li.select(F.lit("lineitem.l_suppkey").alias("rule"),
                                   F.col("l_suppkey").alias("key"), "n_rows")))


@register("rule_domain")
def q_rule_domain(spark, sf):
    """Facility types outside the declared list."""
    d = A.shipments_domain(spark, sf)
    return quality.domain_violations(d.facilities, "facility_type", FACILITY_TYPES)


@register("rule_not_null")
def q_rule_not_null(spark, sf):
    """C4: NOT NULL / length / precision violations of readings and facilities."""
    d = A.shipments_domain(spark, sf)
    r = quality.column_rule_violations(d.readings, RULES["readings"])
    f = quality.column_rule_violations(d.facilities, RULES["facilities"])
    return (r.select(F.lit("readings").alias("table"), "*")
            .unionByName(f.select(F.lit("facilities").alias("table"), "*")))


# ---------------------------------------------------------------- sources

@register("scan_default_column")
def q_scan_default(spark, sf):
    """Series written before the source column existed get its default."""
    s = A.orders_series(spark, sf)
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    old = s.filter(F.col("recorded_at") < cut).drop("source")
    new = s.filter(F.col("recorded_at") >= cut)
    return evolve_union(old, new, {"source": "fingrid"})


@register("json_payload_normalize")
def q_json_payload(spark, sf):
    """JSON property payloads parsed with a declared schema."""
    ev = A.table(spark, sf, "events")
    p = json_field("props", "k DOUBLE")
    return ev.select(F.lit(1).alias("dataset_id"), F.lit("FI").alias("country"),
                     F.col("ts").alias("recorded_at"), p["k"].alias("value"),
                     F.col("event_type").alias("metric"), F.lit("fingrid").alias("source"))


@register("completeness_gate")
def q_completeness(spark, sf):
    """(event type, day) slices of January 2024 without rows."""
    s = A.events_series(spark, sf)
    return missing_slices(s, s.select("metric"), "2024-01-01", "2024-02-01",
                          step="1 day", unit="day", key="metric")


@register("scan_csv_typed")
def q_scan_csv(spark, sf):
    """Events written as CSV (in the shared folder), read back typed."""
    path = scratch_path(spark, "events-csv")
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    (A.table(spark, sf, "events").write.option("header", "true")
     .option("timestampNTZFormat", fmt).csv(path))
    schema = A.table(spark, sf, "events").schema
    df = read_csv_typed(spark, path, schema, keep_corrupt=True)
    good, _bad = split_corrupt(df)
    return good


# ---------------------------------------------------------------- loads

LOAD_TARGET_END = "2024-01-20"
LOAD_BATCH_START = "2024-01-15"
LOAD_REPLAY = ("2024-01-25", "2024-01-26")


def _load_inputs(spark, sf):
    """Target = readings before the 20th; batch = readings from the 15th on
    (5 days overlap), plus a later copy of the 25th with changed values, so
    the batch has in-batch duplicates, conflicts and new keys."""
    r = A.events_domain(spark, sf).readings
    target = r.filter(F.col("recorded_at") < F.lit(LOAD_TARGET_END).cast("timestamp_ntz"))
    part1 = (r.filter(F.col("recorded_at") >= F.lit(LOAD_BATCH_START).cast("timestamp_ntz"))
             .withColumn("_ord", F.struct(F.lit(1).alias("part"), F.col("reading_id").alias("n"))))
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in LOAD_REPLAY)
    part2 = (r.filter((F.col("recorded_at") >= lo) & (F.col("recorded_at") < hi))
             .withColumn("value", F.col("value") + F.lit(1000.0))
             .withColumn("_ord", F.struct(F.lit(2).alias("part"), F.col("reading_id").alias("n"))))
    return target, part1.unionByName(part2)


@register("load_watermark")
def q_load_watermark(spark, sf):
    """L1: batch rows strictly after the target's high-watermark."""
    target, batch = _load_inputs(spark, sf)
    wm = load.high_watermark(target)
    return load.watermark_filter(batch, wm).drop("_ord")


@register("load_watermark_per_sensor")
def q_load_watermark_per_sensor(spark, sf):
    """L1 variant: batch rows newer than their own sensor's high-watermark."""
    target, batch = _load_inputs(spark, sf)
    return load.key_watermark_filter(batch, target, "sensor_id").drop("_ord")


@register("load_insert_absent")
def q_load_insert(spark, sf):
    """L2/L3: table state after insert-if-absent on (reading_id, recorded_at)."""
    target, batch = _load_inputs(spark, sf)
    ins = load.insert_if_absent(batch, target, ["reading_id", "recorded_at"], "_ord")
    return target.unionByName(ins)


@register("load_insert_filtered")
def q_load_insert_filtered(spark, sf):
    """L2/L3 where the key filter matters: a batch of the last ten days against a table of all before,
    with a filter so small that it lets most other keys pass: same answer."""
    target, batch = _load_inputs(spark, sf)
    late = batch.filter(F.col("recorded_at") >= F.lit("2024-01-19").cast("timestamp_ntz"))
    ins = load.insert_if_absent(late, target, ["reading_id", "recorded_at"], "_ord", filter_bits=4096)
    exact = load.insert_if_absent(late.select("sensor_id", "recorded_at", "value", "_ord"), target, ["sensor_id"], "_ord")
    return (ins.select(F.lit("reading_id, recorded_at").alias("keys"), "sensor_id", "recorded_at", "value")
            .unionByName(exact.select(F.lit("sensor_id").alias("keys"), "sensor_id", "recorded_at", "value")))


@register("load_upsert")
def q_load_upsert(spark, sf):
    """L4: grid-style upsert on (dataset_id, recorded_at): value, metric and
    source from the batch's last row, country kept from the first insert."""
    target, batch = _load_inputs(spark, sf)

    def grid(df, country, source):
        return df.select(F.col("sensor_id").alias("dataset_id"), F.lit(country).alias("country"),
                         "recorded_at", "value",
                         F.when(F.col("is_anomaly"), F.lit("error")).otherwise(F.lit("ok")).alias("metric"),
                         F.lit(source).alias("source"), *([c for c in df.columns if c == "_ord"]))
    t = grid(target, "FI", "old")
    b = grid(batch, "SE", "new").withColumn(
        "country", F.when(F.col("_ord.part") == 2, F.lit("NO")).otherwise(F.col("country")))
    return load.upsert(b, t, ["dataset_id", "recorded_at"], ["value", "metric", "source"], "_ord")


@register("load_idempotent")
def q_load_idempotent(spark, sf):
    """Fate of every batch row (late / duplicate / conflict / insert),
    without and with the watermark."""
    target, batch = _load_inputs(spark, sf)
    keys = ["reading_id", "recorded_at"]
    wm = load.high_watermark(target)
    plain = load.status_counts(load.tag_batch(batch, target, keys, "_ord"))
    with_wm = load.status_counts(load.tag_batch(batch, target, keys, "_ord", wm=wm))
    return (plain.select(F.lit(False).alias("use_watermark"), "*")
            .unionByName(with_wm.select(F.lit(True).alias("use_watermark"), "*")))


@register("range_delete")
def q_range_delete(spark, sf):
    """Readings left after DELETE WHERE ts in [Jan 10, Jan 12)."""
    r = A.events_domain(spark, sf).readings
    return load.without_range(r, "recorded_at", F.lit("2024-01-10").cast("timestamp_ntz"),
                              F.lit("2024-01-12").cast("timestamp_ntz"))


# ---------------------------------------------------------------- layout

@register("partition_layout")
def q_partition_layout(spark, sf):
    """Readings clustered for the month layout (with the month column)."""
    return layout.prepare_layout(A.events_domain(spark, sf).readings)


@register("partition_route")
def q_partition_route(spark, sf):
    """Rows inside / outside the declared range [Jan 1, Jan 16), per day."""
    r = layout.route(A.events_domain(spark, sf).readings, F.lit("2024-01-01").cast("timestamp_ntz"),
                     F.lit("2024-01-16").cast("timestamp_ntz"))
    return (r.groupBy(F.date_format("recorded_at", "yyyy-MM-dd").alias("day"), "accepted")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")))


@register("range_read")
def q_range_read(spark, sf):
    """One sensor over a closed 6-day range (the benchmarked query)."""
    r = A.events_domain(spark, sf).readings
    return r.filter((F.col("sensor_id") == F.lit(5))
                    & F.col("recorded_at").between(F.lit("2024-01-05").cast("timestamp_ntz"),
                                                   F.lit("2024-01-11").cast("timestamp_ntz")))


@register("verified_rewrite")
def q_verified_rewrite(spark, sf):
    """Per-month count and content hash that a copy must reproduce
    (portable form, so a second engine can verify it)."""
    return layout.fingerprint(A.events_domain(spark, sf).readings, portable=True)


@register("anomalies_json")
def q_anomalies_json(spark, sf):
    """The parameterised anomalies as one JSON envelope."""
    d = A.events_domain(spark, sf)
    out = scoring.anomalies(d.readings, d.sensors, d.facilities, 3.0, 100, None)
    # unrounded in the library; the comparison needs a fixed precision
    out = out.withColumn("z_score", round_half("z_score", 8))
    return json_envelope(out, {"z_threshold": 3.0, "facility_type": None}, "anomalies",
                         order_by=[-F.col("z_score"), F.col("reading_id")])


# ---------------------------------------------------------------- on storage
# These write into the shared scratch folder and run the operator that they are named for.

def _stored_readings(spark, sf) -> str:
    path = scratch_path(spark, "readings-layout")
    layout.write_layout(A.events_domain(spark, sf).readings, path)
    return path


@register("range_read_stored")
def q_range_read_stored(spark, sf):
    """The benchmarked range query through the month layout's pruning reader."""
    return layout.range_read(spark, _stored_readings(spark, sf), 5, "2024-01-05", "2024-01-11").drop("month")


@register("lookup_stored")
def q_lookup_stored(spark, sf):
    """Readings appended in three loads to a table laid out for lookups, then read by sensors,
    by sensor and time, and by time alone."""
    path, r = scratch_path(spark, "readings-lookup"), A.events_domain(spark, sf).readings
    for k in range(3):
        lookup.write_lookup(r.filter(F.pmod("reading_id", F.lit(3)) == k), path, row_group_bytes=1 << 17)
    asked = {"sensors": {"sensors": [3, 5, -1]}, "sensor and days": {"sensors": [5], "start": "2024-01-05", "stop": "2024-01-11"},
             "hours": {"start": "2024-01-09 05:00:00", "stop": "2024-01-09 07:30:00"}, "from": {"sensors": [8], "start": "2024-01-20"}}
    found = [lookup.lookup(spark, path, **a).drop("month").select(F.lit(k).alias("asked"), "*") for k, a in asked.items()]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


@register("range_delete_stored")
def q_range_delete_stored(spark, sf):
    """The table left by a range delete on storage."""
    path = _stored_readings(spark, sf)
    load.range_delete(spark, path, "recorded_at", "2024-01-10", "2024-01-12")
    return spark.read.parquet(path).drop("month")


@register("rewrite_switch")
def q_rewrite_switch(spark, sf):
    """Copy, compare, switch the pointer; the rows of the copy that is then current."""
    src, dst, pointer = (scratch_path(spark, n) for n in ("rewrite-src", "rewrite-dst", "rewrite-current"))
    A.events_domain(spark, sf).readings.write.parquet(src)
    layout.point_to(spark, pointer, src)
    layout.verified_rewrite(spark, src, dst, pointer=pointer)
    return spark.read.parquet(layout.current_copy(spark, pointer)).drop("month")


@register("load_end_to_end")
def q_load_end_to_end(spark, sf):
    """load() four times (target; batch with watermark; replay without; replay with):
    fates by run, rows that rules refuse included, and the table's rows by month."""
    target, batch = _load_inputs(spark, sf)
    sensors = A.events_domain(spark, sf).sensors.select("sensor_id")
    first = batch.filter("_ord.part = 1")

    def broken(rest, **change):
        cols = {k: F.lit(v).cast(batch.schema[k].dataType) for k, v in change.items()}
        return (first.filter(F.col("reading_id") % 10 == rest)
                .withColumn("_ord", F.struct(F.lit(3).alias("part"), F.col("reading_id").alias("n"))).withColumns(cols))

    given = (batch.unionByName(broken(0, recorded_at=None)).unionByName(broken(1, reading_id=None))
             .unionByName(broken(2, sensor_id=-1)))
    path, keys = scratch_path(spark, "load-table"), ["reading_id", "recorded_at"]
    runs = [(target.withColumn("_ord", F.struct(F.lit(0).alias("part"), F.col("reading_id").alias("n"))), True),
            (given, True), (given, False), (given, True)]
    rows = []
    for k, (rows_in, wm) in enumerate(runs, 1):
        counts = load.load(spark, rows_in, path, keys, "_ord", use_watermark=wm, rules=RULES["readings"],
                           references={"sensor_id": sensors}, rejects_path=scratch_path(spark, "load-rejects"))
        rows += [(k, s, counts[s]) for s in ("rejected", "late", "duplicate", "conflict", "inserted") if counts[s]]
    done = spark.createDataFrame(rows, "run int, status string, n_rows bigint")
    return done.unionByName(spark.read.parquet(path).groupBy(F.concat(F.lit("table "), F.col("month")).alias("status"))
                            .agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(5).alias("run"), "status", "n_rows"))


@register("load_watermark_half_loaded")
def q_load_watermark_half_loaded(spark, sf):
    """A sensor-major load that stopped half-way (even sensors stored, odd ones not
    reached) is resumed: the per-sensor watermark passes exactly the odd sensors' rows."""
    r = A.events_domain(spark, sf).readings
    return load.key_watermark_filter(r, r.filter(F.col("sensor_id") % 2 == 0), "sensor_id")


@register("rule_foreign_key_broken")
def q_rule_fk_broken(spark, sf):
    """C2 with violations: events of users missing in a dimension without every seventh."""
    known = A.table(spark, sf, "customer").filter(F.col("c_custkey") % 7 != 0)
    return quality.foreign_key_violations(A.table(spark, sf, "events"), "user_id", known, "c_custkey")


@register("completeness_gate_declared")
def q_completeness_declared(spark, sf):
    """S7 over declared series, one of which has no row at all."""
    return missing_slices(A.events_series(spark, sf), declared_series(spark, ["error", "never_sent"]),
                          "2024-01-01", "2024-02-01", step="1 day", unit="day")


@register("payload_rows")
def q_payload_rows(spark, sf):
    """Payload documents (of one hour and about 10,000 records at most) written as JSON and
    read back through the operator."""
    ev = A.table(spark, sf, "events").filter("event_type = 'error'")
    record = F.struct(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("startTime"),
                      F.col("value").cast("string").alias("value"))
    path = scratch_path(spark, "payload")
    payload_documents(ev, F.date_trunc("hour", "ts"), record).write.json(path)
    rows = payload_rows(read_payload(spark, path, lines=True), 7, "error")
    return rows.withColumn("recorded_at", F.col("recorded_at").cast("timestamp_ntz"))


def _thinned(spark, sf):
    """Hourly event series with gaps of 3, 6, 7 and 20 hours, empty edges and negative values."""
    s = timeseries.resample(A.events_series(spark, sf), unit="hour")
    p = F.floor(F.unix_seconds(F.col("recorded_at").cast("timestamp")) / 3600) % 60
    at = lambda t: F.lit(t).cast("timestamp_ntz")
    empty = (p.between(3, 5) | p.between(10, 15) | p.between(20, 26) | p.between(35, 54)
             | (F.col("recorded_at") < at("2024-01-01 05:00:00")) | (F.col("recorded_at") >= at("2024-01-29 20:00:00")))
    return s.withColumn("value", F.when(~empty, F.col("value") - 50))


@register("gap_interpolate_thinned")
def q_gap_thinned(spark, sf):
    """G2-G5 where they all matter: long and edge gaps, residual fill, clamping."""
    f = timeseries.fill_gaps(_thinned(spark, sf))
    return f.select("dataset_id", "country", "recorded_at", round_half("value", 6).alias("value"), "metric",
                    F.lit("fingrid").alias("source"))


@register("gap_counts")
def q_gap_counts(spark, sf):
    """Gaps before and after interpolation, and negatives."""
    return timeseries.gap_counts(_thinned(spark, sf))


def _table_name(kind: str) -> str:
    return f"voltaic_{kind}_{uuid.uuid4().hex[:12]}"


@register("scan_catalog_default")
def q_scan_catalog_default(spark, sf):
    """L14/C5 in the catalog: rows stored before ADD COLUMN get its default on read, rows that
    do not give it get it on write, and a NULL that is given stays."""
    s, name = A.orders_series(spark, sf), _table_name("grid")
    cut = lambda t: F.lit(t).cast("timestamp_ntz")
    old = s.filter(F.col("recorded_at") < cut("1996-01-01")).drop("source")
    create_table(old, name, scratch_path(spark, "grid-evolved"))
    add_column(spark, name, "source", "string", "'fingrid'")
    add_column(spark, name, "source", "string", "'again'")  # IF NOT EXISTS
    given = s.filter(F.col("recorded_at") >= cut("1997-01-01"))
    given.withColumn("source", F.when(F.col("dataset_id") != 3, F.col("source"))).write.insertInto(name)
    between = s.filter((F.col("recorded_at") >= cut("1996-01-01")) & (F.col("recorded_at") < cut("1997-01-01")))
    between.createOrReplaceTempView(f"{name}_between")
    columns = ", ".join(old.columns)
    spark.sql(f"INSERT INTO {name} ({columns}) SELECT {columns} FROM {name}_between")
    return spark.table(name)


@register("top3_bucketed")
def q_top3_bucketed(spark, sf):
    """P7 over a bucketed table: the window needs no shuffle of the readings."""
    d, name = A.shipments_domain(spark, sf), _table_name("readings")
    layout.write_bucketed(d.readings, name, scratch_path(spark, "readings-bucketed"), 8)
    return ranking.top_readings_per_sensor(spark.table(name), d.sensors, d.facilities, "1998-12-01", "1999-01-01", 3)


@register("report_runner")
def q_report_runner(spark, sf):
    """Reports run by name to CSV folders, one fails half-way and leaves nothing: what the
    runner says, and the rows that a reader finds."""
    d = A.events_domain(spark, sf)
    broken = d.readings.select(F.lit(1) / (F.col("sensor_id") - 5))
    asked = {"b_fails": lambda s: broken, "c_trend": lambda s: reports.anomaly_trend(d.readings),
             "a_rates": lambda s: quality.anomaly_rate_by_facility(d.readings, d.sensors, d.facilities)}
    out = scratch_path(spark, "reports")
    done = run_reports(spark, asked, out, "20240101_000000")
    found = lambda r: spark.read.csv(r["path"], header=True).count() if r["ok"] else int(load.path_exists(spark, f"{out}/{r['name']}_20240101_000000"))
    rows = [(k, r["name"], r["ok"], r["rows"] if r["ok"] else -1, found(r)) for k, r in enumerate(done, 1)]
    return spark.createDataFrame(rows, "place int, report string, ok boolean, n_rows bigint, n_found bigint")


@register("series_by_metric_and_time")
def q_series_by_metric(spark, sf):
    """The external series upserted into its table, which lies by month, metric and time, and
    one metric read over a time range."""
    path = scratch_path(spark, "grid-table")
    s = A.orders_series(spark, sf).withColumn("_ord", F.struct("value", "metric"))
    s = s.filter((F.col("recorded_at") >= F.lit("1997-06-01").cast("timestamp_ntz")) & (F.col("recorded_at") < F.lit("1997-12-01").cast("timestamp_ntz")))
    load.upsert_table(spark, s, path, ["dataset_id", "recorded_at"], ["value", "metric", "source"], "_ord")
    t = spark.read.parquet(path)
    return t.filter((F.col("metric") == SERIES_METRIC) & layout.month_range_filter("1997-07-10", "1997-08-20") & F.col("recorded_at").between(
        F.lit("1997-07-10").cast("timestamp_ntz"), F.lit("1997-08-20").cast("timestamp_ntz"))).drop("month")


# ---------------------------------------------------------------- arriving files

def _arrivals(spark, sf):
    """Readings as they arrive in five runs: days 1-10; days 16-30 of even sensors, ahead of the
    others; days 8-20 of all, with rows repeated; run 3 again, after a failure before it was recorded;
    days 1-10 sent again beside days 21-31 of all."""
    r = A.events_domain(spark, sf).readings
    days = lambda a, b: r.filter(F.dayofmonth("recorded_at").between(a, b))
    return [days(1, 10), days(16, 30).filter(F.col("sensor_id") % 2 == 0), days(8, 20).unionByName(days(12, 13)), None,
            days(1, 10).unionByName(days(21, 31))]


def _run_arrivals(spark, sf, start):
    """Write each run's files, load them with ``start(source, checkpoint, results)``; counts by run."""
    source, checkpoint = scratch_path(spark, "arrivals"), scratch_path(spark, "arrivals-checkpoint")
    rows, epoch = [], -1
    for k, batch in enumerate(_arrivals(spark, sf), 1):
        if batch is None:
            stateful.forget_commit(spark, checkpoint, epoch)
        else:
            batch.write.parquet(f"{source}/run{k}")
        results = []
        query = start(source, checkpoint, results)
        query.awaitTermination()
        for r in results:
            epoch = r["epoch"] if r["inserted"] else epoch
            rows += [(k, name, n) for name, n in r.items() if name in ("late", "duplicate", "inserted") and n]
        if late := stateful.late_rows(query):
            rows.append((k, "dropped", late))
    return rows


def _loaded(spark, rows, target):
    done = spark.createDataFrame(rows, "run int, status string, n_rows bigint")
    by_day = spark.read.parquet(target).groupBy(F.concat(F.lit("table "), F.date_format("recorded_at", "yyyy-MM-dd")).alias("status"))
    return done.unionByName(by_day.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(9).alias("run"), "status", "n_rows"))


@register("load_incremental_files")
def q_load_incremental(spark, sf):
    """Five availableNow runs with per-sensor watermarks, files out of order, one run
    replayed: fates by run, then the table's rows by day."""
    target, state = scratch_path(spark, "incremental-table"), scratch_path(spark, "incremental-state")
    schema = A.events_domain(spark, sf).readings.schema
    rows = _run_arrivals(spark, sf, lambda source, checkpoint, results: stateful.watermarked_load(
        spark, source, schema, target, ["reading_id", "recorded_at"], state, checkpoint, fmt="parquet", results=results))
    return _loaded(spark, rows, target)


@register("load_incremental_keys")
def q_load_incremental_keys(spark, sf):
    """L6 without watermark: the same runs, with row keys in the state store: every key once."""
    target = scratch_path(spark, "incremental-table")
    schema = A.events_domain(spark, sf).readings.schema
    rows = _run_arrivals(spark, sf, lambda source, checkpoint, results: stateful.deduplicated_load(
        spark, source, schema, target, ["reading_id", "recorded_at"], checkpoint, "40 days", fmt="parquet", results=results))
    return _loaded(spark, rows, target)


# ---------------------------------------------------------------- kept statistics

def _kept_statistics(spark, readings):
    """Monthly statistics of ``readings`` from three batches that share months, the second of them
    contributed twice, with a compaction in between."""
    root = scratch_path(spark, "monthly")
    third = F.pmod(F.col("reading_id"), F.lit(3))
    for k, name in ((0, "a"), (1, "b"), (1, "b")):
        monthly.contribute(readings.filter(third == k), root, name)
    monthly.compact(spark, root)
    monthly.contribute(readings.filter(third == 2), root, "c")
    return monthly.state(spark, root)


@register("zscore_from_monthly")
def q_zscore_kept(spark, sf):
    """P2 against the kept baseline (moments merged by Chan's rule)."""
    d = A.events_domain(spark, sf)
    return scoring.zscore_anomalies(d.readings, d.sensors, d.facilities, 3.0, 200, monthly.baseline(_kept_statistics(spark, d.readings)))


@register("monthly_report_from_monthly")
def q_report_kept(spark, sf):
    """P4 from the kept statistics: no reading is read."""
    d = A.shipments_domain(spark, sf)
    return reports.report_of(monthly.sensor_months(_kept_statistics(spark, d.readings)), d.sensors, d.facilities, SHIP_POWER_SENSOR)


@register("anomaly_trend_from_monthly")
def q_trend_kept(spark, sf):
    """D2 from the kept statistics."""
    return monthly.trend(_kept_statistics(spark, A.shipments_domain(spark, sf).readings))


@register("dq_coverage_from_monthly")
def q_coverage_kept(spark, sf):
    """Q4/AG6 from the kept statistics: distinct days by uniting day masks."""
    return monthly.coverage(_kept_statistics(spark, A.events_domain(spark, sf).readings))
