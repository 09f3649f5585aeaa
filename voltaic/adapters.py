"""Driver test tables -> domain frames.

The pipelines speak the domain vocabulary (readings, sensors, facilities,
grid series).  The driver supplies TPC-H-like tables instead; these adapters
are pure projections/joins over them, so every pipeline's work grows with the
tables it reads.  The same mappings are written as SQL CTEs for the DuckDB
oracle in :mod:`voltaic.plans.oracle`.

* events adapter (sub-hour, one month): readings = events, sensors = customer,
  facilities = nation x region.
* shipments adapter (daily, ~7 years): readings = lineitem, one sensor per
  supplier, facilities = supplier x nation x region, capacity = account
  balance (some are <= 0, which exercises the NULLIF paths).
* orders series: the external "grid" series, long format.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


# Declared schemas of the driver tables this project reads (never inferred:
# a declared schema also spares the footer-reading job at plan time).
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    r = spark.read.schema(schema) if schema else spark.read
    return r.parquet(path)


class Domain:
    """readings / sensors / facilities, each built on first use only."""

    def __init__(self, readings, sensors, facilities):
        self._r, self._s, self._f = readings, sensors, facilities

    @cached_property
    def readings(self) -> DataFrame:
        return self._r()

    @cached_property
    def sensors(self) -> DataFrame:
        return self._s()

    @cached_property
    def facilities(self) -> DataFrame:
        return self._f()


def events_domain(spark: SparkSession, sf_dir: str) -> Domain:
    return Domain(lambda: _ev_readings(spark, sf_dir), lambda: _ev_sensors(spark, sf_dir),
                  lambda: _ev_facilities(spark, sf_dir))


def _ev_readings(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("reading_id"),
        F.col("user_id").alias("sensor_id"),
        F.col("ts").alias("recorded_at"),
        F.col("value"),
        (F.col("event_type") == F.lit("error")).alias("is_anomaly"),
    )


def _ev_sensors(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("sensor_id"),
        F.col("c_nationkey").alias("facility_id"),
        F.col("c_mktsegment").alias("sensor_type"),
        F.lit("unit").alias("unit"),
    )


def _ev_facilities(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("facility_id"),
        F.col("n_name").alias("facility_name"),
        F.col("r_name").alias("facility_type"),
        F.col("n_name").alias("country"),
        F.lit(100.0).alias("capacity_mw"),
    )


def shipments_domain(spark: SparkSession, sf_dir: str, value: str = "l_extendedprice") -> Domain:
    return Domain(lambda: _sh_readings(spark, sf_dir, value), lambda: _sh_sensors(spark, sf_dir),
                  lambda: _sh_facilities(spark, sf_dir))


def _sh_readings(spark, sf_dir, value):
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * F.lit(8) + F.col("l_linenumber")).alias("reading_id"),
        F.col("l_suppkey").alias("sensor_id"),
        F.col("l_shipdate").alias("recorded_at"),
        F.col(value).alias("value"),
        (F.col("l_returnflag") == F.lit("R")).alias("is_anomaly"),
    )


def _sh_sensors(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("sensor_id"),
        F.col("s_suppkey").alias("facility_id"),
        F.lit("power_output").alias("sensor_type"),
        F.lit("MW").alias("unit"),
    )


def _sh_facilities(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
                  .join(region, nation.n_regionkey == region.r_regionkey)
                  .select(F.col("s_suppkey").alias("facility_id"),
                          F.col("s_name").alias("facility_name"),
                          F.col("r_name").alias("facility_type"),
                          F.col("n_name").alias("country"),
                          F.col("s_acctbal").alias("capacity_mw")))


def orders_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """External series in grid_data's long format: one row per order."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.substring("o_orderpriority", 1, 1).cast("int").alias("dataset_id"),
        F.lit("FI").alias("country"),
        F.col("o_orderdate").alias("recorded_at"),
        F.col("o_totalprice").alias("value"),
        F.col("o_orderpriority").alias("metric"),
        F.lit("orders").alias("source"),
    )


def events_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sub-hourly long-format series, one per event type (for resampling)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.lit(1).alias("dataset_id"),
        F.lit("FI").alias("country"),
        F.col("ts").alias("recorded_at"),
        F.col("value"),
        F.col("event_type").alias("metric"),
    )
