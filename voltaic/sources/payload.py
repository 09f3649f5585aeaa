"""External-series payloads: JSON records -> long-format rows, and the
completeness gate that refuses a pull with empty (series, period) slices.

The HTTP pull itself is not part of this library; payload files land in
storage and are read here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefn import bucket, time_grid
from ..schemas import GRID_PAYLOAD


def read_payload(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Payload documents ``{"data": [{"startTime": .., "value": ..}, ...]}``: one per file, or
    one per line (``lines``), which splits and packs better."""
    return spark.read.schema(GRID_PAYLOAD).option("multiLine", str(not lines).lower()).json(path)


def payload_documents(rows: DataFrame, group: Column, record: Column, size: int = 10_000) -> DataFrame:
    """``record`` of every row, in documents ``data`` of one ``group`` each.

    A group of n rows is dealt over ceil(n / size) documents by a hash of the row's number, so
    documents hold about ``size`` records at most whatever the group; equal rows part too.
    """
    each = rows.select(group.alias("g"), record.alias("record"), F.xxhash64(F.monotonically_increasing_id()).alias("k"))
    sizes = rows.select(group.alias("of")).groupBy("of").agg(F.ceil(F.count(F.lit(1)) / size).alias("n"))
    return (each.join(F.broadcast(sizes), F.col("g").eqNullSafe(F.col("of")))  # a row for each group
            .groupBy("g", F.pmod("k", "n").alias("part")).agg(F.collect_list("record").alias("data")).select("data"))


def payload_rows(payload: DataFrame, dataset_id: int, metric: str, country: str = "FI") -> DataFrame:
    """Unnest ``data`` and tag rows with the series they belong to.

    Columns: dataset_id, metric, country, recorded_at, value.  Timestamps with
    an offset are normalised to UTC; values given as text or number are
    converted with try_cast (junk becomes NULL, i.e. a gap).
    """
    rec = payload.select(F.explode("data").alias("r"))
    return rec.select(
        F.lit(dataset_id).cast("int").alias("dataset_id"),
        F.lit(metric).alias("metric"),
        F.lit(country).alias("country"),
        F.to_timestamp(F.col("r.startTime")).alias("recorded_at"),
        F.col("r.value").try_cast("double").alias("value"))


def declared_series(spark: SparkSession, keys: Sequence, key: str = "metric") -> DataFrame:
    """The expected series keys as a frame for :func:`missing_slices`."""
    kind = "long" if all(isinstance(k, int) for k in keys) else "string"
    return spark.createDataFrame([(k,) for k in keys], f"{key} {kind}")


def json_field(c: Column | str, schema: T.DataType | str) -> Column:
    """from_json with a declared schema."""
    c = F.col(c) if isinstance(c, str) else c
    return F.from_json(c, schema)


def missing_slices(rows: DataFrame, series: DataFrame, start: str, stop: str,
                   step: str = "1 month", unit: str = "month", key: str = "metric",
                   ts: str = "recorded_at") -> DataFrame:
    """(series, period) slices of [start, stop) that have no rows.

    ``series`` is a frame of the declared series keys (column ``key``).  Declare it, never
    take it from the rows received: a series without any row must be missed.  The expected
    grid is series x periods, anti-joined with the periods present.
    Columns: <key>, period.
    """
    lo = F.lit(start).cast("timestamp_ntz")
    last = F.lit(stop).cast("timestamp_ntz") - F.expr("INTERVAL 1 MICROSECOND")
    # expected grid: each series key row generates its own periods
    expected = (series.select(key).distinct()
                .select(key, time_grid(lo, last, step).alias("period")))
    present = (rows.filter((F.col(ts) >= F.lit(start).cast("timestamp_ntz"))
                           & (F.col(ts) < F.lit(stop).cast("timestamp_ntz")))
               .select(key, bucket(unit, ts).alias("period")).distinct())
    return expected.join(present, [key, "period"], "left_anti")


class IncompletePayload(RuntimeError):
    pass


def assert_complete(missing: DataFrame, key: str = "metric", max_report: int = 20) -> None:
    """Raise when any slice is empty (the reference refuses such a pull).  The message counts
    them all and names the first ``max_report``."""
    n = missing.count()
    if n:
        sample = missing.orderBy(key, "period").limit(max_report).collect()
        desc = ", ".join(f"{r[key]} @ {r['period']}" for r in sample)
        raise IncompletePayload(f"{n} slices without data, first: {desc}")
