"""Tables for point and range lookups (L10): Bloom filters, small row groups, interleaved order.

The reference indexes (sensor_id, recorded_at).  In Parquet three things stand in for that:

* within a month rows lie along a curve that interleaves the bits of sensor and time (a Z-order), so
  that a row group is a small box of both: a lookup by sensor, by time or by both reads few of
  them, where an order by sensor alone leaves every file to a lookup by time;
* each row group has a Bloom filter of its sensors, which rules out the sensors that lie inside its
  minimum and maximum without being there (many appended files that all span all sensors);
* page indexes (always written) skip the pages of the row groups that remain.

All three are read by Spark's Parquet scan from the pushed filters.  Spark pushes no filter on a time
without a zone, and writes times with a zone as INT96 without statistics unless the session says
otherwise; so the time is stored once more as whole seconds (``_at``), which readers filter as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .layout import MONTH, with_month

#: Bytes of a row group: small, as a lookup reads whole ones; at 100 TB footers stay below a thousandth.
ROW_GROUP_BYTES = 8 << 20
#: Bits of each dimension on the curve, and how many of the sensor's come before it: lookups by
#: sensor are the common ones.
CURVE_BITS, SENSOR_FIRST = 16, 2
#: The time in whole seconds since 1970.
AT = "_at"
_SECONDS = 31 * 86_400


def _at(ts: str | Column) -> Column:
    return F.unix_seconds((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def _spread(x: Column) -> Column:
    """The 16 bits of ``x`` at the even places of 32."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return x


def curve(first: Column, second: Column) -> Column:
    """Place on the Z-order curve of two whole numbers in [0, 2^16)."""
    return _spread(first.cast("long")).bitwiseOR(F.shiftleft(_spread(second.cast("long")), 1))


def sensor_ranks(df: DataFrame, by: str = "sensor_id", steps: int = 256) -> list:
    """Values that cut the rows into ``steps`` about equal parts, so that busy sensors get as much
    of the curve as they have rows (one approximate-quantile pass; the order alone depends on it)."""
    cuts = df.select(F.percentile_approx(F.col(by), [k / steps for k in range(1, steps)], 10_000)).first()[0]
    return sorted(set(cuts or []))


def curve_place(cuts: Sequence, by: str = "sensor_id", ts: str = "recorded_at") -> Column:
    """Place of a row on its month's curve: part of the sensor by :func:`sensor_ranks`, time in the month."""
    part = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col(by))) if len(cuts) else F.lit(0)
    scale = (1 << CURVE_BITS) // (len(cuts) + 1)
    since = _at(ts) - _at(F.date_trunc("month", F.col(ts)))
    part = (part * scale).cast("long")
    first = F.shiftleft(F.shiftright(part, CURVE_BITS - SENSOR_FIRST), 2 * CURVE_BITS)
    rest = F.shiftleft(part, SENSOR_FIRST).bitwiseAND(F.lit((1 << CURVE_BITS) - 1))
    return first.bitwiseOR(curve(rest, F.floor(since * (1 << CURVE_BITS) / _SECONDS)))


def write_lookup(df: DataFrame, path: str, by: str = "sensor_id", ts: str = "recorded_at", distinct: int = 100_000,
                 row_group_bytes: int = ROW_GROUP_BYTES, mode: str = "append", partitions: int | None = None) -> None:
    """Append ``df`` to the month-partitioned table at ``path``, laid out for lookups.

    ``distinct`` is about how many sensors a row group holds at most (the size of its Bloom filter: some
    twelve bits each).  Rows without a sensor sort first, those without a time go to the partition of
    no month."""
    order = [F.col(MONTH), F.col("_place"), F.col(by), F.col(ts)]
    placed = with_month(df, ts).withColumn(AT, _at(ts)).withColumn("_place", curve_place(sensor_ranks(df, by), by, ts))
    placed = placed.repartitionByRange(partitions, *order) if partitions else placed.repartitionByRange(*order)
    (placed.sortWithinPartitions(*order).drop("_place").write.mode(mode).partitionBy(MONTH)
     .option("parquet.block.size", str(row_group_bytes)).option(f"parquet.bloom.filter.enabled#{by}", "true")
     .option(f"parquet.bloom.filter.expected.ndv#{by}", str(distinct)).parquet(path))


def lookup(spark: SparkSession, path: str, sensors: Sequence | None = None, start: str | None = None, stop: str | None = None,
           by: str = "sensor_id", ts: str = "recorded_at", schema=None) -> DataFrame:
    """Rows of the given sensors (all when None) with start <= time <= stop (open ends when None).

    Months come from the bounds and prune directories; sensors and the bounds in seconds are pushed into
    the scan.  ``schema`` (with ``_at long`` and ``month string`` last) spares reading a footer
    when planning."""
    t = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    kind = t.schema[ts].dataType
    if sensors is not None:
        t = t.where(F.col(by).isin(list(sensors)))
    for bound, keep in ((start, lambda c, b: c >= b), (stop, lambda c, b: c <= b)):
        if bound is not None:
            at = F.lit(bound).cast(kind)
            t = t.where(keep(F.col(ts), at) & keep(F.col(MONTH), F.date_format(at, "yyyy-MM")))
            t = t.where(keep(F.col(AT), _at(at))) if AT in t.columns else t
    return t.drop(AT)


def rows_scanned(df: DataFrame) -> int:
    """Rows that the file scans of ``df`` gave after skipping row groups and pages (runs ``df``)."""
    counted = df.select(F.count(F.lit(1)).alias("n"), F.count(df.columns[0]))
    plan = counted._jdf.queryExecution().executedPlan()
    counted._jdf.collectToPython()

    def scans(node):
        if "AdaptiveSparkPlan" in node.nodeName():
            return scans(node.executedPlan())
        if "QueryStage" in node.nodeName():
            return scans(node.plan())
        if node.nodeName().startswith("Scan"):
            return [node]
        kids = node.children()
        return [x for k in range(kids.size()) for x in scans(kids.apply(k))]

    return sum(int(s.metrics().apply("numOutputRows").value()) for s in scans(plan))
