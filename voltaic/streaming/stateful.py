"""Incremental loads that keep their state between runs, not in the table.

:func:`watermarked_load` keeps every sensor's newest time, :func:`deduplicated_load` the row keys
of a time window.  Neither reads the table it appends to, so a run costs what has arrived,
however much is stored.

Per-sensor watermarks are a small versioned table: version N holds one row per sensor after
micro-batch N, and N reads version N - 1.  A micro-batch that is replayed after a failure
therefore sees what it saw the first time, makes the same decisions, and overwrites its own
``epoch=N`` partitions with the same rows.  Rows are not grouped by sensor: their maxima are partial
aggregates, and the versions are joined as a size-checked broadcast, so a sensor that sends a third of
all rows stays spread over all tasks.

Row keys live in Spark's own state store (``dropDuplicatesWithinWatermark``), one entry per key
until the watermark has passed it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.joins import sized_broadcast
from ..operators.layout import MONTH, prepare_layout
from ..operators.load import delete_path, first_per_key
from ..operators.rules import REJECT, with_rejects
from ..operators.stage import Scratch

EPOCH = "epoch"
ORDER = "_input_order"


def arrivals(spark: SparkSession, source: str, schema: T.StructType, fmt: str = "csv", options: dict | None = None,
             max_files: int | None = None) -> DataFrame:
    """New files under ``source`` (folders included) as a stream, each row with where it stood:
    file time, path, offset of the split."""
    reader = spark.readStream.schema(schema).format(fmt).option("recursiveFileLookup", "true").options(**(options or {}))
    if fmt == "csv":
        reader = reader.option("header", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    place = F.struct(F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_path").alias("path"),
                     F.col("_metadata.file_block_start").alias("block"))
    return reader.load(source).select("*", place.alias("_place"))


def _versions(spark: SparkSession, state: str) -> list[int]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(state)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    done = [n for n in names if n.startswith("v=") and fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{state}/{n}/_SUCCESS"))]
    return sorted(int(n[2:]) for n in done)


def watermarks(spark: SparkSession, state: str, before: int | None = None) -> DataFrame | None:
    """by, high: the newest complete version, or the newest before micro-batch ``before``."""
    found = [v for v in _versions(spark, state) if before is None or v < before]
    return spark.read.parquet(f"{state}/v={found[-1]}") if found else None


def _append(rows: DataFrame, epoch: int, target: str, ts: str, sort_by: Sequence[str]) -> None:
    """The rows of a micro-batch in its own partitions of the month layout, again on a replay."""
    (prepare_layout(rows.withColumn(EPOCH, F.lit(epoch)), ts, [c for c in sort_by if c in rows.columns])
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH, EPOCH).parquet(target))


def watermarked_load(spark: SparkSession, source: str, schema: T.StructType, target: str, keys: Sequence[str], state: str,
                     checkpoint: str, by: str = "sensor_id", ts: str = "recorded_at", fmt: str = "csv", options: dict | None = None,
                     order_within_file: str | None = None, max_files: int | None = None, rules=None, bounds: tuple | None = None,
                     rejects: str | None = None, sort_by: Sequence[str] = ("sensor_id",),
                     results: list | None = None) -> StreamingQuery:
    """Start an ``availableNow`` run that loads every new file once; rows are

    * rejected: a NULL key, time or sensor, a broken rule, a time outside ``bounds``; stored with the
      reason under ``rejects`` when given, by micro-batch
    * late: at or before the newest time stored for their sensor by earlier micro-batches
    * duplicate: not the first of their key in the micro-batch (file time, path, offset, position)
    * inserted: the others, appended to ``target`` by month and micro-batch.

    Files may arrive out of order and again: a sensor that is ahead does not hold others back,
    and what a sensor has sent before is late.  ``results`` receives each micro-batch's counts:
    read = rejected + late + duplicate + inserted.
    """
    keys = list(keys)

    def apply(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        position = F.col(order_within_file) if order_within_file else F.monotonically_increasing_id()
        batch = batch.withColumn(ORDER, F.struct("_place", position.alias("position"))).drop("_place")
        checked = with_rejects(batch, rules, list(dict.fromkeys([*keys, by])), ts, None, bounds)
        old = watermarks(session, state, epoch)
        with Scratch(session) as scratch:
            if old is not None:
                checked = checked.join(sized_broadcast(old.withColumnRenamed("high", "_high")), by, "left")
                late = F.coalesce(F.col(ts) <= F.col("_high"), F.lit(False))
            else:
                late = F.lit(False)
            rows = scratch.put(checked.withColumn("_late", F.col(REJECT).isNull() & late).drop("_high"), "incremental-batch")
            fresh = rows.where(F.col(REJECT).isNull() & ~F.col("_late")).drop(REJECT, "_late", "_raw")
            first = scratch.put(first_per_key(fresh, keys, ORDER).drop(ORDER), "incremental-rows")
            n = rows.agg(F.count(F.lit(1)).alias("read"), F.count(REJECT).alias("rejected"), F.count_if("_late").alias("late")).first()
            inserted = first.count()
            if rejects and n["rejected"]:
                (rows.where(F.col(REJECT).isNotNull()).drop("_late", ORDER).withColumn(EPOCH, F.lit(epoch)).write.mode("overwrite")
                 .option("partitionOverwriteMode", "dynamic").partitionBy(EPOCH).parquet(rejects))
            if inserted:
                _append(first, epoch, target, ts, sort_by)
            newest = first.groupBy(by).agg(F.max(ts).alias("high"))
            both = newest if old is None else old.unionByName(newest).groupBy(by).agg(F.max("high").alias("high"))
            both.write.mode("overwrite").parquet(f"{state}/v={epoch}")
        for v in _versions(session, state):
            if v < epoch - 1:  # a replay of this micro-batch reads the one before it
                delete_path(session, f"{state}/v={v}")
        if results is not None:
            results.append({"epoch": epoch, "read": n["read"], "rejected": n["rejected"], "late": n["late"],
                            "duplicate": n["read"] - n["rejected"] - n["late"] - inserted, "inserted": inserted})

    return (arrivals(spark, source, schema, fmt, options, max_files).writeStream.foreachBatch(apply)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def deduplicated_load(spark: SparkSession, source: str, schema: T.StructType, target: str, keys: Sequence[str], checkpoint: str,
                      within: str, ts: str = "recorded_at", fmt: str = "csv", options: dict | None = None,
                      max_files: int | None = None, sort_by: Sequence[str] = ("sensor_id",), results: list | None = None) -> StreamingQuery:
    """Start an ``availableNow`` run that inserts a row of every key once, in any order of arrival.

    ``within`` (such as "40 days") is how far apart two rows of a key can be in time, and how far
    behind the newest row one may arrive; the state store holds the keys of that window.
    Rows further behind are not stored; :func:`late_rows` counts them after the run.  Rows of one
    key are taken to be equal; of differing ones any may be the one that stays.  ``results``
    receives the rows inserted by each micro-batch.
    """
    keys = list(keys)

    def apply(batch: DataFrame, epoch: int) -> None:
        with Scratch(batch.sparkSession) as scratch:
            rows = scratch.put(batch, "deduplicated-rows")
            inserted = rows.count()
            if inserted:
                _append(rows, epoch, target, ts, sort_by)
        if results is not None:
            results.append({"epoch": epoch, "inserted": inserted})

    event = F.col(ts).cast("timestamp").alias("_event")  # watermarks want a time with a zone
    rows = (arrivals(spark, source, schema, fmt, options, max_files).drop("_place").select("*", event)
            .withWatermark("_event", within).dropDuplicatesWithinWatermark(keys).drop("_event"))
    return rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_rows(query: StreamingQuery) -> int:
    """Rows that a finished :func:`deduplicated_load` left out because they came too late."""
    return sum(int(op.get("numRowsDroppedByWatermark", 0)) for p in query.recentProgress for op in p["stateOperators"])


def forget_commit(spark: SparkSession, checkpoint: str, epoch: int) -> None:
    """Make the next run repeat micro-batch ``epoch``, as after a failure just before it was
    recorded as done; micro-batches after it were never planned."""
    jvm = spark.sparkContext._jvm
    for log, first in (("commits", epoch), ("offsets", epoch + 1)):
        path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/{log}")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for name in [s.getPath().getName() for s in fs.listStatus(path)]:
            if name.isdigit() and int(name) >= first:
                fs.delete(jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/{log}/{name}"), False)
