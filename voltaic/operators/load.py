"""Idempotent loads: high-watermark filter, insert-if-absent, upsert,
range delete — as DataFrame plans plus a staged, all-or-nothing writer.

Semantics kept from the reference:
* watermark: ``MAX(ts)`` of the target, read once before the load; rows
  with ts <= watermark are late and skipped (counted, not silently lost);
  an empty target means no filter.
* insert-if-absent (ON CONFLICT DO NOTHING): within one batch the *first*
  row of a key wins; keys already in the target are skipped.
* upsert (ON CONFLICT DO UPDATE SET value, metric, source): the *last* batch
  row of a key gives the updated columns; the other columns come from the
  row that was inserted first (the target's, else the batch's first).
"Input order" is an explicit column (``order``), never a generated id.

Nothing is lost silently: rows that a rule refuses (a NULL key or time among
them) are counted and stored as rejects, and read = rejected + late + duplicate
+ conflict + inserted.

Scale: per-key winners are ``row_number() = 1``, which plans as a group limit
before and after the one shuffle, so a key repeated a million times is cut
down in every task.  The target side of the conflict joins is pruned to the
batch's months, which with the month layout is partition pruning; months are
computed in Spark (session zone UTC), never from driver-local times.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .joins import sized_broadcast
from .keyfilter import FILTER_BITS, may_hold, span_columns, spans_of, within
from .layout import prepare_layout, touched_months
from .rules import REJECT, with_rejects
from .stage import Scratch, stage


# ---------------------------------------------------------------- plans

def high_watermark(target: DataFrame | None, ts: str = "recorded_at"):
    """MAX(ts) of the target as text (None for an empty target).

    Collected to a literal on purpose: ``ts > literal`` is pushed into the
    batch scan, a join with a one-row aggregate would not be.  Text in the
    session zone (UTC) and cast back, so the driver's own zone plays no part."""
    if target is None:
        return None
    return target.agg(F.max(ts).cast("string").alias("wm")).first()["wm"]


def with_key_watermarks(batch: DataFrame, target: DataFrame, by: str,
                        ts: str = "recorded_at") -> DataFrame:
    """``batch`` plus ``_wm``: the newest target timestamp of the row's key
    (NULL for keys the target has never seen).  The per-key maxima are an
    aggregate over the target's rows of the batch's keys, staged so the size
    of what is broadcast is known."""
    keys_in_batch = batch.select(by).distinct()
    wms = stage(target.join(keys_in_batch, by, "left_semi")
                .groupBy(by).agg(F.max(ts).alias("_wm")), "load-watermarks")
    return batch.join(sized_broadcast(wms), by, "left")


def key_watermark_filter(batch: DataFrame, target: DataFrame, by: str,
                         ts: str = "recorded_at") -> DataFrame:
    """Rows strictly newer than their own key's watermark."""
    w = with_key_watermarks(batch, target, by, ts)
    return w.filter(F.col("_wm").isNull() | (F.col(ts) > F.col("_wm"))).drop("_wm")


def watermark_filter(batch: DataFrame, wm, ts: str = "recorded_at") -> DataFrame:
    """Rows strictly newer than the watermark (all rows when wm is None)."""
    return batch if wm is None else batch.filter(F.col(ts) > _at(batch, ts, wm))


def _at(df: DataFrame, ts: str, value) -> Column:
    """A time (text, datetime or column) as a literal of the column's own type.  Datetimes go
    through text in UTC, so the driver's zone plays no part; naive ones are taken as UTC."""
    if isinstance(value, dt.datetime):
        value = (value.astimezone(dt.timezone.utc).replace(tzinfo=None) if value.tzinfo else value).isoformat(sep=" ")
    return F.lit(value).cast(df.schema[ts].dataType)


def _end_of_key(batch: DataFrame, keys: Sequence[str], order) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order)
    return batch.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= 1).drop("_n")


def first_per_key(batch: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The first row (smallest ``order``) of every key."""
    return _end_of_key(batch, keys, F.col(order).asc())


def last_per_key(batch: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The last row (largest ``order``) of every key."""
    return _end_of_key(batch, keys, F.col(order).desc())


def months_of(batch: DataFrame, ts: str) -> tuple[str, str] | None:
    """First and last month of the batch as 'yyyy-MM', computed in Spark; None without times."""
    m = F.date_format(F.col(ts), "yyyy-MM")
    r = batch.agg(F.min(m).alias("lo"), F.max(m).alias("hi")).first()
    return None if r["lo"] is None else (r["lo"], r["hi"])


def prune_to(target: DataFrame, months: tuple[str, str] | None) -> DataFrame:
    """Restrict a month-partitioned target to a range of months (rows outside cannot share a
    key that contains the time)."""
    if months is None or "month" not in target.columns:
        return target
    return target.filter(F.col("month").between(*map(F.lit, months)))


def insert_if_absent(batch: DataFrame, target: DataFrame, keys: Sequence[str], order: str,
                     months: tuple[str, str] | None = None, filter_bits: int = FILTER_BITS) -> DataFrame:
    """Rows of ``batch`` to insert: first row per key, keys absent in target.

    Target rows whose key the batch cannot hold are cut before they are shuffled
    (:mod:`voltaic.operators.keyfilter`).  The ``order`` column is dropped from the result."""
    first = first_per_key(batch, keys, order)
    t = may_hold(prune_to(target, months).select(*keys), batch, keys, filter_bits)
    return first.join(t, list(keys), "left_anti").drop(order)


def upsert(batch: DataFrame, target: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str], order: str) -> DataFrame:
    """New state of ``target`` after upserting ``batch`` (full outer merge).

    Columns in ``update_cols`` take the batch's last value for every key in
    the batch; all other columns keep the target's value, and new keys take
    the batch's first row.  Result columns are the target's.
    """
    keys = list(keys)
    cols = [c for c in target.columns if c not in keys]
    keep = [c for c in cols if c not in update_cols]
    # Both ends of every key in one aggregate; partial ends cut a hot key down before the shuffle.
    ends = [F.max(F.struct(F.col(order).alias("_o"), F.struct(*update_cols).alias("_u")))["_u"].alias("_u")]
    if keep:
        ends.append(F.min(F.struct(F.col(order).alias("_o"), F.struct(*keep).alias("_k")))["_k"].alias("_k"))
    newest = batch.groupBy(*keys).agg(*ends).withColumn("_new", F.lit(True))
    old = target.withColumn("_old", F.lit(True))
    m = old.join(newest, keys, "full_outer")
    out = []
    for c in cols:
        if c in update_cols:
            out.append(F.when(F.col("_new"), F.col("_u")[c]).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.when(F.col("_old"), F.col(c)).otherwise(F.col("_k")[c]).alias(c))
    return m.select(*keys, *out).select(*target.columns)


def tag_batch(batch: DataFrame, target: DataFrame | None, keys: Sequence[str], order: str,
              ts: str = "recorded_at", wm=None, months: tuple[str, str] | None = None) -> DataFrame:
    """Every batch row with its fate in ``_status``: late (at or before the
    watermark), duplicate (not the first of its key in the batch), conflict
    (key already in the target) or insert."""
    keys = list(keys)
    late = F.coalesce(F.col(ts) <= _at(batch, ts, wm), F.lit(False)) if wm is not None else F.lit(False)
    b = batch.withColumn("_late", late)
    firsts = (b.filter(~F.col("_late")).groupBy(*keys).agg(F.min(order).alias("_first")))
    t = b.join(firsts, keys, "left")
    if target is not None:
        tk = prune_to(target, months).select(*keys).distinct().withColumn("_exists", F.lit(True))
        t = t.join(tk, keys, "left")
    else:
        t = t.withColumn("_exists", F.lit(None).cast("boolean"))
    status = (F.when(F.col("_late"), F.lit("late"))
              .when(F.col(order) != F.col("_first"), F.lit("duplicate"))
              .when(F.col("_exists").isNotNull(), F.lit("conflict"))
              .otherwise(F.lit("insert")))
    return t.withColumn("_status", status).drop("_late", "_first", "_exists")


def status_counts(tagged: DataFrame) -> DataFrame:
    """Columns: status, n_rows."""
    return (tagged.groupBy(F.col("_status").alias("status"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")))


def without_range(df: DataFrame, ts: str, start, stop) -> DataFrame:
    """Rows outside [start, stop) — the state after a range delete."""
    c = F.col(ts)
    return df.filter(~((c >= F.lit(start)) & (c < F.lit(stop))) | c.isNull())


# ---------------------------------------------------------------- storage

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def plan_insert(batch: DataFrame, target: DataFrame | None, keys: Sequence[str], order: str,
                months: tuple[str, str] | None = None, spans: dict | None = None,
                filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per key of ``batch``: its first row, plus ``_exists`` (key
    already in the target).  The target is read within the key ``spans`` (pushed into the scan),
    and rows whose key the batch cannot hold are cut before the shuffle."""
    first = first_per_key(batch, keys, order)
    if target is None:
        return first.withColumn("_exists", F.lit(False))
    tk = within(prune_to(target, months), spans or {}).select(*keys)
    tk = may_hold(tk, batch, keys, filter_bits).distinct().withColumn("_hit", F.lit(True))
    return (first.join(tk, list(keys), "left")
            .withColumn("_exists", F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit"))


def store_rejects(rejects: DataFrame, path: str, batch_id: str | None = None) -> None:
    """Keep refused rows under ``path`` in the partition ``batch`` of that name, in place of what an
    earlier try of the same batch left there; without a name the rows are a batch of their own."""
    rejects.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id or uuid.uuid4().hex}")


def load(spark: SparkSession, batch: DataFrame, target_path: str, keys: Sequence[str],
         order: str, ts: str | None = "recorded_at", use_watermark: bool = True,
         partition_by: str | None = "month", sort_by: Sequence[str] = ("sensor_id",),
         watermark_by: str | None = None, rules=None, references: dict[str, DataFrame] | None = None,
         bounds: tuple | None = None, rejects_path: str | None = None, batch_id: str | None = None) -> dict:
    """Idempotent load of ``batch`` into the Parquet table at ``target_path``
    (created when absent).

    1. rejects: an earlier ``_reject`` reason, a NULL key or time, a broken rule of ``rules``, a
    time outside ``bounds`` (lo <= ts < hi), a foreign key missing in ``references`` (see
    :func:`voltaic.operators.rules.with_rejects`); kept under ``rejects_path`` when given.
    A load that is retried after it failed between rejects and inserts names its batch both times
    (``batch_id``) and has them stored once
    2. watermark (optional) 3. first-wins dedup 4. skip existing keys.  The batch is evaluated
    once: its rows are staged with their fate, and counts, rejects and inserts all come from
    the staged rows.  The insert is one append job (all-or-nothing commit), clustered on
    (month, sort keys, time) like :func:`layout.prepare_layout`.
    ``watermark_by`` (e.g. ``"sensor_id"``) uses one watermark per key
    instead of the table-wide one: a load that stopped half-way through a
    sensor-major file then resumes the sensors it had not reached, where a
    global watermark would skip them.  It costs an aggregate over the
    target's rows of the batch's keys.
    A table without a time (``ts`` None) has neither watermark nor months.
    Returns counts: read = rejected + late + duplicate + conflict + inserted.
    """
    keys = list(keys)
    target = spark.read.parquet(target_path) if path_exists(spark, target_path) else None
    wm = None
    checked = with_rejects(batch, rules, keys, ts, references, bounds)
    late = F.lit(False)
    if use_watermark and target is not None and watermark_by:
        checked = with_key_watermarks(checked, target, watermark_by, ts)
        late, wm = F.col(ts) <= F.col("_wm"), "per " + watermark_by
    elif use_watermark and ts and target is not None:
        wm = high_watermark(target, ts)
        late = (F.col(ts) <= _at(batch, ts, wm)) if wm is not None else F.lit(False)
    checked = checked.withColumn("_late", F.col(REJECT).isNull() & F.coalesce(late, F.lit(False))).drop("_wm")
    with Scratch(spark) as scratch:
        rows = scratch.put(checked, "load-batch")
        month = F.date_format(F.col(ts), "yyyy-MM") if ts else F.lit(None).cast("string")
        good = F.col(REJECT).isNull() & ~F.col("_late")
        b = rows.agg(F.count(F.lit(1)).alias("read"), F.count(F.col(REJECT)).alias("rejected"),
                     F.count_if("_late").alias("late"), F.min(F.when(good, month)).alias("lo"),
                     F.max(F.when(good, month)).alias("hi"), *span_columns(rows, keys, good)).first()
        live = rows.filter(good).drop(REJECT, "_late", "_raw")
        months = (b["lo"], b["hi"]) if b["lo"] is not None and ts in keys else None
        planned = scratch.put(plan_insert(live, target, keys, order, months, spans_of(b, rows, keys)), "load-plan")
        k = planned.agg(F.count(F.lit(1)).alias("keys"), F.count_if("_exists").alias("conflict")).first()
        n_ins = k["keys"] - k["conflict"]
        if b["rejected"] and rejects_path:
            store_rejects(rows.filter(F.col(REJECT).isNotNull()).drop("_late", order), rejects_path, batch_id)
        if n_ins:
            inserts = planned.filter(~F.col("_exists")).drop("_exists", order)
            if partition_by == "month":
                inserts = prepare_layout(inserts.drop("month"), ts,
                                         [c for c in sort_by if c in inserts.columns])
            elif partition_by and partition_by not in inserts.columns:
                inserts = inserts.withColumn(partition_by, F.date_format(F.col(ts), "yyyy-MM"))
            w = inserts.write.mode("append")
            if partition_by:
                w = w.partitionBy(partition_by)
            w.parquet(target_path)
    return {"read": b["read"], "rejected": b["rejected"], "late": b["late"],
            "duplicate": b["read"] - b["rejected"] - b["late"] - k["keys"],
            "conflict": k["conflict"], "inserted": n_ins, "watermark": wm}


def upsert_table(spark: SparkSession, batch: DataFrame, target_path: str, keys: Sequence[str],
                 update_cols: Sequence[str], order: str, ts: str = "recorded_at",
                 partition_by: str = "month", sort_by: Sequence[str] = ("metric",)) -> int:
    """Upsert ``batch`` into a month-partitioned table (created when absent),
    rewriting only the months the batch touches: stage the batch once, merge,
    stage, then dynamic partition overwrite.  Written rows are clustered on
    (month, sort keys, time) so reads by series and time skip row groups.
    Returns the number of batch keys applied."""
    with Scratch(spark) as scratch:
        b = scratch.put(batch.drop(partition_by) if partition_by in batch.columns else batch, "upsert-batch")
        unkeyed = b.filter(F.concat(*[F.col(k).cast("string") for k in keys]).isNull()).count()
        if unkeyed:
            raise ValueError(f"{unkeyed} rows with a NULL key column; nothing was written")
        cols = [c for c in b.columns if c != order]
        if path_exists(spark, target_path):
            target = spark.read.parquet(target_path)
            touched = target.filter(F.col(partition_by).isin(touched_months(b, ts))).drop(partition_by)
        else:
            touched = spark.createDataFrame([], b.select(*cols).schema)
        merged = scratch.put(upsert(b, touched, keys, update_cols, order), "upsert")
        (prepare_layout(merged, ts, [c for c in sort_by if c in cols]).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(target_path))
        return b.select(*keys).distinct().count()


def range_delete(spark: SparkSession, path: str, ts: str, start, stop,
                 partition_by: str = "month") -> int:
    """DELETE WHERE start <= ts < stop on a month-partitioned table: only the
    touched months are read, filtered and staged.  Months that lose all rows are removed,
    then the others overwritten in one commit; both steps only take away rows of the range, so
    a rerun after a failure in between completes the delete.
    Returns the number of rows deleted."""
    t = spark.read.parquet(path)
    lo, hi = _at(t, ts, start), _at(t, ts, stop)
    months = F.col(partition_by).between(F.date_format(lo, "yyyy-MM"), F.date_format(hi, "yyyy-MM"))
    with Scratch(spark) as scratch:
        touched = t.filter(months)
        before = {r[partition_by]: r["n"] for r in touched.groupBy(partition_by).agg(F.count(F.lit(1)).alias("n")).collect()}
        keep = scratch.put(without_range(touched, ts, lo, hi), "range-delete")
        after = {r[partition_by]: r["n"] for r in keep.groupBy(partition_by).agg(F.count(F.lit(1)).alias("n")).collect()}
        changed = [m for m, n in before.items() if after.get(m, 0) != n]
        gone = [m for m in changed if m not in after]
        kept = [m for m in changed if m in after]
        for m in gone:  # whole months first: a rerun after a failure deletes the rest
            delete_path(spark, f"{path.rstrip('/')}/{partition_by}={m}")
        if kept:
            (keep.filter(F.col(partition_by).isin(kept)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path))
        return sum(before.values()) - sum(after.values())
