"""Storage layout: month partitions, range routing, pruned range reads,
verified copy-and-swap.

The reference range-partitions readings by month and indexes
(sensor_id, recorded_at).  Spark has no indexes; the equivalent is a
``month=`` directory per month (partition pruning) with files sorted by
(sensor_id, recorded_at), so Parquet row-group min/max statistics skip
everything but the wanted sensor's rows (PushedFilters).
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .stage import Scratch

MONTH = "month"


def month_key(v) -> str:
    """'yyyy-MM' of a datetime or ISO text."""
    d = v if isinstance(v, (_dt.datetime, _dt.date)) else _dt.datetime.fromisoformat(str(v))
    return f"{d.year:04d}-{d.month:02d}"


def with_month(df: DataFrame, ts: str = "recorded_at", col: str = MONTH) -> DataFrame:
    return df.withColumn(col, F.date_format(F.col(ts), "yyyy-MM"))


def touched_months(df: DataFrame, ts: str = "recorded_at") -> list[str]:
    """Distinct months present in ``df`` (a calendar-bounded list)."""
    return sorted(r[0] for r in df.select(F.date_format(F.col(ts), "yyyy-MM")).distinct().collect())


def prepare_layout(df: DataFrame, ts: str = "recorded_at",
                   sort_by: Sequence[str] = ("sensor_id",), partitions: int | None = None
                   ) -> DataFrame:
    """Add the month column and cluster rows for writing.

    Range partitioning on (month, sort keys, ts) gives balanced tasks that
    each cover a slice of one month — not one task per month, which would
    put a whole month (or a hot month) into a single task — and every file
    is sorted, so row-group statistics are tight.
    """
    d = with_month(df, ts)
    order = [MONTH, *sort_by, ts]
    d = d.repartitionByRange(partitions, *order) if partitions else d.repartitionByRange(*order)
    return d.sortWithinPartitions(*order)


def write_layout(df: DataFrame, path: str, ts: str = "recorded_at",
                 sort_by: Sequence[str] = ("sensor_id",), partitions: int | None = None,
                 mode: str = "errorifexists") -> None:
    prepare_layout(df, ts, sort_by, partitions).write.mode(mode).partitionBy(MONTH).parquet(path)


def route(df: DataFrame, lo, hi, ts: str = "recorded_at") -> DataFrame:
    """Tag rows with ``accepted``: lo <= ts < hi (the declared partition range;
    there is no default partition, so anything else is rejected)."""
    c = F.col(ts)
    return df.withColumn("accepted", (c >= F.lit(lo)) & (c < F.lit(hi)) & c.isNotNull())


def split_route(df: DataFrame, lo, hi, ts: str = "recorded_at") -> tuple[DataFrame, DataFrame]:
    r = route(df, lo, hi, ts)
    return (r.filter("accepted").drop("accepted"), r.filter(~F.col("accepted")).drop("accepted"))


def month_range_filter(start, stop, col: str = MONTH):
    """Partition predicate implied by a time range (Spark does not derive it)."""
    return F.col(col).between(F.lit(month_key(start)), F.lit(month_key(stop)))


def range_read(spark: SparkSession, path: str, sensor_id, start, stop,
               ts: str = "recorded_at", schema=None) -> DataFrame:
    """sensor_id = x AND ts BETWEEN start AND stop on the month layout:
    the month predicate prunes directories, the rest is pushed into the
    Parquet scan.  ``schema`` (data columns + ``month string``) spares the
    footer read at plan time."""
    t = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    return t.filter(month_range_filter(start, stop)
                    & (F.col("sensor_id") == F.lit(sensor_id))
                    & F.col(ts).between(F.lit(start).cast("timestamp_ntz")
                                        if isinstance(start, str) else F.lit(start),
                                        F.lit(stop).cast("timestamp_ntz")
                                        if isinstance(stop, str) else F.lit(stop)))


def _canonical_text(df: DataFrame, cols: Sequence[str]):
    """One text per row that another engine can rebuild exactly: columns in
    name order joined by '|', NULL as \\N, timestamps with six fractional
    digits, numbers as DECIMAL(38,10)."""
    types = dict(df.dtypes)
    parts = []
    for c in cols:
        t, col = types[c], F.col(c)
        if t.startswith("timestamp"):
            txt = F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif t in ("double", "float") or t.startswith("decimal"):
            txt = col.try_cast("decimal(38,10)").cast("string")
        else:
            txt = col.cast("string")
        parts.append(F.coalesce(txt, F.lit("\\N")))
    return F.concat_ws("|", *parts)


def fingerprint(df: DataFrame, ts: str = "recorded_at", exclude: Sequence[str] = (MONTH,),
                portable: bool = False) -> DataFrame:
    """Per-month row count and an order-free content hash (sum of row hashes
    as an exact decimal).  Columns: month, n_rows, content_hash.

    ``portable`` hashes a canonical text of each row with MD5 (first 60
    bits), which another engine can reproduce — e.g. the source database of
    a migration; the default xxhash64 is faster but Spark-specific."""
    cols = sorted(c for c in df.columns if c not in exclude)
    if portable:
        h = F.conv(F.substring(F.md5(_canonical_text(df, cols)), 1, 15), 16, 10)
        h = h.cast("decimal(38,0)")
    else:
        h = F.xxhash64(*[F.col(c) for c in cols]).cast("decimal(38,0)")
    return (df.groupBy(F.date_format(F.col(ts), "yyyy-MM").alias("month"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                 F.sum(h).cast("string").alias("content_hash")))


def compare_fingerprints(a: DataFrame, b: DataFrame) -> DataFrame:
    """Months whose count or hash differ (full outer on month)."""
    x = a.withColumnRenamed("n_rows", "n_old").withColumnRenamed("content_hash", "h_old")
    y = b.withColumnRenamed("n_rows", "n_new").withColumnRenamed("content_hash", "h_new")
    j = x.join(y, "month", "full_outer")
    return j.filter(~(F.col("n_old").eqNullSafe(F.col("n_new"))
                      & F.col("h_old").eqNullSafe(F.col("h_new"))))


def verified_rewrite(spark: SparkSession, src_path: str, dst_path: str, pointer: str | None = None,
                     ts: str = "recorded_at", sort_by: Sequence[str] = ("sensor_id",)) -> dict:
    """Copy ``src_path`` into the month layout at ``dst_path``; switch to the
    copy only when per-month counts and content hashes agree.

    Old and new are scanned once each: both fingerprints are staged.  The source is kept.
    ``pointer`` names a small file that says which copy is current (see :func:`current_copy`);
    it is replaced in one rename when the copy is accepted.
    Returns {ok, old_rows, new_rows, mismatched_months}.
    """
    src = spark.read.parquet(src_path)
    write_layout(src, dst_path, ts, sort_by)
    with Scratch(spark) as scratch:
        fo = scratch.put(fingerprint(src, ts), "fingerprint-old")
        fn = scratch.put(fingerprint(spark.read.parquet(dst_path), ts), "fingerprint-new")
        bad = [r["month"] for r in compare_fingerprints(fo, fn).select("month").collect()]  # a row per month at most
        old_rows, new_rows = (f.agg(F.sum("n_rows")).first()[0] or 0 for f in (fo, fn))
    ok = not bad and old_rows == new_rows
    if ok and pointer:
        point_to(spark, pointer, dst_path)
    return {"ok": ok, "old_rows": int(old_rows), "new_rows": int(new_rows), "mismatched_months": bad}


def point_to(spark: SparkSession, pointer: str, path: str) -> None:
    """Make ``path`` the current copy: written beside the pointer, then renamed over it."""
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    conf = sc._jsc.hadoopConfiguration()
    target, fresh = hadoop.Path(pointer), hadoop.Path(f"{pointer}.{uuid.uuid4().hex}")
    files = hadoop.FileContext.getFileContext(target.getFileSystem(conf).getUri(), conf)
    out = fresh.getFileSystem(conf).create(fresh)
    out.write(bytearray(path.encode()))
    out.close()
    rename = sc._gateway.new_array(hadoop.Options.Rename, 1)
    rename[0] = hadoop.Options.Rename.OVERWRITE
    files.rename(fresh, target, rename)


def current_copy(spark: SparkSession, pointer: str) -> str:
    """The path that a pointer names."""
    return spark.read.text(pointer, wholetext=True).first()[0]


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, by: str = "sensor_id", sort_by: Sequence[str] = ()) -> None:
    """A catalog table at ``path`` whose files are dealt by a hash of ``by`` and sorted.

    Joins with a table bucketed alike, and windows or aggregates by ``by``, then need no shuffle of
    these rows.  Rows are dealt once here, so that each bucket is one file; a sensor that holds a
    third of all rows makes one large file, which is why the month layout stays the default and
    this one is for narrow, evenly spread keys or repeated joins."""
    (df.repartition(buckets, by).write.format("parquet").option("path", path).bucketBy(buckets, by)
     .sortBy(by, *sort_by).saveAsTable(table))
