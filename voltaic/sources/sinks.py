"""Sinks: timestamped report CSVs, atomic table writes, JSON result rows."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefn import iso8601


def run_stamp(now: _dt.datetime | None = None) -> str:
    """``YYYYMMDD_HHMMSS`` of the run."""
    return (now or _dt.datetime.now()).strftime("%Y%m%d_%H%M%S")


def write_report_csv(df: DataFrame, out_dir: str, name: str, stamp: str | None = None,
                     single_file: bool = False) -> str:
    """Write a report as CSV with header to ``<out_dir>/<name>_<stamp>``.

    ``single_file`` coalesces to one task — only for bounded report outputs
    (aggregates, top-k); leave it off for anything that scales with the data.
    Returns the output directory.
    """
    path = f"{out_dir.rstrip('/')}/{name}_{stamp or run_stamp()}"
    w = df.coalesce(1) if single_file else df
    w.write.mode("errorifexists").option("header", "true").csv(path)
    return path


def commit_report(df: DataFrame, out_dir: str, name: str, stamp: str | None = None, single_file: bool = False) -> tuple[str, int]:
    """Write a report like :func:`write_report_csv`, all or nothing: under a name that readers skip, then
    renamed; a report that fails leaves no folder.  Returns the folder and the number of rows, which
    the writing job itself counts (its last stage counts every task once), so nothing is read again."""
    spark, seen = df.sparkSession, Observation()
    path = f"{out_dir.rstrip('/')}/{name}_{stamp or run_stamp()}"
    part = f"{out_dir.rstrip('/')}/_{name}_{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(hadoop.Path(path)):
        raise FileExistsError(path)
    rows = df.coalesce(1) if single_file else df
    try:
        rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.option("header", "true").csv(part)
        if not fs.rename(hadoop.Path(part), hadoop.Path(path)):
            raise FileExistsError(path)
    finally:
        fs.delete(hadoop.Path(part), True)
    return path, int(seen.get["rows"])


def json_ready(df: DataFrame) -> DataFrame:
    """Decimals -> double, timestamps -> ISO-8601 text (API row format)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            c = iso8601(c, with_offset=True)
        elif isinstance(f.dataType, T.TimestampNTZType):
            c = iso8601(c)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def json_envelope(df: DataFrame, params: dict, rows_key: str = "rows",
                  order_by: list | None = None) -> DataFrame:
    """``{<params>, "count": n, <rows_key>: [...]}`` as one JSON string.

    Only for bounded results (the API's limit is at most 1000 rows): the
    rows are gathered into one array.  ``order_by`` keeps the result order.
    """
    r = json_ready(df)
    cols = r.columns
    order = order_by or []
    st = F.struct(*[F.col(c) for c in cols])
    if order:
        keyed = r.select(F.struct(*order).alias("_k"), st.alias("_r"))
        arr = F.transform(F.array_sort(F.collect_list(F.struct("_k", "_r"))), lambda x: x["_r"])
    else:
        keyed = r.select(st.alias("_r"))
        arr = F.collect_list("_r")
    body = keyed.agg(F.count(F.lit(1)).alias("count"), arr.alias(rows_key))
    fields = [(F.lit(v) if v is not None else F.lit(None).cast("string")).alias(k)
              for k, v in params.items()]
    return body.select(F.to_json(F.struct(*fields, "count", rows_key)).alias("json"))
