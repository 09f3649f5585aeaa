"""Typed CSV scans.

One DataFrame scan replaces the reference's 5,000-row chunk loop: the file
is split across tasks, each task streams its split, and memory per task is
bounded by the reader's batch, not the file.  The schema is always declared
(never inferred); malformed rows are kept aside in a corrupt-record column
instead of failing the load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType,
                   timestamp_format: str | None = None, keep_corrupt: bool = True,
                   header: bool = True) -> DataFrame:
    """Read CSV with a declared schema; per-field parsing is the cast.

    Timestamps without an offset are read in the session zone (UTC).  With
    ``keep_corrupt`` rows that do not parse are kept with all fields NULL and
    the raw line in ``_corrupt_record`` (split them off with
    :func:`split_corrupt`).  Empty fields are NULL, never NaN.
    """
    fields = list(schema.fields)
    if keep_corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType(), True))
    r = (spark.read.schema(T.StructType(fields))
         .option("header", str(header).lower())
         .option("mode", "PERMISSIVE")
         .option("nullValue", "")
         .option("nanValue", "NaN"))
    if keep_corrupt:
        r = r.option("columnNameOfCorruptRecord", CORRUPT)
    if timestamp_format:
        r = r.option("timestampFormat", timestamp_format)
    return r.csv(path)


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """Typed rows of a CSV, none left out: the declared columns, ``_reject`` and ``_raw``.

    Every field is read as text and cast on its own.  ``_reject`` is NULL for a good row, else
    ``malformed line`` (wrong number of fields), ``bad <field>`` (text that does not fit the
    type) or ``missing <field>`` (empty but NOT NULL), the first that holds in column order;
    ``_raw`` has the row's text as JSON then.  Which rows are rejected does not depend on
    the columns that a later step selects.
    """
    text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields]
                        + [T.StructField(CORRUPT, T.StringType(), True)])
    raw = (spark.read.schema(text).option("header", str(header).lower()).option("mode", "PERMISSIVE")
           .option("nullValue", "").option("columnPruning", "false")
           .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    typed = {f.name: F.trim(F.col(f.name)).try_cast(f.dataType) for f in schema.fields}
    reasons = [F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed line"))]
    for f in schema.fields:
        reasons.append(F.when(F.col(f.name).isNotNull() & typed[f.name].isNull(), F.lit(f"bad {f.name}")))
        if not f.nullable:
            reasons.append(F.when(F.col(f.name).isNull(), F.lit(f"missing {f.name}")))
    reject = F.coalesce(*reasons)
    kept = F.to_json(F.struct(*[F.col(f.name) for f in schema.fields], F.col(CORRUPT).alias("line")))
    return raw.select(*[c.alias(n) for n, c in typed.items()], reject.alias("_reject"),
                      F.when(reject.isNotNull(), kept).alias("_raw"), input_order().alias("_ord"))


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, corrupt rows) of :func:`read_csv_typed`.

    For a load use :func:`read_csv_checked`: the CSV reader parses only the fields that a
    query needs, so which rows count as corrupt here depends on the columns selected."""
    if CORRUPT not in df.columns:
        return df, df.limit(0)
    bad = F.col(CORRUPT).isNotNull()
    return df.filter(~bad).drop(CORRUPT), df.filter(bad)


def input_order() -> Column:
    """Input order of rows straight off a file scan (apply before any shuffle):
    file path, split offset within the file, then the row's position within
    its split (``monotonically_increasing_id`` grows along a split)."""
    return F.struct(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"))
