"""Default columns on scan and additive schema evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Add each absent column as a literal default.

    Only *absent* columns are filled: an explicit NULL in a present column
    stays NULL (a column DEFAULT applies when the value is not supplied).
    """
    for name, value in defaults.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(value))
    return df


def add_column(spark: SparkSession, table: str, name: str, kind: str, default: str) -> None:
    """ADD COLUMN IF NOT EXISTS ... DEFAULT on a catalog table of Parquet files.

    No file is rewritten: the catalog keeps the default as the column's existence default, which readers
    give to rows of files without the column.  Later rows get it where the column is not given; a NULL
    that is given stays.  ``default`` is a SQL literal."""
    if name.lower() not in (c.lower() for c in spark.table(table).columns):
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS (`{name}` {kind} DEFAULT {default})")


def create_table(df: DataFrame, table: str, path: str) -> None:
    """A catalog table of Parquet files at ``path`` with the columns of ``df``, and its rows."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    df.sparkSession.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{path}'")
    df.write.insertInto(table)


def evolve_union(old: DataFrame, new: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Union of data written before and after ``ADD COLUMN ... DEFAULT``.

    Rows of the old layout get the default for the added columns; rows of the
    new layout keep their own values.  Columns are matched by name.
    """
    return with_defaults(old, defaults).unionByName(new, allowMissingColumns=True)
