"""Materialise an intermediate result in the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import scratch_path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    * cuts the lineage: a lost executor re-reads the staged files instead of
      recomputing the plan that produced them;
    * gives the optimizer the real size of the result (file size), so a
      small aggregate can be broadcast on a proven bound;
    * lets a plan that reads a table be written back over that table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


class Scratch:
    """Staged results of one operation, deleted when it ends (also on failure).

    ``with Scratch(spark) as scratch: df = scratch.put(df, "name")``.  For operations that
    finish their own actions; a lazy result needs :func:`stage`.
    """

    def __init__(self, spark):
        self.spark, self.paths = spark, []

    def __enter__(self):
        return self

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def __exit__(self, *_):
        sc = self.spark.sparkContext
        for path in self.paths:
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
