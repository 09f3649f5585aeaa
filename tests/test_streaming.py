"""Incremental micro-batch loads of arriving CSV files."""

import datetime as dt
import os

from pyspark.sql import types as T

from voltaic.streaming.incremental import incremental_load

SCHEMA = T.StructType([
    T.StructField("reading_id", T.LongType()), T.StructField("sensor_id", T.LongType()),
    T.StructField("recorded_at", T.TimestampNTZType()), T.StructField("value", T.DoubleType()),
    T.StructField("is_anomaly", T.BooleanType())])


def _write(path, start, n):
    with open(path, "w") as fh:
        fh.write("reading_id,sensor_id,recorded_at,value,is_anomaly\n")
        t0 = dt.datetime(2024, 1, 1)
        for i in range(start, start + n):
            ts = (t0 + dt.timedelta(minutes=5 * i)).strftime("%Y-%m-%d %H:%M:%S")
            fh.write(f"{i},{1 + i % 3},{ts},{i * 0.5},false\n")


def test_incremental_stream_is_idempotent(spark, tmp_dir):
    src, target = f"{tmp_dir}/in", f"{tmp_dir}/readings"
    os.makedirs(src)
    _write(f"{src}/part1.csv", 0, 50)
    results = []
    q = incremental_load(spark, src, SCHEMA, target, ["reading_id", "recorded_at"],
                         checkpoint=f"{tmp_dir}/ck", results=results)
    q.awaitTermination(120)
    assert spark.read.parquet(target).count() == 50
    # a new file that repeats 10 old rows and adds 20 new ones
    _write(f"{src}/part2.csv", 40, 30)
    q = incremental_load(spark, src, SCHEMA, target, ["reading_id", "recorded_at"], order_within_file="reading_id",
                         checkpoint=f"{tmp_dir}/ck", results=results)
    q.awaitTermination(120)
    assert spark.read.parquet(target).count() == 70
    assert results[-1]["inserted"] == 20 and results[-1]["late"] == 10
