"""The lookup layout: right rows, and fewer of them read than stored."""

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from voltaic.operators import lookup

N, SENSORS = 400_000, 400


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lookup")) + "/t"
    seconds = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(60 * 86_400))
    rows = spark.range(0, N, 1, 8).select(
        F.col("id").alias("reading_id"), (F.pmod(F.xxhash64("id"), F.lit(SENSORS)) * 2).alias("sensor_id"),
        F.timestamp_seconds(F.lit(1_704_067_200) + seconds).cast("timestamp_ntz").alias("recorded_at"), F.col("id").cast("double").alias("value"))
    for k in range(5):  # loads that all span all sensors and times: 100 files and more
        lookup.write_lookup(rows.where(F.col("reading_id") % 5 == k), path, row_group_bytes=1 << 16, partitions=12)
    return path, rows.cache()


CASES = [({"sensors": [100]}, 0.2), ({"sensors": [101]}, 0.0), ({"sensors": [100], "start": "2024-01-05", "stop": "2024-01-06"}, 0.08),
         ({"start": "2024-01-20 10:00:00", "stop": "2024-01-20 10:59:59"}, 0.35), ({"start": "2024-03-20"}, 0.0),
         ({"sensors": [2, 4], "stop": "2024-01-02"}, 0.1)]


@pytest.mark.parametrize("asked,most", CASES)
def test_rows_and_rows_read(spark, stored, asked, most):
    path, rows = stored
    want = rows
    if "sensors" in asked:
        want = want.where(F.col("sensor_id").isin(asked["sensors"]))
    for k, op in (("start", ">="), ("stop", "<=")):
        if k in asked:
            want = want.where(f"recorded_at {op} timestamp_ntz'{asked[k]}'")
    found = lookup.lookup(spark, path, **asked)
    assert sorted(r["reading_id"] for r in found.collect()) == sorted(r["reading_id"] for r in want.collect())
    assert lookup.rows_scanned(found) <= most * N, (lookup.rows_scanned(found), N)


def test_files_have_filters(stored):
    path, _ = stored
    files = glob.glob(f"{path}/month=*/*.parquet")
    groups = [pq.ParquetFile(f).metadata for f in files]
    assert len(files) >= 60 and sum(g.num_row_groups for g in groups) >= 100


def test_the_curve():
    def z(a, b):
        return sum((a >> k & 1) << 2 * k | (b >> k & 1) << 2 * k + 1 for k in range(16))
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    pairs = [(0, 0), (1, 0), (0, 1), (65535, 65535), (12345, 54321), (40000, 3)]
    got = spark.createDataFrame(pairs, "a int, b int").select("a", "b", lookup.curve(F.col("a"), F.col("b")).alias("z")).collect()
    assert {(r["a"], r["b"]): r["z"] for r in got} == {p: z(*p) for p in pairs}


def test_edges(spark, tmp_dir):
    t = dt.datetime(2024, 2, 29, 23, 59, 59, 999_999)
    schema = "reading_id long, sensor_id long, recorded_at timestamp"
    lookup.write_lookup(spark.createDataFrame([(1, None, t), (2, 7, None), (3, 7, t)], schema), f"{tmp_dir}/t")
    found = lambda **a: sorted(r["reading_id"] for r in lookup.lookup(spark, f"{tmp_dir}/t", **a).collect())
    assert found() == [1, 2, 3] and found(sensors=[7]) == [2, 3] and found(sensors=[]) == []
    assert found(start="2024-02-29 23:59:59.999999") == [1, 3] and found(stop="2024-02-29 23:59:59.999998") == []
    assert lookup.sensor_ranks(spark.createDataFrame([], schema)) == []
