"""Incremental loads with state: order of arrival, replays, refused rows, empty runs."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from voltaic.streaming import stateful

SCHEMA = "reading_id long, sensor_id long, recorded_at timestamp, value double"
T0 = dt.datetime(2024, 1, 30)


def at(h):
    return T0 + dt.timedelta(hours=h)


class Feed:
    """A source folder, and runs over it."""

    def __init__(self, spark, folder, **more):
        self.spark, self.folder, self.more = spark, folder, more
        self.schema = spark.createDataFrame([], SCHEMA).schema
        self.n = 0

    def send(self, rows):
        self.n += 1
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.option("header", "true").csv(f"{self.folder}/in/f{self.n}")

    def run(self):
        out = []
        q = stateful.watermarked_load(self.spark, f"{self.folder}/in", self.schema, f"{self.folder}/table", ["reading_id", "recorded_at"],
                                      f"{self.folder}/state", f"{self.folder}/ckpt", results=out, rejects=f"{self.folder}/rejects", **self.more)
        q.awaitTermination()
        return [{k: v for k, v in r.items() if k != "epoch"} for r in out if r["read"]]

    def table(self):
        return sorted(tuple(r) for r in self.spark.read.parquet(f"{self.folder}/table").select("reading_id", "sensor_id", "value").collect())

    def high(self):
        return {r["sensor_id"]: r["high"] for r in stateful.watermarks(self.spark, f"{self.folder}/state").collect()}


def counts(read, late=0, duplicate=0, inserted=0, rejected=0):
    return {"read": read, "rejected": rejected, "late": late, "duplicate": duplicate, "inserted": inserted}


def test_a_sensor_ahead_does_not_hold_others_back(spark, tmp_dir):
    f = Feed(spark, tmp_dir)
    f.send([(1, 1, at(0), 1.0), (2, 1, at(100), 2.0)])
    assert f.run() == [counts(2, inserted=2)]
    f.send([(3, 2, at(5), 3.0), (4, 1, at(50), 4.0), (2, 1, at(100), 9.0)])
    assert f.run() == [counts(3, late=2, inserted=1)]
    assert f.table() == [(1, 1, 1.0), (2, 1, 2.0), (3, 2, 3.0)]
    assert f.high() == {1: at(100), 2: at(5)}


def test_first_row_of_a_key_and_refused_rows(spark, tmp_dir):
    f = Feed(spark, tmp_dir, bounds=("2024-01-30", "2024-02-01"))
    f.send([(1, 1, at(0), 1.0), (1, 1, at(0), 2.0), (None, 1, at(1), 3.0), (4, None, at(1), 4.0), (5, 1, None, 5.0), (6, 1, at(48), 6.0)])
    assert f.run() == [counts(6, duplicate=1, inserted=1, rejected=4)]
    assert f.table() == [(1, 1, 1.0)]
    why = sorted(r["_reject"] for r in spark.read.parquet(f"{tmp_dir}/rejects").collect())
    assert why == ["missing reading_id", "missing recorded_at", "missing sensor_id", "outside the range recorded_at"]


@pytest.mark.parametrize("lost", ["commit", "state", "data"])
def test_a_replayed_batch_changes_nothing(spark, tmp_dir, lost):
    f = Feed(spark, tmp_dir)
    f.send([(k, k % 3, at(k), float(k)) for k in range(30)])
    f.run()
    f.send([(k, k % 3, at(k), float(k)) for k in range(20, 50)] + [(5, 0, None, 0.0)])
    once = f.run()
    table, high = f.table(), f.high()
    assert once == [counts(31, late=10, inserted=20, rejected=1)]
    if lost == "state":  # stopped after the data, before the watermarks were complete
        os.remove(f"{tmp_dir}/state/v=1/_SUCCESS")
    if lost == "data":  # stopped while the data was written
        part = next(os.path.join(d, n) for d, _, ns in os.walk(f"{tmp_dir}/table") for n in ns if "epoch=1" in d and n.endswith(".parquet"))
        os.remove(part)
    stateful.forget_commit(spark, f"{tmp_dir}/ckpt", 1)
    assert f.run() == once and f.table() == table and f.high() == high
    assert spark.read.parquet(f"{tmp_dir}/rejects").count() == 1
    assert f.run() == []


def test_one_file_a_batch_equals_one_batch(spark, tmp_dir):
    rows = [[(k, k % 4, at(k * 7 % 90), float(k)) for k in range(n, n + 25)] for n in (0, 25, 50)]
    f = Feed(spark, tmp_dir, max_files=1)
    for r in rows:
        f.send(r)
    got = f.run()
    assert len(got) == 3 and sum(r["inserted"] for r in got) == len(f.table())
    high, want = {}, []
    for r in rows:  # a sensor's mark moves after each batch
        new = [x for x in r if x[1] not in high or x[2] > high[x[1]]]
        want += [(x[0], x[1], x[3]) for x in new]
        for x in new:
            high[x[1]] = max(high.get(x[1], x[2]), x[2])
    assert f.table() == sorted(want) and f.high() == high


def test_keys_in_state(spark, tmp_dir):
    schema = spark.createDataFrame([], SCHEMA).schema

    def run(rows, n):
        spark.createDataFrame(rows, schema).coalesce(1).write.option("header", "true").csv(f"{tmp_dir}/in/f{n}")
        q = stateful.deduplicated_load(spark, f"{tmp_dir}/in", schema, f"{tmp_dir}/table", ["reading_id", "recorded_at"], f"{tmp_dir}/ckpt", "10 days")
        q.awaitTermination()
        return stateful.late_rows(q)

    assert run([(1, 1, at(0), 1.0), (1, 1, at(0), 1.0), (2, 1, at(200), 2.0)], 1) == 0
    assert run([(1, 1, at(0), 1.0), (3, 2, at(-20), 3.0)], 2) == 0
    assert run([(4, 2, at(-2000), 4.0), (2, 1, at(200), 2.0)], 3) == 1  # too far behind: counted, not stored
    t = spark.read.parquet(f"{tmp_dir}/table")
    assert sorted(r["reading_id"] for r in t.collect()) == [1, 2, 3]
    assert t.where(F.col("month") == "2024-01").count() == 2
