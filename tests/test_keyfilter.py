"""The key filter: rows cut before the shuffle, no key lost, answers unchanged with a full filter."""

import re

import pytest
from pyspark.sql import functions as F

from voltaic.operators import keyfilter, load

KEYS = ["reading_id", "recorded_at"]


@pytest.fixture(scope="module")
def tables(spark):
    row = lambda df: df.select((F.col("id")).alias("reading_id"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60).alias("recorded_at"),
                               (F.col("id") % 7).alias("sensor_id"), F.col("id").cast("double").alias("value"))
    target = row(spark.range(0, 50_000, 1, 8))
    batch = row(spark.range(49_900, 50_200, 1, 4)).withColumn("_ord", F.col("reading_id"))
    return target, batch.unionByName(batch.withColumn("_ord", F.col("_ord") + 1_000_000))


@pytest.mark.parametrize("bits", [64, 128, 4096, keyfilter.FILTER_BITS])
def test_no_key_is_lost_and_few_others_pass(spark, tables, bits):
    target, batch = tables
    kept = keyfilter.may_hold(target, batch, KEYS, bits)
    assert kept.columns == target.columns
    assert kept.where("reading_id >= 49900").count() == 100
    others = kept.where("reading_id < 49900").count()
    assert others <= 49_900 * min(1, 3 * 300 / bits) and (bits > 128 or others > 40_000)
    got = load.insert_if_absent(batch, target, KEYS, "_ord", filter_bits=bits)
    assert sorted(r["reading_id"] for r in got.collect()) == list(range(50_000, 50_200))


def test_the_filter_is_bounded(spark):
    many = spark.range(100_000).select(F.col("id").alias("k"))
    words = keyfilter.key_words(many, ["k"], 1024)
    assert words.count() <= 16 and keyfilter.key_words(many.limit(5), ["k"]).count() <= 5


def test_target_rows_are_cut_before_the_shuffle(spark, tables):
    """In the plan that ran, the target's side of the anti-join shuffled the batch's keys, not the table."""
    target, batch = tables
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ins = load.insert_if_absent(batch, target, KEYS, "_ord")
        ins.collect()
        plan = ins._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    right = plan[plan.index("LeftAnti"):]
    assert re.search(r"Exchange hashpartitioning\(reading_id.*?BroadcastHashJoin \[_word", right, re.S), plan


def test_keys_of_other_types_and_nulls(spark):
    target = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "k int, t string")
    batch = spark.createDataFrame([(1, "a", 1), (2, None, 2), (None, "c", 3), (9, "z", 4)], "k long, t string, o long")
    assert keyfilter.may_hold(target, batch, ["k", "t"]).count() == 3
    got = load.insert_if_absent(batch, target, ["k", "t"], "o").collect()  # a NULL equals nothing
    assert len(got) == 3 and (1, "a") not in [tuple(r) for r in got]
    assert keyfilter.may_hold(target, batch.limit(0), ["k", "t"]).count() == 0


def test_spans_reach_the_scan(spark, tables, tmp_dir):
    target, batch = tables
    target.write.parquet(f"{tmp_dir}/t")
    row = batch.agg(*keyfilter.span_columns(batch, KEYS, F.lit(True))).first()
    spans = keyfilter.spans_of(row, batch, KEYS)
    cut = keyfilter.within(spark.read.parquet(f"{tmp_dir}/t"), spans)
    assert cut.count() == 100
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        plan = cut.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(reading_id,49900)" in plan and "LessThanOrEqual(recorded_at" in plan
    none = batch.limit(0)
    assert keyfilter.spans_of(none.agg(*keyfilter.span_columns(none, KEYS, F.lit(True))).first(), none, KEYS) == {}


def test_loads_agree_with_and_without_spans(spark, tables, tmp_dir):
    target, batch = tables
    first = target.withColumn("_ord", F.col("reading_id"))
    load.load(spark, first, f"{tmp_dir}/t", KEYS, "_ord")
    got = load.load(spark, batch, f"{tmp_dir}/t", KEYS, "_ord", use_watermark=False)
    assert (got["duplicate"], got["conflict"], got["inserted"]) == (300, 100, 200)
    again = load.load(spark, batch, f"{tmp_dir}/t", KEYS, "_ord", use_watermark=False)
    assert (again["conflict"], again["inserted"]) == (300, 0)
