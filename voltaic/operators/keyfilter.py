"""Cut a large table down to the keys that a small batch may hold, before any shuffle.

Two filters, both in the JVM and neither changing an answer:

* spans: the batch's least and greatest value of every key column, as literals.  They are pushed
  into the Parquet scan, where row groups and pages outside are skipped;
* a Bloom filter with one hash per key: the 64-bit words of a bit array, made from the batch by a
  partial ``bit_or`` and broadcast.  Only words that have a bit set exist, so the filter has at most
  ``min(keys of the batch, bits / 64)`` rows: with FILTER_BITS that is 2^20 rows of two longs,
  whatever the batch holds.  A key of the batch always passes; of the others about
  ``keys / bits`` pass and are told apart by the join that follows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a filter: at most 2^20 words, about 32 MB when broadcast.
FILTER_BITS = 1 << 26


def _place(df: DataFrame, keys: Sequence[str], types: Mapping, bits: int) -> Column:
    """Number of the key's bit.  Keys hash as the batch's types, so both sides agree."""
    return F.pmod(F.xxhash64(*[F.col(k).cast(types[k]) for k in keys]), F.lit(bits))


def key_words(batch: DataFrame, keys: Sequence[str], bits: int = FILTER_BITS) -> DataFrame:
    """The Bloom filter of the batch's keys: _word, _bits."""
    types = {k: batch.schema[k].dataType for k in keys}
    place = batch.select(_place(batch, keys, types, bits).alias("_place"))
    return place.groupBy(F.shiftright("_place", 6).alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(_place & 63 AS INT))")).alias("_bits"))


def may_hold(table: DataFrame, batch: DataFrame, keys: Sequence[str], bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``table`` whose key the batch may hold: all of its keys' rows and a few others.

    A NULL key column hashes like any value, and the join that follows decides what equals what.
    ``bits`` is a multiple of 64.
    """
    keys, types = list(keys), {k: batch.schema[k].dataType for k in keys}
    words = F.broadcast(key_words(batch, keys, bits))  # at most bits / 64 rows
    placed = table.withColumn("_place", _place(table, keys, types, bits)).withColumn("_word", F.shiftright("_place", 6))
    hit = F.getbit("_bits", (F.col("_place").bitwiseAND(F.lit(63))).cast("int")) == 1
    return placed.join(words, "_word").where(hit).select(*table.columns)


def _ordered(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """Key columns whose span can be pushed down; texts are left out (their literals may be long)."""
    plain = ("byte", "short", "integer", "long", "date", "timestamp", "timestamp_ntz", "decimal")
    return [k for k in keys if df.schema[k].dataType.typeName() in plain]


def span_columns(df: DataFrame, keys: Sequence[str], where: Column) -> list[Column]:
    """Aggregates for :func:`spans_of`, as text in the session's zone."""
    return [f(F.when(where, F.col(k))).cast("string").alias(f"{n}_{k}") for k in _ordered(df, keys) for n, f in (("lo", F.min), ("hi", F.max))]


def spans_of(row, df: DataFrame, keys: Sequence[str]) -> dict[str, tuple[str, str, object]]:
    """Column -> (least, greatest, type) from a row with :func:`span_columns`."""
    return {k: (row[f"lo_{k}"], row[f"hi_{k}"], df.schema[k].dataType) for k in _ordered(df, keys) if row[f"lo_{k}"] is not None}


def within(table: DataFrame, spans: Mapping[str, tuple]) -> DataFrame:
    """The rows of ``table`` inside every span."""
    for k, (lo, hi, kind) in spans.items():
        if table.schema[k].dataType == kind:
            table = table.where(F.col(k).between(F.lit(lo).cast(kind), F.lit(hi).cast(kind)))
    return table
