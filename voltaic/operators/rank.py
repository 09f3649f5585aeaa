"""Whole-set ranking without a single-partition window.

RANK / NTILE / PERCENT_RANK over an entire frame are normally windows with
no PARTITION BY, so every row goes to one task.  Here the same numbers are
computed distributed:

1. stage the rows (range partitioning samples its input, which would evaluate
   the plan before it twice), range-partition them on (value, tie breaker) into as many
   parts as ROWS_PER_PART asks for and stage them with their part's number; rows of one value may
   spread over many parts, so a hot value (or many NULLs) is no single task.  Rows that
   are one part need no second copy;
2. count rows per (partition, group) and sum the counts of the partitions
   before, which gives start offsets;
3. number the rows inside each partition and add the offset: the row number
   over the whole set, and within each group;
4. a value's RANK is its smallest row number: one aggregate per value,
   combined before the shuffle and joined back NULL-safely.

Ordering: value DESC NULLS FIRST (PostgreSQL's DESC), ties broken by
``tie_breaker`` for NTILE; PERCENT_RANK uses value ASC NULLS LAST.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .stage import stage

#: Rows of one part, about; one task sorts a part.
ROWS_PER_PART = 250_000


def distributed_ranks(df: DataFrame, value: str, tie_breaker: str, group: str | None = None,
                      tiles: int = 4, partitions: int | None = None) -> DataFrame:
    """Adds ``_rank`` (global RANK, value DESC NULLS FIRST), ``_rank_in_group``
    (RANK within ``group``, when one is given; NULL is a group of its own), ``_tile``
    (NTILE(``tiles``) over value DESC NULLS FIRST, ``tie_breaker``) and
    ``_pct_rank`` (PERCENT_RANK over value ASC NULLS LAST)."""
    order = [F.col(value).desc_nulls_first(), F.col(tie_breaker).asc_nulls_first()]
    df = stage(df.withColumn("_pid", F.lit(0)), "rank-input")  # stored, as a join on a literal has no key
    totals = df.agg(F.count(F.lit(1)).alias("n"), F.count(F.col(value)).alias("valid")).first()
    n_total, n_valid = totals["n"], totals["valid"]
    parts = partitions or max(1, -(-n_total // ROWS_PER_PART))
    rows = (stage(df.repartitionByRange(parts, *order).withColumn("_pid", F.spark_partition_id()), "rank-ranged") if parts > 1
            else df)

    def numbered_from(counts, by):
        """Rows before every partition, of the same group where there is one: a window over one
        row for each partition (and group)."""
        upto = (Window.partitionBy(*by) if by else Window).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
        return counts.select("_pid", *by, F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_at"))

    start = numbered_from(rows.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")), [])
    numbered = (rows.join(start, "_pid")
                .withColumn("_rn", F.col("_at") + F.row_number().over(Window.partitionBy("_pid").orderBy(*order))).drop("_at"))
    first = numbered.groupBy(F.col(value).alias("_v")).agg(F.min("_rn").alias("_rank"), F.count(F.lit(1)).alias("_ties"))
    ranked = numbered.join(first, F.col(value).eqNullSafe(F.col("_v"))).drop("_v")
    if group is not None:
        start_g = (numbered_from(rows.groupBy("_pid", F.col(group).alias("_g")).agg(F.count(F.lit(1)).alias("_n")), ["_g"])
                   .withColumnRenamed("_pid", "_p"))
        in_group = (rows.select("_pid", F.col(value).alias("_v"), F.col(group).alias("_h"), F.col(tie_breaker).alias("_t"))
                    .join(start_g, (F.col("_pid") == F.col("_p")) & F.col("_h").eqNullSafe(F.col("_g"))))
        w = Window.partitionBy("_pid", "_h").orderBy(F.col("_v").desc_nulls_first(), F.col("_t").asc_nulls_first())
        first_g = (in_group.select("_v", "_h", (F.col("_at") + F.row_number().over(w)).alias("_rn_g"))
                   .groupBy("_v", "_h").agg(F.min("_rn_g").alias("_rank_in_group")))
        ranked = ranked.join(first_g, F.col(value).eqNullSafe(F.col("_v")) & F.col(group).eqNullSafe(F.col("_h"))).drop("_v", "_h")
    # NTILE: the first (n mod k) tiles hold one row more
    q, r = divmod(n_total, tiles) if tiles else (0, 0)
    rn = F.col("_rn")
    big = F.lit(r * (q + 1))
    tile = (F.when(rn <= big, (rn - 1) / F.lit(max(q + 1, 1)) + 1)
            .otherwise(F.lit(r) + (rn - 1 - big) / F.lit(max(q, 1)) + 1))
    # rank in ASC NULLS LAST order: 1 + rows with a smaller value
    greater = F.col("_rank") - 1 - F.lit(n_total - n_valid)
    asc_rank = F.when(F.col(value).isNull(), F.lit(n_valid + 1)).otherwise(
        F.lit(n_valid) - greater - F.col("_ties") + 1)
    pct = (F.lit(0.0) if n_total <= 1
           else (asc_rank - 1).cast("double") / F.lit(float(n_total - 1)))
    return (ranked.withColumn("_tile", F.floor(tile).cast("bigint"))
            .withColumn("_pct_rank", pct)
            .drop("_pid", "_rn", "_ties"))
