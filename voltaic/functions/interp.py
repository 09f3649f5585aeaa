"""Linear gap interpolation with a step limit on both sides, as windows.

For a series on a regular grid with position i:
  pv, pi = last non-NULL value before-or-at i and its position
  nv, ni = first non-NULL value at-or-after i and its position
  v not NULL                      -> v
  both neighbours, and i - pi <= L or ni - i <= L
                                  -> pv + (nv - pv) * (i - pi) / (ni - pi)
  only nv (leading gap), ni - i <= L  -> nv
  only pv (trailing gap), i - pi <= L -> pv
  otherwise NULL.
This is what pandas' interpolate(method="linear", limit=L,
limit_direction="both") yields: the middle of a long interior gap stays
NULL, and filled points lie on the full line between the neighbours.

Neighbours before and after come from the same running frame (unbounded preceding
to current row) over ascending and descending positions.  A frame that ends at
"unbounded following" would be evaluated anew for every row, so a second sort
is the cheaper way: both passes are linear, on one shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def interpolate_linear(df: DataFrame, value: str, keys: list[str], order: str, limit: int,
                       out: str) -> DataFrame:
    """Add column ``out`` = ``value`` with gaps interpolated (see module doc)."""
    part = Window.partitionBy(*keys).orderBy(order)
    d = df.withColumn("_i", F.row_number().over(part))
    v, i = F.col(value), F.col("_i")
    back = part.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fwd = (Window.partitionBy(*keys).orderBy(F.col("_i").desc())
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    pv = F.last(v, ignorenulls=True).over(back)
    pi = F.last(F.when(v.isNotNull(), i), ignorenulls=True).over(back)
    nv = F.last(v, ignorenulls=True).over(fwd)
    ni = F.last(F.when(v.isNotNull(), i), ignorenulls=True).over(fwd)
    d = d.select("*", pv.alias("_pv"), pi.alias("_pi"), nv.alias("_nv"), ni.alias("_ni"))
    pv, pi, nv, ni = F.col("_pv"), F.col("_pi"), F.col("_nv"), F.col("_ni")
    lim = F.lit(limit)
    both = pv.isNotNull() & nv.isNotNull()
    line = pv + (nv - pv) * (i - pi).cast("double") / (ni - pi).cast("double")
    filled = (F.when(v.isNotNull(), v)
              .when(both & (((i - pi) <= lim) | ((ni - i) <= lim)), line)
              .when(nv.isNotNull() & pv.isNull() & ((ni - i) <= lim), nv)
              .when(pv.isNotNull() & nv.isNull() & ((i - pi) <= lim), pv))
    return d.withColumn(out, filled).drop("_i", "_pv", "_pi", "_nv", "_ni")


def interpolate_linear_chunked(df: DataFrame, value: str, keys: list[str], ts: str, limit: int,
                               out: str, step_seconds: int = 3600,
                               chunk_unit: str = "month") -> DataFrame:
    """Same result as :func:`interpolate_linear` for a series on a regular
    grid of ``step_seconds``, with window partitions bounded by a time chunk
    (``chunk_unit``) instead of whole series.

    * position = timestamp // step (the grid is regular, so no row_number);
    * within a chunk, the neighbour windows run over (series, chunk);
    * each chunk's first/last non-NULL value is aggregated (one row per
      chunk), and the nearest ones in earlier/later chunks are carried in by
      a window over those chunk rows — bounded by the number of chunks;
    * the carries are joined back on (series, chunk).
    A series of any length is spread over as many tasks as it has chunks.
    """
    keys = list(keys)
    v = F.col(value)
    d = df.select("*", (F.col(ts).cast("timestamp").cast("long")
                        / F.lit(step_seconds)).cast("long").alias("_i"),
                  F.date_trunc(chunk_unit, F.col(ts).cast("timestamp")).alias("_c"))
    i = F.col("_i")
    part = Window.partitionBy(*keys, "_c").orderBy("_i")
    back = part.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fwd = (Window.partitionBy(*keys, "_c").orderBy(F.col("_i").desc())
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = d.select("*",
                 F.last(v, ignorenulls=True).over(back).alias("_pv"),
                 F.last(F.when(v.isNotNull(), i), ignorenulls=True).over(back).alias("_pi"),
                 F.last(v, ignorenulls=True).over(fwd).alias("_nv"),
                 F.last(F.when(v.isNotNull(), i), ignorenulls=True).over(fwd).alias("_ni"))
    # per chunk: last and first non-NULL (position, value) — structs order by
    # position first.  Aggregated from the windowed frame, which is already
    # partitioned by (series, chunk), so this needs no further shuffle.
    nn = F.when(v.isNotNull(), F.struct(i.alias("i"), v.alias("v")))
    chunks = d.groupBy(*keys, "_c").agg(F.max(nn).alias("_last"), F.min(nn).alias("_first"))
    cw = Window.partitionBy(*keys).orderBy("_c")
    carry = chunks.select(
        *keys, "_c",
        F.last("_last", ignorenulls=True).over(
            cw.rowsBetween(Window.unboundedPreceding, -1)).alias("_prev"),
        F.last("_first", ignorenulls=True).over(
            Window.partitionBy(*keys).orderBy(F.col("_c").desc())
            .rowsBetween(Window.unboundedPreceding, -1)).alias("_next"))
    d = d.join(carry, keys + ["_c"], "left")
    pv = F.coalesce(F.col("_pv"), F.col("_prev.v"))
    pi = F.coalesce(F.col("_pi"), F.col("_prev.i"))
    nv = F.coalesce(F.col("_nv"), F.col("_next.v"))
    ni = F.coalesce(F.col("_ni"), F.col("_next.i"))
    lim = F.lit(limit)
    both = pv.isNotNull() & nv.isNotNull()
    line = pv + (nv - pv) * (i - pi).cast("double") / (ni - pi).cast("double")
    filled = (F.when(v.isNotNull(), v)
              .when(both & (((i - pi) <= lim) | ((ni - i) <= lim)), line)
              .when(nv.isNotNull() & pv.isNull() & ((ni - i) <= lim), nv)
              .when(pv.isNotNull() & nv.isNull() & ((i - pi) <= lim), pv))
    return d.withColumn(out, filled).drop("_i", "_c", "_pv", "_pi", "_nv", "_ni", "_prev", "_next")
