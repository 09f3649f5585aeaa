"""Join helpers: size-checked broadcast and dimension enrichment.

Dimensions (sensors, facilities) are joined to the fact table many times.
They are broadcast only when the measured size of the *filtered, projected*
dimension is under a limit; otherwise the join is left to the
planner (sort-merge, with AQE converting it at runtime once real sizes are
known and splitting skewed partitions).  Hot keys on the fact side of a
shuffle join are split by AQE's skew-join handling (inner, left outer, semi
and anti joins); the one full outer join (upsert) joins two key-unique
sides, so it cannot be skewed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper bound for an explicit broadcast, in bytes of plain rows.  Spark's own
# estimate of a Parquet scan is the compressed file size, which says little
# about the rows, so the rows are measured.
BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024
# Where rows cannot be measured first, a compressed estimate must be this much smaller.
COMPRESSION_ALLOWANCE = 4


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of ``df`` (None when it cannot be read)."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(size) if isinstance(size, int) else int(str(size.toString()))
    except Exception:  # Spark Connect or an unavailable estimate
        return None


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows: 16 for each field, and the length of every text or binary value."""
    size = F.lit(16 * len(df.columns)).cast("long")
    for f in df.schema.fields:
        if f.dataType.typeName() in ("string", "binary", "varchar", "char"):
            size = size + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
        elif f.dataType.typeName() in ("array", "map", "struct", "variant"):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f.name)))), F.lit(0))
    return int(df.agg(F.sum(size)).first()[0] or 0)


# Decisions already made, by plan, its estimate and its input files (new files are new names).
_MEASURED: dict[tuple, bool] = {}


def _plan_key(df: DataFrame):
    try:
        return (int(df._jdf.queryExecution().optimizedPlan().semanticHash()), estimated_bytes(df), tuple(sorted(df.inputFiles())))
    except Exception:
        return None


def fits(df: DataFrame, limit: int) -> bool:
    return measured_bytes(df) <= limit


def sized_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES,
                    measure: bool = True) -> DataFrame:
    """``broadcast(df)`` when its size is shown to be within ``limit``.

    The rows are measured by one aggregate (for dimension-sized plans that do
    not read the fact table); the answer is remembered for that plan and
    those input files.  With ``measure=False`` only the optimizer's estimate
    is looked at, with an allowance for compression.  Beyond the limit the frame is
    returned unhinted: the planner picks a shuffle join and AQE may still
    broadcast it from runtime statistics.
    """
    if not measure:
        size = estimated_bytes(df)
        return F.broadcast(df) if size is not None and size * COMPRESSION_ALLOWANCE <= limit else df
    key = _plan_key(df)
    ok = _MEASURED.get(key) if key is not None else None
    if ok is None:
        ok = fits(df, limit)
        if key is not None:
            _MEASURED[key] = ok
    return F.broadcast(df) if ok else df


def dims(sensors: DataFrame, facilities: DataFrame,
         sensor_filter: Column | None = None,
         facility_filter: Column | None = None,
         columns: list[str] | None = None) -> DataFrame:
    """sensors ⋈ facilities, filtered before the join and projected.

    The result is keyed by sensor_id; join it to readings with
    :func:`enrich`.  Filters on the dimensions shrink what is broadcast and
    turn the fact join into a semi-join filter.
    """
    s = sensors if sensor_filter is None else sensors.filter(sensor_filter)
    f = facilities if facility_filter is None else facilities.filter(facility_filter)
    # dimension-to-dimension join: estimate only (the measured check is done
    # once, on the joined result, in enrich)
    d = s.join(sized_broadcast(f, measure=False), "facility_id")
    if columns is not None:
        keep = ["sensor_id"] + [c for c in columns if c != "sensor_id"]
        d = d.select(*keep)
    return d


def enrich(readings: DataFrame, dim: DataFrame) -> DataFrame:
    """Inner join of readings with a (sensor-keyed) dimension frame."""
    return readings.join(sized_broadcast(dim), "sensor_id")
