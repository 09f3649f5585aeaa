"""Declared schemas of the domain tables and their data rules.

Never infer: every file read uses one of these StructTypes.  The rules
(keys, references, domains, NOT NULL, lengths, decimal limits, defaults)
are the constraints the reference's database enforced; here they are data,
consumed by :mod:`voltaic.operators.quality`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

FACILITIES = T.StructType([
    T.StructField("facility_id", T.IntegerType(), False),
    T.StructField("facility_name", T.StringType(), False),
    T.StructField("facility_type", T.StringType(), False),
    T.StructField("country", T.StringType(), False),
    T.StructField("capacity_mw", T.DecimalType(8, 2), False),
    T.StructField("commissioned_year", T.ShortType(), False),
])

SENSORS = T.StructType([
    T.StructField("sensor_id", T.IntegerType(), False),
    T.StructField("facility_id", T.IntegerType(), False),
    T.StructField("sensor_type", T.StringType(), False),
    T.StructField("unit", T.StringType(), False),
])

READINGS = T.StructType([
    T.StructField("reading_id", T.LongType(), False),
    T.StructField("sensor_id", T.IntegerType(), False),
    T.StructField("recorded_at", T.TimestampType(), False),
    T.StructField("value", T.DecimalType(10, 4), True),
    T.StructField("is_anomaly", T.BooleanType(), True),
])

GRID_DATA = T.StructType([
    T.StructField("dataset_id", T.IntegerType(), False),
    T.StructField("country", T.StringType(), False),
    T.StructField("recorded_at", T.TimestampType(), False),
    T.StructField("value", T.DecimalType(12, 4), False),
    T.StructField("metric", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
])

# JSON payload of the external series: {"data": [{"startTime": ..., "value": ...}]}.
# value arrives as string or number; read as string and convert with try_cast.
GRID_PAYLOAD = T.StructType([
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("startTime", T.StringType(), True),
        T.StructField("value", T.StringType(), True),
    ])), True),
])


@dataclass(frozen=True)
class TableRules:
    """Constraint declarations for one table."""
    name: str
    primary_key: tuple[str, ...]
    not_null: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    decimals: dict[str, tuple[int, int]] = field(default_factory=dict)
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)  # col -> (table, col)
    defaults: dict[str, object] = field(default_factory=dict)


# Fixed values of the reference's DDL: lengths, precisions, domain lists and
# defaults must be these for the checks to agree with it.
RULES = {
    "facilities": TableRules(
        name="facilities",
        primary_key=("facility_id",),
        not_null=("facility_id", "facility_name", "facility_type", "country",
                  "capacity_mw", "commissioned_year"),
        max_length={"facility_name": 100, "facility_type": 50, "country": 50},
        decimals={"capacity_mw": (8, 2)},
        domains={"facility_type": ("wind", "solar", "substation")},
    ),
    "sensors": TableRules(
        name="sensors",
        primary_key=("sensor_id",),
        not_null=("sensor_id", "facility_id", "sensor_type", "unit"),
        max_length={"sensor_type": 50, "unit": 20},
        references={"facility_id": ("facilities", "facility_id")},
    ),
    "readings": TableRules(
        name="readings",
        primary_key=("reading_id", "recorded_at"),
        not_null=("reading_id", "sensor_id", "recorded_at"),
        decimals={"value": (10, 4)},
        references={"sensor_id": ("sensors", "sensor_id")},
        defaults={"is_anomaly": False},
    ),
    "grid_data": TableRules(
        name="grid_data",
        primary_key=("dataset_id", "recorded_at"),
        not_null=("dataset_id", "country", "recorded_at", "value", "metric", "source"),
        max_length={"country": 2, "metric": 50, "source": 20},
        decimals={"value": (12, 4)},
        defaults={"country": "FI", "source": "fingrid"},
    ),
}
