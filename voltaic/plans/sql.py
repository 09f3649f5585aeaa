"""SQL access: domain frames as temporary views, and the parameterised
anomaly query with bound (named) parameters.

Users who write SQL against readings / sensors / facilities / grid_data can
register the views and use ``spark.sql``; values are bound with ``args``
(never formatted into the text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.scoring import validate_anomaly_params


def register_views(spark: SparkSession, readings: DataFrame, sensors: DataFrame,
                   facilities: DataFrame, grid_data: DataFrame | None = None,
                   prefix: str = "") -> list[str]:
    """Create or replace temp views ``<prefix>readings`` etc.; returns names."""
    views = {"readings": readings, "sensors": sensors, "facilities": facilities}
    if grid_data is not None:
        views["grid_data"] = grid_data
    names = []
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


ANOMALIES_SQL = """
SELECT reading_id, sensor_id, recorded_at, v AS value, flagged AS pre_labelled,
       abs(v - usual.centre) / usual.spread AS z_score,
       facility_name, facility_type, sensor_type, unit
FROM (SELECT reading_id, sensor_id, recorded_at, is_anomaly AS flagged, double(value) AS v,
             year(recorded_at) * 12 + month(recorded_at) AS period FROM {p}readings) AS point
JOIN (SELECT sensor_id, year(recorded_at) * 12 + month(recorded_at) AS period,
             mean(double(value)) AS centre, std(double(value)) AS spread
      FROM {p}readings WHERE NOT is_anomaly GROUP BY ALL HAVING spread > 0) AS usual
  USING (sensor_id, period)
JOIN {p}sensors USING (sensor_id)
JOIN (SELECT * FROM {p}facilities WHERE facility_type <=> coalesce(:facility_type, facility_type)) AS place
  USING (facility_id)
WHERE abs(v - usual.centre) / usual.spread > :z_threshold
ORDER BY z_score DESC, reading_id, recorded_at
LIMIT :row_limit
"""


def anomalies_sql(spark: SparkSession, z_threshold: float = 3.0, limit: int = 100,
                  facility_type: str | None = None, prefix: str = "") -> DataFrame:
    """The service's anomaly query in Spark SQL with bound parameters, over
    views registered by :func:`register_views`."""
    validate_anomaly_params(z_threshold, limit)
    return spark.sql(ANOMALIES_SQL.format(p=prefix),
                     args={"z_threshold": float(z_threshold), "row_limit": int(limit),
                           "facility_type": facility_type})
