"""Monthly reports: month-over-month change with severity, anomaly trend.

Sums are exact: values are summed as DECIMAL (the reference's NUMERIC), so
the total does not depend on the order partial sums are combined in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import is_true, pct, round_half
from ..functions.timefn import bucket, month_label
from .joins import dims, enrich

SUM_TYPE = "decimal(20,4)"   # wide enough for the domain's NUMERIC(10,4)


def severity(rate):
    """HIGH above 3.0 %, MEDIUM above 1.5 %, else LOW (NULL rate is LOW)."""
    return (F.when(rate > F.lit(3.0), F.lit("HIGH"))
            .when(rate > F.lit(1.5), F.lit("MEDIUM"))
            .otherwise(F.lit("LOW")))


def monthly_report(readings: DataFrame, sensors: DataFrame, facilities: DataFrame,
                   sensor_type: str = "power_output",
                   sample_hours: float | None = None) -> DataFrame:
    """Per (country, facility_type, month): active facilities, mean (3 dp),
    total (1 dp), flagged count, flagged rate (2 dp), change of the total
    against the previous existing month (1 dp), severity band.  All rows
    count, flagged ones included.

    The total is the plain sum of the samples, as in the reference.  With
    ``sample_hours`` (e.g. 5/60 for 5-minute samples of MW) it is weighted
    by the sampling interval, giving energy in MWh.
    """
    # The fact rows are reduced per (sensor, month) on their own narrow key,
    # before the dimension's text columns are joined; facility, country and
    # type come in two more levels over those few rows.  Counting facilities
    # needs no COUNT(DISTINCT).  The mean is the exact decimal sum over the count.
    per_sensor = (readings.groupBy("sensor_id", bucket("month", "recorded_at").alias("month"))
                  .agg(F.count("value").alias("_nv"),
                       F.sum(F.col("value").cast(SUM_TYPE)).alias("_sum"),
                       F.count_if(is_true("is_anomaly")).alias("_a"),
                       F.count(F.lit(1)).alias("_n")))
    return report_of(per_sensor, sensors, facilities, sensor_type, sample_hours)


def report_of(per_sensor: DataFrame, sensors: DataFrame, facilities: DataFrame, sensor_type: str = "power_output",
              sample_hours: float | None = None) -> DataFrame:
    """The report from one row per (sensor_id, month): _nv values, their exact _sum, _a flagged
    readings of _n."""
    d = dims(sensors, facilities, sensor_filter=F.col("sensor_type") == F.lit(sensor_type),
             columns=["facility_id", "country", "facility_type"])
    per_fac = (enrich(per_sensor, d).groupBy("country", "facility_type", "month", "facility_id")
               .agg(*[F.sum(c).alias(c) for c in ("_nv", "_sum", "_a", "_n")]))
    m = (per_fac.groupBy("country", "facility_type", "month")
         .agg(F.count("facility_id").alias("active_facilities"),
              F.try_divide(F.sum("_sum").cast("double"), F.sum("_nv").cast("double")).alias("_avg"),
              F.sum("_sum").alias("_sum"),
              F.sum("_a").alias("anomaly_count"),
              F.sum("_n").alias("total_readings")))
    total = F.col("_sum")
    if sample_hours is not None:
        total = total * F.lit(str(sample_hours)).cast("decimal(20,12)")
    m = m.select("country", "facility_type", "month", "active_facilities",
                 round_half("_avg", 3).alias("avg_power_mw"),
                 F.round(total, 1).alias("_total"),
                 "anomaly_count",
                 round_half(pct(F.col("anomaly_count"), F.col("total_readings")), 2)
                 .alias("anomaly_rate_pct"))
    w = Window.partitionBy("country", "facility_type").orderBy("month")
    delta = F.round(F.col("_total") - F.lag("_total", 1).over(w), 1)
    return (m.select("country", "facility_type", month_label("month").alias("month"),
                     F.col("active_facilities").cast("bigint").alias("active_facilities"),
                     "avg_power_mw",
                     F.col("_total").cast("double").alias("total_energy_mwh"),
                     F.col("anomaly_count").cast("bigint").alias("anomaly_count"),
                     "anomaly_rate_pct",
                     delta.cast("double").alias("mom_energy_change_mwh"),
                     severity(F.col("anomaly_rate_pct")).alias("anomaly_severity"))
            .orderBy("country", "facility_type", "month"))


def anomaly_trend(readings: DataFrame) -> DataFrame:
    """Flagged share of all readings per month (2 dp).  Columns: month,
    anomaly_rate_pct."""
    return (readings.groupBy(bucket("month", "recorded_at").alias("month"))
            .agg(round_half(pct(F.count_if(is_true("is_anomaly")), F.count(F.lit(1))), 2)
                 .alias("anomaly_rate_pct"))
            .orderBy("month"))
