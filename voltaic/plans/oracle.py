"""DuckDB reference SQL for every registered query.

Each statement states what the result is over the driver tables, with the
adapter mappings of :mod:`voltaic.adapters` written as CTEs.  Where there is a
choice it takes another way than the Spark side (window statistics instead of
a joined baseline, ranks by counting, trailing means by joining positions), so
agreement checks both.  Rounded outputs use the same half-away-from-zero nudge
(see :func:`voltaic.functions.numeric.half_nudge`).
"""

from __future__ import annotations

from ..functions.numeric import half_nudge

EVENTS = """
readings AS (
  SELECT event_id AS reading_id, user_id AS sensor_id, ts AS recorded_at, value,
         (event_type = 'error') AS is_anomaly
  FROM events),
sensors AS (
  SELECT c_custkey AS sensor_id, c_nationkey AS facility_id, c_mktsegment AS sensor_type,
         'unit' AS unit
  FROM customer),
facilities AS (
  SELECT n_nationkey AS facility_id, n_name AS facility_name, r_name AS facility_type,
         n_name AS country, CAST(100.0 AS DOUBLE) AS capacity_mw
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

SHIPMENTS = """
readings AS (
  SELECT l_orderkey * 8 + l_linenumber AS reading_id, l_suppkey AS sensor_id,
         l_shipdate AS recorded_at, l_extendedprice AS value,
         (l_returnflag = 'R') AS is_anomaly
  FROM lineitem),
sensors AS (
  SELECT s_suppkey AS sensor_id, s_suppkey AS facility_id, 'power_output' AS sensor_type,
         'MW' AS unit
  FROM supplier),
facilities AS (
  SELECT s_suppkey AS facility_id, s_name AS facility_name, r_name AS facility_type,
         n_name AS country, s_acctbal AS capacity_mw
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey)"""

ORDERS_SERIES = """
grid_data AS (
  SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS dataset_id, 'FI' AS country,
         o_orderdate AS recorded_at, o_totalprice AS value, o_orderpriority AS metric,
         'orders' AS source
  FROM orders)"""

EVENTS_SERIES = """
series AS (
  SELECT 1 AS dataset_id, 'FI' AS country, ts AS recorded_at, value, event_type AS metric
  FROM events)"""


def R(expr: str, n: int) -> str:
    """ROUND half away from zero, nudged like the Spark side."""
    return f"round(({expr}) + sign({expr}) * {half_nudge(n):.0e}, {n})"


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


SQL: dict[str, str] = {}

# Every sensor with its facility's columns.
SITE = """
site AS (SELECT * FROM sensors JOIN facilities USING (facility_id))"""

# Every reading with the mean and deviation of its sensor's clean readings in that month.
DEVIATION = """
deviation AS (
  SELECT readings.*, avg(value) FILTER (NOT is_anomaly) OVER own AS centre,
         stddev_samp(value) FILTER (NOT is_anomaly) OVER own AS spread
  FROM readings
  WINDOW own AS (PARTITION BY sensor_id, year(recorded_at), month(recorded_at))),
outlying AS (
  SELECT * EXCLUDE (centre, spread), abs(value - centre) / spread AS z
  FROM deviation WHERE spread > 0 AND abs(value - centre) / spread > 3)"""

FIRST_BY_Z = "QUALIFY row_number() OVER (ORDER BY z DESC, reading_id, recorded_at) <= "

# P2 -------------------------------------------------------------------------
SQL["zscore_anomalies"] = with_(EVENTS, SITE, DEVIATION) + f"""
SELECT reading_id, sensor_id, recorded_at, {R('value', 4)} AS value, {R('z', 2)} AS z_score,
       is_anomaly AS was_flagged_in_source, facility_name, sensor_type, unit
FROM outlying JOIN site USING (sensor_id) {FIRST_BY_Z} 200"""

# A1 -------------------------------------------------------------------------
SQL["anomalies_by_type"] = with_(EVENTS, SITE, DEVIATION) + f"""
SELECT reading_id, sensor_id, recorded_at, value, is_anomaly AS pre_labelled, {R('z', 8)} AS z_score,
       facility_name, facility_type, sensor_type, unit
FROM outlying JOIN site USING (sensor_id) WHERE facility_type = 'EUROPE' {FIRST_BY_Z} 100"""

SQL["anomalies_by_type_sql"] = SQL["anomalies_by_type"]

# P1 -------------------------------------------------------------------------
# Trailing means join every position to itself and the 23 before it.
SQL["rolling_24h"] = with_(EVENTS, SITE, """
cell AS (
  SELECT facility_id, any_value(facility_name) AS facility_name, date_trunc('hour', recorded_at) AS hour,
         sum(value) / count(value) AS x
  FROM readings JOIN site USING (sensor_id)
  WHERE sensor_type = 'BUILDING' AND NOT is_anomaly GROUP BY facility_id, date_trunc('hour', recorded_at)),
line AS (SELECT *, row_number() OVER (PARTITION BY facility_id ORDER BY hour) AS k FROM cell),
trail AS (
  SELECT a.facility_id, a.k, avg(b.x) AS y
  FROM line AS a CROSS JOIN range(24) AS back(d)
  JOIN line AS b ON b.facility_id = a.facility_id AND b.k = a.k - back.d GROUP BY ALL)""") + f"""
SELECT facility_name, hour, {R('x', 4)} AS avg_power_mw, {R('y', 4)} AS rolling_24h_avg_mw
FROM line JOIN trail USING (facility_id, k)"""

# D3 -------------------------------------------------------------------------
SQL["dash_rolling_type"] = with_(EVENTS, SITE, """
cell AS (
  SELECT facility_type, date_trunc('hour', recorded_at) AS hour, sum(value::DECIMAL(20,4))::DOUBLE AS x
  FROM site JOIN readings USING (sensor_id) WHERE sensor_type = 'BUILDING' GROUP BY ALL),
line AS (SELECT *, row_number() OVER (PARTITION BY facility_type ORDER BY hour) AS k FROM cell)""") + f"""
SELECT a.hour, a.facility_type, {R('avg(b.x)', 6)} AS rolling_24h_avg
FROM line AS a CROSS JOIN range(24) AS back(d)
JOIN line AS b ON b.facility_type = a.facility_type AND b.k = a.k - back.d
GROUP BY a.facility_type, a.hour"""

# P3 -------------------------------------------------------------------------
# Ranks by counting: 1 + how many stand above.  NULL stands first, and last for the percentile.
SQL["facility_ranking"] = with_(SHIPMENTS, SITE, f"""
share AS (
  SELECT facility_id, sum(value) / count(value) / NULLIF(any_value(capacity_mw), 0) * 100 AS pct
  FROM site JOIN readings USING (sensor_id)
  WHERE sensor_type = 'power_output' AND NOT is_anomaly
  GROUP BY facility_id, year(recorded_at), month(recorded_at)),
grade AS (SELECT facility_id, {R('avg(pct)', 2)} AS g FROM share GROUP BY facility_id),
ranked AS (
  SELECT f.*, g, (SELECT count(*) FROM grade) AS n,
         (SELECT count(*) FROM grade AS o WHERE coalesce(o.g > grade.g, o.g IS NULL AND grade.g IS NOT NULL)) AS above,
         (SELECT count(*) FROM grade AS o JOIN facilities AS p USING (facility_id) WHERE p.facility_type = f.facility_type
            AND coalesce(o.g > grade.g, o.g IS NULL AND grade.g IS NOT NULL)) AS above_in_type,
         (SELECT count(*) FROM grade AS o WHERE coalesce(o.g < grade.g, o.g IS NOT NULL AND grade.g IS NULL)) AS below,
         (SELECT count(*) FROM grade AS o WHERE o.g IS NOT DISTINCT FROM grade.g AND o.facility_id < f.facility_id) AS ties
  FROM grade JOIN facilities AS f USING (facility_id))""") + f"""
SELECT facility_name, facility_type, country, capacity_mw::DOUBLE AS capacity_mw, g AS avg_efficiency_pct,
       1 + above AS overall_rank, 1 + above_in_type AS rank_within_type,
       CASE WHEN above + ties < (n % 4) * (n // 4 + 1) THEN 1 + (above + ties) // (n // 4 + 1)
            ELSE 1 + n % 4 + (above + ties - (n % 4) * (n // 4 + 1)) // greatest(n // 4, 1) END AS performance_quartile,
       CASE WHEN n = 1 THEN 0.0 ELSE {R('100.0::DOUBLE * below / (n - 1)', 1)} END AS percentile
FROM ranked"""

# A2 -------------------------------------------------------------------------
SQL["ranking_direct"] = with_(SHIPMENTS, SITE, """
ratio AS (
  SELECT facility_id, sum(value) / count(value) / NULLIF(any_value(capacity_mw), 0) AS q
  FROM readings JOIN site USING (sensor_id) WHERE NOT is_anomaly AND sensor_type = 'power_output'
  GROUP BY facility_id)""") + f"""
SELECT facility_name, facility_type, country, {R('capacity_mw', 2)} AS capacity_mw,
       {R('q * 100', 2)} AS avg_efficiency_pct,
       1 + (SELECT count(*) FROM ratio AS o WHERE coalesce(o.q > ratio.q, o.q IS NULL AND ratio.q IS NOT NULL)) AS overall_rank
FROM ratio JOIN facilities USING (facility_id)"""

# D1 -------------------------------------------------------------------------
# The mean of value / capacity over places of one name and capacity is their summed values over
# the number of values, divided by that capacity once.
SQL["dash_top10"] = with_(SHIPMENTS, SITE, """
own AS (SELECT sensor_id, sum(value) AS total, count(value) AS valued FROM readings GROUP BY sensor_id),
place AS (
  SELECT facility_name, capacity_mw, sum(total) / sum(valued) / NULLIF(capacity_mw, 0) * 100 AS pct
  FROM site JOIN own USING (sensor_id) WHERE sensor_type = 'power_output' GROUP BY facility_name, capacity_mw)""") + f"""
SELECT facility_name, capacity_mw::DOUBLE AS capacity_mw, {R('pct', 2)} AS avg_efficiency_pct FROM place
QUALIFY row_number() OVER (ORDER BY avg_efficiency_pct DESC NULLS FIRST, facility_name, capacity_mw) <= 10"""

# P7 -------------------------------------------------------------------------
SQL["top3_per_sensor"] = with_(SHIPMENTS, SITE, """
best AS (
  SELECT sensor_id, unnest(list({'t': recorded_at, 'v': value}
                                ORDER BY value DESC NULLS FIRST, recorded_at DESC, reading_id)[1:3]) AS top
  FROM readings
  WHERE NOT is_anomaly AND year(recorded_at) = 1998 AND month(recorded_at) = 12 GROUP BY sensor_id)""") + """
SELECT facility_id, facility_name, sensor_id, sensor_type, top.t AS recorded_at, top.v AS value
FROM best JOIN site USING (sensor_id)"""

# P4 -------------------------------------------------------------------------
# Per sensor and month first; the month before is the previous row that exists.
SQL["monthly_report"] = with_(SHIPMENTS, SITE, f"""
part AS (
  SELECT sensor_id, date_trunc('month', recorded_at) AS m, sum(value::DECIMAL(20,4)) AS total, count(value) AS valued,
         count(*) AS n, count_if(is_anomaly) AS flagged
  FROM readings GROUP BY ALL),
line AS (
  SELECT country, facility_type, m, count(DISTINCT facility_id) AS places, {R('sum(total)::DOUBLE / sum(valued)', 3)} AS mean,
         round(sum(total), 1) AS energy, sum(flagged)::BIGINT AS flagged, {R('100.0::DOUBLE * sum(flagged) / sum(n)', 2)} AS rate,
         row_number() OVER (PARTITION BY country, facility_type ORDER BY m) AS k
  FROM part JOIN site USING (sensor_id) WHERE sensor_type = 'power_output' GROUP BY country, facility_type, m)""") + """
SELECT now.country, now.facility_type, strftime(now.m, '%Y-%m') AS month, now.places AS active_facilities,
       now.mean AS avg_power_mw, now.energy::DOUBLE AS total_energy_mwh, now.flagged AS anomaly_count,
       now.rate AS anomaly_rate_pct, round(now.energy - was.energy, 1)::DOUBLE AS mom_energy_change_mwh,
       ['LOW', 'MEDIUM', 'HIGH'][1 + coalesce(now.rate > 1.5, false)::INT + coalesce(now.rate > 3, false)::INT] AS anomaly_severity
FROM line AS now LEFT JOIN line AS was
  ON was.country = now.country AND was.facility_type = now.facility_type AND was.k = now.k - 1"""

# D2 -------------------------------------------------------------------------
# The mean of a 0/1 column; months named by their first day.
SQL["dash_anomaly_trend"] = with_(SHIPMENTS, """
mark AS (SELECT make_timestamp(year(recorded_at), month(recorded_at), 1, 0, 0, 0) AS month,
                100 * (is_anomaly IS NOT DISTINCT FROM TRUE)::INT AS hit FROM readings)""") + f"""
SELECT month, {R('avg(hit)', 2)} AS anomaly_rate_pct FROM mark GROUP BY month"""

# P5 -------------------------------------------------------------------------
# Own power and the external series by a calendar unit, where both have values.
_PAIRS = """
outside AS (SELECT date_trunc('{unit}', recorded_at) AS t, avg(value) AS x FROM grid_data WHERE metric = '1-URGENT' GROUP BY ALL),
own AS (
  SELECT date_trunc('{unit}', recorded_at) AS t, sum(value) / count(value) AS y FROM readings
  WHERE sensor_id IN (SELECT sensor_id FROM site WHERE facility_type = 'EUROPE' AND sensor_type = 'power_output') GROUP BY ALL)"""

# Standardising does not change a correlation, so r is taken from the means themselves.
SQL["series_comparison"] = with_(SHIPMENTS, ORDERS_SERIES, SITE, _PAIRS.format(unit="day"), """
pair AS (SELECT * FROM outside JOIN own USING (t)),
fact AS (SELECT avg(x) AS mx, NULLIF(stddev_samp(x), 0) AS sx, avg(y) AS my, NULLIF(stddev_samp(y), 0) AS sy,
                corr(x, y) AS r FROM pair)""") + f"""
SELECT strftime(t, '%Y-%m-%d') AS day_label, {R('x', 4)} AS real_avg, {R('y', 4)} AS synthetic_avg,
       {R('(x - mx) / sx', 4)} AS real_z, {R('(y - my) / sy', 4)} AS synthetic_z, {R('r', 4)} AS correlation_coefficient
FROM pair CROSS JOIN fact"""

# P6 -------------------------------------------------------------------------
# Pearson r on P5's rounded columns and its two-sided p-value.  DuckDB has no
# t distribution, so the regularised incomplete beta I_x(df/2, 1/2) with
# x = 1 - r^2 is evaluated by its continued fraction (modified Lentz, a
# fixed 400 steps) in a recursive CTE.
SQL["pearson_test"] = (
    "WITH RECURSIVE\npairs AS (" + SQL["series_comparison"] + "),\n" + """stats AS (
  SELECT count(*) FILTER (WHERE real_avg IS NOT NULL AND synthetic_avg IS NOT NULL) AS n,
         covar_samp(real_avg, synthetic_avg)
           / NULLIF(stddev_samp(real_avg) * stddev_samp(synthetic_avg), 0) AS r
  FROM pairs),
prm AS (
  SELECT n, r, (n - 2) / 2.0 AS a, 0.5 AS b, 1 - r * r AS x FROM stats),
br AS (
  SELECT *, x < (a + 1) / (a + b + 2) AS direct,
         CASE WHEN x < (a + 1) / (a + b + 2) THEN a ELSE b END AS aa,
         CASE WHEN x < (a + 1) / (a + b + 2) THEN b ELSE a END AS bb,
         CASE WHEN x < (a + 1) / (a + b + 2) THEN x ELSE 1 - x END AS xx,
         lgamma(a + b) - lgamma(a) - lgamma(b) + a * ln(x) + b * ln(1 - x) AS lbt
  FROM prm WHERE n >= 3 AND r IS NOT NULL AND abs(r) < 1),
cf(m, c, d, h) AS (
  SELECT 0, 1.0::DOUBLE,
         1.0 / (CASE WHEN abs(1 - (aa + bb) * xx / (aa + 1)) > 1e-300
                     THEN 1 - (aa + bb) * xx / (aa + 1) ELSE 1e-300 END),
         1.0 / (CASE WHEN abs(1 - (aa + bb) * xx / (aa + 1)) > 1e-300
                     THEN 1 - (aa + bb) * xx / (aa + 1) ELSE 1e-300 END)
  FROM br
  UNION ALL
  SELECT m + 1, c2, d2, h * d1 * c1 * d2 * c2 FROM (
    SELECT cf.m, cf.h, s1.c1, s1.d1, s2.c2, s2.d2 FROM cf, br,
    LATERAL (SELECT (cf.m + 1) * (br.bb - (cf.m + 1)) * br.xx
                    / ((br.aa - 1 + 2 * (cf.m + 1)) * (br.aa + 2 * (cf.m + 1))) AS num1) e1,
    LATERAL (SELECT 1.0 / (CASE WHEN abs(1 + e1.num1 * cf.d) > 1e-300 THEN 1 + e1.num1 * cf.d ELSE 1e-300 END) AS d1,
                    CASE WHEN abs(1 + e1.num1 / cf.c) > 1e-300 THEN 1 + e1.num1 / cf.c ELSE 1e-300 END AS c1) s1,
    LATERAL (SELECT -(br.aa + (cf.m + 1)) * (br.aa + br.bb + (cf.m + 1)) * br.xx
                    / ((br.aa + 2 * (cf.m + 1)) * (br.aa + 1 + 2 * (cf.m + 1))) AS num2) e2,
    LATERAL (SELECT 1.0 / (CASE WHEN abs(1 + e2.num2 * s1.d1) > 1e-300 THEN 1 + e2.num2 * s1.d1 ELSE 1e-300 END) AS d2,
                    CASE WHEN abs(1 + e2.num2 / s1.c1) > 1e-300 THEN 1 + e2.num2 / s1.c1 ELSE 1e-300 END AS c2) s2
    WHERE cf.m < 400) t),
pv AS (
  SELECT CASE WHEN br.direct THEN exp(br.lbt) * cf.h / br.a
              ELSE 1 - exp(br.lbt) * cf.h / br.b END AS p_value
  FROM br, cf WHERE cf.m = 400)
SELECT CAST(s.n AS BIGINT) AS n, CAST(s.n - 2 AS BIGINT) AS df, round(s.r + sign(s.r) * 1e-13, 8) AS r,
       round((CASE WHEN abs(s.r) >= 1 THEN 0.0 ELSE (SELECT p_value FROM pv) END) + sign(CASE WHEN abs(s.r) >= 1 THEN 0.0 ELSE (SELECT p_value FROM pv) END) * 1e-13, 8) AS p_value,
       CASE WHEN (CASE WHEN abs(s.r) >= 1 THEN 0.0 ELSE (SELECT p_value FROM pv) END) < 0.05
            THEN 'Statistically Significant' ELSE 'Not Statistically Significant' END AS verdict
FROM stats s""")

# D4 -------------------------------------------------------------------------
SQL["dash_normalized"] = with_(SHIPMENTS, ORDERS_SERIES, SITE, _PAIRS.format(unit="month")) + f"""
SELECT t AS month, {R('100 * (x / NULLIF((SELECT max(x) FROM outside), 0))', 1)} AS real_normalized_pct,
       {R('100 * (y / NULLIF((SELECT max(y) FROM own), 0))', 1)} AS synthetic_normalized_pct
FROM outside JOIN own USING (t)"""

# G1 -------------------------------------------------------------------------
_RESAMPLE = with_(EVENTS_SERIES, """
means AS (
  SELECT dataset_id, metric, country, date_trunc('hour', recorded_at) AS b, avg(value) AS value
  FROM series
  WHERE dataset_id IS NOT NULL AND metric IS NOT NULL AND country IS NOT NULL
  GROUP BY 1, 2, 3, 4),
span AS (
  SELECT dataset_id, metric, country, min(b) AS lo, max(b) AS hi FROM means GROUP BY 1, 2, 3),
grid AS (
  SELECT dataset_id, metric, country, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS b
  FROM span),
resampled AS (
  SELECT g.dataset_id, g.metric, g.country, g.b AS recorded_at, m.value
  FROM grid g LEFT JOIN means m
    ON g.dataset_id = m.dataset_id AND g.metric = m.metric AND g.country = m.country
   AND g.b = m.b)""")
SQL["resample_hourly"] = _RESAMPLE + f"""
SELECT dataset_id, metric, country, recorded_at, {R('value', 6)} AS value FROM resampled"""

# G2-G5 ----------------------------------------------------------------------
SQL["gap_interpolate"] = _RESAMPLE + """,
pos AS (
  SELECT *, row_number() OVER (PARTITION BY dataset_id, metric, country ORDER BY recorded_at) AS i
  FROM resampled),
nb AS (
  SELECT *,
    last_value(value IGNORE NULLS) OVER w_back AS pv,
    last_value(CASE WHEN value IS NOT NULL THEN i END IGNORE NULLS) OVER w_back AS pi,
    first_value(value IGNORE NULLS) OVER w_fwd AS nv,
    first_value(CASE WHEN value IS NOT NULL THEN i END IGNORE NULLS) OVER w_fwd AS ni
  FROM pos
  WINDOW w_back AS (PARTITION BY dataset_id, metric, country ORDER BY recorded_at
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         w_fwd AS (PARTITION BY dataset_id, metric, country ORDER BY recorded_at
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
filled AS (
  SELECT dataset_id, country, recorded_at, metric,
    greatest(coalesce(CASE
      WHEN value IS NOT NULL THEN value
      WHEN pv IS NOT NULL AND nv IS NOT NULL AND (i - pi <= 3 OR ni - i <= 3)
        THEN pv + (nv - pv) * CAST(i - pi AS DOUBLE) / CAST(ni - pi AS DOUBLE)
      WHEN pv IS NULL AND nv IS NOT NULL AND ni - i <= 3 THEN nv
      WHEN nv IS NULL AND pv IS NOT NULL AND i - pi <= 3 THEN pv
    END, 0.0), 0.0) AS value
  FROM nb)""" + f"""
SELECT dataset_id, country, recorded_at, {R('value', 6)} AS value, metric, 'fingrid' AS source
FROM filled"""

# Q1-Q7 ----------------------------------------------------------------------
# Sensors as sets: all ids of sensors whose facility is known, without those of readings.
_SILENT = """
silent AS (
  SELECT sensor_id FROM sensors SEMI JOIN facilities USING (facility_id)
  EXCEPT SELECT sensor_id FROM readings)"""
# What each sensor sent, and the same summed up by place.
_SENT = """
sent AS (SELECT sensor_id, count(*) AS n, count_if(is_anomaly) AS bad FROM readings GROUP BY sensor_id),
by_place AS (SELECT facility_name, facility_type, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM sent JOIN site USING (sensor_id) GROUP BY ALL)"""
_DAYS = "(SELECT count(*) FROM (SELECT DISTINCT recorded_at::DATE FROM readings WHERE recorded_at IS NOT NULL))"

SQL["dq_orphan_sensors"] = with_(EVENTS, SITE, _SILENT) + """
SELECT sensor_id, sensor_type, facility_name FROM site WHERE sensor_id IN (FROM silent)"""

SQL["dq_null_values"] = with_(EVENTS) + """
SELECT count(*) - count(value) AS null_value_count FROM readings"""

SQL["dq_anomaly_rate"] = with_(EVENTS, SITE, _SENT) + f"""
SELECT facility_name, facility_type, n AS total_readings, bad AS anomaly_count, {R('bad * 100.0::DOUBLE / n', 2)} AS anomaly_pct
FROM by_place"""

SQL["dq_coverage"] = with_(EVENTS) + f"""
SELECT (SELECT recorded_at FROM readings ORDER BY recorded_at NULLS LAST LIMIT 1) AS earliest_reading,
       (SELECT recorded_at FROM readings ORDER BY recorded_at DESC NULLS LAST LIMIT 1) AS latest_reading,
       {_DAYS} AS days_with_data"""

_SHARE = "avg(coalesce(is_anomaly, FALSE)::INT) * 100"
SQL["dq_global_rate"] = with_(EVENTS) + f"""
SELECT {R(_SHARE, 8)} AS anomaly_rate_pct, {_SHARE} >= 1 AND {_SHARE} <= 4 AS within_band FROM readings"""

_OFF = "abs(count(*) - 10000) / 10000.0"
SQL["dq_volume"] = with_(EVENTS) + f"""
SELECT count(*) AS actual_rows, 10000::BIGINT AS expected_rows, {R(_OFF, 8)} AS deviation, 0.1::DOUBLE AS tolerance,
       count(*) BETWEEN 9000 AND 11000 AS within_tolerance
FROM readings"""

_FACTS = f"""
fact AS (
  SELECT (SELECT count(*) FROM silent) AS silent, (SELECT count(*) FROM by_place) AS places, {_DAYS} AS days,
         (SELECT count(*) - count(value) FROM readings) AS empty, (SELECT count(*) FROM readings) AS n,
         (SELECT {_SHARE} FROM readings) AS share)"""
_VERDICTS = """unnest([
  {'check': 'orphan_sensors', 'passed': silent = 0, 'detail': silent::VARCHAR},
  {'check': 'null_values', 'passed': empty = 0, 'detail': empty::VARCHAR},
  {'check': 'anomaly_rate', 'passed': true, 'detail': places::VARCHAR},
  {'check': 'coverage', 'passed': days >= 30, 'detail': days::VARCHAR}%s], recursive := true)"""
SQL["dq_summary"] = with_(EVENTS, SITE, _SILENT, _SENT, _FACTS) + "\nSELECT " + _VERDICTS % "" + " FROM fact"

SQL["dq_suite"] = with_(EVENTS, SITE, _SILENT, _SENT, _FACTS) + "\nSELECT " + _VERDICTS % """,
  {'check': 'global_rate', 'passed': share BETWEEN 1 AND 4, 'detail': printf('%.4f', share)},
  {'check': 'volume', 'passed': n BETWEEN 9000 AND 11000, 'detail': n::VARCHAR},
  {'check': 'raises_on_a_row', 'passed': false, 'detail': 'error: DIVIDE_BY_ZERO'},
  {'check': 'raises_on_a_cast', 'passed': false, 'detail': 'error: CAST_INVALID_INPUT'}""" + " FROM fact"

# C1-C4 ----------------------------------------------------------------------
SQL["rule_unique"] = """
SELECT l_orderkey, l_linenumber, count(*) AS dup_count
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""

SQL["rule_foreign_key"] = """
SELECT 'events.user_id' AS rule, e.user_id AS key, count(*) AS n_rows
FROM events e
WHERE e.user_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id)
GROUP BY e.user_id
UNION ALL
SELECT 'lineitem.l_suppkey', l.l_suppkey, count(*)
FROM lineitem l
WHERE l.l_suppkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_suppkey)
GROUP BY l.l_suppkey"""

SQL["rule_domain"] = with_(SHIPMENTS) + """
SELECT facility_type AS value, count(*) AS n_rows FROM facilities
WHERE facility_type IS NOT NULL
  AND facility_type NOT IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE')
GROUP BY facility_type"""


def _rule_counts(table: str, present: list[str]) -> list[str]:
    from ..schemas import RULES
    r = RULES[table]
    out = []
    for c in r.not_null:
        if c in present:
            out.append(f"SELECT '{table}' AS \"table\", 'not_null' AS rule, '{c}' AS \"column\", "
                       f"count(*) FILTER (WHERE {c} IS NULL) AS violations FROM {table}")
    for c, n in r.max_length.items():
        if c in present:
            out.append(f"SELECT '{table}', 'max_length', '{c}', "
                       f"count(*) FILTER (WHERE length({c}) > {n}) FROM {table}")
    for c, (p, s) in r.decimals.items():
        if c in present:
            out.append(f"SELECT '{table}', 'decimal', '{c}', count(*) FILTER (WHERE {c} IS NOT NULL "
                       f"AND TRY_CAST({c} AS DECIMAL({p},{s})) IS NULL) FROM {table}")
    return out


SQL["rule_not_null"] = with_(SHIPMENTS) + "\n" + "\nUNION ALL\n".join(
    _rule_counts("readings", ["reading_id", "sensor_id", "recorded_at", "value", "is_anomaly"])
    + _rule_counts("facilities", ["facility_id", "facility_name", "facility_type", "country",
                                  "capacity_mw"]))

# S1-S7 ----------------------------------------------------------------------
SQL["scan_default_column"] = with_(ORDERS_SERIES) + """
SELECT dataset_id, country, recorded_at, value, metric, 'fingrid' AS source
FROM grid_data WHERE recorded_at < TIMESTAMP '1998-01-01'
UNION ALL
SELECT dataset_id, country, recorded_at, value, metric, source
FROM grid_data WHERE recorded_at >= TIMESTAMP '1998-01-01'"""

SQL["json_payload_normalize"] = """
SELECT 1 AS dataset_id, 'FI' AS country, ts AS recorded_at,
       CAST(json_extract(props, '$.k') AS DOUBLE) AS value, event_type AS metric,
       'fingrid' AS source
FROM events"""

SQL["completeness_gate"] = with_(EVENTS_SERIES, """
keys AS (SELECT DISTINCT metric FROM series),
grid AS (
  SELECT metric, unnest(generate_series(TIMESTAMP '2024-01-01',
                                        TIMESTAMP '2024-02-01' - INTERVAL 1 MICROSECOND,
                                        INTERVAL 1 DAY)) AS period
  FROM keys),
present AS (
  SELECT DISTINCT metric, date_trunc('day', recorded_at) AS period FROM series
  WHERE recorded_at >= TIMESTAMP '2024-01-01' AND recorded_at < TIMESTAMP '2024-02-01')""") + """
SELECT g.metric, g.period FROM grid g
WHERE NOT EXISTS (SELECT 1 FROM present p WHERE p.metric = g.metric AND p.period = g.period)"""

SQL["scan_csv_typed"] = "SELECT * FROM events"

# L1-L13 ---------------------------------------------------------------------
LOAD_INPUTS = """
target AS (SELECT * FROM readings WHERE recorded_at < TIMESTAMP '2024-01-20'),
batch AS (
  SELECT reading_id, sensor_id, recorded_at, value, is_anomaly, 1 AS part FROM readings
  WHERE recorded_at >= TIMESTAMP '2024-01-15'
  UNION ALL
  SELECT reading_id, sensor_id, recorded_at, value + 1000.0, is_anomaly, 2 FROM readings
  WHERE recorded_at >= TIMESTAMP '2024-01-25' AND recorded_at < TIMESTAMP '2024-01-26')"""

SQL["load_watermark"] = with_(EVENTS, LOAD_INPUTS) + """
SELECT reading_id, sensor_id, recorded_at, value, is_anomaly FROM batch
WHERE recorded_at > (SELECT max(recorded_at) FROM target)"""

SQL["load_watermark_per_sensor"] = with_(EVENTS, LOAD_INPUTS, """
marks AS (SELECT sensor_id, max(recorded_at) AS wm FROM target GROUP BY sensor_id)""") + """
SELECT b.reading_id, b.sensor_id, b.recorded_at, b.value, b.is_anomaly
FROM batch b LEFT JOIN marks m ON b.sensor_id = m.sensor_id
WHERE m.wm IS NULL OR b.recorded_at > m.wm"""

SQL["load_insert_absent"] = with_(EVENTS, LOAD_INPUTS, """
firsts AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY reading_id, recorded_at
                                 ORDER BY part, reading_id) AS rn
    FROM batch) WHERE rn = 1)""") + """
SELECT reading_id, sensor_id, recorded_at, value, is_anomaly FROM target
UNION ALL
SELECT reading_id, sensor_id, recorded_at, value, is_anomaly FROM firsts f
WHERE NOT EXISTS (SELECT 1 FROM target t
                  WHERE t.reading_id = f.reading_id AND t.recorded_at = f.recorded_at)"""

# Rows of the last days: those the table has not, and the first of each sensor it never saw.
SQL["load_insert_filtered"] = with_(EVENTS, LOAD_INPUTS, """
given AS (SELECT * FROM batch WHERE recorded_at >= TIMESTAMP '2024-01-19'),
missing AS (SELECT reading_id, recorded_at FROM given EXCEPT SELECT reading_id, recorded_at FROM target)""") + """
SELECT 'reading_id, recorded_at' AS keys, arg_min(sensor_id, part) AS sensor_id, recorded_at, arg_min(value, part) AS value
FROM given SEMI JOIN missing USING (reading_id, recorded_at) GROUP BY reading_id, recorded_at
UNION ALL
SELECT 'sensor_id', sensor_id, arg_min(recorded_at, (part, reading_id)), arg_min(value, (part, reading_id)) FROM given
WHERE sensor_id NOT IN (SELECT sensor_id FROM target) GROUP BY sensor_id"""

SQL["load_upsert"] = with_(EVENTS, LOAD_INPUTS, """
t AS (
  SELECT sensor_id AS dataset_id, 'FI' AS country, recorded_at, value,
         CASE WHEN is_anomaly THEN 'error' ELSE 'ok' END AS metric, 'old' AS source
  FROM target),
b AS (
  SELECT sensor_id AS dataset_id, CASE WHEN part = 2 THEN 'NO' ELSE 'SE' END AS country,
         recorded_at, value, CASE WHEN is_anomaly THEN 'error' ELSE 'ok' END AS metric,
         'new' AS source, part, reading_id AS n
  FROM batch),
ranked AS (
  SELECT *,
    row_number() OVER (PARTITION BY dataset_id, recorded_at ORDER BY part, n) AS r_first,
    row_number() OVER (PARTITION BY dataset_id, recorded_at ORDER BY part DESC, n DESC) AS r_last
  FROM b),
nb AS (
  SELECT l.dataset_id, l.recorded_at, l.value, l.metric, l.source, f.country
  FROM ranked l JOIN ranked f
    ON l.dataset_id = f.dataset_id AND l.recorded_at = f.recorded_at
  WHERE l.r_last = 1 AND f.r_first = 1)""") + """
SELECT coalesce(t.dataset_id, nb.dataset_id) AS dataset_id,
       CASE WHEN t.dataset_id IS NOT NULL THEN t.country ELSE nb.country END AS country,
       coalesce(t.recorded_at, nb.recorded_at) AS recorded_at,
       CASE WHEN nb.dataset_id IS NOT NULL THEN nb.value ELSE t.value END AS value,
       CASE WHEN nb.dataset_id IS NOT NULL THEN nb.metric ELSE t.metric END AS metric,
       CASE WHEN nb.dataset_id IS NOT NULL THEN nb.source ELSE t.source END AS source
FROM t FULL OUTER JOIN nb ON t.dataset_id = nb.dataset_id AND t.recorded_at = nb.recorded_at"""

SQL["load_idempotent"] = with_(EVENTS, LOAD_INPUTS, """
wm AS (SELECT max(recorded_at) AS wm FROM target),
tagged AS (
  SELECT b.recorded_at <= (SELECT wm FROM wm) AS is_late,
    row_number() OVER (PARTITION BY b.reading_id, b.recorded_at ORDER BY b.part, b.reading_id) > 1
      AS is_dup,
    EXISTS (SELECT 1 FROM target t
            WHERE t.reading_id = b.reading_id AND t.recorded_at = b.recorded_at) AS is_conflict
  FROM batch b)""") + """
SELECT FALSE AS use_watermark,
       CASE WHEN is_dup THEN 'duplicate' WHEN is_conflict THEN 'conflict' ELSE 'insert' END
         AS status, count(*) AS n_rows
FROM tagged GROUP BY 2
UNION ALL
SELECT TRUE,
       CASE WHEN is_late THEN 'late' WHEN is_dup THEN 'duplicate'
            WHEN is_conflict THEN 'conflict' ELSE 'insert' END, count(*)
FROM tagged GROUP BY 2"""

SQL["range_delete"] = with_(EVENTS) + """
SELECT * FROM readings
WHERE NOT (recorded_at >= TIMESTAMP '2024-01-10' AND recorded_at < TIMESTAMP '2024-01-12')
   OR recorded_at IS NULL"""

SQL["partition_layout"] = with_(EVENTS) + """
SELECT *, strftime(recorded_at, '%Y-%m') AS month FROM readings"""

SQL["partition_route"] = with_(EVENTS) + """
SELECT strftime(recorded_at, '%Y-%m-%d') AS day,
       (recorded_at >= TIMESTAMP '2024-01-01' AND recorded_at < TIMESTAMP '2024-01-16'
        AND recorded_at IS NOT NULL) AS accepted,
       count(*) AS n_rows
FROM readings GROUP BY 1, 2"""

SQL["range_read"] = with_(EVENTS) + """
SELECT * FROM readings
WHERE sensor_id = 5
  AND recorded_at BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-11'"""

# S11 ------------------------------------------------------------------------
# The API envelope as JSON text: decimals as numbers, timestamps as ISO-8601
# (microseconds only when present), rows in z order.  z is rounded to 8 dp in
# both engines so that the number formatting is comparable.
SQL["anomalies_json"] = with_(EVENTS, SITE, DEVIATION, f"""
shown AS (
  SELECT * EXCLUDE (z), {R('z', 8)} AS z8 FROM outlying JOIN site USING (sensor_id) {FIRST_BY_Z} 100)""") + """
SELECT to_json({'z_threshold': 3.0::DOUBLE, 'count': count(*),
        'anomalies': list({'reading_id': reading_id, 'sensor_id': sensor_id,
          'recorded_at': strftime(recorded_at, '%Y-%m-%dT%H:%M:%S') || if(microsecond(recorded_at) % 1000000 = 0, '', strftime(recorded_at, '.%f')),
          'value': value, 'pre_labelled': is_anomaly, 'z_score': z8, 'facility_name': facility_name,
          'facility_type': facility_type, 'sensor_type': sensor_type, 'unit': unit} ORDER BY z8 DESC, reading_id)})::VARCHAR AS json
FROM shown"""

# L12 ------------------------------------------------------------------------
# Portable fingerprint: MD5 of a canonical row text (columns by name, '|',
# NULL as \N, six-digit fractions, DECIMAL(38,10) numbers), first 60 bits
# summed exactly per month.
SQL["verified_rewrite"] = with_(EVENTS, """
canon AS (
  SELECT strftime(recorded_at, '%Y-%m') AS month,
         concat_ws('|',
           coalesce(CAST(is_anomaly AS VARCHAR), '\\N'),
           coalesce(CAST(reading_id AS VARCHAR), '\\N'),
           coalesce(strftime(recorded_at, '%Y-%m-%d %H:%M:%S.%f'), '\\N'),
           coalesce(CAST(sensor_id AS VARCHAR), '\\N'),
           coalesce(CAST(TRY_CAST(value AS DECIMAL(38,10)) AS VARCHAR), '\\N')) AS txt
  FROM readings)""") + """
SELECT month, count(*) AS n_rows,
       CAST(sum(CAST(CAST('0x' || substr(md5(txt), 1, 15) AS UBIGINT) AS DECIMAL(38,0)))
            AS VARCHAR) AS content_hash
FROM canon GROUP BY month"""

# Operators on storage: the table that they leave behind is what the plan says -------------
SQL["range_read_stored"] = SQL["range_read"]
SQL["lookup_stored"] = with_(EVENTS) + """
SELECT unnest(list_filter([if(sensor_id IN (3, 5), 'sensors', NULL),
                           if(sensor_id = 5 AND recorded_at BETWEEN '2024-01-05' AND '2024-01-11', 'sensor and days', NULL),
                           if(recorded_at BETWEEN '2024-01-09 05:00:00' AND '2024-01-09 07:30:00', 'hours', NULL),
                           if(sensor_id = 8 AND recorded_at >= '2024-01-20', 'from', NULL)], lambda x: x IS NOT NULL)) AS asked, readings.*
FROM readings"""
SQL["range_delete_stored"] = SQL["range_delete"]
SQL["rewrite_switch"] = with_(EVENTS) + "\nSELECT * FROM readings"

# L5, end to end: fates by run over a batch with rows that must be refused, then the table.
SQL["load_end_to_end"] = with_(EVENTS, LOAD_INPUTS, """
given AS (
  SELECT * FROM batch
  UNION ALL SELECT reading_id, sensor_id, NULL, value, is_anomaly, 3 FROM batch WHERE reading_id % 10 = 0 AND part = 1
  UNION ALL SELECT NULL, sensor_id, recorded_at, value, is_anomaly, 3 FROM batch WHERE reading_id % 10 = 1 AND part = 1
  UNION ALL SELECT reading_id, -1, recorded_at, value, is_anomaly, 3 FROM batch WHERE reading_id % 10 = 2 AND part = 1),
judged AS (
  SELECT part = 3 AS refused, recorded_at <= (SELECT max(recorded_at) FROM target) AS behind, part = 2 AS again,
         recorded_at < TIMESTAMP '2024-01-20' AS stored
  FROM given),
fate AS (
  SELECT 1 AS run, 'inserted' AS status, count(*) AS n_rows FROM target
  UNION ALL SELECT 2, CASE WHEN refused THEN 'rejected' WHEN behind THEN 'late' WHEN again THEN 'duplicate' ELSE 'inserted' END,
                   count(*) FROM judged GROUP BY 2
  UNION ALL SELECT 3, CASE WHEN refused THEN 'rejected' WHEN again THEN 'duplicate' ELSE 'conflict' END, count(*) FROM judged GROUP BY 2
  UNION ALL SELECT 4, CASE WHEN refused THEN 'rejected' ELSE 'late' END, count(*) FROM judged GROUP BY 2)""") + """
SELECT run, status, n_rows FROM fate WHERE n_rows > 0
UNION ALL SELECT 5, 'table ' || strftime(recorded_at, '%Y-%m'), count(*) FROM readings
GROUP BY 2"""

SQL["load_watermark_half_loaded"] = with_(EVENTS) + """
SELECT * FROM readings WHERE sensor_id % 2 = 1"""

SQL["rule_foreign_key_broken"] = """
SELECT user_id, count(*) AS n_rows FROM events
WHERE user_id IS NOT NULL AND (user_id % 7 = 0 OR user_id NOT IN (SELECT c_custkey FROM customer))
GROUP BY user_id"""

SQL["completeness_gate_declared"] = """
WITH want AS (SELECT unnest(['error', 'never_sent']) AS metric),
day AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS period)
SELECT metric, period FROM want CROSS JOIN day
EXCEPT SELECT event_type, date_trunc('day', ts) FROM events"""

SQL["payload_rows"] = """
SELECT 7 AS dataset_id, 'error' AS metric, 'FI' AS country, ts AS recorded_at, value FROM events WHERE event_type = 'error'"""

# G2-G4 on a series with gaps of 3, 6, 7 and 20 hours, empty edges and negative values.
_THIN = """
hours AS (
  SELECT event_type AS metric, date_trunc('hour', ts) AS h, avg(value) AS v FROM events GROUP BY ALL),
spot AS (
  SELECT metric, unnest(generate_series(min(h), max(h), INTERVAL 1 HOUR)) AS h FROM hours GROUP BY metric),
seat AS (SELECT *, epoch(h)::BIGINT // 3600 AS p FROM spot),
hole AS (
  SELECT metric, h, p, (p % 60 BETWEEN 3 AND 5 OR p % 60 BETWEEN 10 AND 15 OR p % 60 BETWEEN 20 AND 26 OR p % 60 BETWEEN 35 AND 54
         OR h < TIMESTAMP '2024-01-01 05:00:00' OR h >= TIMESTAMP '2024-01-29 20:00:00') AS empty
  FROM seat),
known AS (SELECT hole.metric, hole.h, p, CASE WHEN NOT empty THEN v - 50 END AS v FROM hole LEFT JOIN hours ON hours.metric = hole.metric AND hours.h = hole.h),
near AS (
  SELECT k.metric, k.h, k.p, k.v, max(l.p) AS lp, arg_max(l.v, l.p) AS lv
  FROM known AS k LEFT JOIN known AS l ON l.metric = k.metric AND l.p <= k.p AND l.v IS NOT NULL GROUP BY ALL),
sides AS (
  SELECT n.metric, n.h, n.p, n.v, lp, lv, min(r.p) AS rp, arg_min(r.v, r.p) AS rv
  FROM near AS n LEFT JOIN known AS r ON r.metric = n.metric AND r.p >= n.p AND r.v IS NOT NULL GROUP BY ALL),
line AS (
  SELECT metric, h, v, CASE
    WHEN v IS NOT NULL THEN v
    WHEN least(coalesce(p - lp, 9), coalesce(rp - p, 9)) > 3 THEN NULL
    WHEN lp IS NULL THEN rv WHEN rp IS NULL THEN lv
    ELSE lv + (rv - lv) * (p - lp) / (rp - lp) END AS x
  FROM sides)"""
SQL["gap_interpolate_thinned"] = "WITH " + _THIN + f"""
SELECT 1 AS dataset_id, 'FI' AS country, h AS recorded_at, {R('greatest(coalesce(x, 0), 0)', 6)} AS value, metric, 'fingrid' AS source
FROM line"""
SQL["gap_counts"] = "WITH " + _THIN + """
SELECT count_if(v IS NULL)::BIGINT AS nan_before, count_if(x IS NULL)::BIGINT AS nan_after, count_if(x < 0)::BIGINT AS negatives FROM line"""

# L6 -------------------------------------------------------------------------
# Arrivals by run; run 4 repeats run 3.  A sensor's mark before a run is the newest time it had
# sent in any earlier one.
_ARRIVALS = """
day AS (SELECT *, day(recorded_at) AS d FROM readings),
sent AS (
  SELECT 1 AS run, 1 AS copy, * FROM day WHERE d <= 10
  UNION ALL SELECT 2, 1, * FROM day WHERE d BETWEEN 16 AND 30 AND sensor_id % 2 = 0
  UNION ALL SELECT 3, 1, * FROM day WHERE d BETWEEN 8 AND 20
  UNION ALL SELECT 3, 2, * FROM day WHERE d IN (12, 13)
  UNION ALL SELECT 5, 1, * FROM day WHERE d <= 10 OR d >= 21),
newest AS (SELECT run, sensor_id, max(recorded_at) AS t FROM sent GROUP BY ALL),"""
SQL["load_incremental_files"] = with_(EVENTS, _ARRIVALS + """
mark AS (SELECT s.run, s.sensor_id, max(n.t) AS t FROM (SELECT DISTINCT run, sensor_id FROM sent) AS s
         JOIN newest AS n ON n.sensor_id = s.sensor_id AND n.run < s.run GROUP BY ALL),
fate AS (SELECT run, recorded_at, CASE WHEN recorded_at <= t THEN 'late' WHEN copy > 1 THEN 'duplicate' ELSE 'inserted' END AS status
         FROM sent LEFT JOIN mark USING (run, sensor_id))""") + """
SELECT run, status, count(*) AS n_rows FROM fate GROUP BY ALL
UNION ALL SELECT 4, status, count(*) FROM fate WHERE run = 3 GROUP BY ALL
UNION ALL SELECT 9, 'table ' || strftime(recorded_at, '%Y-%m-%d'), count(*) FROM fate WHERE status = 'inserted' GROUP BY ALL"""

SQL["load_incremental_keys"] = with_(EVENTS, _ARRIVALS + """
first AS (SELECT reading_id, recorded_at, min(run) AS run FROM sent GROUP BY ALL)""") + """
SELECT run, 'inserted' AS status, count(*) AS n_rows FROM first GROUP BY run
UNION ALL SELECT 4, 'inserted', count(*) FROM first WHERE run = 3
UNION ALL SELECT 9, 'table ' || strftime(recorded_at, '%Y-%m-%d'), count(*) FROM first GROUP BY ALL"""

# Kept statistics answer as a full recomputation does -----------------------------------
SQL["zscore_from_monthly"] = SQL["zscore_anomalies"]
SQL["monthly_report_from_monthly"] = SQL["monthly_report"]
SQL["anomaly_trend_from_monthly"] = SQL["dash_anomaly_trend"]
SQL["dq_coverage_from_monthly"] = SQL["dq_coverage"]

# L14 in the catalog: the default for old rows and rows that do not say, what is given otherwise.
SQL["scan_catalog_default"] = with_(ORDERS_SERIES) + """
SELECT dataset_id, country, recorded_at, value, metric,
       CASE WHEN recorded_at < TIMESTAMP '1997-01-01' THEN 'fingrid' WHEN dataset_id = 3 THEN NULL ELSE source END AS source
FROM grid_data"""
SQL["top3_bucketed"] = SQL["top3_per_sensor"]

# Reports in name order with their rows; the one that fails has none and leaves none.
SQL["report_runner"] = with_(EVENTS, SITE) + """,
rates AS (SELECT count(DISTINCT (facility_name, facility_type)) AS n FROM readings JOIN site USING (sensor_id)),
months AS (SELECT count(DISTINCT (year(recorded_at), month(recorded_at))) AS n FROM readings)
SELECT 1 AS place, 'a_rates' AS report, TRUE AS ok, n AS n_rows, n AS n_found FROM rates
UNION ALL SELECT 2, 'b_fails', FALSE, -1, 0
UNION ALL SELECT 3, 'c_trend', TRUE, n, n FROM months"""

# The last row of each (dataset, time) gives value, metric and source.
SQL["series_by_metric_and_time"] = with_(ORDERS_SERIES) + """
SELECT dataset_id, country, recorded_at, max(value) AS value, metric, source FROM grid_data
WHERE metric = '1-URGENT' AND recorded_at BETWEEN TIMESTAMP '1997-07-10' AND TIMESTAMP '1997-08-20' GROUP BY ALL"""
