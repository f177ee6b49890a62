"""Views that make the driver's star-schema tables look like weather tables.

The texts come from the fixture notes of this repository; table names are filled in by the caller.
"""

from __future__ import annotations

from datetime import date

AS_OF = date(2001, 11, 1)

WEATHER_RAW = """
WITH g AS (
  SELECT CAST(l.l_shipdate AS DATE) AS date, n.n_name AS city, r.r_name AS state, n.n_nationkey AS nk,
         MIN(l.l_quantity) AS qmin, MAX(l.l_quantity) AS qmax,
         MAX(l.l_partkey) AS p, MAX(l.l_orderkey) AS o,
         SUM(CAST(ROUND(l.l_discount * 100) AS BIGINT)) AS d
  FROM {lineitem} l
  JOIN {supplier} s ON s.s_suppkey = l.l_suppkey
  JOIN {nation} n ON n.n_nationkey = s.s_nationkey
  JOIN {region} r ON r.r_regionkey = n.n_regionkey
  GROUP BY CAST(l.l_shipdate AS DATE), n.n_name, r.r_name, n.n_nationkey)
SELECT date, city, state,
  CAST(-10 - nk AS DOUBLE) AS latitude, CAST(115 + nk AS DOUBLE) AS longitude,
  CASE WHEN p % 23 = 0 THEN NULL ELSE qmin - 10 END AS min_temp,
  CASE WHEN p % 29 = 0 THEN NULL ELSE qmax - 5 END AS max_temp,
  CASE WHEN o % 31 = 0 THEN NULL WHEN p % 3 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(d AS DOUBLE) END AS rainfall,
  CASE WHEN o % 2 = 0 THEN NULL ELSE CAST(d AS DOUBLE) END AS rain_sum,
  CAST(o % 9 AS DOUBLE) AS precipitation_hours,
  CAST(p % 12 AS DOUBLE) AS evaporation,
  CASE WHEN o % 6 = 0 THEN NULL ELSE CAST(o % 13 AS DOUBLE) END AS sunshine_hours,
  CASE p % 4 WHEN 0 THEN 'N' WHEN 1 THEN 'E' WHEN 2 THEN 'S' ELSE 'W' END AS wind_gust_dir,
  CASE WHEN o % 41 = 0 THEN NULL ELSE CAST(o % 110 AS DOUBLE) END AS wind_gust_speed,
  CASE o % 4 WHEN 0 THEN 'NE' WHEN 1 THEN 'SE' WHEN 2 THEN 'SW' ELSE 'NW' END AS wind_dir_9am,
  CASE p % 3 WHEN 0 THEN 'N' WHEN 1 THEN 'SSE' ELSE NULL END AS wind_dir_3pm,
  CAST(p % 30 AS DOUBLE) AS wind_speed_9am, CAST(p % 35 AS DOUBLE) AS wind_speed_3pm,
  CASE WHEN p % 11 = 0 THEN NULL ELSE CAST(30 + p % 70 AS DOUBLE) END AS humidity_9am,
  CASE WHEN p % 11 = 0 THEN NULL ELSE CAST(20 + p % 80 AS DOUBLE) END AS humidity_3pm,
  CAST(p % 25 AS DOUBLE) AS dew_point_9am, CAST(o % 25 AS DOUBLE) AS dew_point_3pm,
  CAST(1000 + p % 30 AS DOUBLE) AS pressure_9am, CAST(990 + p % 50 AS DOUBLE) AS pressure_3pm,
  CAST(950 + p % 50 AS DOUBLE) AS surface_pressure_9am, CAST(950 + o % 50 AS DOUBLE) AS surface_pressure_3pm,
  CAST(p % 9 AS DOUBLE) AS cloud_9am, CASE WHEN o % 5 = 0 THEN NULL ELSE CAST(o % 9 AS DOUBLE) END AS cloud_3pm,
  qmin AS temp_9am, qmax - 6 AS temp_3pm,
  CASE WHEN p % 3 <> 0 AND d > 1 THEN 1 ELSE 0 END AS rain_today,
  CASE WHEN o % 13 = 0 THEN NULL WHEN p % 3 = 0 THEN CAST(o % 4 AS INT) WHEN o % 5 = 0 THEN 95 ELSE 61 END AS weather_code,
  CAST(o % 300 AS DOUBLE) AS shortwave_radiation_sum,
  CAST(p % 16 AS DOUBLE) / 8 AS vpd_9am, CAST(o % 32 AS DOUBLE) / 8 AS vpd_3pm,
  CAST(p % 45 AS DOUBLE) AS wind_speed_100m_9am, CAST(p % 50 AS DOUBLE) AS wind_speed_100m_3pm
FROM g
"""

WEATHER_PREDICTIONS = """
WITH g AS (
  SELECT CAST(l.l_shipdate AS DATE) AS date, n.n_name AS city,
         MAX(l.l_quantity) AS qmax, MAX(l.l_partkey) AS p, MAX(l.l_orderkey) AS o
  FROM {lineitem} l
  JOIN {supplier} s ON s.s_suppkey = l.l_suppkey
  JOIN {nation} n ON n.n_nationkey = s.s_nationkey
  WHERE l.l_orderkey % 19 <> 0
  GROUP BY CAST(l.l_shipdate AS DATE), n.n_name)
SELECT date, city,
  CASE WHEN o % 37 = 0 THEN NULL WHEN p % 101 >= 50 THEN 1 ELSE 0 END AS rain_tomorrow,
  CASE WHEN o % 37 = 0 THEN NULL ELSE CAST(p % 101 AS DOUBLE) / 100 END AS rain_tomorrow_proba,
  CAST(qmax - 5 + o % 9 - 4 AS DOUBLE) AS max_temp_tomorrow,
  CASE p % 5 WHEN 0 THEN 'Sunny' WHEN 1 THEN 'Cloudy' WHEN 2 THEN 'Rainy' WHEN 3 THEN 'Stormy' ELSE NULL END AS weather_type_tomorrow,
  CAST(o % 101 AS DOUBLE) AS comfort_score,
  CAST(o % 21 AS DOUBLE) / 20 AS heatwave_risk,
  CAST(p % 11 AS DOUBLE) / 10 AS frost_risk,
  CAST(p % 41 AS DOUBLE) / 40 AS storm_probability,
  CAST(CAST(date AS STRING) || ' 06:00:00' AS TIMESTAMP) AS predicted_at
FROM g
"""

DRIFT_REPORTS = """
SELECT MAKE_DATE(2001, 10, EXTRACT(DAY FROM ts)) AS date, event_type AS feature_name,
  CAST(COUNT(*) % 50 AS DOUBLE) / 100 AS ks_stat, CAST(COUNT(*) % 20 AS DOUBLE) / 100 AS p_value,
  COUNT(*) % 20 < 5 AS drifted
FROM {events} GROUP BY MAKE_DATE(2001, 10, EXTRACT(DAY FROM ts)), event_type
"""

MONITORING_DECISIONS = """
SELECT MAKE_DATE(2001, 10, EXTRACT(DAY FROM ts)) AS date,
  CASE COUNT(*) % 4 WHEN 0 THEN 'trigger_retrain' WHEN 1 THEN 'alert_only' WHEN 2 THEN 'alert_insufficient_data' ELSE 'no_action' END AS action,
  CASE COUNT(*) % 4 WHEN 0 THEN 'drift' WHEN 1 THEN 'mild_drift_on_3_features' ELSE 'all_metrics_nominal' END AS reason,
  CAST(COUNT(*) % 6 AS INT) AS n_drifted, '["max_temp"]' AS drifted_features,
  COUNT(*) % 5 = 0 AS low_accuracy, COUNT(*) % 7 = 0 AS high_mae,
  COUNT(*) % 6 >= 4 AS heavy_drift, COUNT(*) % 6 = 3 AS mild_drift,
  CAST(60 + COUNT(*) % 40 AS DOUBLE) / 100 AS rain_accuracy_30d, CAST(COUNT(*) % 50 AS DOUBLE) / 10 AS temp_mae_30d
FROM {events} GROUP BY MAKE_DATE(2001, 10, EXTRACT(DAY FROM ts))
"""

METRICS_HISTORY = """
SELECT MAKE_DATE(2001, 10, EXTRACT(DAY FROM ts)) AS date,
  CASE WHEN event_type = 'error' THEN NULL ELSE 'computed' END AS status,
  CAST(60 + COUNT(*) % 40 AS DOUBLE) / 100 AS rain_accuracy_30d, CAST(COUNT(*) % 50 AS DOUBLE) / 10 AS temp_mae_30d,
  MAX(event_id) AS row_num
FROM {events} GROUP BY MAKE_DATE(2001, 10, EXTRACT(DAY FROM ts)), event_type
"""

RETRAIN_EVENTS = """
SELECT DISTINCT MAKE_DATE(2001, 10, EXTRACT(DAY FROM ts)) AS retrain_date,
  '2001-10-01T00:00:00' AS written_at,
  CASE WHEN EXTRACT(DAY FROM ts) < 15 THEN 'weekly_train' ELSE 'monitoring' END AS source
FROM {events} WHERE EXTRACT(DAY FROM ts) % 7 = 5
"""

SOURCES = {
    "src_weather_raw": WEATHER_RAW,
    "src_weather_predictions": WEATHER_PREDICTIONS,
    "src_drift_reports": DRIFT_REPORTS,
    "src_monitoring_decisions": MONITORING_DECISIONS,
    "src_model_metrics_history": METRICS_HISTORY,
    "src_retrain_events": RETRAIN_EVENTS,
}
TABLES = ("lineitem", "supplier", "nation", "region", "events")
