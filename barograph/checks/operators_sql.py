"""Check queries of the operators outside the warehouse models."""

from __future__ import annotations

from barograph.checks.oracle import AS_OF, add, avg, n_if, r, season
from barograph.checks.warehouse_sql import FIELDS

DAY = "DATE '2001-10-15'"
G0, G1 = "DATE '2001-08-01'", "DATE '2001-10-31'"
RAW = FIELDS[:32]  # observation columns after the place


def even(x: str, n: int) -> str:
    """Half to even after twelve digits."""
    scaled = f"ROUND(CAST({x} AS DOUBLE), 12) * {10.0 ** n}"
    return f"(ROUND_EVEN({scaled}, 0) / {10.0 ** n})"


def cols(names, fmt: str) -> str:
    return ", ".join(fmt.format(c=c) for c in names)


PRED = ["rain_tomorrow", "rain_tomorrow_proba", "max_temp_tomorrow", "weather_type_tomorrow", "comfort_score",
        "heatwave_risk", "frost_risk", "storm_probability", "predicted_at"]
add("full_rows", f"""
SELECT w.*, {cols(PRED, 'p.{c}')} FROM src_weather_raw w LEFT JOIN src_weather_predictions p ON p.date = w.date AND p.city = w.city
""")

# --- sources and sinks --------------------------------------------------------------------------
add("src_scan", "SELECT * FROM src_weather_raw")
add("src_metrics_history", "SELECT date, status, rain_accuracy_30d, temp_mae_30d, row_num FROM src_model_metrics_history")
add("drift_json_explode", "SELECT date, feature_name, ks_stat, p_value, drifted FROM src_drift_reports")
add("decision_json_row", "SELECT * REPLACE (IF(n_drifted > 0, low_accuracy, FALSE) AS low_accuracy) FROM src_monitoring_decisions")
add("csv_roundtrip", "SELECT * FROM full_rows")
add("parquet_export", "SELECT * FROM (" + "SELECT * FROM forecast_accuracy_rounded" + ")")
add("forecast_accuracy_rounded", f"""
SELECT * REPLACE ({cols(['rain_accuracy', 'temp_mae', 'temp_bias', 'avg_pred_rain_proba', 'actual_rain_rate'], 'ROUND(ROUND({c}, 12), 9) AS {c}')})
FROM forecast_accuracy_monthly
""")
add("parquet_export_partitioned", """
SELECT YEAR(prediction_date)::INT AS year, MONTH(prediction_date)::INT AS month, COUNT(*) AS n_rows, SUM(temp_abs_error) AS sum_error
FROM forecast_vs_actual_daily GROUP BY ALL
""")
add("publish_horizon", f"""
SELECT w.* REPLACE (IF(w.date < {AS_OF} - 180, w.max_temp + 100, w.max_temp) AS max_temp),
  {cols(PRED, f'IF(w.date >= {AS_OF} - 120, w2.{{c}}, NULL) AS {{c}}')}
FROM src_weather_raw w JOIN full_rows w2 USING (date, city) WHERE w.date >= {AS_OF} - 210
""")
add("load_run_audit", f"""
SELECT 'manual' AS dag_id, UNNEST([{AS_OF} - 1, {AS_OF}]) AS execution_date, {AS_OF} AS data_date, (SELECT COUNT(*) FROM src_weather_raw) AS rows_weather_raw,
  (SELECT COUNT(*) FROM src_weather_predictions) AS rows_weather_predictions,
  EXISTS (FROM src_monitoring_decisions) AS monitoring_decision_loaded, EXISTS (FROM src_drift_reports) AS drift_report_loaded,
  EXISTS (FROM src_retrain_events) AS retrain_event_loaded
""")
# Published tables and the models behind them.
EXPORTED = [
    ("bi_dashboard_overview", "dashboard_overview"),
    ("bi_data_quality_summary", "data_quality_summary"),
    ("bi_powerbi_homepage_kpis", "homepage_kpis"),
    ("bi_weather_alerts_summary_monthly", "alerts_summary_monthly"),
    ("bi_weather_current_snapshot", "bi_current_snapshot"),
    ("bi_weather_extremes", "bi_extremes"),
    ("bi_weather_risk_alerts", "bi_risk_alerts"),
    ("mart_weather_daily_clean", "daily_clean"),
    ("mart_weather_monthly_city", "monthly_city"),
    ("mart_weather_risk_alerts", "risk_alerts"),
    ("mart_weather_extremes", "weather_extremes"),
    ("mart_current_weather_snapshot", "current_snapshot"),
    ("mart_weather_seasonality", "seasonality"),
    ("mart_weather_state_monthly", "state_monthly"),
    ("mart_weather_yearly_city", "yearly_city"),
    ("mart_weather_comfort_segments", "comfort_segments"),
    ("mart_climate_normals_city_month", "climate_normals"),
    ("mart_forecast_vs_actual_daily", "forecast_vs_actual_daily"),
    ("mart_forecast_accuracy_monthly", "forecast_accuracy_monthly"),
    ("mart_forecast_vs_actual_timeline", "forecast_timeline"),
    ("mart_forecast_confusion_matrix", "confusion_matrix"),
    ("mart_rain_probability_calibration", "rain_calibration"),
    ("mart_data_quality_daily", "data_quality_daily"),
    ("mart_model_performance_overview", "performance_overview"),
    ("mart_model_performance_by_city", "performance_by_city"),
    ("mart_model_calibration", "model_calibration"),
    ("mart_prediction_bias_report", "bias_report"),
    ("mart_seasonal_performance", "seasonal_performance"),
    ("mart_extreme_events_performance", "extreme_events_performance"),
    ("mart_mlops_health", "mlops_health"),
    ("mart_retraining_history", "retraining_history"),
    ("mart_data_freshness_by_city", "data_freshness"),
    ("mart_feature_drift_summary", "feature_drift_summary"),
    ("mart_climate_anomaly_vs_drift", "anomaly_vs_drift"),
    ("mart_city_weather_scorecard", "city_scorecard"),
]
add("export_manifest", " UNION ALL ".join(
    f"SELECT '{export}' AS export, '{t}' AS \"table\", COUNT(*) AS n_rows FROM {m}"
    for export, start in (("daily_bi", "bi_"), ("full_build", "")) for t, m in EXPORTED if t.startswith(start)))
POINTS = "['N','NNE','NE','ENE','E','ESE','SE','SSE','S','SSW','SW','WSW','W','WNW','NW','NNW']"


def point(deg: str) -> str:
    return f"({POINTS})[ROUND_EVEN(({deg}) / 22.5::DOUBLE, 0)::INT % 16 + 1]"


add("payload_parse", f"""
SELECT * REPLACE ({point('wind_speed_9am * 11.25')} AS wind_gust_dir, {point('wind_speed_100m_9am * 7.5')} AS wind_dir_9am,
  {point('wind_speed_100m_3pm * 7.5')} AS wind_dir_3pm, IF(rainfall > 1, 1, 0) AS rain_today)
FROM src_weather_raw
""")
add("payload_parse_map", f"""
SELECT * REPLACE (rainfall AS rain_sum, {point('wind_speed_100m_9am * 7.5')} AS wind_gust_dir,
  {r('wind_speed_9am * 3.6::DOUBLE')} AS wind_gust_speed, IF(rainfall > 1, 1, 0) AS rain_today, humidity_3pm AS humidity_9am,
  {', '.join(f"{r('pressure_3pm / 8 * 10')} AS {c}" for c in ('pressure_9am', 'pressure_3pm', 'surface_pressure_9am', 'surface_pressure_3pm'))},
  {', '.join(f"NULL::{t} AS {c}" for c, t in [(c, 'VARCHAR' if c.startswith('wind_dir') else 'INT' if c == 'weather_code' else 'DOUBLE')
     for c in RAW if c not in ('min_temp', 'max_temp', 'rainfall', 'rain_sum', 'wind_gust_dir', 'wind_gust_speed', 'rain_today',
     'humidity_9am', 'humidity_3pm', 'pressure_9am', 'pressure_3pm', 'surface_pressure_9am', 'surface_pressure_3pm')])})
FROM src_weather_raw
""")
add("schema_evolve", """
SELECT * REPLACE (NULL::DOUBLE AS dew_point_9am, NULL::DOUBLE AS dew_point_3pm, NULL::DOUBLE AS vpd_9am, NULL::DOUBLE AS vpd_3pm,
  NULL::DOUBLE AS wind_speed_100m_9am, NULL::DOUBLE AS wind_speed_100m_3pm, NULL::DOUBLE AS shortwave_radiation_sum)
FROM src_weather_raw
""")

# --- ingestion ----------------------------------------------------------------------------------
add("upsert_merge", """
SELECT * REPLACE (
  CASE WHEN DAY(date) % 3 <> 0 OR DAY(date) % 5 = 0 OR DAY(date) % 2 = 0 THEN max_temp END AS max_temp,
  IF(DAY(date) % 5 = 0, rainfall + 1, rainfall) AS rainfall)
FROM src_weather_raw
""")
add("upsert_replace", """
SELECT * REPLACE (IF(DAY(date) % 5 = 0 OR DAY(date) % 3 <> 0, max_temp, NULL) AS max_temp,
  IF(DAY(date) % 5 = 0, NULL, min_temp) AS min_temp, IF(DAY(date) % 5 = 0, rainfall + 1, rainfall) AS rainfall)
FROM src_weather_raw
""")
add("upsert_ignore", """
SELECT * REPLACE (IF(DAY(date) % 2 = 0 OR DAY(date) % 3 <> 0, max_temp, NULL) AS max_temp) FROM src_weather_raw
""")
COMPLETE = "(humidity_9am + humidity_3pm + pressure_9am + pressure_3pm + temp_9am + temp_3pm + weather_code) IS NOT NULL"
add("existing_cities", f"SELECT DISTINCT city FROM src_weather_raw WHERE date = {DAY}")
add("complete_cities", f"SELECT DISTINCT city FROM src_weather_raw WHERE date = {DAY} AND {COMPLETE}")
add("latest_complete_date", f"SELECT city, MAX(date) FILTER (WHERE {COMPLETE}) AS latest FROM src_weather_raw GROUP BY city")
add("find_gaps", f"""
SELECT n_name AS city, CAST(d AS DATE) AS date FROM nation, GENERATE_SERIES({G0}::TIMESTAMP, {G1}::TIMESTAMP, INTERVAL 1 DAY) t(d)
WHERE NOT EXISTS (SELECT 1 FROM src_weather_raw w WHERE w.city = n_name AND w.date = CAST(d AS DATE) AND {COMPLETE})
""")
add("gap_ranges", """
SELECT city, MIN(date) AS start_date, MAX(date) AS end_date, COUNT(*) AS gap_days
FROM (SELECT city, date, date - CAST(ROW_NUMBER() OVER (PARTITION BY city ORDER BY date) AS INT) AS island FROM find_gaps)
GROUP BY city, island
""")
add("daily_fetch_plan", f"""
SELECT n_name AS city, IF(w.city IS NULL, 'missing', 'incomplete') AS status
FROM nation LEFT JOIN src_weather_raw w ON w.city = n_name AND w.date = {DAY}
WHERE w.city IS NULL OR NOT ({COMPLETE})
""")
add("backfill_plan", f"""
SELECT n_name AS city, IF(latest >= {DAY}, NULL, GREATEST({G0}, latest + 1)) AS start_date,
  IF(latest >= {DAY}, NULL, {DAY}) AS end_date, IF(latest >= {DAY}, 'skip', 'fetch') AS action
FROM nation LEFT JOIN latest_complete_date l ON l.city = n_name
""")
add("repair_summary", """
SELECT city, COUNT(*) AS initial, COUNT(*) FILTER (WHERE DAY(date) > 15) AS remaining FROM find_gaps GROUP BY city
""")
add("daily_coverage_gate", f"""
SELECT {DAY} AS day, COUNT(DISTINCT w.city) AS n_cities, COUNT(DISTINCT n_name) AS expected, COUNT(DISTINCT w.city) > 20 AS passed
FROM nation LEFT JOIN src_weather_raw w ON w.city = n_name AND w.date = {DAY}
""")
add("missing_dates", f"""
SELECT CAST(d AS DATE) AS date FROM GENERATE_SERIES({G0}::TIMESTAMP, TIMESTAMP '2001-11-30', INTERVAL 1 DAY) t(d)
EXCEPT SELECT date FROM src_weather_raw
""")
add("null_rows_by_date", f"""
SELECT date, COUNT(*) AS null_row_count FROM src_weather_raw
WHERE date BETWEEN {G0} AND {G1} AND (max_temp + min_temp + rainfall) IS NULL GROUP BY date
""")
add("gap_report", f"""
WITH w AS (SELECT * FROM src_weather_raw WHERE {AS_OF} - date BETWEEN 1 AND 30),
i AS (
  SELECT CAST(d AS DATE) AS date, 'missing_date' AS issue, 0 AS n
  FROM GENERATE_SERIES(({AS_OF} - 30)::TIMESTAMP, ({AS_OF} - 1)::TIMESTAMP, INTERVAL 1 DAY) t(d)
  WHERE CAST(d AS DATE) NOT IN (SELECT date FROM w)
  UNION ALL SELECT date, 'partial_coverage', COUNT(DISTINCT city) FROM w GROUP BY date HAVING COUNT(DISTINCT city) < 21
  UNION ALL SELECT date, 'null_rows', COUNT(*) FROM w WHERE (max_temp + min_temp + rainfall) IS NULL GROUP BY date)
SELECT *, MIN(date) OVER () AS gap_start, MAX(date) OVER () AS gap_end FROM i
""")
add("validate_sources", f"""
SELECT 'weather_raw_not_empty' AS "check", COUNT(*) AS n, COUNT(*) > 0 AS passed FROM src_weather_raw
UNION ALL SELECT 'weather_predictions_not_empty', COUNT(*), COUNT(*) > 0 FROM src_weather_predictions
UNION ALL SELECT 'drift_reports_not_empty', COUNT(*), COUNT(*) > 0 FROM src_drift_reports
UNION ALL SELECT 'decision_for_run_date', COUNT(*), COUNT(*) > 0 FROM src_monitoring_decisions WHERE date = {DAY}
""")
add("asof_last_retrain", """
SELECT d.date, e.retrain_date AS last_retrain_date
FROM (SELECT DISTINCT date FROM stg_weather_raw) d ASOF LEFT JOIN stg_retrain_events e ON d.date >= e.retrain_date
""")

# --- features -----------------------------------------------------------------------------------
W = "WINDOW w AS (PARTITION BY city ORDER BY date)"
add("features_calendar", f"""
SELECT date, city, MONTH(date) AS month, DAYOFYEAR(date) AS day_of_year, {season('MONTH(date)')} AS season FROM src_weather_raw
""")
add("features_lag", f"""
SELECT date, city, {', '.join(f'LAG({c}, {k}) OVER w AS {c}_lag{k}' for c in ('max_temp', 'min_temp', 'rainfall', 'pressure_3pm') for k in (1, 2))}
FROM src_weather_raw {W}
""")
ROLLED = ("max_temp", "rainfall", "humidity_3pm")
FRAME = "(PARTITION BY city ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)"
add("rolled", f"""
SELECT date, city, max_temp, pressure_3pm, LAG(pressure_3pm) OVER (PARTITION BY city ORDER BY date) AS before,
  {', '.join(f'IF(COUNT({c}) OVER f > 2, AVG({c}) OVER f, NULL) AS {c}_rolling7' for c in ROLLED)}
FROM src_weather_raw WINDOW f AS {FRAME}
""")
add("features_rolling", "SELECT date, city, " + ", ".join(r(f"{c}_rolling7") + f" AS {c}_rolling7" for c in ROLLED) + " FROM rolled")
add("features_derived", f"""
SELECT date, city, pressure_3pm - before AS pressure_tendency, {r('max_temp - max_temp_rolling7')} AS temp_anomaly FROM rolled
""")
add("features_hot_days", f"""
WITH h AS (SELECT date, city, IFNULL(max_temp >= 35, FALSE)::INT AS hot_day FROM src_weather_raw)
SELECT date, city, hot_day, LAG(hot_day, 1, 0) OVER w AS hot_day_lag1, LAG(hot_day, 2, 0) OVER w AS hot_day_lag2,
  (SUM(hot_day) OVER (PARTITION BY city ORDER BY date ROWS 2 PRECEDING))::INT AS consec_hot_days
FROM h {W}
""")
add("features_rain_intensity", f"""
SELECT date, city, {r('IFNULL(rainfall / NULLIF(precipitation_hours, 0), 0)')} AS rainfall_intensity FROM src_weather_raw
""")
COMFORT = even("""GREATEST(LEAST(100
  - CASE WHEN max_temp < 10 THEN (10 - max_temp) * 3.5::DOUBLE WHEN max_temp > 38 THEN (max_temp - 38) * 4
      WHEN max_temp > 30 THEN (max_temp - 30) * 1.5::DOUBLE ELSE 0 END
  - CASE WHEN humidity_3pm > 85 THEN (humidity_3pm - 85) * 0.6::DOUBLE WHEN humidity_3pm < 25 THEN (25 - humidity_3pm) * 0.4::DOUBLE ELSE 0 END
  - CASE WHEN wind_gust_speed > 50 THEN (wind_gust_speed - 50) * 0.5::DOUBLE WHEN wind_gust_speed > 25 THEN (wind_gust_speed - 25) * 0.3::DOUBLE ELSE 0 END
  - IF(rain_today = 1, 15, 0) + IF(sunshine_hours > 7, LEAST((sunshine_hours - 7) * 2, 10), 0), 100), 0)""", 1)
add("comfort_score", f"SELECT date, city, {COMFORT} AS comfort_score FROM src_weather_raw")


def wmo(code: str) -> str:
    # Code ranges of each class; any other code is sunny.
    return (f"CASE WHEN {code} IS NULL THEN 'Unknown' WHEN {code} BETWEEN 95 AND 99 THEN 'Stormy' "
            f"WHEN {code} BETWEEN 51 AND 67 OR {code} BETWEEN 80 AND 86 THEN 'Rainy' "
            f"WHEN {code} BETWEEN 10 AND 19 OR {code} IN (45, 48) THEN 'Cloudy' ELSE 'Sunny' END")


add("weather_type", f"SELECT date, city, {wmo('weather_code')} AS weather_type FROM src_weather_raw")
add("labelled", f"""
WITH n AS (
  SELECT *, LEAD(rainfall) OVER w AS n_rain, LEAD(max_temp) OVER w AS n_max, LEAD(min_temp) OVER w AS n_min,
    LEAD(weather_code) OVER w AS n_code, LEAD(wind_gust_speed) OVER w AS n_gust, LEAD(date) OVER w AS n_date
  FROM src_weather_raw {W})
SELECT n.date, n.city, IF(n_rain > 1, 1, 0) AS rain_tomorrow, n_max AS max_temp_tomorrow, {wmo('n_code')} AS weather_type_tomorrow,
  IF(n_max >= 35 AND h.consec_hot_days > 0, 1, 0) AS heatwave_risk, IF(n_min <= 2, 1, 0) AS frost_risk,
  IF(n_rain > 10 AND n_gust > 50, 1, 0) AS storm_label, n_date
FROM n JOIN features_hot_days h ON h.date = n.date AND h.city = n.city
""")
add("next_row_labels", "SELECT * EXCLUDE (n_date) FROM labelled")
add("labels_train_set", "SELECT * EXCLUDE (n_date) FROM labelled WHERE n_date IS NOT NULL")

add("with_season", f"SELECT *, {season('MONTH(date)')} AS season FROM src_weather_raw")
ENCODED = ["wind_gust_dir", "wind_dir_9am", "wind_dir_3pm", "city", "state", "season"]
add("encode_categoricals", "WITH " + ", ".join(
    f"m_{c} AS (SELECT {c}, (DENSE_RANK() OVER (ORDER BY {c}) - 1)::INT AS k FROM with_season WHERE {c} IS NOT NULL GROUP BY {c})"
    for c in ENCODED) + " SELECT w.date, w.city AS place, " + ", ".join(f"IFNULL(m_{c}.k, -1) AS {c}" for c in ENCODED)
    + " FROM with_season w " + " ".join(f"LEFT JOIN m_{c} ON m_{c}.{c} = w.{c}" for c in ENCODED))
BUILT = {
    "features_calendar": ["month", "day_of_year"],
    "features_lag": ["max_temp_lag1", "max_temp_lag2", "min_temp_lag1", "rainfall_lag1", "rainfall_lag2", "pressure_3pm_lag1"],
    "rolled": ["max_temp_rolling7", "rainfall_rolling7", "humidity_3pm_rolling7"],
    "features_derived": ["pressure_tendency", "temp_anomaly"],
    "features_hot_days": ["consec_hot_days", "hot_day_lag1", "hot_day_lag2"],
    "features_rain_intensity": ["rainfall_intensity"],
}
GIVEN = """min_temp max_temp rainfall evaporation sunshine_hours wind_gust_speed wind_speed_9am wind_speed_3pm humidity_9am
humidity_3pm pressure_9am pressure_3pm cloud_9am cloud_3pm temp_9am temp_3pm rain_today precipitation_hours
shortwave_radiation_sum vpd_9am vpd_3pm wind_speed_100m_9am wind_speed_100m_3pm""".split()
AVERAGED = {*BUILT["rolled"], *BUILT["features_derived"], *BUILT["features_rain_intensity"]}
MATRIX = [*GIVEN, *[x for names in BUILT.values() for x in names], *ENCODED]
add("training_frame", "SELECT w.city AS place, w.date, " + ", ".join(
    [f"w.{x}" for x in GIVEN] + [f"{t}.{x}" for t, names in BUILT.items() for x in names] + [f"e.{x}" for x in ENCODED])
    + " FROM src_weather_raw w JOIN encode_categoricals e ON e.place = w.city AND e.date = w.date "
    + " ".join(f"JOIN {t} ON {t}.city = w.city AND {t}.date = w.date" for t in BUILT))
add("feature_matrix", f"""
SELECT w.place AS key_place, w.date AS key_date, {', '.join(r(f'IFNULL(w.{x}, m.{x})') + f' AS {x}' for x in MATRIX)}
FROM training_frame w, (SELECT {cols(MATRIX, 'MEDIAN({c}) AS {c}')} FROM training_frame) m
""")
add("align_features", f"""
SELECT place, date, {', '.join((r(x) + ' AS ' if x in AVERAGED else '') + x for x in MATRIX if x != 'vpd_9am')},
  0::DOUBLE AS vpd_9am, 0::DOUBLE AS added_after_training FROM training_frame
""")

# --- monitoring ---------------------------------------------------------------------------------
add("stale_predictions", """
SELECT a.city, a.d AS latest_raw, b.d AS latest_pred
FROM (SELECT city, MAX(date) AS d FROM src_weather_raw GROUP BY city) a
LEFT JOIN (SELECT city, MAX(date) AS d FROM src_weather_predictions GROUP BY city) b USING (city)
WHERE a.d IS DISTINCT FROM b.d
""")
KS = ["max_temp", "min_temp", "humidity_3pm", "pressure_3pm", "rainfall", "wind_gust_speed"]


def ks_sql(runs: str) -> str:
    """The test of every feature for each date of a relation with a column ``run``."""
    return f"""
WITH l AS (
  SELECT run, run - date <= 30 AS recent, UNNEST([{', '.join(f"'{c}'" for c in KS)}]) AS feature_name, UNNEST([{', '.join(KS)}]) AS value
  FROM src_weather_raw, {runs} WHERE run - date BETWEEN 1 AND 60),
t AS (SELECT run, feature_name, ({n_if('recent')})::DOUBLE AS n, ({n_if('NOT recent')})::DOUBLE AS m FROM l WHERE value IS NOT NULL
  GROUP BY run, feature_name HAVING n >= 10 AND m >= 10),
g AS (
  SELECT run, feature_name, n, m,
    ABS((COUNT(*) FILTER (WHERE recent) OVER v) / n - (COUNT(*) FILTER (WHERE NOT recent) OVER v) / m) AS gap
  FROM l JOIN t USING (run, feature_name) WHERE value IS NOT NULL
  WINDOW v AS (PARTITION BY run, feature_name ORDER BY value RANGE UNBOUNDED PRECEDING)),
d AS (SELECT run, feature_name, ROUND(MAX(gap), 12) AS d, MAX(n) AS n, MAX(m) AS m FROM g GROUP BY ALL),
p AS (
  WITH RECURSIVE size AS (
    SELECT run, feature_name, d, LEAST(n, m)::BIGINT AS a, GREATEST(n, m)::BIGINT AS b, ROUND(d * n * m)::BIGINT AS gap FROM d),
  path AS (
    SELECT size.*, 0::BIGINT AS i, 0::BIGINT AS low, 0::DOUBLE AS logs,
      LIST_TRANSFORM(RANGE(0, LEAST(b, (gap - 1) // a) + 1), lambda k: 1::DOUBLE) AS ways FROM size WHERE gap > 0
    UNION ALL
    SELECT run, feature_name, d, a, b, gap, i, low, logs + LN(raw[-1]), LIST_TRANSFORM(raw, lambda x: x / raw[-1]) FROM (
      SELECT run, feature_name, d, a, b, gap, i + 1 AS i, f AS low, logs,
        LIST_TRANSFORM(RANGE(1, t - f + 2), lambda x: LIST_SUM(LIST_SLICE(ways, f - low + 1, f - low + x))) AS raw
      FROM (SELECT *, GREATEST(0, FLOOR(((i + 1) * b - gap)::DOUBLE / a)::BIGINT + 1) AS f,
          LEAST(b, CEIL(((i + 1) * b + gap)::DOUBLE / a)::BIGINT - 1) AS t FROM path WHERE i < a)))
  SELECT run, feature_name, d, 1 - EXP(logs + LN(ways[b - low + 1]) + LGAMMA(a + 1) + LGAMMA(b + 1) - LGAMMA(a + b + 1)) AS p
  FROM path WHERE i = a UNION ALL SELECT run, feature_name, d, 1::DOUBLE FROM size WHERE gap <= 0)
SELECT run AS date, feature_name, {even('d', 4)} AS ks_stat, {even('p', 4)} AS p_value, p < 0.05::DOUBLE AS drifted FROM p
"""


add("ks_drift", ks_sql(f"(SELECT {AS_OF} AS run)"))
add("run_dates", f"SELECT DISTINCT date AS run FROM stg_monitoring_decisions WHERE DAY(date) % 10 = 1 UNION SELECT {AS_OF}")
add("ks_drift_history", ks_sql("run_dates"))
add("drift_window_completeness", f"""
WITH w AS (SELECT ({n_if(f'{AS_OF} - date BETWEEN 1 AND 30')})::DOUBLE / 750 AS a, ({n_if(f'{AS_OF} - date BETWEEN 31 AND 60')})::DOUBLE / 750 AS b
  FROM src_weather_raw)
SELECT {r('a')} AS completeness_recent, {r('b')} AS completeness_baseline, LEAST(a, b) < 0.7::DOUBLE AS warning FROM w
""")
add("window_rows", f"SELECT * FROM full_rows WHERE {AS_OF} - date <= 30")
add("verifiable_metrics", f"""
WITH n AS (SELECT *, LEAD(rain_today) OVER w AS was, LEAD(max_temp) OVER w AS reached FROM window_rows {W}),
m AS (
  SELECT COUNT(*) AS k, {even('AVG((was = rain_tomorrow)::INT)', 4)} AS a30, {even('AVG(ABS(reached - max_temp_tomorrow))', 2)} AS e30,
    {even(f'AVG((was = rain_tomorrow)::INT) FILTER (WHERE {AS_OF} - date <= 7)', 4)} AS a7,
    {even(f'AVG(ABS(reached - max_temp_tomorrow)) FILTER (WHERE {AS_OF} - date <= 7)', 2)} AS e7 FROM n)
SELECT {AS_OF} AS date, IF(k < 30, 'no_data', 'computed') AS status, IF(k < 30, NULL, a30) AS rain_accuracy_30d,
  IF(k < 30, NULL, e30) AS temp_mae_30d, IF(k < 30, NULL, a7) AS rain_accuracy_7d, IF(k < 30, NULL, e7) AS temp_mae_7d,
  IF(k < 30, 'insufficient_rows (' || k || ' < 30)', NULL) AS reason FROM m
""")
add("prediction_coverage_gap", """
SELECT COUNT(DISTINCT city) AS cities_without_predictions FROM window_rows WHERE rain_tomorrow IS NULL
""")
add("retrain_cooldown", """
SELECT d.date, MAX(e.retrain_date) AS last_retrain_date, IFNULL(d.date - MAX(e.retrain_date) < 7, FALSE) AS in_cooldown
FROM stg_monitoring_decisions d LEFT JOIN stg_retrain_events e ON e.retrain_date <= d.date GROUP BY d.date
""")


def decision_sql(metrics: str, drift: str) -> str:
    return f"""
WITH f AS (SELECT date, COUNT(DISTINCT feature_name) AS k, STRING_AGG(DISTINCT feature_name, ',' ORDER BY feature_name) AS names
  FROM {drift} WHERE drifted GROUP BY date),
b AS (
  SELECT m.date, rain_accuracy_30d, temp_mae_30d, rain_accuracy_7d, temp_mae_7d,
    IFNULL(names, '') AS drifted_features, IFNULL(k, 0) AS n_drifted,
    IFNULL(rain_accuracy_30d < 0.75::DOUBLE, FALSE) AS low_accuracy, IFNULL(temp_mae_30d > 3, FALSE) AS high_mae,
    IFNULL(k, 0) >= 4 AS heavy_drift, IFNULL(k, 0) = 3 AS mild_drift,
    IFNULL(rain_accuracy_7d < 0.7::DOUBLE, FALSE) OR IFNULL(temp_mae_7d > 4, FALSE) AS early_warning,
    EXISTS (FROM stg_retrain_events e WHERE m.date - e.retrain_date BETWEEN 0 AND 6) AS in_cooldown
  FROM {metrics} m LEFT JOIN f USING (date)),
x AS (
  SELECT *, CASE WHEN rain_accuracy_30d IS NULL AND temp_mae_30d IS NULL THEN 'insufficient_data_for_metrics'
    WHEN low_accuracy OR high_mae OR heavy_drift THEN IF(in_cooldown, 'retrain_needed_but_cooldown_active', CONCAT_WS(' | ',
      IF(low_accuracy, PRINTF('rain_accuracy %.1f%% < 75%%', rain_accuracy_30d * 100), NULL),
      IF(high_mae, PRINTF('temp_mae %.2fC > 3.0C', temp_mae_30d), NULL),
      IF(heavy_drift, PRINTF('drift on %d features (>=4)', n_drifted), NULL)))
    WHEN mild_drift THEN 'mild_drift_on_3_features' WHEN early_warning THEN 'early_warning_7d' ELSE 'all_metrics_nominal' END AS reason FROM b)
SELECT *, reason AS reason_text,
  CASE reason WHEN 'insufficient_data_for_metrics' THEN 'insufficient_data' WHEN 'all_metrics_nominal' THEN 'no_action'
    WHEN 'retrain_needed_but_cooldown_active' THEN 'alert_only' WHEN 'mild_drift_on_3_features' THEN 'alert_only'
    WHEN 'early_warning_7d' THEN 'alert_only' ELSE 'trigger_retrain' END AS action
FROM x
"""


add("stored_metrics", "SELECT *, NULL::DOUBLE AS rain_accuracy_7d, NULL::DOUBLE AS temp_mae_7d FROM stg_model_metrics_history")
add("monitoring_decision", decision_sql("stored_metrics", "stg_drift_reports"))
add("metrics_by_run", f"""
WITH n AS (SELECT run, date, rain_tomorrow, max_temp_tomorrow, LEAD(rain_today) OVER w AS was, LEAD(max_temp) OVER w AS reached
  FROM full_rows, run_dates WHERE date BETWEEN run - 30 AND run WINDOW w AS (PARTITION BY run, city ORDER BY date)),
m AS (SELECT run, COUNT(*) AS k, {even('AVG((was = rain_tomorrow)::INT)', 4)} AS a30, {even('AVG(ABS(reached - max_temp_tomorrow))', 2)} AS e30,
  {even('AVG((was = rain_tomorrow)::INT) FILTER (WHERE run - date <= 7)', 4)} AS a7,
  {even('AVG(ABS(reached - max_temp_tomorrow)) FILTER (WHERE run - date <= 7)', 2)} AS e7 FROM n GROUP BY run)
SELECT run AS date, IF(k >= 30, a30, NULL) AS rain_accuracy_30d, IF(k >= 30, e30, NULL) AS temp_mae_30d,
  IF(k >= 30, a7, NULL) AS rain_accuracy_7d, IF(k >= 30, e7, NULL) AS temp_mae_7d FROM run_dates LEFT JOIN m USING (run)
""")
add("monitoring_run", decision_sql("metrics_by_run", "ks_drift_history"))
add("metrics_history_append", """
SELECT date, status, rain_accuracy_30d, temp_mae_30d, row_num FROM src_model_metrics_history
UNION ALL SELECT date, status, rain_accuracy_30d, temp_mae_30d, (SELECT MAX(row_num) + 1 FROM src_model_metrics_history) FROM verifiable_metrics
""")
add("baseline_gate", """
WITH p AS (
  SELECT date, LAG(rain_accuracy_30d) OVER (ORDER BY date) AS old_rain_accuracy, LAG(temp_mae_30d) OVER (ORDER BY date) AS old_temp_mae,
    rain_accuracy_30d AS new_rain_accuracy, temp_mae_30d AS new_temp_mae FROM stg_model_metrics_history),
q AS (SELECT *, IFNULL(new_rain_accuracy < ROUND(old_rain_accuracy - 0.02::DOUBLE, 12), FALSE) AS a,
  IFNULL(new_temp_mae > ROUND(old_temp_mae + 0.2::DOUBLE, 12), FALSE) AS b FROM p)
SELECT * EXCLUDE (a, b), a OR b AS degraded, CONCAT_WS(' | ',
  IF(a, PRINTF('rain_accuracy degraded: %.3f vs baseline %.3f', new_rain_accuracy, old_rain_accuracy), NULL),
  IF(b, PRINTF('temp_mae degraded: %.2f vs baseline %.2f', new_temp_mae, old_temp_mae), NULL)) AS issues
FROM q
""")
add("baseline_delta", f"""
WITH e AS (SELECT ARG_MAX(rain_accuracy_30d, date) - ARG_MIN(rain_accuracy_30d, date) AS a,
  ARG_MAX(temp_mae_30d, date) - ARG_MIN(temp_mae_30d, date) AS b FROM stg_model_metrics_history)
SELECT 'rain_accuracy_30d' AS metric, {even('a', 6)} AS delta FROM e UNION ALL SELECT 'temp_mae_30d', {even('b', 6)} FROM e
""")
add("alert_dedup", """
WITH RECURSIVE sent AS (
  SELECT event_type AS alert_key, MIN(ts) AS ts FROM events GROUP BY event_type
  UNION ALL
  SELECT s.alert_key, (SELECT MIN(e.ts) FROM events e WHERE e.event_type = s.alert_key AND e.ts >= s.ts + INTERVAL 24 HOUR)
  FROM sent s WHERE s.ts IS NOT NULL)
SELECT alert_key, ts FROM sent WHERE ts IS NOT NULL
""")

# --- exploration --------------------------------------------------------------------------------
# Column lists.
ENRICHED = [
    "rain_sum", "precipitation_hours", "dew_point_9am", "dew_point_3pm", "surface_pressure_9am",
    "surface_pressure_3pm", "shortwave_radiation_sum", "vpd_9am", "vpd_3pm", "wind_speed_100m_9am",
    "wind_speed_100m_3pm",
]
BASE = [
    "min_temp", "max_temp", "temp_9am", "temp_3pm", "rainfall", "rain_today", "humidity_9am", "humidity_3pm",
    "pressure_9am", "pressure_3pm", "evaporation", "sunshine_hours", "cloud_9am", "cloud_3pm", "wind_gust_speed",
    "wind_speed_9am", "wind_speed_3pm", "weather_code",
]
TARGETS = PRED[:8]
add("complete_cases", f"""
SELECT *, MONTH(date) AS month, YEAR(date) AS year, {season('MONTH(date)')} AS season FROM full_rows
WHERE {' AND '.join(f'{c} IS NOT NULL' for c in ENRICHED + BASE + TARGETS)}
""")
ALL = ["date", "city", "state", "latitude", "longitude"] + RAW + PRED
add("null_rates", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {r(f'100::DOUBLE * (COUNT(*) - COUNT({c})) / COUNT(*)')} AS null_pct FROM full_rows" for c in ALL))
add("city_coverage", f"""
SELECT city, MIN(date) AS first_date, MAX(date) AS last_date, COUNT(*) AS n_days, MAX(date) - MIN(date) + 1 AS expected_days,
  {r('COUNT(*) * 100::DOUBLE / (MAX(date) - MIN(date) + 1)')} AS completeness_pct
FROM src_weather_raw GROUP BY city
""")
add("pivot_city_year", "SELECT city, " + ", ".join(f'{n_if(f"YEAR(date) = {y}")} AS "{y}"' for y in range(1995, 2002))
    + " FROM src_weather_raw GROUP BY city")
add("value_counts", "SELECT wind_dir_3pm AS value, COUNT(*) AS n FROM src_weather_raw WHERE wind_dir_3pm IS NOT NULL GROUP BY 1")
add("describe_numeric", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, COUNT({c}) AS count, {avg(c)} AS mean, {r(f'STDDEV({c})')} AS std, MIN({c}) AS min, MAX({c}) AS max, "
    + ", ".join(f"{r(f'QUANTILE_CONT({c}, {p / 100})')} AS q{p}" for p in (25, 50, 75)) + " FROM src_weather_raw"
    for c in ["latitude", "longitude", *RAW] if "_dir" not in c))
add("histogram", """
WITH e AS (SELECT MIN(max_temp) AS lo, (MAX(max_temp) - MIN(max_temp)) / 25 AS w FROM src_weather_raw),
b AS (SELECT LEAST(FLOOR((max_temp - lo) / w), 24)::INT AS bin, lo, w FROM src_weather_raw, e WHERE max_temp IS NOT NULL)
SELECT bin, COUNT(*) AS n, «lo + bin * w» AS bin_low FROM b GROUP BY bin, lo, w
""")
add("log_histogram", """
WITH l AS (SELECT LN(1 + rainfall) AS x FROM src_weather_raw WHERE rainfall > 0),
e AS (SELECT MAX(x) / 16 AS w FROM l),
b AS (SELECT LEAST(FLOOR(x / w), 15)::INT AS bin, w FROM l, e)
SELECT bin, COUNT(*) AS n, «bin * w» AS bin_low FROM b GROUP BY bin, w
""")
add("quantile_profile", " UNION ALL ".join(
    f"SELECT 'rainfall' AS feature, {p}::DOUBLE AS prob, {r(f'QUANTILE_CONT(rainfall, {p})')} AS quantile FROM src_weather_raw WHERE rainfall > 0"
    for p in (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)))


def box_sql(relation: str) -> str:
    return f"""
WITH q AS (SELECT grouping, grp, measure, QUANTILE_CONT(value, 0.25) AS q25, QUANTILE_CONT(value, 0.5) AS q50, QUANTILE_CONT(value, 0.75) AS q75
  FROM {relation} GROUP BY ALL),
i AS (SELECT q.*, value, value BETWEEN 2.5::DOUBLE * q25 - 1.5::DOUBLE * q75 AND 2.5::DOUBLE * q75 - 1.5::DOUBLE * q25 AS ok
  FROM {relation} JOIN q USING (grouping, grp, measure))
SELECT grouping, grp, measure, {r('q25')} AS q25, {r('q50')} AS q50, {r('q75')} AS q75, MIN(value) FILTER (WHERE ok) AS whisker_low,
  MAX(value) FILTER (WHERE ok) AS whisker_high, ({n_if('NOT ok')})::BIGINT AS n_outliers, COUNT(*) AS n
FROM i GROUP BY grouping, grp, measure, q25, q50, q75
"""


BOXES = {
    ("season", "with_season"): ["max_temp", "rainfall", "humidity_3pm"],
    ("rain_today", "with_season"): ["humidity_3pm", "pressure_3pm", "cloud_3pm"],
    ("weather_type_tomorrow", "src_weather_predictions"): ["rain_tomorrow_proba", "max_temp_tomorrow", "comfort_score"],
}
add("box_values", " UNION ALL ".join(
    f"SELECT '{g}' AS grouping, {g}::VARCHAR AS grp, '{m}' AS measure, {m}::DOUBLE AS value FROM {t} WHERE {g} IS NOT NULL AND {m} IS NOT NULL"
    for (g, t), measures in BOXES.items() for m in measures))
add("boxplot_groups", box_sql("box_values"))
add("boxplot_stats", """
SELECT grp AS season, q25, q50, q75, whisker_low, whisker_high, n_outliers, n FROM boxplot_groups
WHERE grouping = 'season' AND measure = 'rainfall'
""")


def profiled(keys: str, table: str, means: dict[str, str], where: str = "TRUE") -> str:
    inner = ", ".join(f"{avg(c)} AS {n}" for n, c in means.items())
    return f"SELECT {keys}, {inner} FROM {table} WHERE {where} GROUP BY ALL"


add("monthly_climatology", profiled("MONTH(date) AS month", "src_weather_raw", dict(
    max_temp="max_temp", min_temp="min_temp", rain_pct="rain_today", shortwave="shortwave_radiation_sum", vpd_3pm="vpd_3pm",
    dew_point="dew_point_3pm", precip_hours="precipitation_hours")))
add("annual_trend", " UNION ALL ".join(f"""
SELECT '{c}' AS feature, {r('REGR_SLOPE(y, x) * 10', 6)} AS slope_per_decade, {r('REGR_INTERCEPT(y, x)', 4)} AS intercept,
  {r('REGR_R2(y, x)', 6)} AS r2, COUNT(*) AS n_years
FROM (SELECT YEAR(date) AS x, AVG({c}) AS y FROM src_weather_raw WHERE {c} IS NOT NULL GROUP BY 1) WHERE x <= 2000
""" for c in ("max_temp", "min_temp")))
add("city_profile", profiled("city, state", "src_weather_raw", dict(
    max_temp_mean="max_temp", min_temp_mean="min_temp", rain_days_share="rain_today", rainfall_mean="rainfall",
    humidity_3pm_mean="humidity_3pm", wind_gust_mean="wind_gust_speed")))
STATE = dict(max_temp="max_temp", min_temp="min_temp", rain_days="rain_today", humidity_3pm="humidity_3pm",
             wind_gust="wind_gust_speed", sunshine="sunshine_hours")
add("state_profile", "SELECT state, " + ", ".join(f"{avg(c, 2)} AS {n}" for n, c in STATE.items()) + " FROM src_weather_raw GROUP BY state")
add("minmax_profile", "SELECT state, " + ", ".join(
    r(f"(x.{n} - MIN(x.{n}) OVER ()) / NULLIF(MAX(x.{n}) OVER () - MIN(x.{n}) OVER (), 0)") + f" AS {n}" for n in STATE)
    + " FROM state_profile x")
add("geo_profile", profiled("city, latitude, longitude", "full_rows", dict(
    max_temp="max_temp", vpd_3pm="vpd_3pm", rain_pct="rain_today", heatwave="heatwave_risk", frost="frost_risk")))
add("risk_by_city", profiled("city", "full_rows", dict(
    heatwave_risk_mean="heatwave_risk", frost_risk_mean="frost_risk", storm_prob_mean="storm_probability"),
    "rain_tomorrow IS NOT NULL AND rain_tomorrow_proba IS NOT NULL"))
# Column lists.
CF = [
    "min_temp", "max_temp", "temp_9am", "temp_3pm", "rainfall", "rain_sum", "precipitation_hours", "rain_today",
    "humidity_9am", "humidity_3pm", "dew_point_9am", "dew_point_3pm", "pressure_9am", "pressure_3pm",
    "surface_pressure_9am", "surface_pressure_3pm", "cloud_9am", "cloud_3pm", "sunshine_hours",
    "shortwave_radiation_sum", "wind_gust_speed", "wind_speed_9am", "wind_speed_3pm", "wind_speed_100m_9am",
    "wind_speed_100m_3pm", "vpd_9am", "vpd_3pm", "evaporation",
]
CT = [
    "rain_tomorrow", "max_temp_tomorrow", "comfort_score", "heatwave_risk", "frost_risk", "storm_probability",
]
PAIRS = [(a, b) for i, a in enumerate(CF + CT) for b in (CF + CT)[i:]]
add("corr_half", f"""
SELECT UNNEST([{', '.join(f"'{a}'" for a, _ in PAIRS)}]) AS a, UNNEST([{', '.join(f"'{b}'" for _, b in PAIRS)}]) AS b, UNNEST(rs) AS r
FROM (SELECT [{', '.join(r(f'CORR({a}, {b})', 6) for a, b in PAIRS)}] AS rs FROM full_rows)
""")
add("corr_matrix", "SELECT a, b, r FROM corr_half UNION SELECT b, a, r FROM corr_half")
add("corr_top5", f"""
SELECT b AS target, a AS feature, r, ROW_NUMBER() OVER (PARTITION BY b ORDER BY ABS(r) DESC, a)::INT AS rank FROM corr_matrix
WHERE b IN ({', '.join(f"'{c}'" for c in CT)}) AND a IN ({', '.join(f"'{c}'" for c in CF)}) AND r IS NOT NULL QUALIFY rank <= 5
""")
add("corr_redundant", "SELECT * FROM corr_matrix WHERE a < b AND ABS(r) >= 0.85::DOUBLE")


def tail(t: str, dof: str, steps: int = 50_000) -> str:
    """Two-sided p-value of Student's t: the density summed at midpoints over the angle of t."""
    angle = f"ATAN(ABS({t}) / SQRT({dof}))"
    inside = f"SUM(EXP(({dof} - 1) * LN(COS((k + 0.5::DOUBLE) * {angle} / {steps})))) * {angle} / {steps}"
    factor = f"2 * EXP(LGAMMA(({dof} + 1) / 2) - LGAMMA({dof} / 2)) / SQRT(PI())"
    return f"GREATEST(0, 1 - (SELECT {factor} * {inside} FROM RANGE({steps}) steps(k)))"


add("pearson_pair", f"""
WITH c AS (SELECT CORR(shortwave_radiation_sum, max_temp_tomorrow) AS rr, REGR_COUNT(shortwave_radiation_sum, max_temp_tomorrow)::BIGINT AS n FROM full_rows),
u AS (SELECT *, rr * SQRT((n - 2) / (1 - rr * rr)) AS tt, (n - 2)::DOUBLE AS v FROM c)
SELECT {r('rr', 6)} AS r, n, {r('tt', 4)} AS t, {r(tail('tt', 'v'), 6)} AS p FROM u
""")
add("pooled_t", f"""
WITH l AS (SELECT rain_tomorrow AS g, UNNEST(['humidity_3pm', 'dew_point_3pm', 'cloud_3pm', 'pressure_3pm', 'vpd_3pm']) AS feature,
  UNNEST([humidity_3pm, dew_point_3pm, cloud_3pm, pressure_3pm, vpd_3pm]) AS v FROM full_rows WHERE rain_tomorrow IS NOT NULL),
a AS (SELECT feature, COUNT(v) FILTER (WHERE g = 0) AS n0, COUNT(v) FILTER (WHERE g = 1) AS n1, AVG(v) FILTER (WHERE g = 0) AS m0,
  AVG(v) FILTER (WHERE g = 1) AS m1, VAR_POP(v) FILTER (WHERE g = 0) AS p0, VAR_POP(v) FILTER (WHERE g = 1) AS p1 FROM l GROUP BY feature),
u AS (SELECT *, (m0 - m1) / SQRT((n0 * p0 + n1 * p1) / (n0 + n1 - 2) * ((n0 + n1)::DOUBLE / (n0 * n1))) AS tt,
  (n0 + n1 - 2)::DOUBLE AS w FROM a)
SELECT feature, n0, n1, {r('tt', 6)} AS t, {r(tail('tt', 'w'), 6)} AS p FROM u
""")
add("wind_ratio", f"""
SELECT date, city, {r('wind_speed_100m_9am / (wind_speed_9am + 0.01::DOUBLE)')} AS wind_ratio_9am,
  {r('wind_speed_100m_3pm / (wind_speed_3pm + 0.01::DOUBLE)')} AS wind_ratio_3pm FROM src_weather_raw
""")
DELTA = "max_temp_tomorrow - max_temp"
add("delta_temp", f"""
SELECT {avg(DELTA)} AS mean, {r(f'STDDEV({DELTA})')} AS std, COUNT({DELTA}) AS n, {r(f'QUANTILE_CONT({DELTA}, 0.05)')} AS p5,
  {r(f'QUANTILE_CONT({DELTA}, 0.95)')} AS p95 FROM full_rows
""")
add("calibration_curve", f"""
WITH k AS (SELECT rain_tomorrow_proba AS p, rain_tomorrow AS y FROM full_rows WHERE rain_tomorrow_proba IS NOT NULL AND rain_tomorrow IS NOT NULL),
s AS (SELECT MIN(p) AS a, MAX(p) AS z FROM k),
b AS (SELECT y, GREATEST(CEIL(ROUND((p - a) * 10 / (z - a), 12))::INT - 1, 0) AS bin, a, (z - a) / 10 AS w FROM k, s)
SELECT bin, {r('ANY_VALUE(a) + (bin + 0.5::DOUBLE) * ANY_VALUE(w)')} AS bin_center, {avg('y')} AS observed_rate, COUNT(*) AS n FROM b GROUP BY bin
""")
add("class_balance", """
SELECT feature, ROUND_EVEN(v, 0)::INT AS class, COUNT(*) AS n FROM (
  SELECT UNNEST(['rain_tomorrow', 'heatwave_risk', 'frost_risk']) AS feature, UNNEST([rain_tomorrow::DOUBLE, heatwave_risk, frost_risk]) AS v
  FROM full_rows) WHERE v IS NOT NULL GROUP BY ALL
""")
add("mae_by_city", f"""
SELECT city, {avg('temp_abs_error', 2)} AS mae, {r('MAX(temp_abs_error)', 2)} AS max_error, {r('MEDIAN(temp_abs_error)', 2)} AS median_error
FROM forecast_timeline WHERE temp_abs_error IS NOT NULL GROUP BY city
""")
add("seasonal_month_performance", f"""
SELECT MONTH(po.month) AS month_num, {avg('po.rain_accuracy')} AS rain_accuracy, {avg('po.temp_mae')} AS temp_mae FROM performance_overview po GROUP BY 1
""")
add("date_ranges", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", MIN({d}) AS first_date, MAX({d}) AS last_date FROM {t}" for t, d in (
        ("performance_overview", "month"), ("performance_by_city", "month"), ("forecast_timeline", "prediction_date"),
        ("mlops_health", "date"), ("retraining_history", "retrain_date"))))
add("city_means", """
SELECT city, state, ROUND(AVG(pc.rain_accuracy), 12) AS acc, ROUND(AVG(pc.temp_mae), 12) AS mae, COUNT(*) AS n_months
FROM performance_by_city pc GROUP BY city, state
""")
add("topk_cities", f"""
SELECT city, state, {r('acc')} AS rain_accuracy_avg, {r('mae')} AS temp_mae_avg, n_months, list FROM (
  (SELECT *, 'best_accuracy' AS list FROM city_means ORDER BY acc DESC NULLS LAST, city LIMIT 5)
  UNION ALL (SELECT *, 'largest_error' FROM city_means ORDER BY mae DESC NULLS LAST, city LIMIT 5))
""")
add("hash_sample", """
SELECT date, city, max_temp, max_temp_tomorrow, state FROM full_rows WHERE max_temp + max_temp_tomorrow IS NOT NULL
ORDER BY MD5(city || '|' || date::VARCHAR) LIMIT 5000
""")
add("max_gap", """
SELECT city, MAX(g) AS max_gap_days FROM (SELECT city, date - LAG(date) OVER (PARTITION BY city ORDER BY date) AS g FROM src_weather_raw) GROUP BY city
""")


def backtest(days: int) -> str:
    return (f"SELECT {days} AS window_days, {r('AVG(ABS(p - max_temp))')} AS mae, COUNT(DISTINCT date) AS evaluated_days FROM ("
            f"SELECT date, max_temp, LAG(max_temp_tomorrow) OVER (PARTITION BY city ORDER BY date) AS p FROM full_rows "
            f"WHERE date >= (SELECT MAX(date) - {days} FROM src_weather_raw)) WHERE p + max_temp IS NOT NULL")


add("backtest_window", " UNION ALL ".join(backtest(d) for d in (7, 30, 90)))
add("backtest_rain_accuracy", f"""
SELECT city, {r('AVG((p = rain_today)::INT)')} AS rain_accuracy, COUNT(*) AS evaluated_days FROM (
  SELECT city, rain_today, LAG(rain_tomorrow) OVER (PARTITION BY city ORDER BY date) AS p FROM full_rows
  WHERE date >= (SELECT MAX(date) - 90 FROM src_weather_raw)) WHERE p + rain_today IS NOT NULL GROUP BY city
""")
add("pivot_city_date", "SELECT date, " + ", ".join(
    f"{r(f'''AVG(max_temp_tomorrow) FILTER (WHERE city = 'NATION_{i}')''')} AS \"NATION_{i}\"" for i in range(25))
    + " FROM full_rows WHERE max_temp_tomorrow IS NOT NULL GROUP BY date")
add("last_month_by_city", f"""
SELECT * REPLACE ({r('rain_accuracy_30d_eom')} AS rain_accuracy_30d_eom, {r('temp_mae_30d_eom')} AS temp_mae_30d_eom)
FROM performance_by_city WHERE month = (SELECT MAX(month) FROM performance_by_city)
""")
add("latest_health", "SELECT * FROM mlops_health ORDER BY date DESC LIMIT 1")

# --- measures -----------------------------------------------------------------------------------
SLICE = "city = 'NATION_7' AND prediction_date BETWEEN DATE '1999-01-01' AND DATE '2000-12-31'"


def sliced(name: str, body: str, second: str = SLICE) -> None:
    add(name, " UNION ALL ".join(
        "SELECT " + body.replace("@WHERE", where).replace("@SLICE", label) for label, where in (("all", "TRUE"), ("slice", second))))


sliced("kpi_latest_day", f"""
prediction_date AS latest_date, {r('AVG(pred_max_temp_tomorrow)', 1)} AS avg_temp_tomorrow, {r('AVG(pred_rain_proba) * 100', 1)} AS avg_rain_pct,
  {r('AVG(comfort_score)', 1)} AS avg_comfort_score, {r('AVG(heatwave_risk) * 100', 1)} AS avg_heatwave_pct,
  {r('AVG(storm_probability) * 100', 1)} AS avg_storm_pct,
  (SELECT COUNT(DISTINCT g.city) FROM forecast_vs_actual_daily g WHERE g.prediction_date = f.prediction_date) AS active_cities,
  STRFTIME(prediction_date, '%d/%m/%Y') AS latest_date_label, '@SLICE' AS slice
FROM forecast_vs_actual_daily f WHERE @WHERE AND prediction_date = (SELECT MAX(prediction_date) FROM forecast_vs_actual_daily WHERE @WHERE)
GROUP BY prediction_date
""", "city = 'NATION_7'")
add("kpi_alerts_today", f"""
SELECT weather_date, COUNT(*) AS n_alerts_today, {n_if("alert_level = 'Critical'")} AS n_critical_today, {n_if("alert_level = 'High'")} AS n_high_today,
  (SELECT COUNT(*) FROM weather_extremes) AS n_extreme_events
FROM risk_alerts WHERE weather_date = (SELECT MAX(weather_date) FROM risk_alerts) GROUP BY weather_date
""")
add("kpi_ops_latest", """
SELECT date, completeness_pct, IFNULL(MAP {'no_action': 'OK', 'alert_only': 'Attention', 'trigger_retrain': 'Critique',
  'alert_insufficient_data': 'Données insuffisantes'}[monitoring_action], 'Inconnu') AS global_status, days_since_retrain, n_drifted_features,
  rain_accuracy_30d, temp_mae_30d FROM mlops_health ORDER BY date DESC LIMIT 1
""")
sliced("kpi_forecast_actual", f"""
{r('AVG(pred_max_temp_tomorrow)', 1)} AS predicted_temp, {r('AVG(actual_max_temp_tomorrow)', 1)} AS actual_temp,
  {r('AVG(pred_rain_proba) * 100', 1)} AS mean_rain_pct,
  {r('AVG(actual_rain_tomorrow) FILTER (WHERE actual_max_temp_tomorrow IS NOT NULL) * 100', 1)} AS actual_rain_pct,
  COUNT(actual_max_temp_tomorrow) AS n_validated, '@SLICE' AS slice FROM forecast_vs_actual_daily WHERE @WHERE
""")
QUALITY = """SELECT ROUND(AVG(IFNULL(rain_prediction_correct, 0)) FILTER (WHERE actual_max_temp_tomorrow IS NOT NULL), 12) AS acc,
  ROUND(AVG(temp_abs_error), 12) AS mae, ROUND(AVG(temp_error_signed), 12) AS bias, ROUND(AVG(comfort_score), 12) AS comfort,
  COUNT(*) FILTER (WHERE forecast_result = 'True positive') AS tp, COUNT(*) FILTER (WHERE forecast_result = 'True negative') AS tn,
  COUNT(*) FILTER (WHERE forecast_result = 'False positive') AS fp, COUNT(*) FILTER (WHERE forecast_result = 'False negative') AS fn
  FROM forecast_vs_actual_daily WHERE @WHERE"""
sliced("kpi_quality", f"""
{r('acc')} AS rain_accuracy, {r('mae')} AS temp_mae, {r('bias')} AS temp_bias, tp, tn, fp, fn, {r('tp::DOUBLE / NULLIF(tp + fp, 0)')} AS precision,
  {r('tp::DOUBLE / NULLIF(tp + fn, 0)')} AS recall, {r('acc * 100', 1)} AS rain_accuracy_pct, {r('mae', 2)} AS temp_mae_rounded,
  {r('2 * tp::DOUBLE / NULLIF(2 * tp + fp + fn, 0)')} AS f1_score, {r('fp * 100::DOUBLE / NULLIF(fp + tn, 0)', 1)} AS false_alarm_pct,
  {r('fn * 100::DOUBLE / NULLIF(fn + tp, 0)', 1)} AS missed_rain_pct,
  CASE WHEN bias > 0.5 THEN 'Surchauffe' WHEN bias < -0.5 THEN 'Sous-estime' ELSE 'Neutre' END AS bias_direction, '@SLICE' AS slice FROM ({QUALITY})
""")
sliced("kpi_vs_baseline", f"""
{r('(acc - 0.77::DOUBLE) * 100', 1)} AS accuracy_vs_baseline, {r('mae - 1.63::DOUBLE', 2)} AS mae_vs_baseline, '@SLICE' AS slice FROM ({QUALITY})
""")
add("kpi_retraining", f"""
SELECT {avg('accuracy_delta')} AS avg_accuracy_delta, {avg('mae_delta')} AS avg_mae_delta, COUNT(*) AS n_retrains,
  {n_if('low_accuracy OR heavy_drift')} AS n_degrading, {r('100::DOUBLE * ' + n_if('low_accuracy OR heavy_drift') + ' / COUNT(*)', 0)} AS pct_degrading
FROM retraining_history
""")
SCORE = r("acc * 40 + comfort * 0.4::DOUBLE + GREATEST((5 - mae) * 4, 0)", 1)
sliced("kpi_weather_score", f"""
{SCORE} AS weather_score, CASE WHEN {SCORE} >= 90 THEN 'Excellent' WHEN {SCORE} >= 75 THEN 'Bon' WHEN {SCORE} >= 60 THEN 'Moyen' ELSE 'Faible' END
  AS performance_category, '@SLICE' AS slice FROM ({QUALITY})
""")
sliced("kpi_city_label", """
IF(COUNT(DISTINCT lieu_state) = 1, MIN(lieu_state), NULL) AS city_label, '@SLICE' AS slice FROM location_cities WHERE @WHERE
""", "lieu = 'NATION_7'")
MONTHS = "'January','February','March','April','May','June','July','August','September','October','November','December'"
add("calendar_days", """
SELECT CAST(d AS DATE) AS date FROM GENERATE_SERIES(
  (SELECT MAKE_DATE(YEAR(MIN(date)), 1, 1)::TIMESTAMP FROM stg_weather_raw),
  (SELECT MAKE_DATE(YEAR(MAX(date)), 12, 31)::TIMESTAMP FROM stg_weather_raw), INTERVAL 1 DAY) t(d)
""")
add("full_calendar", f"""
SELECT date, YEAR(date) AS year, MONTH(date) AS month_num, MONTHNAME(date) AS month_name, MONTHNAME(date)[:3] AS month_short,
  STRFTIME(date, '%Y-%m') AS year_month, 'T' || QUARTER(date) AS quarter, DAY(date) AS day, ISODOW(date) AS weekday_num, DAYNAME(date) AS weekday_name,
  CAST((DAYOFYEAR(date) + ISODOW(MAKE_DATE(YEAR(date), 1, 1)) - 2) // 7 + 1 AS INT) AS week_of_year, STRFTIME(date, 'W%V') AS iso_week,
  ISOYEAR(date) AS iso_year, STRFTIME(date, '%G-W%V') AS iso_year_week, {season('MONTH(date)')} AS season,
  CAST((MONTH(date) % 12) // 3 + 1 AS INT) AS season_order
FROM calendar_days
""")
add("forecast_calc_columns", f"""
SELECT *, {season('MONTH(prediction_date)')} AS season, STRFTIME(prediction_date, '%Y-%m') AS year_month_label, YEAR(prediction_date) AS year,
  MONTHNAME(prediction_date)[:3] AS month_name, (actual_max_temp_tomorrow IS NOT NULL)::INT AS has_actual,
  CASE WHEN temp_error_signed > 0.5 THEN 'Surchauffe' WHEN temp_error_signed < -0.5 THEN 'Sous-estime' ELSE 'Neutre' END AS bias_direction_row,
  IFNULL(MAP {{'True positive': 'Vrai positif (pluie détectée)', 'True negative': 'Vrai négatif (sec bien prédit)',
    'False positive': 'Fausse alarme (prédit pluie, sec)', 'False negative': 'Pluie manquée (pas prédit, a plu)'}}[forecast_result],
    forecast_result) AS forecast_result_fr
FROM forecast_vs_actual_daily
""")
add("drift_month_date", "SELECT *, MAKE_DATE(year, month, 1) AS month_date FROM feature_drift_summary")
add("typed_mart_read", """
SELECT * EXCLUDE (state, latitude, longitude, weather_type_tomorrow), weather_type_tomorrow AS predicted_type FROM forecast_vs_actual_daily
""")

# --- quality and serving ------------------------------------------------------------------------
add("assert_not_null", " UNION ALL ".join(
    f"SELECT 'not_null:{c}' AS \"check\", {n_if(f'{c} IS NULL')} AS n_bad, {n_if(f'{c} IS NULL')} = 0 AS passed FROM stg_weather_raw"
    for c in ("date", "city", "min_temp", "wind_dir_3pm")))
add("assert_unique", " UNION ALL ".join(
    f"SELECT 'unique:{k}' AS \"check\", COUNT(*) AS n_bad, COUNT(*) = 0 AS passed FROM (SELECT {k} FROM stg_weather_raw GROUP BY {k} HAVING COUNT(*) > 1)"
    for k in ("date,city", "date")))
add("assert_accepted_values", """
SELECT 'accepted_values:action' AS "check", COUNT(*) AS n_bad, COUNT(*) = 0 AS passed FROM stg_monitoring_decisions
WHERE action NOT IN ('trigger_retrain', 'alert_only', 'alert_insufficient_data', 'no_action')
UNION ALL SELECT 'accepted_values:pred_weather_type_tomorrow', COUNT(*), COUNT(*) = 0 FROM stg_weather_predictions
WHERE pred_weather_type_tomorrow NOT IN ('Sunny', 'Rainy')
""")
GATES = {
    "no nulls": " + ".join(f"COUNT(*) - COUNT({c})" for c in BASE + ENRICHED + TARGETS),
    "max_temp in [-5, 55]": n_if("max_temp NOT BETWEEN -5 AND 55"), "min_temp in [-15, 40]": n_if("min_temp NOT BETWEEN -15 AND 40"),
    "humidity in [0, 100]": n_if("humidity_9am NOT BETWEEN 0 AND 100 OR humidity_3pm NOT BETWEEN 0 AND 100"),
    "pressure_9am in [950, 1060]": n_if("pressure_9am NOT BETWEEN 950 AND 1060"), "rainfall >= 0": n_if("rainfall < 0"),
    **{f"{c} in [0, 1]": n_if(f"{c} NOT BETWEEN 0 AND 1") for c in ("rain_tomorrow_proba", "heatwave_risk", "frost_risk", "storm_probability")},
    "comfort_score in [0, 100]": n_if("comfort_score NOT BETWEEN 0 AND 100"),
    "max_temp_tomorrow in [0, 55]": n_if("max_temp_tomorrow NOT BETWEEN 0 AND 55"), "vpd >= 0": n_if("LEAST(vpd_9am, vpd_3pm) < 0"),
    "shortwave_radiation_sum >= 0": n_if("shortwave_radiation_sum < 0"), "max_temp >= min_temp": n_if("max_temp < min_temp"),
    "no duplicate (city, date)": "COUNT(*) - COUNT(DISTINCT (city, date))", "26 cities": "ABS(26 - COUNT(DISTINCT city))",
    "no gap over 7 days": "MAX((SELECT COUNT(*) FROM max_gap WHERE max_gap_days > 7))",
}
add("quality_gates", "SELECT gate, n_bad, IF(n_bad = 0, 'PASS', 'FAIL') AS status FROM (" + " UNION ALL ".join(
    f"SELECT '{g}' AS gate, CAST({x} AS BIGINT) AS n_bad FROM full_rows" for g, x in GATES.items()) + ")")
add("api_weather", "SELECT * FROM full_rows WHERE city = 'NATION_7' AND date >= DATE '1999-01-01' ORDER BY date DESC, city LIMIT 500")
add("api_latest", "SELECT * FROM full_rows WHERE predicted_at IS NOT NULL QUALIFY ROW_NUMBER() OVER (PARTITION BY city ORDER BY date DESC) = 1")
add("api_predictions", "SELECT * FROM src_weather_predictions WHERE YEAR(date) IN (1999, 2000)")
# Client names of published models that are not made from the name of the table.
NAMED = {
    "homepage_kpis": "bi-homepage-kpis",
    "forecast_timeline": "forecast-timeline",
    "mlops_health": "health",
    "performance_by_city": "performance-by-city",
    "performance_overview": "performance-overview",
}
add("api_mart", " UNION ALL ".join(
    f"SELECT '{NAMED.get(m, t.removeprefix('mart_').replace('_', '-'))}' AS slug, COUNT(*) AS n_rows FROM {m}"
    for t, m in [*EXPORTED, ("location_cities", "location_cities")]))
add("json_records", """
SELECT '{"date":"' || date || '","city":"' || city || '","max_temp":' || IFNULL(max_temp::VARCHAR, 'null') || ',"wind_dir_3pm":'
  || IFNULL('"' || wind_dir_3pm || '"', 'null') || ',"weather_code":' || IFNULL(weather_code::VARCHAR, 'null') || ',"comfort_score":'
  || IFNULL(comfort_score::VARCHAR, 'null') || ',"rate":'
  || IFNULL(ROUND_EVEN(rainfall / NULLIF(precipitation_hours, 0), 0)::VARCHAR, 'null') || '}' AS value
FROM full_rows
""")
add("city_list", "SELECT city, state, latitude AS lat, longitude AS lon FROM dim_city")
add("last_update", "SELECT MAX(date) AS last_data_update FROM src_weather_raw")

# --- learning -----------------------------------------------------------------------------------
add("target_mask", "SELECT * FROM labels_train_set WHERE max_temp_tomorrow IS NOT NULL")
add("class_weights", " UNION ALL ".join(
    f"SELECT {n_if(f'{t} = 0')} AS negatives, {n_if(f'{t} = 1')} AS positives, "
    + r(f"(SUM(1 - {t}))::DOUBLE / GREATEST(SUM({t}), 1)") + f" AS ratio, '{t}' AS label FROM labels_train_set"
    for t in ("rain_tomorrow", "heatwave_risk", "frost_risk", "storm_label")))
add("stratified_split", """
SELECT date, city, rain_tomorrow, ROW_NUMBER() OVER (PARTITION BY rain_tomorrow ORDER BY MD5('42|' || city || '|' || date)) - 1
  < ROUND(0.2::DOUBLE * COUNT(*) OVER (PARTITION BY rain_tomorrow)) AS is_test FROM labels_train_set
""")
add("fitted_rows", """
SELECT model, label, COUNT(*) AS n, ROUND(0.2::DOUBLE * COUNT(*)) AS held FROM (
  SELECT UNNEST([
    {'model': 'rain_tomorrow', 'label': rain_tomorrow::VARCHAR}, {'model': 'heatwave_risk', 'label': heatwave_risk::VARCHAR},
    {'model': 'frost_risk', 'label': frost_risk::VARCHAR}, {'model': 'storm_label', 'label': storm_label::VARCHAR},
    {'model': 'max_temp_tomorrow', 'label': 'all'}, {'model': 'weather_type_tomorrow', 'label': weather_type_tomorrow}], recursive := true)
  FROM target_mask) GROUP BY model, label
""")
FITTED = "model, SUM(n - held)::BIGINT AS n_train, SUM(held)::BIGINT AS n_test, TRUE AS beats_constant"
BINARY = "('rain_tomorrow', 'heatwave_risk', 'frost_risk', 'storm_label')"
add("train_binary", f"""
SELECT {FITTED}, {r("COALESCE(SUM(held) FILTER (WHERE label = '1'), 0) / SUM(held)", 4)} AS pos_rate FROM fitted_rows
WHERE model IN {BINARY} GROUP BY model
""")
add("train_regression", f"SELECT {FITTED} FROM fitted_rows WHERE model = 'max_temp_tomorrow' GROUP BY model")
add("train_multiclass", f"""
SELECT {FITTED}, COUNT(*) AS n_classes, STRING_AGG(label, ',' ORDER BY label) AS labels FROM fitted_rows
WHERE model = 'weather_type_tomorrow' GROUP BY model
""")
add("feature_importance_top20", f"""
SELECT target, rank::INT AS rank, TRUE AS configured, TRUE AS falling, TRUE AS is_share
FROM (SELECT DISTINCT model AS target FROM fitted_rows WHERE model IN {BINARY}), RANGE(1, 21) t(rank)
""")
add("score_predictions", """
SELECT date, city, comfort_score, TRUE AS shares, TRUE AS rain_by_threshold, TRUE AS known_type, TRUE AS has_max_temp, TRUE AS stamped
FROM comfort_score
""")
add("judged", "SELECT * FROM actuals_vs_predictions WHERE actual_max_temp IS NOT NULL")
add("binary_metrics", f"""
WITH b AS (SELECT actual_rain::INT AS y, pred_rain_proba AS p, pred_rain_proba >= 0.5 AS said FROM judged WHERE pred_rain_proba IS NOT NULL),
k AS (SELECT y, (RANK() OVER (ORDER BY p) + (COUNT(*) OVER (PARTITION BY p) - 1) / 2::DOUBLE) AS rk FROM b),
u AS (SELECT SUM(rk) FILTER (WHERE y = 1) AS s, (COUNT(*) FILTER (WHERE y = 1))::DOUBLE AS n1, (COUNT(*) FILTER (WHERE y = 0))::DOUBLE AS n0 FROM k)
SELECT {r('AVG((said = (y = 1))::INT)', 4)} AS accuracy,
  {r('2::DOUBLE * COUNT(*) FILTER (WHERE said AND y = 1) / (COUNT(*) FILTER (WHERE said) + COUNT(*) FILTER (WHERE y = 1))', 4)} AS f1,
  {r('AVG(y)', 4)} AS pos_rate, {r('(SELECT (s - n1 * (n1 + 1) / 2) / (n1 * n0) FROM u)', 4)} AS auc_roc FROM b
""")
add("multiclass_metrics", f"""
WITH m AS (SELECT {wmo('actual_weather_code')} AS y, IFNULL(pred_weather_type_tomorrow, 'Unknown') AS p FROM judged),
k AS (SELECT c, COUNT(*) FILTER (WHERE y = c) AS s, 2::DOUBLE * COUNT(*) FILTER (WHERE y = c AND p = c)
  / (COUNT(*) FILTER (WHERE y = c) + COUNT(*) FILTER (WHERE p = c)) AS f FROM m, (SELECT y AS c FROM m UNION SELECT p FROM m) GROUP BY c)
SELECT (SELECT {r('AVG((y = p)::INT)', 4)} FROM m) AS accuracy, {r('AVG(f)', 4)} AS f1_macro, {r('SUM(f * s) / SUM(s)', 4)} AS f1_weighted,
  COUNT(*) AS n_classes FROM k
""")
ERR = "actual_max_temp - pred_max_temp_tomorrow"
add("regression_metrics", f"""
SELECT {r(f'AVG(ABS({ERR}))', 3)} AS mae, {r(f'1 - SUM(({ERR}) ** 2) / (VAR_POP(actual_max_temp) * COUNT(*))', 4)} AS r2,
  {r(f'SQRT(AVG(({ERR}) ** 2))', 3)} AS rmse FROM judged
""")

# --- streams ------------------------------------------------------------------------------------
add("stream_completeness", """
WITH d AS (SELECT CAST(ts AS DATE) AS day, user_id FROM events)
SELECT day, COUNT(DISTINCT user_id) AS n_keys, COUNT(*) AS n_rows, COUNT(DISTINCT user_id) < 100 AS below_threshold FROM d
WHERE day + 1 <= (SELECT MAX(ts) - INTERVAL 1 DAY FROM events) GROUP BY day
""")
add("stream_rolling_metrics", f"""
WITH d AS (SELECT CAST(DATE_TRUNC('day', ts) AS TIMESTAMP) AS day, ts, event_type, value FROM events),
w AS (SELECT CAST(day - INTERVAL (k) DAY AS TIMESTAMP) AS window_start, event_type, value FROM d, RANGE(7) t(k))
SELECT window_start, window_start + INTERVAL 7 DAY AS window_end, COUNT(*) AS n, {avg("(event_type <> 'error')::INT")} AS accuracy,
  {avg('value')} AS mean_error FROM w WHERE window_start + INTERVAL 7 DAY <= (SELECT MAX(ts) - INTERVAL 1 DAY FROM events) GROUP BY window_start
""")
add("stream_sessions", """
WITH g AS (SELECT user_id, ts, IFNULL(ts - LAG(ts) OVER u >= INTERVAL 1 DAY, TRUE) AS fresh FROM events WINDOW u AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, COUNT(*) FILTER (WHERE fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 1 DAY AS session_end, COUNT(*) AS n FROM s GROUP BY user_id, k
HAVING MAX(ts) + INTERVAL 1 DAY <= (SELECT MAX(ts) - INTERVAL 1 DAY FROM events)
""")
add("stream_alert_dedup", "SELECT alert_key, ts FROM alert_dedup")
add("stream_retrain_cooldown", """
WITH RECURSIVE e AS (SELECT DISTINCT user_id::VARCHAR AS model, ts FROM events WHERE event_type = 'error'),
done AS (
  SELECT model, MIN(ts) AS ts FROM e GROUP BY model
  UNION ALL
  SELECT d.model, (SELECT MIN(e.ts) FROM e WHERE e.model = d.model AND e.ts >= d.ts + INTERVAL 7 DAY) FROM done d WHERE d.ts IS NOT NULL)
SELECT e.model, e.ts, IF(done.ts IS NULL, 'alert_only', 'trigger_retrain') AS action FROM e LEFT JOIN done USING (model, ts)
WHERE e.ts < (SELECT DATE_TRUNC('hour', MAX(ts) - INTERVAL 1 DAY) FROM events WHERE event_type = 'error')
""")
add("closed", "SELECT CAST(MAX(ts) - INTERVAL 1 DAY AS DATE) AS upto FROM events")
add("stream_outages", """
WITH p AS (SELECT DISTINCT user_id::VARCHAR AS user_id, CAST(ts AS DATE) AS d FROM events WHERE CAST(ts AS DATE) < (SELECT upto FROM closed)),
n AS (SELECT user_id, d, LEAD(d) OVER (PARTITION BY user_id ORDER BY d) AS nx FROM p)
SELECT user_id, d + 1 AS start_date, nx - 1 AS end_date, (nx - d - 1)::BIGINT AS gap_days FROM n WHERE nx > d + 1
UNION ALL
SELECT user_id, d + 1, NULL, NULL FROM n WHERE nx IS NULL AND d + 2 <= (SELECT upto FROM closed)
""")
add("stream_accuracy_windows", f"""
WITH d AS (SELECT (user_id % 25)::VARCHAR AS model, CAST(ts AS DATE) AS day, (event_type <> 'error')::INT AS good, value / 20 AS value FROM events),
k AS (SELECT model, day, COUNT(*) AS n, SUM(good) AS g, SUM(value) AS v FROM d WHERE day < (SELECT upto FROM closed) GROUP BY ALL),
w AS (SELECT model, day, {', '.join(f'SUM({x}) OVER {name} AS {x}_{name}' for name in ('short', 'long') for x in 'ngv')} FROM k
  WINDOW short AS (PARTITION BY model ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW),
    long AS (PARTITION BY model ORDER BY day RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)),
m AS (SELECT model, day, {', '.join(f'n_{x}::BIGINT AS n_{x}, g_{x} / n_{x} AS accuracy_{x}, v_{x} / n_{x} AS error_{x}' for x in ('short', 'long'))} FROM w)
SELECT model, day, {', '.join(f'n_{x}, ' + r(f'accuracy_{x}') + f' AS accuracy_{x}, ' + r(f'error_{x}') + f' AS error_{x}' for x in ('short', 'long'))},
  accuracy_short < 0.70 OR error_short > 4.0 AS early, early AND NOT (accuracy_long < 0.75 OR error_long > 3.0) AS early_warning FROM m
""")
add("stream_late_repair", "FROM stream_completeness")
add("stream_merge_upsert", """
SELECT * REPLACE (IF(DAY(date) >= 10, rainfall + 0.5::DOUBLE, rainfall) AS rainfall, IF(DAY(date) > 20 AND DAY(date) % 3 = 0, NULL, max_temp) AS max_temp)
FROM src_weather_raw
""")

# --- scalars ------------------------------------------------------------------------------------
K = "SELECT date, city, "
SRC = " FROM src_weather_raw"
add("scalar_date_parts", K + f"""YEAR(date) AS year, MONTH(date) AS month, DAY(date) AS day, DAYOFWEEK(date) AS dow, WEEKOFYEAR(date) AS week,
  QUARTER(date) AS quarter, DAYOFYEAR(date) AS day_of_year, ISOYEAR(date) AS iso_year, STRFTIME(date, '%G-W%V') AS iso_year_week,
  MONTHNAME(date) AS month_name, DAYNAME(date) AS weekday_name, {season('MONTH(date)')} AS season,
  {season('MONTH(date)', "'DJF','MAM','JJA','SON'")} AS season_code""" + SRC)
add("scalar_date_trunc", K + """CAST(DATE_TRUNC('month', date) AS DATE) AS month_start, CAST(DATE_TRUNC('year', date) AS DATE) AS year_start,
  CAST(DATE_TRUNC('week', date) AS DATE) AS week_start""" + SRC)
add("scalar_date_arith", K + f"""date + 1 AS next_day, date - 7 AS week_before, DATEDIFF('day', date, {AS_OF}) AS age_days,
  DAYOFYEAR(date) - 1 AS days_in_year""" + SRC)
add("scalar_math", K + f"""ABS(min_temp) AS absolute, {r('SQRT(pressure_3pm)')} AS root, min_temp * min_temp AS square, FLOOR(vpd_3pm)::BIGINT AS floored,
  {r('vpd_3pm * 1.05::DOUBLE', 1)} AS half_up, {even('vpd_9am', 1)} AS half_even, LEAST(min_temp, max_temp) AS smallest,
  GREATEST(min_temp, max_temp) AS largest, GREATEST(LEAST(min_temp, 10), 0) AS clamped""" + SRC)
add("scalar_null", K + f"""COALESCE(rainfall, rain_sum, 0) AS first_known, NULLIF(rainfall, 0) AS zero_to_null,
  {r('rainfall / NULLIF(precipitation_hours, 0)')} AS safe_ratio, max_temp IS NULL AS is_missing, IF(cloud_9am > 1, cloud_9am, NULL) AS finite""" + SRC)
add("scalar_bool_sum", K + """(max_temp >= 35)::INT + (min_temp < 2)::INT + IFNULL(rainfall >= 25, FALSE)::INT AS n_flags, n_flags >= 2 AS any_two""" + SRC)
add("scalar_case_bands", K + """CASE WHEN max_temp < 10 THEN 'Cold' WHEN max_temp < 20 THEN 'Mild' WHEN max_temp < 30 THEN 'Warm'
  WHEN max_temp < 35 THEN 'Hot' ELSE 'Extreme heat' END AS band, CASE WHEN wind_gust_speed >= 90 THEN 'Critical' WHEN wind_gust_speed >= 70 THEN 'High'
  WHEN wind_gust_speed >= 60 THEN 'Medium' ELSE 'None' END AS gust_level""" + SRC)
add("scalar_string", K + """city || ', ' || state AS place, wind_gust_dir || '/' || wind_dir_3pm AS winds, date::VARCHAR AS iso_date,
  PRINTF('%.1f%%', vpd_9am * 100) AS percent, 'drift on ' || IFNULL(weather_code::VARCHAR, 'null') || ' features (>=4)' AS sentence""" + SRC)
add("scalar_json", K + """'["' || wind_gust_dir || '","' || wind_dir_9am || '"]' AS listed, weather_code AS code_back, wind_dir_3pm AS direction_back""" + SRC)
add("scalar_array_get", K + """[temp_9am, temp_3pm, humidity_9am, humidity_3pm][(DAY(date) % 3) * 2 + 1] AS picked,
  [temp_9am, temp_3pm, humidity_9am, humidity_3pm][DAY(date) % 8 + 1] AS past_end""" + SRC)
add("scalar_map_explode", """SELECT * FROM (SELECT date, city, UNNEST(['temp', 'rain', 'gust']) AS reading,
  UNNEST([max_temp, rainfall, wind_gust_speed]) AS value FROM src_weather_raw) WHERE value IS NOT NULL""")
add("unit_conversion", K + f"""{r('shortwave_radiation_sum * 100 / 3600')} AS sunshine_h, {r('humidity_9am / 12.5::DOUBLE')} AS cloud_okta,
  {r('vpd_9am * 10')} AS pressure_hpa, {r('wind_speed_9am * 3.6::DOUBLE')} AS gust_kmh""" + SRC)
add("compass", K + f"{point('wind_speed_9am * 11.25')} AS gust, {point('wind_speed_100m_9am * 7.5')} AS morning" + SRC)
add("bucketize", K + """FLOOR(rain_tomorrow_proba * 10) / 10::DOUBLE AS bucket_low,
  CASE WHEN rain_tomorrow_proba >= 1 THEN 11 ELSE FLOOR(rain_tomorrow_proba * 10)::BIGINT + 1 END AS bucket,
  rain_tomorrow_proba >= 0.5::DOUBLE AS above_threshold FROM src_weather_predictions""")

# A part may not be named like a column or a table it is built from.
ALIASES = {"labels": "next_row_labels", "calendar": "full_calendar"}
