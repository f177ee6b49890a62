"""Column lists and StructTypes of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and order of the two stored weather tables.
RAW_NUMBERS = [
    "latitude", "longitude", "min_temp", "max_temp", "rainfall", "rain_sum", "precipitation_hours",
    "evaporation", "sunshine_hours", "wind_gust_speed", "wind_speed_9am", "wind_speed_3pm",
    "humidity_9am", "humidity_3pm", "dew_point_9am", "dew_point_3pm", "pressure_9am",
    "pressure_3pm", "surface_pressure_9am", "surface_pressure_3pm", "cloud_9am", "cloud_3pm",
    "temp_9am", "temp_3pm", "shortwave_radiation_sum", "vpd_9am", "vpd_3pm",
    "wind_speed_100m_9am", "wind_speed_100m_3pm",
]
RAW_TEXTS = ["state", "wind_gust_dir", "wind_dir_9am", "wind_dir_3pm"]
RAW_COLUMNS = [
    "date", "city", "state", "latitude", "longitude", "min_temp", "max_temp", "rainfall",
    "rain_sum", "precipitation_hours", "evaporation", "sunshine_hours", "wind_gust_dir",
    "wind_gust_speed", "wind_dir_9am", "wind_dir_3pm", "wind_speed_9am", "wind_speed_3pm",
    "humidity_9am", "humidity_3pm", "dew_point_9am", "dew_point_3pm", "pressure_9am",
    "pressure_3pm", "surface_pressure_9am", "surface_pressure_3pm", "cloud_9am", "cloud_3pm",
    "temp_9am", "temp_3pm", "rain_today", "weather_code", "shortwave_radiation_sum", "vpd_9am",
    "vpd_3pm", "wind_speed_100m_9am", "wind_speed_100m_3pm",
]
PREDICTION_COLUMNS = [
    "date", "city", "rain_tomorrow", "rain_tomorrow_proba", "max_temp_tomorrow",
    "weather_type_tomorrow", "comfort_score", "heatwave_risk", "frost_risk", "storm_probability",
    "predicted_at",
]
# Fields counted by the daily data-quality mart, by group.
QUALITY_FIELDS = [c for c in RAW_COLUMNS if c not in ("date", "city", "state", "latitude", "longitude")] + [
    "rain_tomorrow", "rain_tomorrow_proba", "max_temp_tomorrow", "weather_type_tomorrow",
    "comfort_score", "heatwave_risk", "frost_risk", "storm_probability",
]
QUALITY_GROUPS = {
    "missing_rain_fields": [
        "rainfall", "rain_sum", "precipitation_hours", "rain_today", "rain_tomorrow",
        "rain_tomorrow_proba",
    ],
    "missing_temperature_fields": [
        "min_temp", "max_temp", "temp_9am", "temp_3pm", "max_temp_tomorrow",
    ],
    "missing_wind_fields": [
        "wind_gust_speed", "wind_speed_9am", "wind_speed_3pm", "wind_speed_100m_9am",
        "wind_speed_100m_3pm",
    ],
    "missing_pressure_fields": [
        "pressure_9am", "pressure_3pm", "surface_pressure_9am", "surface_pressure_3pm",
    ],
    "missing_cloud_solar_fields": [
        "cloud_9am", "cloud_3pm", "sunshine_hours", "shortwave_radiation_sum",
    ],
}
# Column groups of the complete-case exploration dataset.
ENRICHED_COLUMNS = [
    "rain_sum", "precipitation_hours", "dew_point_9am", "dew_point_3pm", "surface_pressure_9am",
    "surface_pressure_3pm", "shortwave_radiation_sum", "vpd_9am", "vpd_3pm",
    "wind_speed_100m_9am", "wind_speed_100m_3pm",
]
BASE_COLUMNS = [
    "min_temp", "max_temp", "temp_9am", "temp_3pm", "rainfall", "rain_today", "humidity_9am",
    "humidity_3pm", "pressure_9am", "pressure_3pm", "evaporation", "sunshine_hours", "cloud_9am",
    "cloud_3pm", "wind_gust_speed", "wind_speed_9am", "wind_speed_3pm", "weather_code",
]
TARGET_COLUMNS = [
    "rain_tomorrow", "rain_tomorrow_proba", "max_temp_tomorrow", "weather_type_tomorrow",
    "comfort_score", "heatwave_risk", "frost_risk", "storm_probability",
]
CORRELATION_FEATURES = [
    "min_temp", "max_temp", "temp_9am", "temp_3pm", "rainfall", "rain_sum",
    "precipitation_hours", "rain_today", "humidity_9am", "humidity_3pm", "dew_point_9am",
    "dew_point_3pm", "pressure_9am", "pressure_3pm", "surface_pressure_9am",
    "surface_pressure_3pm", "cloud_9am", "cloud_3pm", "sunshine_hours",
    "shortwave_radiation_sum", "wind_gust_speed", "wind_speed_9am", "wind_speed_3pm",
    "wind_speed_100m_9am", "wind_speed_100m_3pm", "vpd_9am", "vpd_3pm", "evaporation",
]
CORRELATION_TARGETS = [
    "rain_tomorrow", "max_temp_tomorrow", "comfort_score", "heatwave_risk", "frost_risk",
    "storm_probability",
]


def raw_type(column: str) -> T.DataType:
    if column == "date":
        return T.DateType()
    if column == "city" or column in RAW_TEXTS:
        return T.StringType()
    if column in ("rain_today", "weather_code"):
        return T.IntegerType()
    return T.DoubleType()


WEATHER_RAW = T.StructType([T.StructField(c, raw_type(c)) for c in RAW_COLUMNS])

_PREDICTION_TYPES = {
    "date": T.DateType(),
    "city": T.StringType(),
    "rain_tomorrow": T.IntegerType(),
    "weather_type_tomorrow": T.StringType(),
    "predicted_at": T.TimestampType(),
}
WEATHER_PREDICTIONS = T.StructType(
    [T.StructField(c, _PREDICTION_TYPES.get(c, T.DoubleType())) for c in PREDICTION_COLUMNS]
)

_D, _S, _B, _I = T.DoubleType(), T.StringType(), T.BooleanType(), T.IntegerType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


DRIFT_REPORTS = _struct(date=T.DateType(), feature_name=_S, ks_stat=_D, p_value=_D, drifted=_B)
MONITORING_DECISIONS = _struct(
    date=T.DateType(), action=_S, reason=_S, n_drifted=_I, drifted_features=_S, low_accuracy=_B,
    high_mae=_B, heavy_drift=_B, mild_drift=_B, rain_accuracy_30d=_D, temp_mae_30d=_D,
)
METRICS_HISTORY = _struct(
    date=T.DateType(), status=_S, rain_accuracy_30d=_D, temp_mae_30d=_D, row_num=T.LongType()
)
RETRAIN_EVENTS = _struct(retrain_date=T.DateType(), written_at=_S, source=_S)

DRIFT_DOCUMENT = _struct(
    date=_S, data_quality_warning=_B, completeness_recent_pct=_D, completeness_baseline_pct=_D,
    features=T.MapType(_S, _struct(ks_stat=_D, p_value=_D, drifted=_B)),
)
DECISION_DOCUMENT = _struct(
    date=_S, action=_S, reason=_S, n_drifted=_I, drifted_features=T.ArrayType(_S), low_accuracy=_B,
    high_mae=_B, heavy_drift=_B, mild_drift=_B, rain_accuracy_30d=_D, temp_mae_30d=_D,
)
