"""Staging: typed views of the stored sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph import schemas
from barograph.config import DEFAULTS, Settings


def typed_scan(df: DataFrame, schema, keys: list[str], min_date=None) -> DataFrame:
    """Cast to the schema and keep rows whose keys are set and whose date is in the horizon."""
    out = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    for key in keys:
        out = out.where(F.col(key).isNotNull())
    if min_date is not None:
        out = out.where(F.col("date") >= F.lit(min_date))
    return out


def _is_one(column: str):
    """0/1 to boolean; a missing value counts as false."""
    return F.coalesce(F.col(column) == 1, F.lit(False))


def stg_weather_raw(src_weather_raw: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    rows = typed_scan(src_weather_raw, schemas.WEATHER_RAW, ["date", "city"], cfg.horizon.min_date)
    return rows.withColumn("rain_today", _is_one("rain_today"))


PREFIXED = {
    "rain_tomorrow": "pred_rain_tomorrow",
    "rain_tomorrow_proba": "pred_rain_proba",
    "max_temp_tomorrow": "pred_max_temp_tomorrow",
    "weather_type_tomorrow": "pred_weather_type_tomorrow",
    "heatwave_risk": "pred_heatwave_risk",
    "frost_risk": "pred_frost_risk",
    "storm_probability": "pred_storm_probability",
}


def stg_weather_predictions(
    src_weather_predictions: DataFrame, cfg: Settings = DEFAULTS
) -> DataFrame:
    rows = typed_scan(
        src_weather_predictions, schemas.WEATHER_PREDICTIONS, ["date", "city"], cfg.horizon.min_date
    )
    return rows.withColumn("rain_tomorrow", _is_one("rain_tomorrow")).withColumnsRenamed(PREFIXED)


def stg_model_metrics_history(src_model_metrics_history: DataFrame) -> DataFrame:
    """Last recorded run of each date. ``max_by`` combines on the map side; no sort, no window."""
    rows = typed_scan(src_model_metrics_history, schemas.METRICS_HISTORY, ["status"])
    kept = F.struct("status", "rain_accuracy_30d", "temp_mae_30d")
    return (
        rows.groupBy("date").agg(F.max_by(kept, "row_num").alias("last")).select("date", "last.*")
    )


def stg_monitoring_decisions(src_monitoring_decisions: DataFrame) -> DataFrame:
    return typed_scan(src_monitoring_decisions, schemas.MONITORING_DECISIONS, []).withColumnRenamed(
        "n_drifted", "n_drifted_features"
    )


def stg_drift_reports(src_drift_reports: DataFrame) -> DataFrame:
    return typed_scan(src_drift_reports, schemas.DRIFT_REPORTS, [])


def stg_retrain_events(src_retrain_events: DataFrame) -> DataFrame:
    return typed_scan(src_retrain_events, schemas.RETRAIN_EVENTS, [])
