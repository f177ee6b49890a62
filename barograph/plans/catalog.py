"""Names of all models, what each is built from, and how a refresh stores them.

A model is a function from DataFrames to a DataFrame. ``Catalog.table`` calls only the builders a
request needs. Models listed in ``STORED`` feed many others; a catalog with a ``store`` writes them
once as Parquet and later plans read that table, which also cuts their lineage.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from barograph.config import DEFAULTS, Settings
from barograph.plans import bi, core, forecast, intermediate, model, staging, weather
from barograph.sources.landing import write_table


@dataclass(frozen=True)
class Model:
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    layer: str
    as_of: bool = False
    settings: bool = False


def _m(build, layer, *inputs, as_of=False, settings=False) -> Model:
    return Model(build, inputs, layer, as_of, settings)


MODELS: dict[str, Model] = {
    "stg_weather_raw": _m(staging.stg_weather_raw, "staging", "src_weather_raw", settings=True),
    "stg_weather_predictions": _m(
        staging.stg_weather_predictions, "staging", "src_weather_predictions", settings=True
    ),
    "stg_model_metrics_history": _m(
        staging.stg_model_metrics_history, "staging", "src_model_metrics_history"
    ),
    "stg_monitoring_decisions": _m(
        staging.stg_monitoring_decisions, "staging", "src_monitoring_decisions"
    ),
    "stg_drift_reports": _m(staging.stg_drift_reports, "staging", "src_drift_reports"),
    "stg_retrain_events": _m(staging.stg_retrain_events, "staging", "src_retrain_events"),
    "dim_alert_type": _m(core.dim_alert_type, "core", "spark"),
    "dim_weather_code": _m(core.dim_weather_code, "core", "spark"),
    "dim_cities": _m(core.dim_cities, "core", "stg_weather_raw"),
    "dim_city": _m(core.dim_city, "core", "dim_cities"),
    "dim_date": _m(core.dim_date, "core", "stg_weather_raw"),
    "dim_geography": _m(core.dim_geography, "core", "dim_cities", "features_stats"),
    "dim_weather_type": _m(core.dim_weather_type, "core", "stg_weather_predictions"),
    "weather_final": _m(
        intermediate.weather_final, "intermediate", "stg_weather_raw", "stg_weather_predictions"
    ),
    "actuals_vs_predictions": _m(
        intermediate.actuals_vs_predictions,
        "intermediate", "stg_weather_predictions", "stg_weather_raw",
    ),
    "completeness_daily": _m(
        intermediate.completeness_daily,
        "intermediate", "stg_weather_raw", as_of=True, settings=True,
    ),
    "freshness_by_city": _m(
        intermediate.freshness_by_city, "intermediate", "dim_cities", as_of=True, settings=True
    ),
    "extreme_events_actual": _m(
        intermediate.extreme_events_actual, "intermediate", "stg_weather_raw"
    ),
    "drift_ranking": _m(
        intermediate.drift_ranking, "intermediate", "stg_drift_reports", as_of=True, settings=True
    ),
    "gap_to_retrain": _m(
        intermediate.gap_to_retrain, "intermediate", "retrain_events", "completeness_daily"
    ),
    "performance_daily": _m(
        intermediate.performance_daily, "intermediate", "actuals_vs_predictions"
    ),
    "bias_by_city": _m(
        intermediate.bias_by_city, "intermediate", "actuals_vs_predictions", "dim_date"
    ),
    "prediction_calibration": _m(
        intermediate.prediction_calibration, "intermediate", "actuals_vs_predictions", "dim_date"
    ),
    "retrain_events": _m(
        intermediate.retrain_events,
        "intermediate",
        "stg_retrain_events", "stg_model_metrics_history", "stg_monitoring_decisions",
    ),
    "anomaly_score": _m(intermediate.anomaly_score, "intermediate", "stg_weather_raw"),
    "features_stats": _m(intermediate.features_stats, "intermediate", "stg_weather_raw"),
    "daily_clean": _m(weather.daily_clean, "mart", "weather_final"),
    "monthly_city": _m(weather.monthly_city, "mart", "daily_clean"),
    "state_monthly": _m(weather.state_monthly, "mart", "daily_clean"),
    "yearly_city": _m(weather.yearly_city, "mart", "daily_clean"),
    "seasonality": _m(weather.seasonality, "mart", "daily_clean"),
    "climate_normals": _m(weather.climate_normals, "mart", "daily_clean"),
    "comfort_segments": _m(weather.comfort_segments, "mart", "daily_clean"),
    "current_snapshot": _m(weather.current_snapshot, "mart", "daily_clean"),
    "weather_extremes": _m(weather.weather_extremes, "mart", "daily_clean"),
    "risk_alerts": _m(weather.risk_alerts, "mart", "daily_clean"),
    "forecast_vs_actual_daily": _m(forecast.forecast_vs_actual_daily, "mart", "daily_clean"),
    "forecast_accuracy_monthly": _m(
        forecast.forecast_accuracy_monthly, "mart", "forecast_vs_actual_daily"
    ),
    "confusion_matrix": _m(forecast.confusion_matrix, "mart", "forecast_vs_actual_daily"),
    "forecast_timeline": _m(
        forecast.forecast_timeline,
        "mart",
        "actuals_vs_predictions", "performance_daily", "dim_cities",
        as_of=True, settings=True,
    ),
    "rain_calibration": _m(forecast.rain_calibration, "mart", "forecast_vs_actual_daily"),
    "location_cities": _m(forecast.location_cities, "mart", "dim_city"),
    "data_quality_daily": _m(forecast.data_quality_daily, "mart", "daily_clean"),
    "city_scorecard": _m(
        forecast.city_scorecard,
        "mart", "monthly_city", "forecast_accuracy_monthly", "data_quality_daily",
    ),
    "performance_overview": _m(model.performance_overview, "mart", "actuals_vs_predictions"),
    "performance_by_city": _m(model.performance_by_city, "mart", "performance_daily", "dim_cities"),
    "model_calibration": _m(model.model_calibration, "mart", "prediction_calibration"),
    "bias_report": _m(model.bias_report, "mart", "bias_by_city", "dim_cities"),
    "seasonal_performance": _m(
        model.seasonal_performance, "mart", "actuals_vs_predictions", "dim_date"
    ),
    "extreme_events_performance": _m(
        model.extreme_events_performance,
        "mart", "extreme_events_actual", "actuals_vs_predictions", "dim_date",
    ),
    "data_freshness": _m(
        model.data_freshness, "mart", "freshness_by_city", as_of=True, settings=True
    ),
    "mlops_health": _m(
        model.mlops_health,
        "mart",
        "stg_weather_raw", "stg_retrain_events", "completeness_daily", "stg_monitoring_decisions",
        as_of=True, settings=True,
    ),
    "retraining_history": _m(model.retraining_history, "mart", "gap_to_retrain"),
    "anomaly_vs_drift": _m(
        model.anomaly_vs_drift,
        "mart", "stg_drift_reports", "anomaly_score", "stg_monitoring_decisions",
    ),
    "feature_drift_summary": _m(
        model.feature_drift_summary, "mart", "stg_drift_reports", "dim_date", "drift_ranking"
    ),
    "dashboard_overview": _m(
        bi.dashboard_overview,
        "mart",
        "monthly_city", "forecast_accuracy_monthly", "risk_alerts", "data_quality_daily",
    ),
    "data_quality_summary": _m(bi.data_quality_summary, "mart", "data_quality_daily"),
    "homepage_kpis": _m(bi.homepage_kpis, "mart", "current_snapshot", "dashboard_overview"),
    "alerts_summary_monthly": _m(bi.alerts_summary_monthly, "mart", "risk_alerts"),
    "bi_current_snapshot": _m(bi.bi_current_snapshot, "mart", "current_snapshot"),
    "bi_extremes": _m(bi.bi_extremes, "mart", "weather_extremes"),
    "bi_risk_alerts": _m(bi.bi_risk_alerts, "mart", "risk_alerts"),
}

# Models that feed many others, with the date column their folders are cut by.
STORED = {"daily_clean": "weather_date", "actuals_vs_predictions": "prediction_date"}

# Published table name of each exported mart, the names a client asks for.
PUBLISHED = {
    "bi_dashboard_overview": "dashboard_overview",
    "bi_data_quality_summary": "data_quality_summary",
    "bi_powerbi_homepage_kpis": "homepage_kpis",
    "bi_weather_alerts_summary_monthly": "alerts_summary_monthly",
    "bi_weather_current_snapshot": "bi_current_snapshot",
    "bi_weather_extremes": "bi_extremes",
    "bi_weather_risk_alerts": "bi_risk_alerts",
    "mart_weather_daily_clean": "daily_clean",
    "mart_weather_monthly_city": "monthly_city",
    "mart_weather_risk_alerts": "risk_alerts",
    "mart_weather_extremes": "weather_extremes",
    "mart_current_weather_snapshot": "current_snapshot",
    "mart_weather_seasonality": "seasonality",
    "mart_weather_state_monthly": "state_monthly",
    "mart_weather_yearly_city": "yearly_city",
    "mart_weather_comfort_segments": "comfort_segments",
    "mart_climate_normals_city_month": "climate_normals",
    "mart_forecast_vs_actual_daily": "forecast_vs_actual_daily",
    "mart_forecast_accuracy_monthly": "forecast_accuracy_monthly",
    "mart_forecast_vs_actual_timeline": "forecast_timeline",
    "mart_forecast_confusion_matrix": "confusion_matrix",
    "mart_rain_probability_calibration": "rain_calibration",
    "mart_data_quality_daily": "data_quality_daily",
    "mart_model_performance_overview": "performance_overview",
    "mart_model_performance_by_city": "performance_by_city",
    "mart_model_calibration": "model_calibration",
    "mart_prediction_bias_report": "bias_report",
    "mart_seasonal_performance": "seasonal_performance",
    "mart_extreme_events_performance": "extreme_events_performance",
    "mart_mlops_health": "mlops_health",
    "mart_retraining_history": "retraining_history",
    "mart_data_freshness_by_city": "data_freshness",
    "mart_feature_drift_summary": "feature_drift_summary",
    "mart_climate_anomaly_vs_drift": "anomaly_vs_drift",
    "mart_city_weather_scorecard": "city_scorecard",
    "location_cities": "location_cities",
}


def export_manifest(name: str) -> list[str]:
    """Published tables of a named export: the 7 BI marts daily, or all but the locations."""
    if name == "daily_bi":
        return [t for t in PUBLISHED if t.startswith("bi_")]
    if name == "full_build":
        return [t for t in PUBLISHED if t != "location_cities"]
    raise KeyError(f"unknown export {name!r}; known: daily_bi, full_build")


def ancestors(name: str) -> list[str]:
    """Models a model needs, itself included, parents first."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in MODELS and n not in order:
            for parent in MODELS[n].inputs:
                visit(parent)
            order.append(n)

    visit(name)
    return order


class Catalog:
    """Builds models on demand from a source reader."""

    def __init__(
        self,
        spark: SparkSession,
        read_source: Callable[[str], DataFrame],
        as_of: date,
        settings: Settings = DEFAULTS,
        store: Callable[[str], str] | None = None,
    ):
        self.spark = spark
        self.read_source = read_source
        self.as_of = as_of
        self.settings = settings
        self.store = store
        self._built: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name in PUBLISHED:
            name = PUBLISHED[name]
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def _build(self, name: str) -> DataFrame:
        if name not in MODELS:
            return self.read_source(name)
        spec = MODELS[name]
        args = [self.spark if i == "spark" else self.table(i) for i in spec.inputs]
        extra = {}
        if spec.as_of:
            extra["as_of"] = self.as_of
        if spec.settings:
            extra["cfg"] = self.settings
        df = spec.build(*args, **extra)
        if self.store is None or name not in STORED:
            return df
        path = self.store(name)
        write_table(df, path, STORED[name])
        return self.spark.read.parquet(path).select(*df.columns)

    def export(self, names: list[str], write: Callable[[DataFrame, str], None]) -> None:
        """Write the named tables one after the other with ``write(df, name)``."""
        for name in names:
            write(self.table(name), name)
