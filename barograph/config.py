"""Thresholds and windows that are part of the query semantics.

Every builder takes the settings it needs as an argument with one of these objects as default, so
a caller changes a rule by passing a changed copy (``dataclasses.replace``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date


# The feature lists and limits below must equal the published configuration.
@dataclass(frozen=True)
class LabelRules:
    rain_min_mm: float = 1.0
    heatwave_c: float = 35.0
    frost_c: float = 2.0
    storm_rain_mm: float = 10.0
    storm_gust_kmh: float = 50.0


@dataclass(frozen=True)
class MonitoringRules:
    min_rain_accuracy: float = 0.75
    max_temp_mae: float = 3.0
    drift_features_alert: int = 3
    drift_features_retrain: int = 4
    cooldown_days: int = 7
    ks_alpha: float = 0.05
    drift_window_days: int = 30
    min_values_for_ks: int = 10
    min_window_completeness: float = 0.7
    features: tuple[str, ...] = (
        "max_temp",
        "min_temp",
        "humidity_3pm",
        "pressure_3pm",
        "rainfall",
        "wind_gust_speed",
    )
    min_rows_for_metrics: int = 30
    early_window_days: int = 7
    early_min_rain_accuracy: float = 0.70
    early_max_temp_mae: float = 4.0


@dataclass(frozen=True)
class IngestRules:
    min_cities: int = 21
    expected_cities: int = 26
    complete_when: tuple[str, ...] = (
        "humidity_9am",
        "humidity_3pm",
        "pressure_9am",
        "pressure_3pm",
        "temp_9am",
        "temp_3pm",
        "weather_code",
    )
    critical: tuple[str, ...] = ("max_temp", "min_temp", "rainfall")
    gap_lookback_days: int = 30
    publish_raw_days: int = 180
    publish_prediction_days: int = 90


@dataclass(frozen=True)
class TrainingRules:
    test_share: float = 0.2
    seed: int = 42
    rain_threshold: float = 0.5
    accuracy_tolerance: float = 0.02
    mae_tolerance: float = 0.20
    trees: int = 300
    multiclass_trees: int = 400
    rare_trees: int = 200
    depth: int = 6
    rare_depth: int = 4
    learning_rate: float = 0.05
    subsample: float = 0.8
    column_share: float = 0.8
    numerical: tuple[str, ...] = (
        "min_temp", "max_temp", "rainfall", "evaporation", "sunshine_hours", "wind_gust_speed",
        "wind_speed_9am", "wind_speed_3pm", "humidity_9am", "humidity_3pm", "pressure_9am",
        "pressure_3pm", "cloud_9am", "cloud_3pm", "temp_9am", "temp_3pm", "rain_today", "month",
        "day_of_year", "max_temp_lag1", "max_temp_lag2", "min_temp_lag1", "rainfall_lag1",
        "rainfall_lag2", "pressure_3pm_lag1", "max_temp_rolling7", "rainfall_rolling7",
        "humidity_3pm_rolling7", "pressure_tendency", "temp_anomaly", "consec_hot_days",
        "hot_day_lag1", "hot_day_lag2", "precipitation_hours", "rainfall_intensity",
        "shortwave_radiation_sum", "vpd_9am", "vpd_3pm", "wind_speed_100m_9am",
        "wind_speed_100m_3pm",
    )
    categorical: tuple[str, ...] = (
        "wind_gust_dir", "wind_dir_9am", "wind_dir_3pm", "city", "state", "season",
    )
    targets: tuple[str, ...] = (
        "rain_tomorrow", "max_temp_tomorrow", "weather_type_tomorrow", "heatwave_risk",
        "frost_risk", "storm_label",
    )


@dataclass(frozen=True)
class Horizon:
    """Lookbacks, in days, counted from an explicit as-of date."""

    min_date: date = date(2016, 1, 1)
    timeline_days: int = 90
    health_days: int = 30
    completeness_days: int = 90
    recent_drift_days: int = 30
    freshness_sla_days: int = 3


@dataclass(frozen=True)
class Settings:
    labels: LabelRules = field(default_factory=LabelRules)
    monitoring: MonitoringRules = field(default_factory=MonitoringRules)
    ingest: IngestRules = field(default_factory=IngestRules)
    training: TrainingRules = field(default_factory=TrainingRules)
    horizon: Horizon = field(default_factory=Horizon)


DEFAULTS = Settings()
