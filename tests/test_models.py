"""Keys of the models, plans, and the published names."""

import pytest

from barograph.operators.quality import assert_unique
from barograph.operators.serving import api_mart, slugs
from barograph.plans.catalog import MODELS, PUBLISHED, ancestors, export_manifest

GRAIN = {
    "date city": "stg_weather_raw stg_weather_predictions weather_final extreme_events_actual anomaly_score",
    "weather_date city": "daily_clean data_quality_daily",
    "prediction_date city": "actuals_vs_predictions performance_daily forecast_vs_actual_daily forecast_timeline",
    "date": "dim_date stg_model_metrics_history stg_monitoring_decisions completeness_daily mlops_health anomaly_vs_drift",
    "date feature_name": "stg_drift_reports",
    "feature_name": "drift_ranking",
    "feature_name year month": "feature_drift_summary",
    "retrain_date": "stg_retrain_events retrain_events gap_to_retrain retraining_history",
    "city": "dim_cities dim_city dim_geography freshness_by_city data_freshness",
    "lieu": "location_cities",
    "city state": "current_snapshot bi_current_snapshot",
    "city month": "features_stats performance_by_city",
    "city season year": "bias_by_city",
    "city season": "bias_report",
    "prob_bucket_low season": "prediction_calibration model_calibration",
    "season year": "seasonal_performance",
    "event_type city season": "extreme_events_performance",
    "month": "performance_overview",
    "year_month city state": "monthly_city forecast_accuracy_monthly confusion_matrix data_quality_summary city_scorecard",
    "year_month city state proba_bucket": "rain_calibration",
    "year_month state": "state_monthly",
    "year city state": "yearly_city",
    "year season city state": "seasonality",
    "month city state": "climate_normals",
    "year_month state comfort_category temperature_category rainfall_category": "comfort_segments",
    "weather_date city alert_type": "risk_alerts bi_risk_alerts",
    "weather_date city extreme_type": "weather_extremes bi_extremes",
    "year_month state alert_type alert_level": "alerts_summary_monthly",
    "year_month": "dashboard_overview",
    "weather_code": "dim_weather_code",
    "alert_type": "dim_alert_type",
    "weather_type": "dim_weather_type",
}
KEYS = {model: keys.split() for keys, models in GRAIN.items() for model in models.split()}


def test_every_model_has_a_key():
    assert set(MODELS) - set(KEYS) == {"homepage_kpis"}
    assert len(MODELS) == 62


@pytest.mark.parametrize("name", sorted(KEYS))
def test_key_is_unique(ctx, name):
    assert assert_unique(ctx.table(name), KEYS[name]).first()["passed"]


def test_published_names(ctx):
    assert len(PUBLISHED) == 36 and len(slugs()) == 36
    assert len(export_manifest("daily_bi")) == 7 and len(export_manifest("full_build")) == 35
    assert api_mart("health", ctx.catalog).columns[0] == "date"
    with pytest.raises(KeyError):
        api_mart("nope", ctx.catalog)


def test_only_ancestors_are_built():
    assert ancestors("dim_city") == ["stg_weather_raw", "dim_cities", "dim_city"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(ctx):
    text = plan(ctx.table("performance_overview"))
    assert "comfort_score" not in text
    from pyspark.sql import functions as F

    text = plan(ctx.table("stg_weather_raw").where(F.col("date") >= "2001-01-01").select("city"))
    assert "PushedFilters: [IsNotNull(date), IsNotNull(city), GreaterThanOrEqual(date" in text
    assert "max_temp" not in text


@pytest.mark.parametrize("name", sorted(MODELS))
def test_no_model_plans_a_cross_join(ctx, name):
    text = plan(ctx.table(name))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_extremes_read_their_source_once(ctx):
    assert plan(ctx.table("weather_extremes")).count("FileScan parquet") == 1
    assert plan(ctx.table("risk_alerts")).count("FileScan parquet") == 1
