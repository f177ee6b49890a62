"""Forecast, location, quality and scorecard marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barograph import schemas
from barograph.config import DEFAULTS, Settings
from barograph.functions import calendar as cal
from barograph.functions.numeric import (
    as_int, band, count_if, flag, nulls_in, ratio, round_half_up, snap,
)
from barograph.plans.intermediate import days_before

# Label of (predicted, observed) rain.
OUTCOMES = {
    (True, True): "True positive",
    (False, False): "True negative",
    (True, False): "False positive",
    (False, True): "False negative",
}


def forecast_vs_actual_daily(daily_clean: DataFrame) -> DataFrame:
    """Day D against day D + 1 of the same city and state. A null state matches nothing.

    pred_rain_tomorrow and actual_rain_tomorrow read 0 when unknown; forecast_result tells.
    """
    actual = daily_clean.select(
        F.date_sub("weather_date", 1).alias("weather_date"),
        "city",
        "state",
        F.col("rain_today").alias("_rained"),
        F.col("max_temp").alias("actual_max_temp_tomorrow"),
    )
    said, rained = F.col("rain_tomorrow"), F.col("_rained")
    error = F.col("max_temp_tomorrow") - F.col("actual_max_temp_tomorrow")
    result = F.lit("Unknown")
    for (predicted, observed), label in OUTCOMES.items():
        result = F.when((said == predicted) & (rained == observed), label).otherwise(result)
    return daily_clean.join(actual, ["city", "state", "weather_date"], "left").select(
        F.col("weather_date").alias("prediction_date"),
        F.date_add("weather_date", 1).alias("actual_date"),
        "city",
        "state",
        "latitude",
        "longitude",
        flag(said).alias("pred_rain_tomorrow"),
        F.col("rain_tomorrow_proba").alias("pred_rain_proba"),
        flag(rained).alias("actual_rain_tomorrow"),
        as_int(said == rained).alias("rain_prediction_correct"),
        result.alias("forecast_result"),
        F.col("max_temp_tomorrow").alias("pred_max_temp_tomorrow"),
        "actual_max_temp_tomorrow",
        F.abs(error).alias("temp_abs_error"),
        error.alias("temp_error_signed"),
        "weather_type_tomorrow",
        "comfort_score",
        "heatwave_risk",
        "frost_risk",
        "storm_probability",
        "predicted_at",
    )


def _by_month(df: DataFrame, *more: str):
    day = F.col("prediction_date")
    return df.groupBy(
        cal.month_start(day).alias("year_month"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        "city",
        "state",
        *more,
    )


def forecast_accuracy_monthly(forecast_vs_actual_daily: DataFrame) -> DataFrame:
    return _by_month(forecast_vs_actual_daily).agg(
        F.count(F.lit(1)).alias("n_predictions"),
        F.count("actual_rain_tomorrow").alias("n_rain_actuals"),
        F.avg("rain_prediction_correct").alias("rain_accuracy"),
        F.avg("temp_abs_error").alias("temp_mae"),
        F.max("temp_abs_error").alias("temp_max_error"),
        F.avg("temp_error_signed").alias("temp_bias"),
        F.avg("pred_rain_proba").alias("avg_pred_rain_proba"),
        F.avg("actual_rain_tomorrow").alias("actual_rain_rate"),
    )


def confusion_matrix(forecast_vs_actual_daily: DataFrame) -> DataFrame:
    known = forecast_vs_actual_daily.where(F.col("forecast_result") != "Unknown")
    cells = {label.lower().replace(" ", "_"): label for label in OUTCOMES.values()}
    counts = _by_month(known).agg(
        *[count_if(F.col("forecast_result") == label).alias(n) for n, label in cells.items()],
        F.count(F.lit(1)).alias("n_predictions"),
    )
    tp, tn, fp, fn = (F.col(n) for n in ("true_positive", "true_negative", "false_positive", "false_negative"))
    return counts.withColumns(
        {
            "accuracy": ratio(tp + tn, "n_predictions"),
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "f1_score": ratio(2 * tp, 2 * tp + fp + fn),
            "false_positive_rate": ratio(fp, fp + tn),
            "false_negative_rate": ratio(fn, fn + tp),
        }
    )


def forecast_timeline(
    actuals_vs_predictions: DataFrame,
    performance_daily: DataFrame,
    dim_cities: DataFrame,
    as_of: date,
    cfg: Settings = DEFAULTS,
) -> DataFrame:
    """The last 90 days of predictions and actuals with the rolling figures of that day.

    The filter is repeated on the rolling side: rows outside it can match nothing.
    """
    recent = F.col("prediction_date") >= days_before(as_of, cfg.horizon.timeline_days)
    rolling = performance_daily.where(recent).select(
        "prediction_date", "city", "rain_accuracy_30d", "temp_mae_30d", "rain_accuracy_7d", "temp_mae_7d"
    )
    return (
        actuals_vs_predictions.where(recent)
        .drop("predicted_at", "actual_weather_code", "rain_abs_error")
        .join(rolling, ["prediction_date", "city"], "left")
        .join(dim_cities.select("city", "state"), "city", "left")
    )


def rain_calibration(forecast_vs_actual_daily: DataFrame) -> DataFrame:
    """Ten labelled probability buckets per city-month; 1.0 belongs to the last one."""
    labels = [(limit / 10, f"{limit * 10 - 10:02d}-{limit * 10}%") for limit in range(1, 10)]
    proba, rained = F.col("pred_rain_proba"), F.col("actual_rain_tomorrow")
    base = forecast_vs_actual_daily.where(proba.isNotNull()).withColumn(
        "proba_bucket", band(proba, labels, "90-100%", above=False)
    )
    miss = proba - rained
    return _by_month(base, "proba_bucket").agg(
        F.count(F.lit(1)).alias("n_predictions"),
        F.avg(proba).alias("avg_predicted_probability"),
        F.avg(rained).alias("actual_rain_rate"),
        snap(F.avg(proba) - F.avg(rained)).alias("calibration_gap"),
        F.avg(miss * miss).alias("brier_score"),
    )


def location_cities(dim_city: DataFrame) -> DataFrame:
    return (
        dim_city.dropna(subset=["city", "latitude", "longitude"])
        .select(
            F.col("city").alias("lieu"),
            "state",
            "latitude",
            "longitude",
            F.concat("city", F.lit(", "), "state").alias("lieu_state"),
        )
        .distinct()
    )


# Completeness limits of the daily status.
QUALITY_STATUS = [(0.90, "Good"), (0.75, "Warning"), (0.50, "Poor")]


def data_quality_daily(daily_clean: DataFrame) -> DataFrame:
    total = len(schemas.QUALITY_FIELDS)
    complete = 1 - F.col("n_missing_fields").cast("double") / F.lit(float(total))
    return daily_clean.select(
        "weather_date",
        "city",
        "state",
        "latitude",
        "longitude",
        F.lit(total).alias("n_total_fields"),
        nulls_in(schemas.QUALITY_FIELDS).alias("n_missing_fields"),
        *[nulls_in(fields).alias(name) for name, fields in schemas.QUALITY_GROUPS.items()],
    ).withColumns(
        {
            "completeness_pct": round_half_up(complete * 100, 2),
            "data_quality_status": band(complete, QUALITY_STATUS, "Critical"),
        }
    )


# Score limits of the monthly scorecard.
SCORE_BANDS = [(85, "Excellent"), (70, "Good"), (55, "Medium"), (40, "To monitor")]


def city_scorecard(
    monthly_city: DataFrame, forecast_accuracy_monthly: DataFrame, data_quality_daily: DataFrame
) -> DataFrame:
    """One score per city and month from weather, forecast and data quality, and its rank.

    monthly_city and forecast_accuracy_monthly already have this grain, so their rows are joined
    as they are; only the daily quality is averaged first.
    """
    keys = ["year_month", "city", "state"]
    weather = monthly_city.select(
        *keys, "latitude", "longitude", "avg_max_temp", "avg_min_temp", "total_rainfall",
        "rainy_day_rate", "avg_comfort_score", "avg_heatwave_risk", "avg_frost_risk",
        "avg_storm_probability",
    )
    forecast = forecast_accuracy_monthly.select(
        *keys,
        F.col("rain_accuracy").alias("forecast_rain_accuracy"),
        F.col("temp_mae").alias("forecast_temp_mae"),
    )
    quality = data_quality_daily.groupBy(
        cal.month_start("weather_date").alias("year_month"), "city", "state"
    ).agg(F.avg("completeness_pct").alias("data_completeness_pct"))

    def known(column: str, default: float):
        return F.coalesce(F.col(column), F.lit(default))

    # Weights of the score.
    score = (
        known("avg_comfort_score", 0.0) * 0.30
        + (1 - known("avg_heatwave_risk", 0.0)) * 15
        + (1 - known("avg_frost_risk", 0.0)) * 10
        + (1 - known("avg_storm_probability", 0.0)) * 15
        + known("forecast_rain_accuracy", 0.5) * 20
        + (1 - F.least(known("forecast_temp_mae", 10.0) / 10.0, F.lit(1.0))) * 10
        + known("data_completeness_pct", 0.0) * 0.10
    )
    scored = (
        weather.join(forecast, keys, "left")
        .join(quality, keys, "left")
        .withColumn("global_weather_score", round_half_up(score, 2))
    )
    # a month has as many rows as there are places, so it is ranked in one window
    by_score = Window.partitionBy("year_month").orderBy(F.desc("global_weather_score"))
    return scored.withColumn("city_rank", F.rank().over(by_score)).withColumn(
        "performance_category", band(F.col("global_weather_score"), SCORE_BANDS, "Critical")
    )
