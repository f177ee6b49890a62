"""Model, operations and drift marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barograph.config import DEFAULTS, Settings
from barograph.functions import calendar as cal
from barograph.functions.numeric import count_if, ratio, round_half_up, rows, snap
from barograph.operators.sequence import asof_last
from barograph.operators.quantiles import exact_quantiles
from barograph.plans.intermediate import days_before, with_season



def accuracy() -> Column:
    return round_half_up(F.avg(F.col("rain_correct").cast("double")), 4)


def temp_error(fn) -> Column:
    return round_half_up(fn("temp_abs_error"), 3)


def performance_overview(actuals_vs_predictions: DataFrame) -> DataFrame:
    """Months over all cities. Days without an actual count as wrong in rain_accuracy.

    City-months are combined first, then months. The days of a city-month travel as one bit each,
    so the distinct days of a month need no second distinct aggregation.
    """
    per_city = actuals_vs_predictions.groupBy(
        cal.month_start("prediction_date").alias("month"), "city"
    ).agg(
        rows().alias("_rows"),
        F.sum("rain_correct").alias("_correct"),
        F.sum("temp_abs_error").alias("_error"),
        F.count("temp_abs_error").alias("_errors"),
        F.max("temp_abs_error").alias("_max"),
        F.min("temp_abs_error").alias("_min"),
        count_if(F.col("has_actuals")).alias("_known"),
        F.bit_or(F.expr("shiftleft(1L, dayofmonth(prediction_date))")).alias("_days"),
    )
    return per_city.groupBy("month").agg(
        F.sum("_rows").alias("n_city_days"),
        F.bit_count(F.bit_or("_days")).cast("bigint").alias("n_days"),
        F.count("city").alias("n_cities"),
        round_half_up(ratio(F.sum("_correct"), F.sum("_rows")), 4).alias("rain_accuracy"),
        round_half_up(ratio(F.sum("_error"), F.sum("_errors")), 3).alias("temp_mae"),
        round_half_up(F.max("_max"), 3).alias("temp_max_error"),
        round_half_up(F.min("_min"), 3).alias("temp_min_error"),
        round_half_up(100.0 * ratio(F.sum("_known"), F.sum("_rows")), 1).alias("pct_with_actuals"),
    )


def performance_by_city(performance_daily: DataFrame, dim_cities: DataFrame) -> DataFrame:
    months = performance_daily.groupBy(
        cal.month_start("prediction_date").alias("month"), "city"
    ).agg(
        rows().alias("n_days"),
        accuracy().alias("rain_accuracy"),
        temp_error(F.avg).alias("temp_mae"),
        temp_error(F.max).alias("temp_max_error"),
        F.max("rain_accuracy_30d").alias("rain_accuracy_30d_eom"),
        F.max("temp_mae_30d").alias("temp_mae_30d_eom"),
    )
    return months.join(dim_cities.select("city", "state", "latitude", "longitude"), "city", "left")


def model_calibration(prediction_calibration: DataFrame) -> DataFrame:
    """Reliability per season and over all seasons. The input has a few dozen rows."""
    buckets = ["prob_bucket_low", "prob_bucket_high", "prob_bucket_mid"]
    measures = ["mean_predicted_proba", "observed_rain_rate", "brier_score_bucket"]
    total = F.sum("n_predictions")
    overall = prediction_calibration.groupBy(*buckets).agg(
        F.lit("All seasons").alias("season"),
        total.alias("n_predictions"),
        *[
            round_half_up(ratio(F.sum(F.col(m) * F.col("n_predictions")), total), 4).alias(m)
            for m in measures
        ],
    )
    seasonal = prediction_calibration.select(
        *buckets, "season", "n_predictions", *[round_half_up(m, 4).alias(m) for m in measures]
    )
    gap = snap(F.col("mean_predicted_proba") - F.col("observed_rain_rate"))
    verdict = F.when(gap > 0.1, "Overconfident").when(gap < -0.1, "Underconfident").otherwise("Calibrated")
    return overall.unionByName(seasonal).withColumns(
        {
            "calibration_error": round_half_up(gap, 4),
            "is_miscalibrated": F.abs(gap) > 0.1,
            "calibration_verdict": verdict,
        }
    )


def bias_report(bias_by_city: DataFrame, dim_cities: DataFrame) -> DataFrame:
    """Bias per city and season, years weighted by their days."""
    days = F.sum("n_days")

    def weighted(column: str) -> Column:
        return snap(ratio(F.sum(F.col(column) * F.col("n_days")), days))

    bias = weighted("temp_mean_bias")
    direction = F.when(bias > 0.5, "Overestimates").when(bias < -0.5, "Underestimates")
    places = dim_cities.select("city", "state", "latitude", "longitude")
    return (
        bias_by_city.groupBy("city", "season")
        .agg(
            days.alias("n_days_total"),
            *[round_half_up(weighted(c), 3).alias(c) for c in ("temp_mean_bias", "temp_mae", "temp_rmse")],
            *[
                round_half_up(weighted(c), 2).alias(c)
                for c in ("rain_false_positive_pct", "rain_false_negative_pct")
            ],
            direction.otherwise("Unbiased").alias("temp_bias_direction"),
        )
        .join(places, "city", "left")
        .withColumn("high_rain_miss_rate", F.col("rain_false_negative_pct") > 20)
        .withColumn("high_temp_error", F.col("temp_mae") > 3.0)
    )


def seasonal_performance(actuals_vs_predictions: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Season by year, and season over all years (year null).

    Both levels come from one pass: the rows are expanded into the two grouping sets. The exact P90
    is read off counts per distinct error, so no task holds the errors of a season.
    """
    base = with_season(
        actuals_vs_predictions.where("has_actuals"),
        dim_date.select(
            "date",
            F.col("season_southern").alias("season"),
            F.col("season_code_southern").alias("season_code"),
            "year",
        ),
        ["season", "season_code", "year"],
    )
    season, code, year = (F.col(c) for c in ("season", "season_code", "year"))
    # levels as grouping_id() numbers them: 0 keeps the year, 1 leaves it out
    def group(of: Column, level: int) -> Column:
        return F.struct(season.alias("_season"), code.alias("_code"), of.alias("_year"), F.lit(level).alias("_of"))

    no_year = F.lit(-1)
    keys = ["_season", "_code", "_year", "_of"]
    errors = base.select(
        F.explode(F.array(group(F.coalesce(year, no_year), 0), group(no_year, 1))).alias("_group"),
        F.col("temp_abs_error").cast("double").alias("value"),
    ).select("_group.*", "value")
    p90 = exact_quantiles(errors.where(F.col("value").isNotNull()), keys, [0.9]).select(
        *keys, round_half_up("quantile", 3).alias("temp_mae_p90")
    )
    grouped = base.groupingSets([[season, code, year], [season, code]], season, code, year).agg(
        F.grouping_id().cast("int").alias("_of"),
        rows().alias("n_city_days"),
        F.countDistinct("prediction_date").alias("n_days"),
        F.countDistinct("city").alias("n_cities"),
        accuracy().alias("rain_accuracy"),
        temp_error(F.avg).alias("temp_mae"),
        temp_error(F.stddev_samp).alias("temp_mae_stddev"),
        temp_error(F.max).alias("temp_max_error"),
    )
    same = (
        grouped["season"].eqNullSafe(p90["_season"])
        & grouped["season_code"].eqNullSafe(p90["_code"])
        & (F.coalesce(grouped["year"], no_year) == p90["_year"])
        & (grouped["_of"] == p90["_of"])
    )
    return grouped.join(p90, same, "left").drop(*keys)


def extreme_events_performance(
    extreme_events_actual: DataFrame, actuals_vs_predictions: DataFrame, dim_date: DataFrame
) -> DataFrame:
    """Accuracy on four kinds of extreme day and on all days, per city and season.

    One joined pass: every row is repeated for the events it belongs to, then grouped once.
    """
    events = extreme_events_actual.select(
        F.date_sub("date", 1).alias("prediction_date"),
        "city",
        "is_heatwave_day",
        "is_frost_day",
        "is_storm_day",
        "is_heavy_rain_day",
    )
    base = with_season(
        actuals_vs_predictions.where("has_actuals"),
        dim_date.withColumn("season", F.col("season_southern")),
        ["season"],
    ).join(events, ["prediction_date", "city"], "left")

    def event(label: str, applies: Column, risk: Column, flagged: Column) -> Column:
        row = F.struct(
            F.lit(label).alias("event_type"),
            risk.cast("double").alias("risk"),
            flagged.cast("double").alias("flagged"),
        )
        return F.when(applies, row)

    def over_half(column: str) -> Column:
        return F.when(F.col(column) >= 0.5, 1.0).otherwise(0.0)

    c = F.col
    nothing = F.lit(None)
    labelled = F.array(
        event("Heatwave", c("is_heatwave_day"), c("pred_heatwave_risk"), over_half("pred_heatwave_risk")),
        event("Frost", c("is_frost_day"), c("pred_frost_risk"), over_half("pred_frost_risk")),
        event("Storm", c("is_storm_day"), c("pred_storm_probability"), over_half("pred_storm_probability")),
        # For rain the published flag rate is the mean probability.
        event("Heavy rain", c("is_heavy_rain_day"), c("pred_rain_proba"), c("pred_rain_proba")),
        event("Baseline (all days)", F.lit(True), nothing, nothing),
    )
    return (
        base.withColumn("_event", F.explode(F.array_compact(labelled)))
        .groupBy(F.col("_event.event_type").alias("event_type"), "city", "season")
        .agg(
            rows().alias("n_event_days"),
            accuracy().alias("rain_accuracy"),
            temp_error(F.avg).alias("temp_mae"),
            round_half_up(F.avg("_event.flagged"), 4).alias("risk_flag_rate"),
            round_half_up(F.avg("_event.risk"), 4).alias("mean_predicted_risk"),
        )
    )


def data_freshness(freshness_by_city: DataFrame, as_of: date, cfg: Settings = DEFAULTS) -> DataFrame:
    return freshness_by_city.withColumns(
        {
            "internal_completeness_pct": round_half_up("internal_completeness_pct", 2),
            "sla_breached": F.col("days_since_last_update") > cfg.horizon.freshness_sla_days,
            "pipeline_age_days": cal.days_between(F.lit(as_of), "first_observed_date"),
        }
    )


def mlops_health(
    stg_weather_raw: DataFrame,
    stg_retrain_events: DataFrame,
    completeness_daily: DataFrame,
    stg_monitoring_decisions: DataFrame,
    as_of: date,
    cfg: Settings = DEFAULTS,
) -> DataFrame:
    """One row per day of the last 30: completeness, the decision taken the day after, and the age
    of the last retrain.

    A day exists when it has observations, which is when it has a completeness row.
    """
    recent = F.col("date") >= days_before(as_of, cfg.horizon.health_days)
    completeness = completeness_daily.where(recent).drop("complete_cities")
    last = asof_last(
        completeness.select("date"),
        stg_retrain_events.where(F.col("retrain_date").isNotNull()),
        "date", "retrain_date", "last_retrain_date",
    )
    decisions = stg_monitoring_decisions.select(
        F.date_sub("date", 1).alias("date"),
        F.col("action").alias("monitoring_action"),
        F.col("reason").alias("monitoring_reason"),
        "n_drifted_features",
        "heavy_drift",
        "mild_drift",
        "low_accuracy",
        "high_mae",
        "rain_accuracy_30d",
        "temp_mae_30d",
    )
    return (
        completeness.join(decisions, "date", "left")
        .join(last, "date", "left")
        .withColumn("days_since_retrain", cal.days_between("date", "last_retrain_date"))
    )


def retraining_history(gap_to_retrain: DataFrame) -> DataFrame:
    now, later = F.col("rain_accuracy_30d"), F.col("next_rain_accuracy")
    mae, later_mae = F.col("temp_mae_30d"), F.col("next_temp_mae")
    return gap_to_retrain.select(
        "retrain_date",
        "source",
        "trigger_action",
        "trigger_reason",
        "n_drifted_features",
        "heavy_drift",
        "low_accuracy",
        "preceded_by_gap",
        "gap_days_in_7d_window",
        "max_missing_cities_7d",
        round_half_up("avg_completeness_7d", 1).alias("avg_completeness_7d_pct"),
        round_half_up(now, 4).alias("rain_accuracy_at_retrain"),
        round_half_up(mae, 3).alias("temp_mae_at_retrain"),
        "next_retrain_date",
        round_half_up(later, 4).alias("next_rain_accuracy"),
        round_half_up(later_mae, 3).alias("next_temp_mae"),
        round_half_up(later - now, 4).alias("accuracy_delta"),
        round_half_up(mae - later_mae, 3).alias("mae_delta"),
        F.coalesce(later < snap(now - 0.02), F.lit(False)).alias("accuracy_degraded_after_retrain"),
    )


# Labels of the drift explanation.
DRIFT_LABELS = {
    (True, True): "Drift during anomalous weather — investigate before retraining",
    (True, False): "Drift on normal weather — model degradation likely",
    (False, True): "No drift despite anomalous weather — model robust",
}
DRIFT_BASELINE_LABEL = "No drift, normal weather — baseline"


def anomaly_vs_drift(
    stg_drift_reports: DataFrame, anomaly_score: DataFrame, stg_monitoring_decisions: DataFrame
) -> DataFrame:
    """Daily drift next to daily weather anomaly. A day without anomaly rows gets the baseline
    label even when features drifted, as published."""
    drift = stg_drift_reports.groupBy("date").agg(
        F.countDistinct("feature_name").alias("n_features_monitored"),
        count_if(F.col("drifted")).alias("n_drifted_features"),
        round_half_up(F.avg("ks_stat"), 4).alias("mean_ks_stat"),
        round_half_up(F.max("ks_stat"), 4).alias("max_ks_stat"),
    )

    def mean_size(z: str) -> Column:
        return round_half_up(F.avg(F.abs(F.col(z))), 2).alias(f"avg_abs_{z}")

    anomaly = anomaly_score.groupBy("date").agg(
        rows().alias("n_cities_observed"),
        count_if(F.col("is_anomalous_day")).alias("n_anomalous_cities"),
        round_half_up(F.avg("composite_anomaly_score"), 3).alias("avg_composite_anomaly"),
        round_half_up(F.max("composite_anomaly_score"), 3).alias("max_composite_anomaly"),
        round_half_up(F.avg("n_anomalous_features"), 2).alias("avg_anomalous_features_per_city"),
        mean_size("z_max_temp"),
        mean_size("z_rainfall"),
        mean_size("z_wind_gust"),
    )
    decisions = stg_monitoring_decisions.select(
        "date", F.col("action").alias("monitoring_action"), "heavy_drift", "low_accuracy"
    )
    drifted = F.col("n_drifted_features") > 0
    unusual = (F.col("n_anomalous_cities") > 0.3 * F.col("n_cities_observed")) | (
        F.col("avg_composite_anomaly") > 2.0
    )
    label = F.lit(DRIFT_BASELINE_LABEL)
    for (has_drift, is_unusual), text in DRIFT_LABELS.items():
        label = F.when((drifted == has_drift) & (F.col("high_weather_anomaly") == is_unusual), text).otherwise(label)
    return (
        drift.join(anomaly, "date", "left")
        .join(decisions, "date", "left")
        .withColumn("any_drift", drifted)
        .withColumn("high_weather_anomaly", unusual)
        .withColumn("drift_explainability_label", label)
    )


def feature_drift_summary(
    stg_drift_reports: DataFrame, dim_date: DataFrame, drift_ranking: DataFrame
) -> DataFrame:
    days = dim_date.select("date", "year", "month", F.col("season_southern").alias("season"))
    months = (
        stg_drift_reports.join(days, "date", "left")
        .groupBy("feature_name", "year", "month", "season")
        .agg(
            rows().alias("days_monitored"),
            count_if(F.col("drifted")).alias("drift_days"),
            round_half_up(F.avg("ks_stat"), 4).alias("mean_ks_stat"),
            round_half_up(F.max("ks_stat"), 4).alias("max_ks_stat"),
            round_half_up(F.avg("p_value"), 4).alias("mean_p_value"),
        )
    )
    overall = drift_ranking.select(
        "feature_name",
        "drift_rank",
        "drift_tier",
        F.col("drift_frequency_pct").alias("overall_drift_pct"),
        F.col("drift_freq_last_30d_pct").alias("recent_drift_pct"),
        "drift_accelerating",
        "total_monitoring_days",
    )
    share = round_half_up(100.0 * ratio("drift_days", "days_monitored"), 2)
    return months.withColumn("monthly_drift_pct", share).join(overall, "feature_name", "left")
