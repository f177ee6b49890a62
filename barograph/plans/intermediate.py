"""Intermediate models: joins, scores and rolling figures the marts are built from."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barograph.config import DEFAULTS, Settings
from barograph.functions.rows import attach_row
from barograph.functions import calendar as cal
from barograph.functions.numeric import as_int, band, count_if, ratio, round_half_up, snap
from barograph.operators.sequence import drop_halo, neighbour, row_blocks
from barograph.plans.staging import PREFIXED


def days_before(as_of: date, days: int) -> Column:
    return F.date_sub(F.lit(as_of), days)


def weather_final(stg_weather_raw: DataFrame, stg_weather_predictions: DataFrame) -> DataFrame:
    """Observations with the prediction made on the same day, under the original names."""
    predictions = stg_weather_predictions.withColumnsRenamed({v: k for k, v in PREFIXED.items()})
    return stg_weather_raw.join(predictions, ["date", "city"], "left")


def actuals_vs_predictions(
    stg_weather_predictions: DataFrame, stg_weather_raw: DataFrame
) -> DataFrame:
    """A prediction dated D meets the observation of calendar day D + 1.

    Moving the observation one day back keeps this a plain equi-join on (date, city).
    """
    next_day = stg_weather_raw.select(
        F.date_sub("date", 1).alias("date"),
        "city",
        F.col("rain_today").alias("actual_rain"),
        F.col("max_temp").alias("actual_max_temp"),
        F.col("min_temp").alias("actual_min_temp"),
        F.col("rainfall").alias("actual_rainfall"),
        F.col("weather_code").alias("actual_weather_code"),
    )
    joined = stg_weather_predictions.join(next_day, ["date", "city"], "left")
    predicted, actual = F.col("pred_rain_tomorrow"), F.col("actual_rain")
    return joined.select(
        F.col("date").alias("prediction_date"),
        "city",
        F.date_add("date", 1).alias("actual_date"),
        *stg_weather_predictions.columns[2:],
        "actual_rain",
        "actual_max_temp",
        "actual_min_temp",
        "actual_rainfall",
        "actual_weather_code",
        # A missing actual counts as wrong here; has_actuals tells the two cases apart.
        F.coalesce(as_int(predicted == actual), F.lit(0)).alias("rain_correct"),
        as_int(predicted != actual).alias("rain_abs_error"),
        F.abs(F.col("pred_max_temp_tomorrow") - F.col("actual_max_temp")).alias("temp_abs_error"),
        F.col("actual_max_temp").isNotNull().alias("has_actuals"),
    )


def completeness_daily(
    stg_weather_raw: DataFrame, as_of: date, cfg: Settings = DEFAULTS
) -> DataFrame:
    """Cities present and complete per day against the best day of the lookback."""
    both = F.col("min_temp").isNotNull() & F.col("max_temp").isNotNull()
    daily = stg_weather_raw.groupBy("date").agg(
        F.countDistinct("city").alias("present_cities"),
        F.countDistinct(F.when(both, F.col("city"))).alias("complete_cities"),
    )
    expected = daily.where(F.col("date") >= days_before(as_of, cfg.horizon.completeness_days)).agg(
        F.max("complete_cities").alias("expected_cities")
    )
    done, want = F.col("complete_cities"), F.col("expected_cities")
    pct = F.when(want > 0, round_half_up(100.0 * done / want, 2))
    return attach_row(daily, expected).select(
        "date",
        "present_cities",
        "complete_cities",
        "expected_cities",
        (want - done).alias("missing_city_count"),
        pct.alias("completeness_pct"),
        (done < want).alias("has_gap"),
    )


FRESHNESS = [(1, "Current"), (2, "Yesterday"), (4, "Stale (2-3d)"), (8, "Stale (4-7d)")]


def freshness_by_city(dim_cities: DataFrame, as_of: date, cfg: Settings = DEFAULTS) -> DataFrame:
    """Days since the last observation per city, and holes inside its range.

    The city dimension already holds first day, last day and row count, so no second pass over the
    observations is needed.
    """
    lag = cal.days_between(F.lit(as_of), "last_observed_date")
    span = cal.days_between("last_observed_date", "first_observed_date") + 1
    tier = F.when(lag < 0, "Yesterday").otherwise(band(lag, FRESHNESS, "Critical (>7d)", above=False))
    return dim_cities.select(
        "city",
        "last_observed_date",
        "first_observed_date",
        F.col("total_records").alias("total_days"),
        span.alias("date_range_days"),
        "state",
        "latitude",
        "longitude",
        lag.alias("days_since_last_update"),
        round_half_up(100.0 * ratio("total_records", span), 2).alias("internal_completeness_pct"),
        (span - F.col("total_records")).alias("internal_gap_days"),
        tier.alias("freshness_tier"),
        (lag > 3).alias("is_stale"),
    )


def extreme_events_actual(stg_weather_raw: DataFrame) -> DataFrame:
    """Observed extremes per city and day. An unknown reading makes its flag, and the compound
    flag, null; gust and rain count as not extreme when missing."""
    hot, cold = F.col("max_temp"), F.col("min_temp")
    thunder = F.col("weather_code").isin(95, 96, 99)
    gusty = F.coalesce(F.col("wind_gust_speed") >= 90, F.lit(False))
    soaked = F.coalesce(F.col("rainfall") >= 25, F.lit(False))
    flags = {
        "is_heatwave_day": hot >= 35,
        "is_frost_day": cold < 2,
        "is_storm_day": gusty | thunder,
        "is_heavy_rain_day": soaked,
    }
    label = (
        F.when(hot >= 40, "Extreme heat (≥40°C)")
        .when(hot >= 35, "Heatwave (35-39°C)")
        .when(cold < 0, "Hard frost (<0°C)")
        .when(cold < 2, "Frost (0-2°C)")
        .when(thunder, "Thunderstorm")
        .when(gusty, "High wind gust")
        .when(soaked, "Heavy rain")
        .otherwise("Normal")
    )
    total = sum((as_int(c) for c in flags.values()), F.lit(0))
    return stg_weather_raw.select(
        "date",
        "city",
        *[c.alias(n) for n, c in flags.items()],
        (total >= 2).alias("is_compound_extreme"),
        label.alias("event_label"),
        "max_temp",
        "min_temp",
        "rainfall",
        "wind_gust_speed",
        "weather_code",
    )


DRIFT_TIERS = [(50, "Chronic"), (20, "Frequent"), (5, "Occasional")]


def drift_ranking(
    stg_drift_reports: DataFrame, as_of: date, cfg: Settings = DEFAULTS
) -> DataFrame:
    """Drift history per feature. Ties of the rank are broken by feature name.

    The rank is a window without partition, over one row per monitored feature: its size is the
    number of monitored columns.
    """
    recent = F.col("date") >= days_before(as_of, cfg.horizon.recent_drift_days)
    drifted = F.col("drifted")
    ks = F.col("ks_stat")
    span = stg_drift_reports.agg(
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.countDistinct("date").alias("total_monitoring_days"),
    )
    features = stg_drift_reports.groupBy("feature_name").agg(
        F.countDistinct("date").alias("days_monitored"),
        count_if(drifted).alias("drift_days"),
        round_half_up(F.avg(ks), 4).alias("mean_ks_stat"),
        round_half_up(F.max(ks), 4).alias("max_ks_stat"),
        round_half_up(F.avg(F.when(drifted, ks)), 4).alias("mean_ks_stat_when_drifted"),
        round_half_up(F.avg("p_value"), 4).alias("mean_p_value"),
        round_half_up(F.min("p_value"), 4).alias("min_p_value"),
        count_if(recent & drifted).alias("drift_days_last_30d"),
        F.countDistinct(F.when(recent, F.col("date"))).alias("_recent_days"),
    )

    def share(days: str, of: str) -> Column:
        return round_half_up(100.0 * ratio(days, of), 2)

    order = Window.orderBy(
        F.desc_nulls_last("drift_frequency_pct"),
        F.desc_nulls_last("mean_ks_stat"),
        F.asc("feature_name"),
    )
    ranked = (
        features.withColumn("drift_frequency_pct", share("drift_days", "days_monitored"))
        .withColumn("drift_freq_last_30d_pct", share("drift_days_last_30d", "_recent_days"))
        .drop("_recent_days")
        .withColumn("drift_rank", F.row_number().over(order))
        .withColumn("drift_tier", band(F.col("drift_frequency_pct"), DRIFT_TIERS, "Rare"))
        .withColumn(
            "drift_accelerating",
            F.col("drift_freq_last_30d_pct") > F.col("drift_frequency_pct") * 1.5,
        )
    )
    return attach_row(ranked, span)


def gap_to_retrain(retrain_events: DataFrame, completeness_daily: DataFrame) -> DataFrame:
    """Data gaps in the seven days before each retrain, and the metrics of the next retrain.

    The interval ``[r - 7, r)`` holds exactly seven calendar days, so the range join becomes an
    equi-join on the exploded days.
    """
    window_days = F.sequence(F.date_sub("retrain_date", 7), F.date_sub("retrain_date", 1))
    gap = F.col("has_gap")
    quality = (
        retrain_events.select("retrain_date", F.explode(window_days).alias("date"))
        .join(completeness_daily, "date", "left")
        .groupBy("retrain_date")
        .agg(
            F.max(F.when(gap, 1).otherwise(0)).alias("preceded_by_gap"),
            count_if(gap).alias("gap_days_in_7d_window"),
            F.max("missing_city_count").alias("max_missing_cities_7d"),
            F.avg("completeness_pct").alias("avg_completeness_7d"),
        )
    )
    following = neighbour(
        retrain_events,
        [],
        "retrain_date",
        {
            "retrain_date": "next_retrain_date",
            "rain_accuracy_30d": "next_rain_accuracy",
            "temp_mae_30d": "next_temp_mae",
        },
    )
    return following.join(quality, "retrain_date", "left").select(
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
        "avg_completeness_7d",
        "rain_accuracy_30d",
        "temp_mae_30d",
        "next_retrain_date",
        "next_rain_accuracy",
        "next_temp_mae",
    )


def performance_daily(actuals_vs_predictions: DataFrame) -> DataFrame:
    """Rolling accuracy and error per city over the last 30 and 7 rows that have an actual."""
    base = actuals_vs_predictions.where("has_actuals").select(
        "prediction_date", "city", "actual_date", "rain_correct", "temp_abs_error"
    )
    blocks, by_city = row_blocks(base, ["city"], "prediction_date", before=29)
    for rows in (30, 7):
        frame = by_city.rowsBetween(1 - rows, 0)
        blocks = blocks.withColumns(
            {
                f"rain_accuracy_{rows}d": F.avg(F.col("rain_correct").cast("double")).over(frame),
                f"temp_mae_{rows}d": F.avg("temp_abs_error").over(frame),
            }
        )
    return drop_halo(blocks)


def with_season(df: DataFrame, dim_date: DataFrame, columns: list[str]) -> DataFrame:
    """Join calendar attributes of ``prediction_date``; null for a day without observations."""
    days = dim_date.select(F.col("date").alias("prediction_date"), *columns)
    return df.join(days, "prediction_date", "left")


def bias_by_city(actuals_vs_predictions: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Signed errors per city, season and year. A group holds at most the days of one season."""
    base = with_season(
        actuals_vs_predictions.where("has_actuals"),
        dim_date.withColumn("season", F.col("season_southern")),
        ["season", "year"],
    )
    error = F.col("pred_max_temp_tomorrow") - F.col("actual_max_temp")
    said, was = F.col("pred_rain_tomorrow"), F.col("actual_rain")
    rows = F.count(F.lit(1))
    bias = snap(F.avg(error))
    return base.groupBy("city", "season", "year").agg(
        rows.alias("n_days"),
        round_half_up(F.avg(error), 3).alias("temp_mean_bias"),
        round_half_up(F.avg("temp_abs_error"), 3).alias("temp_mae"),
        round_half_up(F.stddev_samp(error), 3).alias("temp_bias_stddev"),
        round_half_up(F.sqrt(F.avg(error * error)), 3).alias("temp_rmse"),
        F.percentile("temp_abs_error", 0.9).alias("temp_mae_p90"),
        round_half_up(100.0 * count_if(said & ~was) / rows, 2).alias("rain_false_positive_pct"),
        round_half_up(100.0 * count_if(~said & was) / rows, 2).alias("rain_false_negative_pct"),
        F.when(F.abs(bias) < 0.5, "Unbiased")
        .when(bias > 0, "Overestimates")
        .otherwise("Underestimates")
        .alias("temp_bias_direction"),
    )


def prediction_calibration(actuals_vs_predictions: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Predicted against observed rain per ten-point bucket and season.

    A probability of exactly 1 falls in an eleventh bucket from 1.0 to 1.0, as published.
    """
    base = with_season(
        actuals_vs_predictions.where(
            F.col("has_actuals") & F.col("pred_rain_proba").isNotNull()
        ),
        dim_date.withColumn("season", F.col("season_southern")),
        ["season"],
    )
    low = F.floor(F.col("pred_rain_proba") * 10).cast("double") / 10.0
    proba, rained = F.col("pred_rain_proba"), as_int(F.col("actual_rain")).cast("double")
    said, seen = snap(F.avg(proba)), snap(F.avg(rained))
    error = snap(said - seen)
    return (
        base.withColumn("prob_bucket_low", low)
        .withColumn("prob_bucket_high", F.least(F.col("prob_bucket_low") + 0.1, F.lit(1.0)))
        .withColumn("prob_bucket_mid", F.col("prob_bucket_low") + 0.05)
        .groupBy("prob_bucket_low", "prob_bucket_high", "prob_bucket_mid", "season")
        .agg(
            F.count(F.lit(1)).alias("n_predictions"),
            said.alias("mean_predicted_proba"),
            seen.alias("observed_rain_rate"),
            error.alias("calibration_error"),
            F.abs(error).alias("abs_calibration_error"),
            F.avg((proba - rained) * (proba - rained)).alias("brier_score_bucket"),
            F.coalesce(error > 0.1, F.lit(False)).alias("overconfident"),
            F.coalesce(error < -0.1, F.lit(False)).alias("underconfident"),
        )
    )


def retrain_events(
    stg_retrain_events: DataFrame,
    stg_model_metrics_history: DataFrame,
    stg_monitoring_decisions: DataFrame,
) -> DataFrame:
    metrics = stg_model_metrics_history.select(
        F.col("date").alias("retrain_date"),
        "rain_accuracy_30d",
        "temp_mae_30d",
        F.col("status").alias("metrics_status"),
    )
    decisions = stg_monitoring_decisions.select(
        F.col("date").alias("retrain_date"),
        F.col("action").alias("trigger_action"),
        F.col("reason").alias("trigger_reason"),
        "n_drifted_features",
        "heavy_drift",
        "mild_drift",
        "low_accuracy",
        "high_mae",
    )
    return stg_retrain_events.join(metrics, "retrain_date", "left").join(
        decisions, "retrain_date", "left"
    )


def features_stats(stg_weather_raw: DataFrame) -> DataFrame:
    """City by year-month statistics."""
    averages = [
        "max_temp", "min_temp", "rainfall", "precipitation_hours", "humidity_9am", "humidity_3pm",
        "pressure_9am", "pressure_3pm", "wind_gust_speed", "cloud_9am", "cloud_3pm",
        "shortwave_radiation_sum",
    ]
    return stg_weather_raw.groupBy("city", cal.month_start("date").alias("month")).agg(
        F.count(F.lit(1)).alias("n_days"),
        count_if(F.col("rain_today")).alias("n_rainy_days"),
        *[F.avg(c).alias(f"avg_{c}") for c in averages],
        *[F.stddev_samp(c).alias(f"stddev_{c}") for c in ("max_temp", "min_temp")],
        F.min("max_temp").alias("min_max_temp"),
        *[F.max(c).alias(f"max_{c}") for c in ("max_temp", "rainfall", "wind_gust_speed")],
    )


ANOMALY_FEATURES = {
    "z_max_temp": "max_temp",
    "z_min_temp": "min_temp",
    "z_rainfall": "rainfall",
    "z_wind_gust": "wind_gust_speed",
    "z_humidity_3pm": "humidity_3pm",
    "z_pressure_3pm": "pressure_3pm",
}


def anomaly_score(stg_weather_raw: DataFrame) -> DataFrame:
    """Six z-scores per city and day against the city's calendar month over all years.

    The published model joins year-month rows on the calendar month alone and so repeats each day
    once per year of history; its stated grain is city by day. This builds the stated grain: the
    baseline pools all years of a city and calendar month. Two features have a real deviation, four
    use the published stand-ins. The pooled baseline has one row per city and month (Catalyst
    picks the join by its size).
    """
    base = stg_weather_raw.groupBy("city", F.month("date").alias("_month")).agg(
        *[F.avg(c).alias(f"_mean_{c}") for c in ANOMALY_FEATURES.values()],
        F.stddev_samp("max_temp").alias("_dev_max_temp"),
        F.stddev_samp("min_temp").alias("_dev_min_temp"),
    )
    # Stand-in deviations as a share of the mean (rain: root of the mean).
    deviation = {
        "max_temp": F.col("_dev_max_temp"),
        "min_temp": F.col("_dev_min_temp"),
        "rainfall": F.sqrt("_mean_rainfall"),
        "wind_gust_speed": F.col("_mean_wind_gust_speed") * 0.3,
        "humidity_3pm": F.col("_mean_humidity_3pm") * 0.15,
        "pressure_3pm": F.col("_mean_pressure_3pm") * 0.005,
    }
    joined = stg_weather_raw.withColumn("_month", F.month("date")).join(base, ["city", "_month"], "left")
    scored = joined.select(
        "date",
        "city",
        *[
            snap(F.try_divide(F.col(c) - F.col(f"_mean_{c}"), deviation[c])).alias(z)
            for z, c in ANOMALY_FEATURES.items()
        ],
    )
    unusual = {z: F.abs(F.col(z)) > 2 for z in ANOMALY_FEATURES}
    count = sum((as_int(c) for c in unusual.values()), F.lit(0))
    largest = F.greatest(*[F.abs(F.coalesce(F.col(z), F.lit(0.0))) for z in ANOMALY_FEATURES])
    return scored.select(
        "date",
        "city",
        *[round_half_up(z, 2).alias(z) for z in ANOMALY_FEATURES],
        *[c.alias(z.replace("z_", "anomaly_", 1)) for z, c in unusual.items()],
        count.alias("n_anomalous_features"),
        largest.alias("composite_anomaly_score"),
        (count >= 2).alias("is_anomalous_day"),
    )
