"""BI measures: one-row aggregates over the marts, with an optional city and date range."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barograph.functions.rows import attach_row
from barograph.functions import calendar as cal
from barograph.functions.numeric import count_if, flag, ratio, round_half_up, snap

c = F.col


def sliced(
    df: DataFrame, day: str, city: str | None = None, start: date | None = None, end: date | None = None
) -> DataFrame:
    if city is not None:
        df = df.where(c("city") == city)
    if start is not None:
        df = df.where(c(day) >= F.lit(start))
    if end is not None:
        df = df.where(c(day) <= F.lit(end))
    return df


def _latest(per_day: DataFrame, day: str) -> DataFrame:
    """The row of the last day, picked with ``max_by``; no row when there are no days."""
    last = per_day.agg(F.max_by(F.struct(*per_day.columns), day).alias("r"))
    return last.where(c("r").isNotNull()).select("r.*")


def kpi_latest_day(fva: DataFrame, city: str | None = None) -> DataFrame:
    """Figures of the latest prediction day. Active cities are counted over all cities."""
    measured = sliced(fva, "prediction_date", city).groupBy("prediction_date").agg(
        round_half_up(F.avg("pred_max_temp_tomorrow"), 1).alias("avg_temp_tomorrow"),
        round_half_up(F.avg("pred_rain_proba") * 100, 1).alias("avg_rain_pct"),
        round_half_up(F.avg("comfort_score"), 1).alias("avg_comfort_score"),
        round_half_up(F.avg("heatwave_risk") * 100, 1).alias("avg_heatwave_pct"),
        round_half_up(F.avg("storm_probability") * 100, 1).alias("avg_storm_pct"),
    )
    cities = fva.groupBy("prediction_date").agg(F.countDistinct("city").alias("active_cities"))
    return (
        _latest(measured, "prediction_date")
        .join(cities, "prediction_date", "left")
        .withColumnRenamed("prediction_date", "latest_date")
        .withColumn("latest_date_label", F.date_format("latest_date", "dd/MM/yyyy"))
    )


def kpi_alerts_today(alerts: DataFrame, extremes: DataFrame, city: str | None = None) -> DataFrame:
    per_day = sliced(alerts, "weather_date", city).groupBy("weather_date").agg(
        F.count(F.lit(1)).alias("n_alerts_today"),
        count_if(c("alert_level") == "Critical").alias("n_critical_today"),
        count_if(c("alert_level") == "High").alias("n_high_today"),
    )
    events = sliced(extremes, "weather_date", city).agg(F.count(F.lit(1)).alias("n_extreme_events"))
    return attach_row(_latest(per_day, "weather_date"), events)


# Status text of each monitoring action.
STATUS_TEXT = {
    "no_action": "OK",
    "alert_only": "Attention",
    "trigger_retrain": "Critique",
    "alert_insufficient_data": "Données insuffisantes",
}
STATUS_UNKNOWN = "Inconnu"


def kpi_ops_latest(health: DataFrame) -> DataFrame:
    text = F.lit(STATUS_UNKNOWN)
    for action, label in STATUS_TEXT.items():
        text = F.when(c("monitoring_action") == action, label).otherwise(text)
    return _latest(health, "date").select(
        "date",
        "completeness_pct",
        text.alias("global_status"),
        "days_since_retrain",
        "n_drifted_features",
        "rain_accuracy_30d",
        "temp_mae_30d",
    )


def has_actual() -> Column:
    return c("actual_max_temp_tomorrow").isNotNull()


def kpi_forecast_actual(fva: DataFrame, city=None, start=None, end=None) -> DataFrame:
    known = has_actual()
    rained = count_if(known & (c("actual_rain_tomorrow") == 1))
    return sliced(fva, "prediction_date", city, start, end).agg(
        round_half_up(F.avg("pred_max_temp_tomorrow"), 1).alias("predicted_temp"),
        round_half_up(F.avg("actual_max_temp_tomorrow"), 1).alias("actual_temp"),
        round_half_up(F.avg("pred_rain_proba") * 100, 1).alias("mean_rain_pct"),
        round_half_up(ratio(rained, count_if(known)) * 100, 1).alias("actual_rain_pct"),
        count_if(known).alias("n_validated"),
    )


def _quality(fva: DataFrame) -> DataFrame:
    """The shared figures behind the reliability measures."""
    known = has_actual()
    outcome = c("forecast_result")
    return fva.agg(
        snap(ratio(count_if(known & (c("rain_prediction_correct") == 1)), count_if(known))).alias("rain_accuracy"),
        snap(F.avg(F.when(known, c("temp_abs_error")))).alias("temp_mae"),
        snap(F.avg(F.when(known, c("temp_error_signed")))).alias("temp_bias"),
        snap(F.avg("comfort_score")).alias("_comfort"),
        *[
            count_if(outcome == label).alias(name)
            for name, label in (
                ("tp", "True positive"), ("tn", "True negative"),
                ("fp", "False positive"), ("fn", "False negative"),
            )
        ],
    )


def kpi_quality(fva: DataFrame, city=None, start=None, end=None) -> DataFrame:
    tp, tn, fp, fn = c("tp"), c("tn"), c("fp"), c("fn")
    precision, recall = c("precision"), c("recall")
    bias = c("temp_bias")
    # French bias labels.
    direction = F.when(bias > 0.5, "Surchauffe").when(bias < -0.5, "Sous-estime").otherwise("Neutre")
    return (
        _quality(sliced(fva, "prediction_date", city, start, end))
        .drop("_comfort")
        .withColumns({"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn)})
        .withColumns(
            {
                "rain_accuracy_pct": round_half_up(c("rain_accuracy") * 100, 1),
                "temp_mae_rounded": round_half_up("temp_mae", 2),
                "f1_score": ratio(2 * precision * recall, precision + recall),
                "false_alarm_pct": round_half_up(ratio(fp, fp + tn) * 100, 1),
                "missed_rain_pct": round_half_up(ratio(fn, fn + tp) * 100, 1),
                "bias_direction": direction,
            }
        )
    )


# Published baseline of rain accuracy and temperature error.
BASELINE_ACCURACY, BASELINE_MAE = 0.77, 1.63


def kpi_vs_baseline(fva: DataFrame, city=None, start=None, end=None) -> DataFrame:
    return _quality(sliced(fva, "prediction_date", city, start, end)).select(
        round_half_up((c("rain_accuracy") - BASELINE_ACCURACY) * 100, 1).alias("accuracy_vs_baseline"),
        round_half_up(c("temp_mae") - BASELINE_MAE, 2).alias("mae_vs_baseline"),
    )


def kpi_retraining(history: DataFrame) -> DataFrame:
    n, worse = F.count(F.lit(1)), count_if(c("low_accuracy") | c("heavy_drift"))
    return history.agg(
        F.avg("accuracy_delta").alias("avg_accuracy_delta"),
        F.avg("mae_delta").alias("avg_mae_delta"),
        n.alias("n_retrains"),
        worse.alias("n_degrading"),
        round_half_up(F.coalesce(ratio(worse, n), F.lit(0.0)) * 100, 0).alias("pct_degrading"),
    )


def kpi_weather_score(fva: DataFrame, city=None, start=None, end=None) -> DataFrame:
    # Weights and French bands of the score.
    score = round_half_up(
        c("rain_accuracy") * 40
        + c("_comfort") * 0.4
        + F.greatest((F.lit(5.0) - c("temp_mae")) * 4, F.lit(0.0)),
        1,
    )
    s = c("weather_score")
    bands = F.when(s >= 90, "Excellent").when(s >= 75, "Bon").when(s >= 60, "Moyen").otherwise("Faible")
    return (
        _quality(sliced(fva, "prediction_date", city, start, end))
        .select(score.alias("weather_score"))
        .withColumn("performance_category", bands)
    )


def kpi_city_label(locations: DataFrame, city: str | None = None) -> DataFrame:
    """The label of the selected city, or null when the selection has several."""
    if city is not None:
        locations = locations.where(c("lieu") == city)
    single = F.countDistinct("lieu_state") == 1
    return locations.agg(F.when(single, F.max("lieu_state")).alias("city_label"))


def calendar(days: DataFrame, column: str = "date") -> DataFrame:
    """Every day of the full years that ``days`` touches, with its attributes."""
    span = days.agg(
        F.make_date(F.year(F.min(column)), F.lit(1), F.lit(1)).alias("_a"),
        F.make_date(F.year(F.max(column)), F.lit(12), F.lit(31)).alias("_b"),
    )
    d = c("date")
    first_week_shift = F.weekday(cal.year_start(d))
    return (
        span.select(F.explode(F.sequence("_a", "_b", F.expr("interval 1 day"))).alias("date"))
        .withColumns(
            {
                "year": F.year(d),
                "month_num": F.month(d),
                "month_name": F.date_format(d, "MMMM"),
                "month_short": F.date_format(d, "MMM"),
                "year_month": F.date_format(d, "yyyy-MM"),
                "quarter": F.concat(F.lit("T"), F.quarter(d).cast("string")),
                "day": F.dayofmonth(d),
                "weekday_num": cal.iso_weekday(d),
                "weekday_name": F.date_format(d, "EEEE"),
                "week_of_year": (F.floor((F.dayofyear(d) - 1 + first_week_shift) / 7) + 1).cast("int"),
                "iso_week": F.concat(F.lit("W"), F.lpad(F.weekofyear(d).cast("string"), 2, "0")),
                "iso_year": cal.iso_year(d),
                "iso_year_week": cal.iso_year_week(d),
                "season": cal.season(d),
                "season_order": cal.season_index(d),
            }
        )
    )


# French text of each forecast result.
RESULT_FR = {
    "True positive": "Vrai positif (pluie détectée)",
    "True negative": "Vrai négatif (sec bien prédit)",
    "False positive": "Fausse alarme (prédit pluie, sec)",
    "False negative": "Pluie manquée (pas prédit, a plu)",
}


def forecast_calc_columns(fva: DataFrame) -> DataFrame:
    day, error = c("prediction_date"), c("temp_error_signed")
    result = c("forecast_result")
    text = result
    for label, french in RESULT_FR.items():
        text = F.when(result == label, french).otherwise(text)
    return fva.withColumns(
        {
            "season": cal.season(day),
            "year_month_label": F.date_format(day, "yyyy-MM"),
            "year": F.year(day),
            "month_name": F.date_format(day, "MMM"),
            "has_actual": flag(has_actual()),
            "bias_direction_row": F.when(error > 0.5, "Surchauffe")
            .when(error < -0.5, "Sous-estime")
            .otherwise("Neutre"),
            "forecast_result_fr": text,
        }
    )


def drift_month_date(summary: DataFrame) -> DataFrame:
    return summary.withColumn("month_date", F.make_date("year", "month", F.lit(1)))


def typed_mart_read(
    csv: DataFrame, drop: list[str] | None = None, rename: dict[str, str] | None = None
) -> DataFrame:
    """A CSV mart read with its schema, without the dropped columns and under client names."""
    return csv.drop(*(drop or [])).withColumnsRenamed(rename or {})
