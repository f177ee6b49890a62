"""BI marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.functions.rows import attach_row
from barograph.functions import calendar as cal
from barograph.functions.numeric import count_if, flag, snap

ALERT_COUNTS = {
    # Alert type counted by each overview column.
    "n_rain_alerts": "Rain risk",
    "n_storm_alerts": "Storm risk",
    "n_heatwave_alerts": "Heatwave risk",
    "n_frost_alerts": "Frost risk",
    "n_low_comfort_alerts": "Low comfort",
}


def dashboard_overview(
    monthly_city: DataFrame,
    forecast_accuracy_monthly: DataFrame,
    risk_alerts: DataFrame,
    data_quality_daily: DataFrame,
) -> DataFrame:
    """One row per month from four sources, each reduced to months before the joins."""
    means = [
        "avg_max_temp", "avg_min_temp", "rainy_day_rate", "avg_comfort_score", "avg_heatwave_risk",
        "avg_frost_risk", "avg_storm_probability",
    ]
    weather = monthly_city.groupBy("year_month").agg(
        F.countDistinct("city").alias("n_cities"),
        F.sum("n_days").alias("n_city_days"),
        F.sum("total_rainfall").alias("total_rainfall"),
        *[F.avg(c).alias(c) for c in means],
    )
    forecast = forecast_accuracy_monthly.groupBy("year_month").agg(
        F.avg("rain_accuracy").alias("rain_accuracy"),
        F.avg("temp_mae").alias("temp_mae"),
        F.max("temp_max_error").alias("temp_max_error"),
        F.sum("n_predictions").alias("n_predictions"),
    )
    alerts = risk_alerts.groupBy(cal.month_start("weather_date").alias("year_month")).agg(
        F.count(F.lit(1)).alias("n_alerts"),
        count_if(F.col("alert_level") == "Critical").alias("n_critical_alerts"),
        *[count_if(F.col("alert_type") == kind).alias(n) for n, kind in ALERT_COUNTS.items()],
    )
    quality = data_quality_daily.groupBy(cal.month_start("weather_date").alias("year_month")).agg(
        F.avg("completeness_pct").alias("avg_completeness_pct"),
        count_if(F.col("data_quality_status") == "Critical").alias("n_critical_quality_days"),
    )
    joined = weather
    for part in (forecast, alerts, quality):
        joined = joined.join(part, "year_month", "left")
    broken = (snap("avg_completeness_pct") < 75) | (F.col("n_critical_alerts") > 0)
    weak = (snap("rain_accuracy") < 0.70) | (snap("temp_mae") > 4)
    status = F.when(broken, "Critical").when(weak, "Warning").otherwise("Healthy")
    return joined.fillna(0, subset=["n_alerts", "n_critical_alerts", *ALERT_COUNTS]).withColumn(
        "global_status", status
    )


def data_quality_summary(data_quality_daily: DataFrame) -> DataFrame:
    groups = ("rain", "temperature", "wind", "pressure", "cloud_solar")
    return data_quality_daily.groupBy(
        cal.month_start("weather_date").alias("year_month"), "city", "state"
    ).agg(
        F.avg("completeness_pct").alias("avg_completeness_pct"),
        F.avg("n_missing_fields").alias("avg_missing_fields"),
        *[F.sum(f"missing_{g}_fields").alias(f"total_missing_{g}_fields") for g in groups],
        *[
            count_if(F.col("data_quality_status") == s).alias(f"{s.lower()}_quality_days")
            for s in ("Good", "Warning", "Poor", "Critical")
        ],
    )


def homepage_kpis(current_snapshot: DataFrame, dashboard_overview: DataFrame) -> DataFrame:
    """A single row: the cities at the latest date, and the latest month of the overview.

    ``max_by`` picks the latest day and month in one pass instead of a join to the maximum.
    """
    measures = {
        "avg_max_temp_tomorrow": "max_temp_tomorrow",
        "avg_rain_tomorrow_proba": "rain_tomorrow_proba",
        "avg_current_comfort_score": "comfort_score",
        "avg_current_heatwave_risk": "heatwave_risk",
        "avg_current_frost_risk": "frost_risk",
        "avg_current_storm_probability": "storm_probability",
    }
    by_date = current_snapshot.groupBy("latest_date").agg(
        F.countDistinct("city").alias("current_n_cities"),
        *[F.avg(source).alias(name) for name, source in measures.items()],
    )
    newest = by_date.agg(F.max_by(F.struct(*by_date.columns), "latest_date").alias("r"))
    latest = newest.where(F.col("r").isNotNull()).select("r.*")
    month = dashboard_overview.agg(
        F.max_by(
            F.struct(
                F.col("rain_accuracy").alias("latest_month_rain_accuracy"),
                F.col("temp_mae").alias("latest_month_temp_mae"),
                F.col("avg_completeness_pct").alias("latest_month_completeness_pct"),
                F.col("n_critical_alerts").alias("latest_month_critical_alerts"),
                F.col("global_status").alias("latest_global_status"),
            ),
            "year_month",
        ).alias("r")
    ).select("r.*")
    return attach_row(latest, month)


def alerts_summary_monthly(risk_alerts: DataFrame) -> DataFrame:
    return risk_alerts.groupBy(
        cal.month_start("weather_date").alias("year_month"), "state", "alert_type", "alert_level"
    ).agg(
        F.count(F.lit(1)).alias("n_alerts"),
        F.countDistinct("city").alias("n_cities_impacted"),
        F.avg("alert_score").alias("avg_alert_score"),
        F.max("alert_score").alias("max_alert_score"),
    )


def bi_current_snapshot(current_snapshot: DataFrame) -> DataFrame:
    critical = {
        "critical_rain_flag": "rain_tomorrow_proba",
        "critical_storm_flag": "storm_probability",
        "critical_heatwave_flag": "heatwave_risk",
        "critical_frost_flag": "frost_risk",
    }
    flags = {name: flag(F.col(source) >= 0.80) for name, source in critical.items()}
    return current_snapshot.withColumns(flags | {"low_comfort_flag": flag(F.col("comfort_score") < 60)})


def bi_extremes(weather_extremes: DataFrame) -> DataFrame:
    return weather_extremes.withColumn("year_month", cal.month_start("weather_date"))


def bi_risk_alerts(risk_alerts: DataFrame) -> DataFrame:
    return risk_alerts.withColumn("year_month", cal.month_start("weather_date"))
