"""Exploration statistics and dashboard queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from barograph import schemas
from barograph.functions import calendar as cal
from barograph.operators import explore as e
from barograph.operators.serving import weather_full
from barograph.queries import Context, query
from barograph.sources.adapters import AS_OF

c = F.col


def raw(ctx: Context):
    return ctx.table("src_weather_raw")


def full(ctx: Context):
    return weather_full(ctx.table("src_weather_raw"), ctx.table("src_weather_predictions"))


@query("complete_cases", exact=True)
def _(ctx: Context):
    return e.complete_cases(full(ctx))


@query("null_rates")
def _(ctx: Context):
    return e.null_rates(full(ctx))


@query("city_coverage")
def _(ctx: Context):
    return e.city_coverage(raw(ctx))


@query("pivot_city_year")
def _(ctx: Context):
    return e.pivot_city_year(raw(ctx))


@query("value_counts")
def _(ctx: Context):
    return e.value_counts(raw(ctx), "wind_dir_3pm")


@query("describe_numeric")
def _(ctx: Context):
    return e.describe_numeric(raw(ctx))


@query("histogram")
def _(ctx: Context):
    return e.histogram(raw(ctx), "max_temp", 25)


@query("log_histogram")
def _(ctx: Context):
    return e.log_histogram(raw(ctx), "rainfall", 16)


@query("quantile_profile")
def _(ctx: Context):
    rainy = raw(ctx).where(c("rainfall") > 0)
    return e.quantile_profile(rainy, "rainfall", [0.25, 0.5, 0.75, 0.9, 0.95, 0.99])


@query("boxplot_stats")
def _(ctx: Context):
    return e.boxplot_stats(raw(ctx).withColumn("season", cal.season("date")), "season", "rainfall")


@query("boxplot_groups")
def _(ctx: Context):
    """Three groupings, each over its three measures."""
    seasons = raw(ctx).withColumn("season", cal.season("date"))
    by_season = e.box_values(seasons, "season", ["max_temp", "rainfall", "humidity_3pm"])
    by_rain = e.box_values(seasons, "rain_today", ["humidity_3pm", "pressure_3pm", "cloud_3pm"])
    by_type = e.box_values(
        ctx.table("src_weather_predictions"),
        "weather_type_tomorrow",
        ["rain_tomorrow_proba", "max_temp_tomorrow", "comfort_score"],
    )
    return e.boxplots(by_season.unionByName(by_rain).unionByName(by_type))


@query("monthly_climatology")
def _(ctx: Context):
    return e.monthly_climatology(raw(ctx))


@query("annual_trend")
def _(ctx: Context):
    return e.annual_trend(raw(ctx), ["max_temp", "min_temp"], AS_OF.year)


@query("city_profile")
def _(ctx: Context):
    return e.city_profile(raw(ctx))


@query("state_profile")
def _(ctx: Context):
    return e.state_profile(raw(ctx))


@query("geo_profile")
def _(ctx: Context):
    return e.geo_profile(full(ctx))


@query("minmax_profile")
def _(ctx: Context):
    return e.minmax_profile(e.state_profile(raw(ctx)), "state", list(e.STATE_MEANS))


CORRELATED = schemas.CORRELATION_FEATURES + schemas.CORRELATION_TARGETS


def corr(ctx: Context):
    return e.corr_matrix(full(ctx), CORRELATED)


@query("corr_matrix")
def _(ctx: Context):
    return corr(ctx)


@query("corr_top5")
def _(ctx: Context):
    return e.corr_top(corr(ctx), schemas.CORRELATION_TARGETS, schemas.CORRELATION_FEATURES)


@query("corr_redundant")
def _(ctx: Context):
    return e.corr_redundant(corr(ctx), 0.85)


@query("pearson_pair")
def _(ctx: Context):
    return e.pearson_pair(full(ctx), "shortwave_radiation_sum", "max_temp_tomorrow")


@query("pooled_t")
def _(ctx: Context):
    features = ["humidity_3pm", "dew_point_3pm", "cloud_3pm", "pressure_3pm", "vpd_3pm"]
    return e.pooled_t(full(ctx), "rain_tomorrow", features)


@query("wind_ratio")
def _(ctx: Context):
    return e.wind_ratio(raw(ctx))


@query("delta_temp")
def _(ctx: Context):
    return e.delta_temp(full(ctx))


@query("calibration_curve")
def _(ctx: Context):
    return e.calibration_curve(full(ctx), "rain_tomorrow_proba", "rain_tomorrow")


@query("class_balance")
def _(ctx: Context):
    return e.class_balance(full(ctx), ["rain_tomorrow", "heatwave_risk", "frost_risk"])


@query("mae_by_city")
def _(ctx: Context):
    return e.mae_by_city(ctx.table("forecast_timeline"))


@query("seasonal_month_performance")
def _(ctx: Context):
    return e.seasonal_month_performance(ctx.table("performance_overview"))


@query("date_ranges")
def _(ctx: Context):
    days = {
        "performance_overview": "month", "performance_by_city": "month",
        "forecast_timeline": "prediction_date", "mlops_health": "date",
        "retraining_history": "retrain_date",
    }
    return e.date_ranges({n: (ctx.table(n), day) for n, day in days.items()})


@query("risk_by_city")
def _(ctx: Context):
    return e.risk_by_city(full(ctx))


@query("topk_cities")
def _(ctx: Context):
    return e.topk_cities(ctx.table("performance_by_city"))


@query("hash_sample", exact=True)
def _(ctx: Context):
    kept = full(ctx).where(c("max_temp").isNotNull() & c("max_temp_tomorrow").isNotNull())
    return e.hash_sample(kept.select("date", "city", "max_temp", "max_temp_tomorrow", "state"), ["city", "date"], 5000)


@query("max_gap")
def _(ctx: Context):
    return e.max_gap(raw(ctx))


@query("backtest_window")
def _(ctx: Context):
    parts = [
        e.backtest_window(full(ctx), "max_temp_tomorrow", "max_temp", days) for days in (7, 30, 90)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("backtest_rain_accuracy")
def _(ctx: Context):
    return e.backtest_rain_accuracy(full(ctx), 90)


@query("pivot_city_date")
def _(ctx: Context):
    places = ctx.given("nation").select(c("n_name").alias("city"))
    return e.pivot_city_date(full(ctx), "max_temp_tomorrow", places)


@query("last_month_by_city")
def _(ctx: Context):
    return e.last_month_by_city(ctx.table("performance_by_city"))


@query("latest_health")
def _(ctx: Context):
    return e.latest_health(ctx.table("mlops_health"))
