"""BI measures, quality assertions and serving queries."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.operators import measures as k
from barograph.operators import quality as q
from barograph.operators import serving as s
from barograph.queries import Context, query
from barograph.query_sets.exploration import full
from barograph.session import scratch_path
from barograph.sources.sinks import write_csv

c = F.col
CITY, START, END = "NATION_7", date(1999, 1, 1), date(2000, 12, 31)


def fva(ctx: Context):
    return ctx.table("forecast_vs_actual_daily")


def both(build, *slices) -> DataFrame:
    """The measure over everything and over a slice, told apart by a label."""
    parts = [build(**kwargs).withColumn("slice", F.lit(label)) for label, kwargs in slices]
    return reduce(DataFrame.unionByName, parts)


ALL_AND_SLICE = (("all", {}), ("slice", {"city": CITY, "start": START, "end": END}))


@query("kpi_latest_day")
def _(ctx: Context):
    return both(lambda **kw: k.kpi_latest_day(fva(ctx), **kw), ("all", {}), ("slice", {"city": CITY}))


@query("kpi_alerts_today")
def _(ctx: Context):
    return k.kpi_alerts_today(ctx.table("risk_alerts"), ctx.table("weather_extremes"))


@query("kpi_ops_latest")
def _(ctx: Context):
    return k.kpi_ops_latest(ctx.table("mlops_health"))


@query("kpi_forecast_actual")
def _(ctx: Context):
    return both(lambda **kw: k.kpi_forecast_actual(fva(ctx), **kw), *ALL_AND_SLICE)


@query("kpi_quality")
def _(ctx: Context):
    return both(lambda **kw: k.kpi_quality(fva(ctx), **kw), *ALL_AND_SLICE)


@query("kpi_vs_baseline")
def _(ctx: Context):
    return both(lambda **kw: k.kpi_vs_baseline(fva(ctx), **kw), *ALL_AND_SLICE)


@query("kpi_retraining")
def _(ctx: Context):
    return k.kpi_retraining(ctx.table("retraining_history"))


@query("kpi_weather_score")
def _(ctx: Context):
    return both(lambda **kw: k.kpi_weather_score(fva(ctx), **kw), *ALL_AND_SLICE)


@query("kpi_city_label")
def _(ctx: Context):
    locations = ctx.table("location_cities")
    return both(lambda **kw: k.kpi_city_label(locations, **kw), ("all", {}), ("slice", {"city": CITY}))


@query("calendar")
def _(ctx: Context):
    return k.calendar(ctx.table("stg_weather_raw"))


@query("forecast_calc_columns", exact=True)
def _(ctx: Context):
    return k.forecast_calc_columns(fva(ctx))


@query("drift_month_date")
def _(ctx: Context):
    return k.drift_month_date(ctx.table("feature_drift_summary"))


@query("typed_mart_read", exact=True)
def _(ctx: Context):
    mart = fva(ctx)
    path = scratch_path(ctx.spark, "mart-csv")
    write_csv(mart, path)
    csv = ctx.spark.read.schema(mart.schema).option("header", True).csv(path)
    return k.typed_mart_read(csv, ["state", "latitude", "longitude"], {"weather_type_tomorrow": "predicted_type"})


@query("assert_not_null")
def _(ctx: Context):
    return q.assert_not_null(ctx.table("stg_weather_raw"), ["date", "city", "min_temp", "wind_dir_3pm"])


@query("assert_unique")
def _(ctx: Context):
    one = q.assert_unique(ctx.table("stg_weather_raw"), ["date", "city"])
    return one.unionByName(q.assert_unique(ctx.table("stg_weather_raw"), ["date"]))


@query("assert_accepted_values")
def _(ctx: Context):
    actions = ["trigger_retrain", "alert_only", "alert_insufficient_data", "no_action"]
    one = q.assert_accepted_values(ctx.table("stg_monitoring_decisions"), "action", actions)
    two = q.assert_accepted_values(ctx.table("stg_weather_predictions"), "pred_weather_type_tomorrow", ["Sunny", "Rainy"])
    return one.unionByName(two)


@query("quality_gates")
def _(ctx: Context):
    return q.quality_gates(full(ctx), 26)


@query("api_weather", exact=True)
def _(ctx: Context):
    return s.api_weather(full(ctx), city=CITY, start=START, limit=500)


@query("api_latest", exact=True)
def _(ctx: Context):
    return s.api_latest(full(ctx))


@query("api_predictions", exact=True)
def _(ctx: Context):
    return s.api_predictions(ctx.table("src_weather_predictions"), start=START, end=END)


@query("api_mart")
def _(ctx: Context):
    """The rows behind every client name."""
    counts = [
        s.api_mart(slug, ctx.catalog).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(slug).alias("slug"), "n_rows")
        for slug in sorted(s.slugs())
    ]
    return reduce(DataFrame.unionByName, counts)


@query("json_records")
def _(ctx: Context):
    # Rain per hour is NaN on a day of zero hours; it has to read null.
    hours = c("precipitation_hours")
    rate = F.when(hours > 0, F.rint(c("rainfall") / hours)).otherwise(F.lit(float("nan")))
    kept = ["date", "city", "max_temp", "wind_dir_3pm", "weather_code", "comfort_score"]
    return s.json_records(full(ctx).select(*kept, rate.alias("rate")))


@query("city_list")
def _(ctx: Context):
    return s.city_list(ctx.table("dim_city"))


@query("last_update")
def _(ctx: Context):
    return s.last_update(ctx.table("src_weather_raw"))
