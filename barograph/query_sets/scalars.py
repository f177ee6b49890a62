"""Scalar function families, one projection each over all observations."""

from __future__ import annotations

from pyspark.sql import functions as F

from barograph.config import DEFAULTS
from barograph.functions import calendar as cal
from barograph.functions import numeric as n
from barograph.functions import weather as w
from barograph.plans.weather import TEMPERATURE_BANDS
from barograph.queries import Context, query
from barograph.sources.adapters import AS_OF

c = F.col


def rows(ctx: Context, **columns):
    return ctx.table("src_weather_raw").select("date", "city", *[v.alias(k) for k, v in columns.items()])


@query("scalar_date_parts")
def _(ctx: Context):
    return rows(
        ctx, year=F.year("date"), month=F.month("date"), day=F.dayofmonth("date"),
        dow=F.dayofweek("date") - 1, week=F.weekofyear("date"), quarter=F.quarter("date"),
        day_of_year=F.dayofyear("date"), iso_year=cal.iso_year("date"), iso_year_week=cal.iso_year_week("date"),
        month_name=F.date_format("date", "MMMM"), weekday_name=F.date_format("date", "EEEE"),
        season=cal.season("date"), season_code=cal.season_code("date"),
    )


@query("scalar_date_trunc")
def _(ctx: Context):
    return rows(
        ctx, month_start=cal.month_start("date"), year_start=cal.year_start("date"), week_start=cal.week_start("date")
    )


@query("scalar_date_arith")
def _(ctx: Context):
    return rows(
        ctx, next_day=F.date_add("date", 1), week_before=F.date_sub("date", 7),
        age_days=cal.days_between(F.lit(AS_OF), "date"), days_in_year=cal.days_between("date", cal.year_start("date")),
    )


@query("scalar_math")
def _(ctx: Context):
    x, y = c("min_temp"), c("pressure_3pm")
    return rows(
        ctx, absolute=F.abs(x), root=F.sqrt(y), square=F.pow(x, F.lit(2)), floored=F.floor(c("vpd_3pm")),
        half_up=n.round_half_up(c("vpd_3pm") * 1.05, 1), half_even=n.round_half_even(c("vpd_9am"), 1),
        smallest=F.least(x, c("max_temp")), largest=F.greatest(x, c("max_temp")), clamped=n.clamp(x, 0.0, 10.0),
    )


@query("scalar_null")
def _(ctx: Context):
    bad = F.when(c("cloud_9am") == 0, F.lit(float("nan"))).when(c("cloud_9am") == 1, F.lit(float("inf")))
    return rows(
        ctx, first_known=F.coalesce("rainfall", "rain_sum", F.lit(0.0)), zero_to_null=F.nullif(c("rainfall"), F.lit(0.0)),
        safe_ratio=n.ratio("rainfall", "precipitation_hours"), is_missing=c("max_temp").isNull(),
        finite=n.finite(bad.otherwise(c("cloud_9am"))),
    )


@query("scalar_bool_sum")
def _(ctx: Context):
    hot, cold, wet = c("max_temp") >= 35, c("min_temp") < 2, F.coalesce(c("rainfall") >= 25, F.lit(False))
    total = n.as_int(hot) + n.as_int(cold) + n.as_int(wet)
    return rows(ctx, n_flags=total, any_two=total >= 2)


@query("scalar_case_bands")
def _(ctx: Context):
    return rows(
        ctx, band=n.band(c("max_temp"), TEMPERATURE_BANDS, "Extreme heat", above=False),
        gust_level=n.band(c("wind_gust_speed"), [(90, "Critical"), (70, "High"), (60, "Medium")], "None"),
    )


@query("scalar_string")
def _(ctx: Context):
    return rows(
        ctx, place=F.concat("city", F.lit(", "), "state"), winds=F.concat("wind_gust_dir", F.lit("/"), "wind_dir_3pm"),
        iso_date=c("date").cast("string"), percent=F.format_string("%.1f%%", c("vpd_9am") * 100),
        sentence=F.format_string("drift on %d features (>=%d)", c("weather_code"), F.lit(4)),
    )


@query("scalar_json")
def _(ctx: Context):
    text = F.to_json(F.struct("wind_dir_3pm", "weather_code"))
    back = F.from_json(text, "wind_dir_3pm string, weather_code int")
    return rows(
        ctx, listed=F.to_json(F.array("wind_gust_dir", "wind_dir_9am")), code_back=back.getField("weather_code"),
        direction_back=back.getField("wind_dir_3pm"),
    )


@query("scalar_array_get")
def _(ctx: Context):
    values = F.array("temp_9am", "temp_3pm", "humidity_9am", "humidity_3pm")
    day = F.dayofmonth("date")
    return rows(ctx, picked=F.get(values, (day % 3) * 2), past_end=F.get(values, day % 8))


@query("scalar_map_explode")
def _(ctx: Context):
    readings = F.create_map(
        F.lit("temp"), c("max_temp"), F.lit("rain"), c("rainfall"), F.lit("gust"), c("wind_gust_speed")
    )
    base = ctx.table("src_weather_raw").select("date", "city", F.explode(readings).alias("reading", "value"))
    return base.where(c("value").isNotNull())


@query("unit_conversion")
def _(ctx: Context):
    return rows(
        ctx, sunshine_h=w.hours(c("shortwave_radiation_sum") * 100), cloud_okta=w.okta(c("humidity_9am")),
        pressure_hpa=w.hectopascal(c("vpd_9am")), gust_kmh=w.kmh(c("wind_speed_9am")),
    )


@query("compass")
def _(ctx: Context):
    return rows(ctx, gust=w.compass(c("wind_speed_9am") * 11.25), morning=w.compass(c("wind_speed_100m_9am") * 7.5))


@query("bucketize")
def _(ctx: Context):
    p = c("rain_tomorrow_proba")
    edges = F.lit(0.0), F.lit(1.0), F.lit(10)
    return ctx.table("src_weather_predictions").select(
        "date", "city", (F.floor(p * 10) / 10.0).alias("bucket_low"), F.width_bucket(p, *edges).alias("bucket"),
        (p >= DEFAULTS.training.rain_threshold).alias("above_threshold"),
    )
