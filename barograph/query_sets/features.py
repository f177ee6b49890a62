"""Features, labels and the matrices built from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from barograph.operators import features as f
from barograph.functions import weather as w
from barograph.sources.landing import stored
from barograph.queries import SETTINGS, Context, query

c = F.col


def raw(ctx: Context):
    return ctx.table("src_weather_raw")


def keyed(df, *columns):
    return df.select("date", "city", *columns)


def frame(ctx: Context, keep_last: bool = True):
    return f.feature_frame(raw(ctx), SETTINGS.labels, keep_last)


@query("features_calendar")
def _(ctx: Context):
    return keyed(f.features_calendar(raw(ctx)), "month", "day_of_year", "season")


@query("features_lag", exact=True)
def _(ctx: Context):
    return keyed(f.features_lag(raw(ctx)), *[f"{x}_lag{n}" for x in f.LAGGED for n in (1, 2)])


@query("features_rolling")
def _(ctx: Context):
    return keyed(f.features_rolling(raw(ctx)), *[f"{x}_rolling7" for x in f.ROLLED])


@query("features_derived")
def _(ctx: Context):
    return keyed(frame(ctx), "pressure_tendency", "temp_anomaly")


@query("features_hot_days")
def _(ctx: Context):
    return keyed(
        f.features_hot_days(raw(ctx)), "hot_day", "hot_day_lag1", "hot_day_lag2", "consec_hot_days"
    )


@query("features_rain_intensity")
def _(ctx: Context):
    return keyed(f.features_rain_intensity(raw(ctx)), "rainfall_intensity")


@query("comfort_score", exact=True)
def _(ctx: Context):
    return keyed(raw(ctx).withColumn("comfort_score", w.comfort_score()), "comfort_score")


@query("weather_type")
def _(ctx: Context):
    return keyed(raw(ctx).withColumn("weather_type", w.weather_type("weather_code")), "weather_type")


@query("labels", exact=True)
def _(ctx: Context):
    return keyed(f.labels(raw(ctx)), *SETTINGS.training.targets)


@query("labels_train_set", exact=True)
def _(ctx: Context):
    return keyed(f.labels_train_set(f.labels(raw(ctx))), *SETTINGS.training.targets)


@query("encode_categoricals")
def _(ctx: Context):
    base = f.features_calendar(raw(ctx)).withColumn("place", c("city"))
    columns = ["wind_gust_dir", "wind_dir_9am", "wind_dir_3pm", "city", "state", "season"]
    mappings = stored(f.category_codes(base, columns), "category-codes")  # once, not once per column
    encoded, _ = f.encode_categoricals(base, columns, mappings)
    return encoded.select("date", "place", *columns)


def training_frame(ctx: Context):
    """All 46 configured columns, categories as codes, under the key (place, date)."""
    rules = SETTINGS.training
    base = frame(ctx).withColumn("place", c("city"))
    mappings = ctx.once("category-codes", lambda: stored(f.category_codes(base, rules.categorical), "category-codes"))
    encoded, _ = f.encode_categoricals(base, rules.categorical, mappings)
    return encoded


@query("feature_matrix")
def _(ctx: Context):
    return f.feature_matrix(training_frame(ctx), keys=["place", "date"])


@query("align_features")
def _(ctx: Context):
    """The configured columns as a model expects them, whatever else the frame has; one the frame lacks is 0."""
    rules = SETTINGS.training
    lacking = training_frame(ctx).drop("vpd_9am")
    return f.align_features(lacking, [*rules.numerical, *rules.categorical, "added_after_training"], ["place", "date"])
