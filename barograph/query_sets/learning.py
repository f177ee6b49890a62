"""Model training and evaluation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barograph.functions.rows import attach_row
from barograph.functions.weather import weather_type
from barograph.operators import learning as l
from barograph.operators.features import feature_frame, labels_train_set
from barograph.queries import SETTINGS, Context, query
from barograph.sources.landing import stored

c = F.col
RULES = SETTINGS.training
BINARY = ("rain_tomorrow", "heatwave_risk", "frost_risk", "storm_label")


def frame(ctx: Context) -> DataFrame:
    """The feature frame as a table: training reads it once per tree level."""
    return ctx.once(
        "features",
        lambda: stored(feature_frame(ctx.table("src_weather_raw"), SETTINGS.labels, keep_last=True), "features"),
    )


def prepared(ctx: Context) -> tuple[DataFrame, l.Prepared]:
    """Binned training rows, stored once for all models."""
    return ctx.once("binned", lambda: l.prepare(l.target_mask(training_rows(ctx), RULES.targets), RULES))


def trained(ctx: Context, *targets: str) -> list[l.Trained]:
    """The models of some targets; a query fits only the targets it shows, several at a time."""
    new = [t for t in targets if not ctx.has(f"model-{t}")]
    for target, result in l.train_targets(*prepared(ctx), new, RULES).items():
        ctx.once(f"model-{target}", lambda result=result: result)
    return [ctx.once(f"model-{t}", lambda: None) for t in targets]


def training_rows(ctx: Context) -> DataFrame:
    return labels_train_set(frame(ctx))


def outcomes(ctx: Context) -> DataFrame:
    """Stored predictions next to what happened the day after."""
    return ctx.table("actuals_vs_predictions").where("has_actuals")


@query("target_mask", exact=True)
def _(ctx: Context):
    return l.target_mask(training_rows(ctx), RULES.targets).select("date", "city", *RULES.targets)


@query("class_weights")
def _(ctx: Context):
    parts = [
        l.class_weights(training_rows(ctx), t).withColumn("label", F.lit(t))
        for t in ("rain_tomorrow", "heatwave_risk", "frost_risk", "storm_label")
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("stratified_split")
def _(ctx: Context):
    split = l.stratified_split(training_rows(ctx), "rain_tomorrow", ["city", "date"])
    return split.select("date", "city", "rain_tomorrow", "is_test")


@query("binary_metrics")
def _(ctx: Context):
    rows = outcomes(ctx).where(c("pred_rain_proba").isNotNull())
    return l.binary_metrics(rows.withColumn("label", c("actual_rain").cast("int")), "label", "pred_rain_proba")


@query("multiclass_metrics")
def _(ctx: Context):
    rows = outcomes(ctx).withColumns(
        {
            "label": weather_type("actual_weather_code"),
            "said": F.coalesce("pred_weather_type_tomorrow", F.lit("Unknown")),
        }
    )
    return l.multiclass_metrics(rows, "label", "said")


@query("regression_metrics")
def _(ctx: Context):
    return l.regression_metrics(outcomes(ctx), "actual_max_temp", "pred_max_temp_tomorrow")


def fit_summary(ctx: Context, target: str) -> DataFrame:
    """What is certain of a fitted model: the rows it saw, and that it fits them better than a constant."""
    found = l.losses(trained(ctx, target)[0])
    return found.select(
        F.lit(target).alias("model"), "n_train", "n_test", (c("loss") < c("constant_loss")).alias("beats_constant")
    )


@query("train_binary")
def _(ctx: Context):
    parts = []
    for target, fitted in zip(BINARY, trained(ctx, *BINARY), strict=True):
        share = fitted.metrics.select("pos_rate")
        parts.append(attach_row(fit_summary(ctx, target), share))
    return reduce(DataFrame.unionByName, parts)


@query("train_regression")
def _(ctx: Context):
    return fit_summary(ctx, "max_temp_tomorrow")


@query("train_multiclass")
def _(ctx: Context):
    fitted = trained(ctx, "weather_type_tomorrow")[0]
    labels = fitted.model.labels
    return fit_summary(ctx, "weather_type_tomorrow").select(
        "*", F.lit(len(labels)).cast("long").alias("n_classes"), F.lit(",".join(labels)).alias("labels")
    )


@query("model_metrics")
def _(ctx: Context):
    """Every test metric of the six models, in long form."""
    parts = []
    for target, fitted in zip(RULES.targets, trained(ctx, *RULES.targets), strict=True):
        values = F.array(
            *[F.struct(F.lit(n).alias("metric"), c(n).cast("double").alias("value")) for n in fitted.metrics.columns]
        )
        parts.append(fitted.metrics.select(F.lit(target).alias("model"), F.inline(values)))
    return reduce(DataFrame.unionByName, parts)


def importances(ctx: Context) -> DataFrame:
    tops = [
        l.feature_importance_top20(fitted.model).select(F.lit(t).alias("target"), "*")
        for t, fitted in zip(BINARY, trained(ctx, *BINARY), strict=True)
    ]
    return reduce(DataFrame.unionByName, tops)


@query("feature_importances")
def _(ctx: Context):
    return importances(ctx)


@query("feature_importance_top20")
def _(ctx: Context):
    """What is certain of the lists: their lengths, names and order."""
    by = Window.partitionBy("target").orderBy(F.desc("importance"), "feature")
    ranked = importances(ctx).select(
        "target",
        F.row_number().over(by).alias("rank"),
        c("feature").isin(prepared(ctx)[1].columns).alias("configured"),
        F.coalesce(c("importance") <= F.lag("importance").over(by), F.lit(True)).alias("falling"),
        c("importance").between(0, 1).alias("is_share"),
    )
    return ranked


def predictions(ctx: Context) -> DataFrame:
    models = {t: x.model for t, x in zip(RULES.targets, trained(ctx, *RULES.targets), strict=True)}
    return l.score_predictions(frame(ctx), models, prepared(ctx)[1], RULES)


@query("predictions")
def _(ctx: Context):
    return predictions(ctx)


@query("score_predictions")
def _(ctx: Context):
    """What is certain of the predictions: their keys, and that the eleven columns agree."""
    labels = trained(ctx, "weather_type_tomorrow")[0].model.labels
    shares = [c(n).between(0, 1) for n in ("rain_tomorrow_proba", "heatwave_risk", "frost_risk", "storm_probability")]
    rain = (c("rain_tomorrow") == 1) == (c("rain_tomorrow_proba") >= RULES.rain_threshold)
    edge = F.abs(c("rain_tomorrow_proba") - RULES.rain_threshold) < 0.0001  # rounded across the threshold
    return predictions(ctx).select(
        "date",
        "city",
        "comfort_score",
        reduce(lambda a, b: a & b, shares).alias("shares"),
        (rain | edge).alias("rain_by_threshold"),
        c("weather_type_tomorrow").isin(labels).alias("known_type"),
        c("max_temp_tomorrow").isNotNull().alias("has_max_temp"),
        c("predicted_at").isNotNull().alias("stamped"),
    )
