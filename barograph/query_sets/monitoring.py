"""Drift, metrics and decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from barograph.operators import monitoring as m
from barograph.operators.sequence import neighbour
from barograph.queries import SETTINGS, Context, query
from barograph.sources.adapters import AS_OF

c = F.col
RULES = SETTINGS.monitoring


def weather(ctx: Context):
    return ctx.table("src_weather_raw"), ctx.table("src_weather_predictions")


@query("stale_predictions")
def _(ctx: Context):
    return m.stale_predictions(*weather(ctx))


@query("ks_drift")
def _(ctx: Context):
    return m.ks_drift(ctx.table("src_weather_raw"), AS_OF)


def run_dates(ctx: Context):
    """The 1st, 11th, 21st and 31st of the recorded run dates, and today."""
    recorded = ctx.table("stg_monitoring_decisions").where(F.dayofmonth("date") % 10 == 1).select("date")
    return recorded.unionByName(recorded.agg(F.lit(AS_OF).alias("date"))).distinct()


@query("ks_drift_history")
def _(ctx: Context):
    return m.ks_drift_history(ctx.table("src_weather_raw"), run_dates(ctx))


@query("monitoring_run")
def _(ctx: Context):
    """Metrics, drift, cooldown and decision as each run date saw them."""
    decisions = m.monitoring_run(*weather(ctx), ctx.table("stg_retrain_events"), run_dates(ctx))
    return decisions.withColumns(
        {"reason": c("reason_text"), "drifted_features": F.array_join("drifted_features", ",")}
    )


@query("drift_window_completeness")
def _(ctx: Context):
    return m.drift_window_completeness(ctx.table("src_weather_raw"), AS_OF, 25)


@query("verifiable_metrics")
def _(ctx: Context):
    return m.verifiable_metrics(*weather(ctx), AS_OF)


@query("prediction_coverage_gap")
def _(ctx: Context):
    return m.prediction_coverage_gap(*weather(ctx), AS_OF)


@query("monitoring_decision")
def _(ctx: Context):
    decisions = m.monitoring_decision(
        ctx.table("stg_model_metrics_history"), ctx.table("stg_drift_reports"), ctx.table("stg_retrain_events")
    )
    return decisions.withColumns(
        {"reason": c("reason_text"), "drifted_features": F.array_join("drifted_features", ",")}
    )


@query("retrain_cooldown")
def _(ctx: Context):
    return m.retrain_cooldown(ctx.table("stg_retrain_events"), ctx.table("stg_monitoring_decisions").select("date"))


@query("metrics_history_append")
def _(ctx: Context):
    snapshot = m.verifiable_metrics(*weather(ctx), AS_OF)
    return m.metrics_history_append(ctx.table("src_model_metrics_history"), snapshot)


def metric_pairs(ctx: Context):
    """Each recorded run against the run before it."""
    history = ctx.table("stg_model_metrics_history")
    names = {"rain_accuracy_30d": "old_rain_accuracy", "temp_mae_30d": "old_temp_mae"}
    return neighbour(history, [], "date", names, ahead=False).select(
        "date",
        *names.values(),
        c("rain_accuracy_30d").alias("new_rain_accuracy"),
        c("temp_mae_30d").alias("new_temp_mae"),
    )


@query("baseline_gate")
def _(ctx: Context):
    gate = m.baseline_gate(metric_pairs(ctx))
    return gate.withColumn("issues", F.array_join("issues", " | "))


@query("baseline_delta")
def _(ctx: Context):
    """The metrics of the last recorded run against those of the first one."""
    history = ctx.table("stg_model_metrics_history")
    metrics = F.array(
        *[F.struct(F.lit(n).alias("metric"), c(n).alias("value")) for n in ("rain_accuracy_30d", "temp_mae_30d")]
    )

    def run(pick):
        return history.agg(pick(metrics, c("date")).alias("p")).select(F.inline("p"))

    return m.baseline_delta(run(F.min_by), run(F.max_by))


@query("alert_dedup")
def _(ctx: Context):
    alerts = ctx.given("events").select(c("event_type").alias("alert_key"), "ts")
    return m.alert_dedup(alerts)
