"""Streaming jobs, drained over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from barograph.queries import Context, query
from barograph.session import scratch_path
from barograph.sources.landing import conform, write_table
from barograph import schemas
from barograph.streaming import jobs, repair, stateful

c = F.col


def events(ctx: Context):
    return jobs.read_stream(ctx.spark, ctx.folder, "events")


@query("stream_completeness")
def _(ctx: Context):
    stream = jobs.stream_completeness(events(ctx), "user_id", "1 day", expected=100)
    return jobs.run_to_table(ctx.spark, stream, "stream-completeness")


@query("stream_rolling_metrics")
def _(ctx: Context):
    scored = events(ctx).withColumn("good", c("event_type") != "error")
    stream = jobs.stream_rolling_metrics(scored, "7 days", "1 day")
    return jobs.run_to_table(ctx.spark, stream, "stream-rolling")


@query("stream_sessions")
def _(ctx: Context):
    stream = jobs.stream_sessions(events(ctx), "user_id", "1 day")
    return jobs.run_to_table(ctx.spark, stream, "stream-sessions")


@query("stream_alert_dedup")
def _(ctx: Context):
    """All alerts that are sent, to the end of the table."""
    rows, end = jobs.with_end(events(ctx))
    stream = stateful.stream_alert_dedup(rows, "event_type", 24)
    return jobs.run_to_table(ctx.spark, stream, "stream-alerts", by_row=True, end=end)


@query("stream_retrain_cooldown")
def _(ctx: Context):
    """Every error is a retrain trigger of the model named by its user."""
    triggers = events(ctx).where("event_type = 'error'")
    stream = stateful.stream_retrain_cooldown(triggers, "user_id")
    return jobs.run_to_table(ctx.spark, stream, "stream-retrains", by_row=True)


@query("stream_outages")
def _(ctx: Context):
    stream = stateful.stream_outages(events(ctx), "user_id")
    return jobs.run_to_table(ctx.spark, stream, "stream-outages", by_row=True)


@query("stream_accuracy_windows")
def _(ctx: Context):
    scored = events(ctx).withColumns(
        {"model": c("user_id") % 25, "good": c("event_type") != "error", "value": c("value") / 20}
    )
    stream = stateful.stream_accuracy_windows(scored, "model")
    return jobs.run_to_table(ctx.spark, stream, "stream-accuracy", by_row=True)


@query("stream_late_repair")
def _(ctx: Context):
    """The events in three deliveries: the first half of the month, the second, and a tenth of all rows
    that was held back until then."""
    given = ctx.given("events").withColumn("ts", c("ts").cast("timestamp"))
    held = F.pmod(F.xxhash64("event_id"), F.lit(10)) == 0
    early = F.dayofmonth("ts") <= 15
    arriving = scratch_path(ctx.spark, "repair-arriving")
    for part in (early & ~held, ~early & ~held, held):
        given.where(part).coalesce(1).write.mode("append").parquet(arriving)
    source = ctx.spark.readStream.schema(given.schema).option("maxFilesPerTrigger", 1).parquet(arriving)
    return repair.stream_late_repair(source, "user_id", expected=100).counts().drop("repaired")


@query("stream_merge_upsert", exact=True)
def _(ctx: Context):
    """The stored observations, then a stream of refetched rows merged into them.

    The refetch is a folder of Parquet files derived from the stored rows: a third of its maxima
    are missing and must not replace stored ones; rain is corrected.
    """
    raw = ctx.table("src_weather_raw")
    target = scratch_path(ctx.spark, "merge-target")
    write_table(raw.where(F.dayofmonth("date") <= 20), target, "date")
    arriving = scratch_path(ctx.spark, "merge-arriving")
    (
        raw.where(F.dayofmonth("date") >= 10)
        .withColumn("max_temp", F.when(F.dayofmonth("date") % 3 != 0, c("max_temp")))
        .withColumn("rainfall", c("rainfall") + 0.5)
        .write.parquet(arriving)
    )
    source = ctx.spark.readStream.schema(raw.schema).parquet(arriving)
    jobs.stream_merge_upsert(source, target)
    return conform(ctx.spark.read.parquet(target), schemas.WEATHER_RAW)
