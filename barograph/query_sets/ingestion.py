"""Upserts, gaps and fetch plans."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from barograph.operators import ingest
from barograph.operators.sequence import asof_last
from barograph.queries import SETTINGS, Context, query
from barograph.sources.adapters import AS_OF

c = F.col
DAY = date(2001, 10, 15)
START, END = date(2001, 8, 1), date(2001, 10, 31)


def cities(ctx: Context):
    return ctx.given("nation").select(c("n_name").alias("city"))


def stored_half(ctx: Context):
    """What was stored before: rows of even days, with a later null in two columns."""
    raw = ctx.table("src_weather_raw")
    return raw.where(F.dayofmonth("date") % 2 == 0)


def refetched(ctx: Context):
    """What is fetched again: all rows, with readings the provider dropped, and twice on some days.

    ``load_order`` tells the two copies apart; the second one has no minimum.
    """
    raw = ctx.table("src_weather_raw")
    first = raw.withColumn("max_temp", F.when(F.dayofmonth("date") % 3 != 0, c("max_temp"))).withColumn(
        "load_order", F.lit(1)
    )
    second = (
        raw.where(F.dayofmonth("date") % 5 == 0)
        .withColumn("min_temp", F.lit(None).cast("double"))
        .withColumn("rainfall", c("rainfall") + 1)
        .withColumn("load_order", F.lit(2))
    )
    return first.unionByName(second)


@query("upsert_merge", exact=True)
def _(ctx: Context):
    return ingest.upsert_merge(stored_half(ctx), refetched(ctx), order_col="load_order")


@query("upsert_replace", exact=True)
def _(ctx: Context):
    return ingest.upsert_replace(stored_half(ctx), refetched(ctx), ["date", "city"], "load_order")


@query("upsert_ignore", exact=True)
def _(ctx: Context):
    return ingest.upsert_ignore(stored_half(ctx), refetched(ctx), ["date", "city"], "load_order")


@query("existing_cities")
def _(ctx: Context):
    return ingest.existing_cities(ctx.table("src_weather_raw"), DAY)


@query("complete_cities")
def _(ctx: Context):
    return ingest.complete_cities(ctx.table("src_weather_raw"), DAY)


@query("latest_complete_date")
def _(ctx: Context):
    return ingest.latest_complete_date(ctx.table("src_weather_raw"))


def gaps(ctx: Context):
    return ingest.find_gaps(ctx.table("src_weather_raw"), cities(ctx), START, END)


@query("find_gaps")
def _(ctx: Context):
    return gaps(ctx)


@query("gap_ranges")
def _(ctx: Context):
    return ingest.gap_ranges(gaps(ctx))


@query("daily_fetch_plan")
def _(ctx: Context):
    return ingest.daily_fetch_plan(ctx.table("src_weather_raw"), cities(ctx), DAY)


@query("backfill_plan")
def _(ctx: Context):
    return ingest.backfill_plan(ctx.table("src_weather_raw"), cities(ctx), START, DAY)


@query("repair_summary")
def _(ctx: Context):
    """Refetch every gap day of the first half of a month, merge it, and count what is left."""
    raw = ctx.table("src_weather_raw")
    before = gaps(ctx)
    required = SETTINGS.ingest.complete_when
    fetched = before.where(F.dayofmonth("date") <= 15).select(
        "date", "city", *[F.lit(50).cast(raw.schema[x].dataType).alias(x) for x in required]
    )
    repaired = ingest.upsert_merge(raw, fetched)
    return ingest.repair_summary(before, ingest.find_gaps(repaired, cities(ctx), START, END))


@query("daily_coverage_gate")
def _(ctx: Context):
    return ingest.daily_coverage_gate(ctx.table("src_weather_raw"), cities(ctx), DAY)


@query("missing_dates")
def _(ctx: Context):
    return ingest.missing_dates(ctx.table("src_weather_raw"), START, date(2001, 11, 30))


@query("null_rows_by_date")
def _(ctx: Context):
    critical = [*SETTINGS.ingest.critical, "not_a_column"]
    return ingest.null_rows_by_date(ctx.table("src_weather_raw"), critical, START, END)


@query("gap_report")
def _(ctx: Context):
    return ingest.gap_report(ctx.table("src_weather_raw"), AS_OF, SETTINGS.ingest)


@query("validate_sources")
def _(ctx: Context):
    tables = {n: ctx.table(f"src_{n}") for n in ("weather_raw", "weather_predictions", "drift_reports")}
    return ingest.validate_sources(ctx.table("src_monitoring_decisions"), tables, DAY)


@query("asof_last_retrain")
def _(ctx: Context):
    days = ctx.table("stg_weather_raw").select("date").distinct()
    return asof_last(days, ctx.table("stg_retrain_events"), "date", "retrain_date", "last_retrain_date")
