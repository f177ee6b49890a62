"""Scans, payloads and sinks."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from barograph import schemas
from barograph.operators import ingest
from barograph.operators.serving import weather_full
from barograph.plans.catalog import PUBLISHED, export_manifest
from barograph.queries import Context, query
from barograph.session import scratch_path
from barograph.sources import payloads, sinks
from barograph.sources.adapters import AS_OF
from barograph.sources.landing import conform

c = F.col
START, END = date(1995, 1, 1), date(2001, 12, 31)


@query("src_scan", exact=True)
def _(ctx: Context):
    return ctx.table("src_weather_raw")


@query("src_metrics_history", exact=True)
def _(ctx: Context):
    """JSON lines written by Spark and read back with a schema; the order column is in the record."""
    path = scratch_path(ctx.spark, "metrics-jsonl")
    ctx.table("src_model_metrics_history").write.json(path)
    return payloads.metrics_history(ctx.spark.read.text(path))


@query("drift_json_explode", exact=True)
def _(ctx: Context):
    stats = F.struct(c("feature_name"), F.struct("ks_stat", "p_value", "drifted"))
    documents = ctx.table("src_drift_reports").groupBy("date").agg(
        F.map_from_entries(F.collect_list(stats)).alias("features")
    )
    value = F.to_json(F.struct(c("date").cast("string").alias("date"), "features"))
    return payloads.drift_json_explode(documents.select(value.alias("value")))


@query("decision_json_row", exact=True)
def _(ctx: Context):
    """Documents that lack the low_accuracy key when no feature drifted."""
    rows = ctx.table("src_monitoring_decisions")
    document = F.struct(
        c("date").cast("string").alias("date"),
        "action",
        "reason",
        F.when(c("n_drifted") > 0, c("n_drifted")).alias("n_drifted"),
        F.from_json("drifted_features", "array<string>").alias("drifted_features"),
        F.when(c("n_drifted") > 0, c("low_accuracy")).alias("low_accuracy"),
        "high_mae",
        "heavy_drift",
        "mild_drift",
        "rain_accuracy_30d",
        "temp_mae_30d",
    )
    return payloads.decision_json_row(rows.select(F.to_json(document).alias("value")))


@query("csv_roundtrip", exact=True)
def _(ctx: Context):
    full = weather_full(ctx.table("src_weather_raw"), ctx.table("src_weather_predictions"))
    path = scratch_path(ctx.spark, "weather-full-csv")
    sinks.write_csv(full, path)
    return ctx.spark.read.schema(full.schema).option("header", True).csv(path)


@query("parquet_export")
def _(ctx: Context):
    path = scratch_path(ctx.spark, "mart")
    sinks.write_parquet(ctx.table("forecast_accuracy_monthly"), path)
    return ctx.spark.read.parquet(path)


@query("parquet_export_partitioned")
def _(ctx: Context):
    path = scratch_path(ctx.spark, "mart-by-month")
    sinks.write_parquet(ctx.table("forecast_vs_actual_daily"), path, "prediction_date")
    return ctx.spark.read.parquet(path).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("temp_abs_error").alias("sum_error")
    )


@query("publish_horizon", exact=True)
def _(ctx: Context):
    """Published thirty days earlier, with other maxima, and again: older rows stay as they were."""
    paths = [scratch_path(ctx.spark, f"published-{name}") for name in ("raw", "predictions")]
    tables = ctx.table("src_weather_raw"), ctx.table("src_weather_predictions")
    earlier = tables[0].withColumn("max_temp", c("max_temp") + 100), tables[1]
    for (raw, pred), as_of in ((earlier, AS_OF - timedelta(days=30)), (tables, AS_OF)):
        for rows, path in zip(sinks.publish_horizon(raw, pred, as_of), paths, strict=True):
            sinks.publish(ctx.spark, rows, path)
    raw, pred = (
        conform(ctx.spark.read.parquet(path), table.schema) for path, table in zip(paths, tables, strict=True)
    )
    return weather_full(raw, pred)


@query("load_run_audit")
def _(ctx: Context):
    path = scratch_path(ctx.spark, "load-audit")
    for day in (AS_OF - timedelta(days=1), AS_OF):
        row = sinks.load_run_audit(
            {n: ctx.table(f"src_{n}") for n in ("weather_raw", "weather_predictions")},
            "manual",
            AS_OF,
            {
                "monitoring_decision": ctx.table("src_monitoring_decisions"),
                "drift_report": ctx.table("src_drift_reports"),
                "retrain_event": ctx.table("src_retrain_events"),
            },
            day,
        )
        sinks.append_audit(row, path)
    row = ctx.spark.read.parquet(path)
    return row.drop("run_id", "loaded_at")


@query("export_manifest")
def _(ctx: Context):
    """Exported tables of each named export with their row counts."""
    parts = [
        ctx.table(PUBLISHED[t]).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(export).alias("export"), F.lit(t).alias("table"), "n_rows"
        )
        for export in ("daily_bi", "full_build")
        for t in export_manifest(export)
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _landed_payloads(ctx: Context):
    """One provider document per city and month, made from the stored rows."""
    raw = ctx.table("src_weather_raw").withColumn("_month", F.trunc("date", "MM"))
    day = F.struct(*schemas.RAW_COLUMNS)
    months = raw.groupBy("city", "_month").agg(F.sort_array(F.collect_list(day)).alias("days"))

    def daily(value):
        return F.transform("days", value)

    def hourly(morning, afternoon):
        def hours(d):
            at = [F.lit(None).cast("double")] * 24
            at[9], at[15] = morning(d), afternoon(d)
            return F.array(*at)

        return F.flatten(F.transform("days", hours))

    def field(name, factor=1.0):
        return lambda d: d[name] * factor

    d = payloads.DAILY
    daily_fields = [daily(lambda x: x["date"].cast("string")).alias("time")]
    for column, variable in d.items():
        source, factor = column, 1.0
        if column == "sunshine_hours":
            factor = 3600.0
        if column == "wind_gust_dir":
            source, factor = "wind_speed_9am", 11.25
        daily_fields.append(daily(field(source, factor)).alias(variable))
    hourly_fields = []
    for column, variable in payloads.HOURLY.items():
        source, factor = column, 1.0
        if column == "wind_dir":
            source, factor = "wind_speed_100m", 7.5
        if column == "cloud":
            factor = 12.5
        hourly_fields.append(
            hourly(field(f"{source}_9am", factor), field(f"{source}_3pm", factor)).alias(variable)
        )
    document = F.struct(
        F.struct(*daily_fields).alias("daily"), F.struct(*hourly_fields).alias("hourly")
    )
    options = {"ignoreNullFields": "false"}
    return months.select("city", F.to_json(document, options).alias("payload"))


@query("payload_parse", exact=True)
def _(ctx: Context):
    return payloads.payload_parse(_landed_payloads(ctx), ctx.table("dim_city"), START, END)


@query("payload_parse_map")
def _(ctx: Context):
    """Date-keyed documents per city and month; a missing reading is the sentinel -999."""
    raw = ctx.table("src_weather_raw").withColumn("_month", F.trunc("date", "MM"))
    key = F.date_format("date", "yyyyMMdd")
    parameters = {
        "T2M_MAX": c("max_temp"), "T2M_MIN": c("min_temp"), "PRECTOTCORR": c("rainfall"),
        "RH2M": c("humidity_3pm"), "PS": c("pressure_3pm") / 8, "WS10M_MAX": c("wind_speed_9am"),
        "WD10M": c("wind_speed_100m_9am") * 7.5,
    }
    months = raw.groupBy("city", "_month").agg(
        *[
            F.map_from_entries(
                F.collect_list(F.struct(key.alias("k"), F.coalesce(v, F.lit(-999.0)).alias("v")))
            ).alias(name)
            for name, v in parameters.items()
        ]
    )
    document = F.struct(F.struct(F.struct(*parameters).alias("parameter")).alias("properties"))
    rows = months.select("city", F.to_json(document.getField("properties")).alias("_p")).select(
        "city", F.concat(F.lit('{"properties":'), c("_p"), F.lit("}")).alias("payload")
    )
    return payloads.payload_parse_map(rows, ctx.table("dim_city"), START, END)


@query("schema_evolve", exact=True)
def _(ctx: Context):
    """An old table without the later columns, read under today's schema."""
    old = ctx.table("src_weather_raw").drop(
        "dew_point_9am", "dew_point_3pm", "vpd_9am", "vpd_3pm", "wind_speed_100m_9am",
        "wind_speed_100m_3pm", "shortwave_radiation_sum",
    )
    return ingest.schema_evolve(old)
