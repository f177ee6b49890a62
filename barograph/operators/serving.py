"""The read queries of the serving layer as functions; no server."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph import schemas
from barograph.operators.measures import sliced
from barograph.plans.catalog import PUBLISHED, Catalog
from barograph.sources.sinks import clean_numbers


def weather_full(raw: DataFrame, pred: DataFrame) -> DataFrame:
    """Stored observations with the stored prediction of the same day."""
    return raw.join(pred, ["date", "city"], "left").select(
        *schemas.RAW_COLUMNS, *schemas.PREDICTION_COLUMNS[2:]
    )


def api_weather(
    full: DataFrame,
    city: str | None = None,
    start: date | None = None,
    end: date | None = None,
    limit: int = 50_000,
) -> DataFrame:
    """History, newest first. Order and limit become one top-k per task."""
    return sliced(full, "date", city, start, end).orderBy(F.desc("date"), "city").limit(limit)


def api_latest(full: DataFrame, city: str | None = None) -> DataFrame:
    """The last row of every city that has a prediction."""
    predicted = sliced(full, "date", city).where(F.col("predicted_at").isNotNull())
    return (
        predicted.groupBy("city")
        .agg(F.max_by(F.struct(*full.columns), "date").alias("r"))
        .select("r.*")
    )


def api_predictions(
    pred: DataFrame, city: str | None = None, start: date | None = None, end: date | None = None
) -> DataFrame:
    rows = sliced(pred, "date", city, start, end).select(*schemas.PREDICTION_COLUMNS)
    return rows.orderBy(F.desc("date"), "city")


# Client names that differ from the published table name without its prefix.
SLUGS = {
    "bi-homepage-kpis": "bi_powerbi_homepage_kpis",
    "forecast-timeline": "mart_forecast_vs_actual_timeline",
    "health": "mart_mlops_health",
    "performance-by-city": "mart_model_performance_by_city",
    "performance-overview": "mart_model_performance_overview",
}


def slugs() -> dict[str, str]:
    """Client name of every published mart."""
    named = dict(SLUGS)
    for table in PUBLISHED:
        if table not in SLUGS.values():
            named[table.removeprefix("mart_").replace("_", "-")] = table
    return named


def api_mart(slug: str, catalog: Catalog) -> DataFrame:
    known = slugs()
    if slug not in known:
        raise KeyError(f"unknown mart {slug!r}; available: {sorted(known)}")
    return catalog.table(known[slug])


def json_records(df: DataFrame) -> DataFrame:
    """Each row as JSON text: ISO dates, null for NaN and infinities, no field left out."""
    fields = F.struct(*df.columns)
    return clean_numbers(df).select(
        F.to_json(fields, {"ignoreNullFields": "false", "dateFormat": "yyyy-MM-dd"}).alias("value")
    )


def city_list(dim_city: DataFrame) -> DataFrame:
    return dim_city.select(
        "city", "state", F.col("latitude").alias("lat"), F.col("longitude").alias("lon")
    )


def last_update(raw: DataFrame) -> DataFrame:
    return raw.agg(F.max("date").alias("last_data_update"))
