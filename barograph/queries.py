"""Every operator as a named query over the given tables: name -> f(spark, folder)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barograph.config import DEFAULTS
from barograph.functions.numeric import round_half_up
from barograph.plans.catalog import MODELS, Catalog
from barograph.session import scratch_path
from barograph.sources.adapters import AS_OF
from barograph.sources.landing import given, landed

Query = Callable[[SparkSession, str], DataFrame]
DIGITS = 9
SETTINGS = replace(DEFAULTS, horizon=replace(DEFAULTS.horizon, min_date=date(1995, 1, 1)))

QUERIES: dict[str, Query] = {}
_contexts: dict[tuple[str, str], "Context"] = {}


class Context:
    """The catalog and the given tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._results: dict[str, object] = {}
        self.catalog = Catalog(
            spark,
            lambda name: landed(spark, folder, name),
            AS_OF,
            SETTINGS,
            store=lambda name: scratch_path(spark, name),
        )

    def table(self, name: str) -> DataFrame:
        return self.catalog.table(name)

    def once(self, name: str, build: Callable[[], object]):
        """A result shared by several queries, such as trained models."""
        if name not in self._results:
            self._results[name] = build()
        return self._results[name]

    def has(self, name: str) -> bool:
        return name in self._results

    def given(self, name: str) -> DataFrame:
        return given(self.spark, self.folder, name)


def context(spark: SparkSession, folder: str) -> Context:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _contexts:
        _contexts[key] = Context(spark, folder)
    return _contexts[key]


def presented(df: DataFrame) -> DataFrame:
    """Doubles to nine digits, so that the order of partial sums does not show."""
    return df.select(
        *[
            round_half_up(f.name, DIGITS).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def query(
    name: str, exact: bool = False
) -> Callable[[Callable[[Context], DataFrame]], Callable[[Context], DataFrame]]:
    """Register a function of a Context as a query. ``exact`` results hold stored or integer values
    only, whose digits cannot depend on the order of sums, and are returned as they are."""

    def register(build: Callable[[Context], DataFrame]) -> Callable[[Context], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        finish = (lambda df: df) if exact else presented
        QUERIES[name] = lambda spark, folder: finish(build(context(spark, folder)))
        return build

    return register


# Models whose columns are stored values, whole numbers, labels, or already rounded.
EXACT_MODELS = {
    "stg_weather_raw", "stg_weather_predictions", "stg_model_metrics_history",
    "stg_monitoring_decisions", "stg_drift_reports", "stg_retrain_events", "dim_alert_type",
    "dim_weather_code", "dim_cities", "dim_city", "dim_date", "dim_weather_type", "weather_final",
    "actuals_vs_predictions", "completeness_daily", "extreme_events_actual", "daily_clean",
    "current_snapshot", "weather_extremes", "forecast_vs_actual_daily", "location_cities",
    "data_quality_daily", "bi_current_snapshot", "bi_extremes",
}
for _name in MODELS:
    query(_name, exact=_name in EXACT_MODELS)(lambda ctx, _name=_name: ctx.table(_name))


def all_queries() -> dict[str, Query]:
    from barograph.query_sets import (  # noqa: F401
        business, exploration, features, ingestion, learning, monitoring, scalars, sources, streams,
    )

    return dict(QUERIES)
