"""Reading the given tables and landing the weather tables built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph import schemas
from barograph.session import scratch_path
from barograph.sources import adapters

# (application, folder) -> landed path of each source table
_landed: dict[tuple[str, str], dict[str, str]] = {}

LAYOUT = {
    "src_weather_raw": ("date", schemas.WEATHER_RAW),
    "src_weather_predictions": ("date", schemas.WEATHER_PREDICTIONS),
    "src_drift_reports": (None, schemas.DRIFT_REPORTS),
    "src_monitoring_decisions": (None, schemas.MONITORING_DECISIONS),
    "src_model_metrics_history": (None, schemas.METRICS_HISTORY),
    "src_retrain_events": (None, schemas.RETRAIN_EVENTS),
}


def given(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def adapt(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The lazy adapter query of one source table."""
    tables = {t: given(spark, folder, t) for t in adapters.TABLES if "{" + t + "}" in adapters.SOURCES[name]}
    return spark.sql(adapters.SOURCES[name], **tables)


def conform(df: DataFrame, schema) -> DataFrame:
    """Cast to a declared schema; a column that is not there yet is added as null."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def write_table(df: DataFrame, path: str, date_column: str | None = None) -> None:
    """Full refresh of a stored table, one folder per year when it has a date.

    The rebalance hint lets adaptive execution split a year that holds most of the rows and merge
    small ones; sorting by date gives tight row-group statistics for date filters.
    """
    if date_column is None:
        df.write.mode("overwrite").parquet(path)
        return
    (
        df.withColumn("year", F.year(date_column))
        .hint("rebalance", "year")
        .sortWithinPartitions("year", date_column)
        .write.mode("overwrite")
        .partitionBy("year")
        .parquet(path)
    )


def land(spark: SparkSession, folder: str, name: str) -> str:
    """Write one source table to the shared folder, once per application; return its path."""
    done = _landed.setdefault((spark.sparkContext.applicationId, folder), {})
    if name not in done:
        date_column, schema = LAYOUT[name]
        path = scratch_path(spark, name)
        write_table(conform(adapt(spark, folder, name), schema), path, date_column)
        done[name] = path
    return done[name]


def landed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A source table as stored: explicit schema, no inference, columns in declared order."""
    _, schema = LAYOUT[name]
    path = land(spark, folder, name)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def stored(df: DataFrame, label: str) -> DataFrame:
    """The same rows as a table in the shared folder: cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
