"""Writing results: CSV, Parquet, published horizons and the load audit."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barograph.config import DEFAULTS, IngestRules
from barograph.functions.rows import attach_row
from barograph.functions.numeric import finite
from barograph.operators.ingest import merge_into, upsert_replace
from barograph.sources.landing import write_table


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; the commit protocol shows either all files or none."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, date_col: str | None = None) -> None:
    """Parquet, in year/month folders when a date column is named. One pass writes all folders."""
    if date_col is None:
        df.write.mode("overwrite").parquet(path)
        return
    parts = df.withColumns({"year": F.year(date_col), "month": F.month(date_col)})
    (
        parts.hint("rebalance", "year", "month")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month")
        .parquet(path)
    )


def clean_numbers(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            finite(f.name).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def publish_horizon(
    raw: DataFrame, pred: DataFrame, as_of: date, rules: IngestRules = DEFAULTS.ingest
) -> tuple[DataFrame, DataFrame]:
    """The rows a serving store keeps: 180 days of observations, 90 of predictions, no NaN."""

    def last(df: DataFrame, days: int) -> DataFrame:
        return clean_numbers(df.where(F.col("date") >= F.date_sub(F.lit(as_of), days)))

    return last(raw, rules.publish_raw_days), last(pred, rules.publish_prediction_days)


def publish(spark: SparkSession, rows: DataFrame, path: str, keys: Sequence[str] = ("date", "city")) -> None:
    """Upsert whole rows by key into a published table in year folders; rows that it has and that are
    not published again stay. A first publication creates the table."""
    note = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not note.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(note):
        write_table(rows, path, "date")
        return
    ordered = rows.withColumn("_turn", F.monotonically_increasing_id())
    merge_into(spark, path, ordered, keys, merge=upsert_replace, order_col="_turn")


def append_audit(row: DataFrame, path: str) -> None:
    """Add an audit row to the table of all runs."""
    row.write.mode("append").parquet(path)


def load_run_audit(
    tables: dict[str, DataFrame],
    dag_id: str,
    data_date: date,
    loaded: dict[str, DataFrame],
    execution_date: date | None = None,
) -> DataFrame:
    """One audit row: row counts of ``tables`` and whether each of ``loaded`` has rows. The run is of
    ``execution_date``, by default the date of the data."""
    counts = [t.agg(F.count(F.lit(1)).alias(f"rows_{name}")) for name, t in tables.items()]
    flags = [t.agg((F.count(F.lit(1)) > 0).alias(f"{name}_loaded")) for name, t in loaded.items()]
    row = reduce(attach_row, counts + flags)
    return row.select(
        F.uuid().alias("run_id"),
        F.lit(dag_id).alias("dag_id"),
        F.lit(execution_date or data_date).alias("execution_date"),
        F.lit(data_date).alias("data_date"),
        "*",
        F.current_timestamp().alias("loaded_at"),
    )
