"""Structured Streaming versions of the time-driven jobs.

Each function takes a streaming DataFrame with an event time ``ts`` (TIMESTAMP) and returns a
streaming DataFrame or starts a query. ``run_to_table`` drains what is there with availableNow and
gives the result as a table in the shared folder; state and checkpoints live there too, so a lost
executor or a restart resumes from them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.operators.ingest import KEYS, merge_into
from barograph.session import scratch_path

c = F.col


def read_stream(spark: SparkSession, folder: str, table: str, max_files: int = 256) -> DataFrame:
    """A stored table as a stream, its event time cast to TIMESTAMP. The table is one Parquet file or a
    folder of part files; a table that is not there is an error. A backlog is drained in micro-batches
    of ``max_files``, which bounds what a stateful function sees of one key at once."""
    path = f"{folder}/{table}.parquet"
    schema = spark.read.parquet(path).schema
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if files.getFileStatus(hadoop).isDirectory():
        rows = reader.parquet(path)
    else:
        rows = reader.option("pathGlobFilter", f"{table}.parquet").parquet(folder)
    return rows.withColumn("ts", c("ts").cast("timestamp")) if "ts" in rows.columns else rows


#: Seconds of the year 9999, a time beyond all rows.
END = 253_370_764_800


def with_end(src: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
    """The rows of a bounded stream, and a function that ends it: a last row, of nulls and a time beyond all
    others, comes through a second source and moves the watermark past every row. What waits for the
    watermark is decided then; the last row itself waits for ever."""
    spark = src.sparkSession
    folder = scratch_path(spark, "stream-end")
    spark.createDataFrame([], src.schema).write.parquet(folder)

    def end() -> None:
        values = [
            (F.timestamp_seconds(F.lit(END)) if field.name == "ts" else F.lit(None)).cast(field.dataType).alias(field.name)
            for field in src.schema
        ]
        spark.range(1).select(*values).write.mode("append").parquet(folder)

    return src.unionByName(spark.readStream.schema(src.schema).parquet(folder)), end


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def row_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state on disk, entry by entry, as stateful processors need."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(STATE_STORE) if before is None else spark.conf.set(STATE_STORE, before)


def run_to_table(
    spark: SparkSession,
    stream: DataFrame,
    label: str,
    mode: str = "append",
    by_row: bool = False,
    end: Callable[[], None] | None = None,
) -> DataFrame:
    """Drain the stream into Parquet in the shared folder and read it back. ``by_row`` is for streams with
    stateful processors; ``end`` (of :func:`with_end`) ends the stream once it is drained."""
    out = scratch_path(spark, label)
    writer = (
        stream.writeStream.outputMode(mode)
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", scratch_path(spark, f"{label}-state"))
        .trigger(availableNow=True)
    )

    def drain() -> None:
        if by_row:
            with row_state(spark):
                query = writer.start()
                query.awaitTermination()
        else:
            query = writer.start()
            query.awaitTermination()

    drain()
    if end is not None:
        end()
        drain()  # the same query goes on from its checkpoint
    return spark.read.schema(stream.schema).parquet(out)


def stream_merge_upsert(
    src: DataFrame, target_path: str, keys: Sequence[str] = KEYS, order_col: str | None = None
) -> None:
    """Merge-safe ingestion: every micro-batch rewrites only the years it touches.

    Rows of one key in a batch are folded, by ``order_col`` if there is one. Merging a batch twice
    gives the same table, and ``merge_into`` first finishes a merge that was stopped, so a batch that
    is replayed after a failure is harmless.
    """
    spark = src.sparkSession

    def merge(batch: DataFrame, _: int) -> None:
        merge_into(batch.sparkSession, target_path, batch, keys, order_col=order_col)

    query = (
        src.writeStream.foreachBatch(merge)
        .option("checkpointLocation", scratch_path(spark, "merge-state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_completeness(src: DataFrame, key: str, watermark: str = "1 day", expected: int = 0) -> DataFrame:
    """Distinct keys per closed day. Rows behind the watermark are dropped.

    Two chained aggregations: the first keeps one state row per (day, key), the second counts them,
    so no state row ever holds a set of keys.
    """
    per_key = (
        src.withWatermark("ts", watermark)
        .groupBy(F.window("ts", "1 day").alias("day"), c(key))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return (
        per_key.groupBy(F.window(c("day"), "1 day").alias("w"))
        .agg(F.count(F.lit(1)).alias("n_keys"), F.sum("_n").alias("n_rows"))
        .select(
            F.to_date("w.start").alias("day"),
            "n_keys",
            "n_rows",
            (c("n_keys") < expected).alias("below_threshold"),
        )
    )


def stream_rolling_metrics(
    src: DataFrame, length: str = "7 days", slide: str = "1 day", watermark: str = "1 day"
) -> DataFrame:
    """Mean of ``value`` and share of good rows over sliding windows."""
    return (
        src.withWatermark("ts", watermark)
        .groupBy(F.window("ts", length, slide).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(F.col("good").cast("double")).alias("accuracy"),
            F.avg("value").alias("mean_error"),
        )
        .select(c("w.start").alias("window_start"), c("w.end").alias("window_end"), "n", "accuracy", "mean_error")
    )


def stream_sessions(src: DataFrame, key: str, gap: str = "1 day", watermark: str = "1 day") -> DataFrame:
    """Runs of presence per key; the outages are the spaces between two sessions."""
    return (
        src.withWatermark("ts", watermark)
        .groupBy(F.session_window("ts", gap).alias("s"), c(key))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(key, c("s.start").alias("session_start"), c("s.end").alias("session_end"), "n")
    )
