"""Completeness per day with a repair loop for rows that come after their day was closed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barograph.session import scratch_path

c = F.col
PARTIAL = "day date, key string, n long, late boolean"
COUNTS = "day date, n_keys long, n_rows long, below_threshold boolean"


@dataclass(frozen=True)
class RepairLog:
    """The tables of one repaired stream. Each is written per micro-batch, into a folder of the batch that
    a replay overwrites, so a batch that is run twice counts once."""

    spark: SparkSession
    folder: str
    rows: T.StructType

    def _read(self, table: str, schema: T.StructType | str) -> DataFrame:
        fields = schema.fields if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema).fields
        with_batch = T.StructType([*fields, T.StructField("batch", T.LongType())])
        return self.spark.read.schema(with_batch).parquet(f"{self.folder}/{table}")

    def write(self, df: DataFrame, table: str, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.folder}/{table}/batch={batch}")

    def partials(self) -> DataFrame:
        """(day, key, n, late, batch): rows per day and key of each batch."""
        return self._read("partials", PARTIAL)

    def late(self) -> DataFrame:
        """Every row that came after its day was closed, with the batch it came in."""
        return self._read("late", self.rows)

    def changes(self) -> DataFrame:
        """(day, n_keys, n_rows, below_threshold, batch): a row per day and batch that closed or repaired it."""
        return self._read("counts", COUNTS)

    def counts(self) -> DataFrame:
        """(day, n_keys, n_rows, below_threshold, repaired): the last count of every closed day."""
        row = F.struct("n_keys", "n_rows", "below_threshold")
        latest = self.changes().groupBy("day").agg(
            F.max_by(row, "batch").alias("row"), (F.count(F.lit(1)) > 1).alias("repaired")
        )
        return latest.select("day", "row.*", "repaired")

    def retractions(self) -> DataFrame:
        """The counts that a later batch replaced."""
        last = self.changes().groupBy("day").agg(F.max("batch").alias("last"))
        return self.changes().join(last, "day").where(c("batch") < c("last")).drop("last")

    def watermark(self, before: int):
        """The watermark that the batches before this one reached; None before the first."""
        if not before:
            return None
        marks = self._read("marks", "at timestamp")
        return marks.where(c("batch") < before).agg(F.max("at")).first()[0]


def stream_late_repair(
    src: DataFrame, key: str, delay: str = "1 day", expected: int = 0
) -> RepairLog:
    """Drain a stream with an event time ``ts`` and count rows and distinct keys per day.

    A day is closed once the largest time seen, less ``delay``, has passed its end. Rows of days that
    earlier batches closed go to a side table, and the counts of those days are taken again, over
    all that was ever seen of them, and replace the old ones. Rows without a time or key are skipped.
    """
    spark = src.sparkSession
    rows = src.where(c("ts").isNotNull() & c(key).isNotNull())
    log = RepairLog(spark, scratch_path(spark, "repair"), rows.schema)

    def run(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        before = log.watermark(number)
        day = F.to_date("ts")
        closed = F.lit(False) if before is None else F.date_add(day, 1).cast("timestamp") <= F.lit(before)
        log.write(batch.where(closed), "late", number)
        partial = batch.groupBy(day.alias("day"), c(key).cast("string").alias("key")).agg(
            F.count(F.lit(1)).alias("n"), F.bool_or(closed).alias("late")
        )
        log.write(partial, "partials", number)
        reached = batch.agg((F.max("ts") - F.expr(f"INTERVAL {delay}")).alias("at")).where("at IS NOT NULL")
        if before is not None:
            reached = reached.select(F.greatest("at", F.lit(before)).alias("at"))
        log.write(reached, "marks", number)
        after = log.watermark(number + 1)
        if after is None:
            log.write(session.createDataFrame([], COUNTS), "counts", number)
            return
        # days that this batch closes or repairs; older days are not read again
        seen = log.partials().where(c("batch") <= number)
        oldest = log.partials().where((c("batch") == number) & c("late")).agg(F.min("day")).first()[0]
        if before is not None:
            since = min(x for x in (oldest, before.date()) if x is not None)
            seen = seen.where(c("day") >= F.lit(since))
        now_closed = F.date_add("day", 1).cast("timestamp") <= F.lit(after)
        was_open = F.lit(True) if before is None else F.date_add("day", 1).cast("timestamp") > F.lit(before)
        repaired = (c("batch") == number) & c("late")
        counts = (
            seen.where(now_closed)
            .groupBy("day", "key")
            .agg(F.sum("n").alias("n"), F.bool_or(was_open | repaired).alias("due"))
            .groupBy("day")
            .agg(F.count(F.lit(1)).alias("n_keys"), F.sum("n").alias("n_rows"), F.bool_or("due").alias("due"))
            .where("due")
            .select("day", "n_keys", "n_rows", (c("n_keys") < expected).alias("below_threshold"))
        )
        log.write(counts, "counts", number)

    query = (
        rows.writeStream.foreachBatch(run)
        .option("checkpointLocation", scratch_path(spark, "repair-state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return log
