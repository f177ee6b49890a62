"""Upserts, gap detection and fetch plans."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph import schemas
from barograph.config import DEFAULTS, IngestRules
from barograph.functions.rows import attach_row
from barograph.functions.numeric import all_present, any_missing, count_if, finite
from barograph.operators.sequence import islands
from barograph.session import scratch_path
from barograph.sources.landing import conform

KEYS = ("date", "city")


def schema_evolve(df: DataFrame, schema=schemas.WEATHER_RAW) -> DataFrame:
    """Declared columns in declared order; a missing one is added as a typed null."""
    return conform(df, schema)


def upsert_merge(
    old: DataFrame, new: DataFrame, keys: Sequence[str] = KEYS, order_col: str | None = None
) -> DataFrame:
    """Merge-safe upsert: a null or NaN in the new row never replaces a stored value.

    Several new rows of one key are first folded by ``order_col``, or by their place in the new rows
    where none is given: per column the last value that is there, which is what merging them one by
    one gives. The fold and the join share one partitioning by key.
    """
    keys = list(keys)
    kinds = dict(new.dtypes)
    values = [c for c in old.columns if c not in keys and c in kinds]
    turn = F.monotonically_increasing_id() if order_col is None else F.col(order_col)
    rows = new.select(
        *keys,
        *[(finite(c) if kinds[c] in ("double", "float") else F.col(c)).alias(f"_new_{c}") for c in values],
        turn.alias("_turn"),
    )
    folded = [
        F.max_by(f"_new_{c}", F.when(F.col(f"_new_{c}").isNotNull(), F.col("_turn"))).alias(f"_new_{c}")
        for c in values
    ]
    fresh = rows.groupBy(*keys).agg(*folded) if folded else rows.select(*keys).distinct()
    joined = old.join(fresh, keys, "full_outer")
    return joined.select(
        *[F.coalesce(f"_new_{c}", c).alias(c) if c in values else F.col(c) for c in old.columns]
    )


def upsert_replace(old: DataFrame, new: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Last writer wins, whole rows. ``order_col`` orders the new rows; all of them beat old ones.

    ``max_by`` keeps one row per key on the map side, so no key is ever sorted.
    """
    keys = list(keys)
    row = F.struct(*old.columns)
    ranked = old.select(*old.columns, F.lit(0).alias("_load"), F.lit(0).cast("bigint").alias("_order"))
    later = new.select(
        *old.columns, F.lit(1).alias("_load"), F.col(order_col).cast("bigint").alias("_order")
    )
    return (
        ranked.unionByName(later)
        .groupBy(*keys)
        .agg(F.max_by(row, F.struct("_load", "_order")).alias("_row"))
        .select("_row.*")
    )


def upsert_ignore(
    old: DataFrame, new: DataFrame, keys: Sequence[str], order_col: str | None = None
) -> DataFrame:
    """First writer wins: only new keys are appended."""
    keys = list(keys)
    first = new.select(*old.columns).dropDuplicates(keys)
    if order_col is not None:
        first = (
            new.groupBy(*keys)
            .agg(F.min_by(F.struct(*old.columns), order_col).alias("_row"))
            .select("_row.*")
        )
    return old.unionByName(first.join(old.select(*keys), keys, "left_anti"))


def _note(spark: SparkSession, path: str):
    """The file that names a merge which is ready to be swapped in, and its file system."""
    note = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_merge")
    return note, note.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _swap(spark: SparkSession, path: str, staging: str) -> None:
    """Replace the years of a table that a staging table has."""
    (
        spark.read.parquet(staging)
        .hint("rebalance", "year")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year")
        .parquet(path)
    )


def finish_merge(spark: SparkSession, path: str) -> bool:
    """Finish a merge that was stopped while its years were swapped in; whether there was one."""
    note, files = _note(spark, path)
    if not files.exists(note):
        return False
    stream = files.open(note)
    staging = stream.readUTF()
    stream.close()
    _swap(spark, path, staging)
    files.delete(note, False)
    return True


def merge_into(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    keys: Sequence[str] = KEYS,
    merge: Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame] = upsert_merge,
    order_col: str | None = None,
) -> None:
    """Merge new rows into a table stored in year folders, rewriting only the years they touch.

    Spark cannot overwrite files it is reading, so the merged years go to a staging table in the
    shared folder first. A note beside the years then names the staging table, and goes once they are
    swapped in. A stop before the note leaves the table as it was; a stop after it is made good by
    the next merge, or by ``finish_merge``, from the staging table, however far the swap came.
    """
    finish_merge(spark, path)
    stored = spark.read.parquet(path)
    fresh = new.withColumn("year", F.year("date"))
    touched = stored.join(fresh.select("year").distinct(), "year", "left_semi")
    staging = scratch_path(spark, "merge")
    extra = {} if order_col is None else {"order_col": order_col}
    merged = merge(touched.drop("year"), new, keys, **extra)
    merged.withColumn("year", F.year("date")).write.parquet(staging)
    note, files = _note(spark, path)
    stream = files.create(note, False)  # of two merges at once the second fails here, before it changes anything
    stream.writeUTF(staging)
    stream.close()
    _swap(spark, path, staging)
    files.delete(note, False)


def existing_cities(df: DataFrame, day: date) -> DataFrame:
    return df.where(F.col("date") == F.lit(day)).select("city").distinct()


def complete_cities(
    raw: DataFrame, day: date, required: Sequence[str] = DEFAULTS.ingest.complete_when
) -> DataFrame:
    return existing_cities(raw.where(all_present(required)), day)


def latest_complete_date(
    raw: DataFrame, required: Sequence[str] = DEFAULTS.ingest.complete_when
) -> DataFrame:
    """Last complete day of every city; null for a city that never had one."""
    return raw.groupBy("city").agg(F.max(F.when(all_present(required), F.col("date"))).alias("latest"))


def days(spark_df: DataFrame, start: date, end: date) -> DataFrame:
    """Each row of the input with every day of an inclusive range."""
    span = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    return spark_df.withColumn("date", F.explode(span))


def _range(spark: SparkSession, start: date, end: date) -> DataFrame:
    return days(spark.range(1).select(), start, end)


def find_gaps(
    raw: DataFrame,
    cities: DataFrame,
    start: date,
    end: date,
    required: Sequence[str] = DEFAULTS.ingest.complete_when,
) -> DataFrame:
    """Missing or incomplete days of every expected city: an anti-join on (city, date)."""
    done = raw.where(
        all_present(required) & F.col("date").between(F.lit(start), F.lit(end))
    ).select("city", "date")
    return days(cities.select("city"), start, end).join(done, ["city", "date"], "left_anti")


def gap_ranges(gaps: DataFrame) -> DataFrame:
    """Contiguous ranges of gap days per city."""
    return islands(gaps, ["city"], "date")


def daily_fetch_plan(
    raw: DataFrame,
    cities: DataFrame,
    day: date,
    required: Sequence[str] = DEFAULTS.ingest.complete_when,
) -> DataFrame:
    """Cities still to fetch for a day, and why. No rows means the fetch is skipped."""
    seen = (
        raw.where(F.col("date") == F.lit(day))
        .groupBy("city")
        .agg(F.max(all_present(required)).alias("_complete"))
    )
    return (
        cities.select("city")
        .join(seen, "city", "left")
        .where(~F.coalesce("_complete", F.lit(False)))
        .select("city", F.when(F.col("_complete").isNull(), "missing").otherwise("incomplete").alias("status"))
    )


def backfill_plan(
    raw: DataFrame,
    cities: DataFrame,
    start: date,
    end: date,
    force: bool = False,
    required: Sequence[str] = DEFAULTS.ingest.complete_when,
) -> DataFrame:
    """Range to fetch per city: resume after its last complete day, skip it when up to date."""
    latest = F.lit(None).cast("date") if force else F.col("latest")
    resume = F.greatest(F.lit(start), F.date_add(latest, 1))
    skip = F.coalesce(latest >= F.lit(end), F.lit(False))
    return (
        cities.select("city")
        .join(latest_complete_date(raw, required), "city", "left")
        .select(
            "city",
            F.when(~skip, resume).alias("start_date"),
            F.when(~skip, F.lit(end)).alias("end_date"),
            F.when(skip, "skip").otherwise("fetch").alias("action"),
        )
    )


def repair_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """Gap days per city before and after a repair."""

    def per_city(gaps: DataFrame, name: str) -> DataFrame:
        return gaps.groupBy("city").agg(F.count(F.lit(1)).alias(name))

    return per_city(before, "initial").join(per_city(after, "remaining"), "city", "full_outer").fillna(
        0, subset=["initial", "remaining"]
    )


def daily_coverage_gate(
    raw: DataFrame, cities: DataFrame, day: date, min_cities: int = DEFAULTS.ingest.min_cities
) -> DataFrame:
    """One row: how many expected cities have data for the day, and whether that is enough."""
    present = cities.select("city").distinct().join(
        existing_cities(raw, day).withColumn("_seen", F.lit(True)), "city", "left"
    )
    n = count_if(F.col("_seen"))
    return present.agg(
        F.lit(day).alias("day"),
        n.alias("n_cities"),
        F.count(F.lit(1)).alias("expected"),
        (n >= min_cities).alias("passed"),
    )


def missing_dates(raw: DataFrame, start: date, end: date) -> DataFrame:
    seen = raw.where(F.col("date").between(F.lit(start), F.lit(end))).select("date").distinct()
    return _range(raw.sparkSession, start, end).join(seen, "date", "left_anti")


def null_rows_by_date(
    raw: DataFrame, critical: Sequence[str], start: date, end: date
) -> DataFrame:
    """Rows with a null in a critical column, per day. Columns the table lacks are left out."""
    known = [c for c in critical if c in raw.columns]
    if not known:
        return _range(raw.sparkSession, start, end).limit(0).withColumn(
            "null_row_count", F.lit(0).cast("bigint")
        )
    return (
        raw.where(F.col("date").between(F.lit(start), F.lit(end)) & any_missing(known))
        .groupBy("date")
        .agg(F.count(F.lit(1)).alias("null_row_count"))
    )


def gap_report(
    raw: DataFrame, as_of: date, rules: IngestRules = DEFAULTS.ingest
) -> DataFrame:
    """Bad days of the lookback with the reason, and the range that covers them all."""
    start, end = as_of - timedelta(days=rules.gap_lookback_days), as_of - timedelta(days=1)
    inside = raw.where(F.col("date").between(F.lit(start), F.lit(end)))
    coverage = inside.groupBy("date").agg(F.countDistinct("city").alias("n"))
    missing = missing_dates(raw, start, end).select(
        "date", F.lit("missing_date").alias("issue"), F.lit(0).cast("bigint").alias("n")
    )
    partial = coverage.where(F.col("n") < rules.min_cities).select(
        "date", F.lit("partial_coverage").alias("issue"), "n"
    )
    nulls = null_rows_by_date(raw, rules.critical, start, end).select(
        "date", F.lit("null_rows").alias("issue"), F.col("null_row_count").alias("n")
    )
    bad = missing.unionByName(partial).unionByName(nulls)
    span = bad.agg(F.min("date").alias("gap_start"), F.max("date").alias("gap_end"))
    return attach_row(bad, span)


def validate_sources(decisions: DataFrame, tables: dict[str, DataFrame], run_date: date) -> DataFrame:
    """Checks before a refresh: every input has rows, and a decision exists for the run date."""
    checks = [
        t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(f"{name}_not_empty").alias("check"), "n")
        for name, t in tables.items()
    ]
    checks.append(
        decisions.agg(count_if(F.col("date") == F.lit(run_date)).alias("n")).select(
            F.lit("decision_for_run_date").alias("check"), "n"
        )
    )
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out.withColumn("passed", F.col("n") > 0)


def require(checks: DataFrame) -> None:
    """Raise when a check failed. Collects the failed checks, one row per rule."""
    failed = [row["check"] for row in checks.where(~F.col("passed")).select("check").collect()]
    if failed:
        raise ValueError(f"failed checks: {', '.join(sorted(failed))}")
