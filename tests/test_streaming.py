"""Streams over several micro-batches, with late rows."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from barograph.streaming import jobs

T0 = datetime(2026, 1, 1)


def stream_of(spark, tmp_path, batches, ddl):
    """One file per batch, read one file per micro-batch in the order written."""
    folder = tmp_path / "in"
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(str(folder / f"b{n:02d}"))
    schema = spark.createDataFrame([], ddl).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(folder))


def test_completeness_drops_late_rows(spark, tmp_path):
    def at(day, hour, city):
        return (T0 + timedelta(days=day, hours=hour), city)

    batches = [
        [at(0, 1, "a"), at(0, 2, "b"), at(0, 3, "a")],
        [at(1, 1, "a"), at(4, 0, "a")],
        [at(9, 0, "a")],
        # Chained aggregations judge lateness by the watermark of the batch before.
        [at(0, 5, "late"), at(9, 1, "b")],
    ]
    src = stream_of(spark, tmp_path, batches, "ts timestamp, city string")
    out = jobs.run_to_table(spark, jobs.stream_completeness(src, "city", "1 day", expected=2), "t-complete")
    got = {r["day"].day: (r["n_keys"], r["n_rows"], r["below_threshold"]) for r in out.collect()}
    assert got[1] == (2, 3, False)
    assert got[2] == (1, 1, True)
    assert all(day <= 5 for day in got)


def test_replayed_merge_is_harmless(spark, tmp_path, ctx):
    from barograph.operators.ingest import merge_into
    from barograph.sources.landing import write_table

    raw = ctx.table("src_weather_raw").where(F.year("date") == 1996)
    path = str(tmp_path / "stored")
    write_table(raw, path, "date")
    fresh = raw.where(F.dayofmonth("date") == 3).withColumn("rainfall", F.lit(9.0))
    merge_into(spark, path, fresh)
    once = spark.read.parquet(path).agg(F.count("*"), F.sum("rainfall")).first()
    merge_into(spark, path, fresh)
    assert spark.read.parquet(path).agg(F.count("*"), F.sum("rainfall")).first() == once


def test_a_table_is_a_file_or_a_folder(spark, folder, tmp_path):
    import pytest

    events = spark.read.parquet(f"{folder}/events.parquet")
    events.repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    counts = [
        jobs.run_to_table(spark, jobs.read_stream(spark, where, "events"), "t-read").count()
        for where in (folder, str(tmp_path))
    ]
    assert counts == [events.count()] * 2
    with pytest.raises(Exception, match="(?i)path"):
        jobs.read_stream(spark, str(tmp_path), "nothing")
