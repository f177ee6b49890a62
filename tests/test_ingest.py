"""Upserts, gaps and payloads."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from barograph import schemas
from barograph.operators import ingest as i
from barograph.sources import payloads
from barograph.sources.landing import write_table


def rows(spark, *given):
    full = [tuple(r.get(c) for c in schemas.RAW_COLUMNS) for r in given]
    return spark.createDataFrame(full, schemas.WEATHER_RAW)


DAY = date(2026, 3, 20)
FULL = {"date": DAY, "city": "A", "humidity_9am": 65.0, "humidity_3pm": 48.0, "pressure_9am": 1014.0,
        "pressure_3pm": 1011.0, "temp_9am": 18.0, "temp_3pm": 25.0, "weather_code": 1, "max_temp": 27.0}


def test_merge_keeps_stored_values(spark):
    again = FULL | {"humidity_9am": None, "humidity_3pm": None, "pressure_9am": None, "max_temp": 28.0}
    merged = i.upsert_merge(rows(spark, FULL), rows(spark, again, FULL | {"city": "B"})).orderBy("city").collect()
    assert len(merged) == 2
    assert (merged[0]["humidity_9am"], merged[0]["humidity_3pm"], merged[0]["pressure_9am"], merged[0]["max_temp"]) == (
        65.0, 48.0, 1014.0, 28.0,
    )


def test_merge_folds_a_batch_in_load_order(spark):
    old = rows(spark)
    batch = rows(spark, FULL, FULL | {"max_temp": None, "temp_9am": 1.0}).withColumn(
        "n", F.when(F.col("max_temp").isNull(), 2).otherwise(1)
    )
    row = i.upsert_merge(old, batch, order_col="n").first()
    assert (row["max_temp"], row["temp_9am"]) == (27.0, 1.0)


def test_replace_and_ignore(spark):
    old = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    new = spark.createDataFrame([(2, "first", 1), (2, "second", 2), (3, "only", 1), (3, "late", 2)], "k int, v string, n int")
    got = {r["k"]: r["v"] for r in i.upsert_replace(old, new, ["k"], "n").collect()}
    assert got == {1: "old", 2: "second", 3: "late"}
    got = {r["k"]: r["v"] for r in i.upsert_ignore(old, new, ["k"], "n").collect()}
    assert got == {1: "old", 2: "old", 3: "only"}


def test_merge_into_rewrites_only_touched_years(spark, tmp_path):
    path = str(tmp_path / "table")
    stored = rows(spark, FULL, FULL | {"date": date(2025, 1, 1)}, FULL | {"date": date(2024, 1, 1)})
    write_table(stored, path, "date")
    before = {p.name for p in (tmp_path / "table" / "year=2024").iterdir()}
    i.merge_into(spark, path, rows(spark, FULL | {"max_temp": 30.0, "temp_9am": None}, FULL | {"city": "Z"}))
    table = spark.read.parquet(path)
    assert table.count() == 4
    row = table.where((F.col("date") == DAY) & (F.col("city") == "A")).first()
    assert (row["max_temp"], row["temp_9am"]) == (30.0, 18.0)
    assert {p.name for p in (tmp_path / "table" / "year=2024").iterdir()} == before


def test_gaps_and_ranges(spark):
    raw = rows(spark, *[FULL | {"date": date(2026, 3, d)} for d in (18, 19, 22, 24)],
               FULL | {"date": date(2026, 3, 23), "weather_code": None})
    cities = spark.createDataFrame([("A",)], "city string")
    gaps = i.find_gaps(raw, cities, date(2026, 3, 18), date(2026, 3, 24))
    got = [tuple(r) for r in i.gap_ranges(gaps).orderBy("start_date").collect()]
    assert got == [("A", date(2026, 3, 20), date(2026, 3, 21), 2), ("A", date(2026, 3, 23), date(2026, 3, 23), 1)]


def test_backfill_plan(spark):
    cities = spark.createDataFrame([("A",), ("B",), ("C",)], "city string")
    raw = rows(spark, FULL, FULL | {"city": "B", "date": date(2026, 3, 31)})
    plan = {r["city"]: (r["start_date"], r["action"]) for r in i.backfill_plan(raw, cities, date(2026, 3, 1), date(2026, 3, 31)).collect()}
    assert plan == {"A": (date(2026, 3, 21), "fetch"), "B": (None, "skip"), "C": (date(2026, 3, 1), "fetch")}
    forced = i.backfill_plan(raw, cities, date(2026, 3, 1), date(2026, 3, 31), force=True)
    assert {r["start_date"] for r in forced.collect()} == {date(2026, 3, 1)}


def test_fetch_plan(spark):
    cities = spark.createDataFrame([("A",), ("B",), ("C",)], "city string")
    raw = rows(spark, FULL, FULL | {"city": "B", "weather_code": None})
    got = {r["city"]: r["status"] for r in i.daily_fetch_plan(raw, cities, DAY).collect()}
    assert got == {"B": "incomplete", "C": "missing"}


def test_failed_checks_raise(spark):
    decisions = spark.createDataFrame([(DAY,)], "date date")
    checks = i.validate_sources(decisions, {"raw": decisions}, date(2026, 3, 21))
    with pytest.raises(ValueError, match="decision_for_run_date"):
        i.require(checks)
    i.require(i.validate_sources(decisions, {"raw": decisions}, DAY))


def test_payload_hours(spark):
    hours = [float(h) for h in range(24)]
    payload = {
        "daily": {"time": ["2026-03-20", "2026-03-21"], "temperature_2m_min": [12.0, 13.0], "temperature_2m_max": [27.0, 28.0],
                  "precipitation_sum": [1.2, None], "sunshine_duration": [36000.0, None],
                  "winddirection_10m_dominant": [90.0, None], "weathercode": [61.0, 0.0]},
        "hourly": {"temperature_2m": hours, "dew_point_2m": [100 + h for h in hours], "surface_pressure": [900 + h for h in hours],
                   "vapour_pressure_deficit": [h / 10 for h in hours], "windspeed_100m": [5 + h for h in hours],
                   "cloudcover": [50.0] * 24, "winddirection_10m": [180.0] * 24},
    }
    df = spark.createDataFrame([("A", json.dumps(payload)), ("B", json.dumps({"daily": {"time": []}}))], "city string, payload string")
    places = spark.createDataFrame([("A", "S", -30.0, 140.0), ("B", "S", 0.0, 0.0)], "city string, state string, latitude double, longitude double")
    got = payloads.payload_parse(df, places, DAY, DAY).collect()
    assert len(got) == 1
    r = got[0]
    assert (r["temp_9am"], r["temp_3pm"], r["dew_point_9am"], r["dew_point_3pm"]) == (9.0, 15.0, 109.0, 115.0)
    assert (r["surface_pressure_9am"], r["vpd_3pm"], r["wind_speed_100m_9am"], r["wind_speed_100m_3pm"]) == (909.0, 1.5, 14.0, 20.0)
    assert (r["sunshine_hours"], r["cloud_9am"], r["wind_gust_dir"], r["wind_dir_3pm"], r["rain_today"]) == (10.0, 4.0, "E", "S", 1)
    later = payloads.payload_parse(df, places, date(2026, 3, 21), date(2026, 3, 21)).first()
    assert (later["temp_9am"], later["rain_today"], later["max_temp"]) == (None, 0, 28.0)


def test_date_keyed_payload(spark):
    parameter = {"T2M_MAX": {"20260320": 27.0, "20260321": -999.0}, "T2M_MIN": {"20260320": 12.0}, "PS": {"20260320": 101.3},
                 "RH2M": {"20260320": 55.0, "20260322": 1.0}, "WS10M_MAX": {"20260320": 10.0}}
    df = spark.createDataFrame([("A", json.dumps({"properties": {"parameter": parameter}}))], "city string, payload string")
    places = spark.createDataFrame([("A", "S", -30.0, 140.0)], "city string, state string, latitude double, longitude double")
    got = payloads.payload_parse_map(df, places, date(2026, 3, 1), date(2026, 3, 31)).orderBy("date").collect()
    assert len(got) == 2 and got[1]["max_temp"] is None
    assert (got[0]["pressure_9am"], got[0]["wind_gust_speed"], got[0]["humidity_3pm"]) == (pytest.approx(1013.0), 36.0, 55.0)


def test_merge_folds_without_an_order_and_ignores_nan(spark):
    stored = rows(spark, FULL)
    batch = rows(spark, FULL | {"max_temp": float("nan"), "temp_9am": 1.0}, FULL | {"max_temp": 31.0, "temp_9am": None}).coalesce(1)
    merged = i.upsert_merge(stored, batch).collect()
    assert [(r["max_temp"], r["temp_9am"]) for r in merged] == [(31.0, 1.0)]
    only_nan = i.upsert_merge(stored, rows(spark, FULL | {"max_temp": float("nan")})).first()
    assert only_nan["max_temp"] == 27.0


def test_merge_stopped_while_swapping_is_finished(spark, tmp_path):
    path, staging = str(tmp_path / "table"), str(tmp_path / "staging")
    kept, lost = FULL | {"date": date(2024, 1, 1)}, FULL | {"date": date(2025, 1, 1)}
    write_table(rows(spark, kept, lost), staging, "date")
    write_table(rows(spark, kept), path, "date")  # the swap had removed the other year and stopped
    note, files = i._note(spark, path)
    stream = files.create(note, True)
    stream.writeUTF(staging)
    stream.close()
    assert spark.read.parquet(path).count() == 1
    i.merge_into(spark, path, rows(spark, lost | {"max_temp": 33.0}))
    found = {r["date"].year: r["max_temp"] for r in spark.read.parquet(path).collect()}
    assert found == {2024: 27.0, 2025: 33.0} and not files.exists(note)
    assert not i.finish_merge(spark, path)


def test_publishing_keeps_older_rows(spark, tmp_path):
    from barograph.sources import sinks

    path = str(tmp_path / "published")
    old, again = FULL | {"date": date(2025, 12, 1)}, FULL | {"max_temp": 1.0}
    sinks.publish(spark, rows(spark, old, FULL), path)
    sinks.publish(spark, rows(spark, again, FULL | {"city": "B"}), path)
    found = {(r["date"], r["city"]): r["max_temp"] for r in spark.read.parquet(path).collect()}
    assert found == {(date(2025, 12, 1), "A"): 27.0, (DAY, "A"): 1.0, (DAY, "B"): 27.0}
