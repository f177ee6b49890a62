"""The chunked operators against plain windows, on skewed keys and tiny blocks."""

import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barograph.operators import sequence as q
from barograph.operators.quantiles import exact_quantiles, melt


@pytest.fixture(scope="module")
def skewed(spark):
    """One city with most of the rows, gaps, a city with a single row, and missing values."""
    rng = random.Random(7)
    rows = []
    for city, days in (("hot", 900), ("thin", 60), ("one", 1)):
        day = date(1999, 11, 20)
        for _ in range(days):
            day += timedelta(days=rng.choice([1, 1, 1, 2, 5, 40]) if city != "hot" else rng.choice([1, 1, 2]))
            rows.append((city, day, rng.choice([None, float(rng.randint(0, 50))])))
    return spark.createDataFrame(rows, "city string, date date, x double").cache()


def as_set(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_row_numbers(skewed):
    plain = skewed.withColumn("_seq", F.row_number().over(Window.partitionBy("city").orderBy("date")) - 1)
    assert as_set(q.number_rows(skewed, ["city"], "date"), "city", "date", "_seq") == as_set(
        plain, "city", "date", "_seq"
    )


@pytest.mark.parametrize("block", [8, 64, 4096])
def test_frames_across_blocks(skewed, block):
    by_city = Window.partitionBy("city").orderBy("date")
    wanted = skewed.withColumns(
        {
            "mean": F.avg("x").over(by_city.rowsBetween(-7, 0)),
            "lag2": F.lag("x", 2).over(by_city),
            "lead1": F.lead("x").over(by_city),
        }
    )
    blocks, window = q.row_blocks(skewed, ["city"], "date", before=7, after=1, block_rows=block)
    got = q.drop_halo(
        blocks.withColumns(
            {
                "mean": F.avg("x").over(window.rowsBetween(-7, 0)),
                "lag2": F.lag("x", 2).over(window),
                "lead1": F.lead("x").over(window),
            }
        )
    )
    columns = ["city", "date", "mean", "lag2", "lead1"]
    assert as_set(got, *columns) == as_set(wanted, *columns)


def test_block_size_bounds_a_task(skewed):
    blocks, _ = q.row_blocks(skewed, ["city"], "date", before=7, after=1, block_rows=64)
    largest = blocks.groupBy("city", "_block").count().agg(F.max("count")).first()[0]
    assert largest <= 64 + 7 + 1


def test_halo_longer_than_block_is_refused(skewed):
    with pytest.raises(ValueError):
        q.row_blocks(skewed, ["city"], "date", before=9, block_rows=8)


@pytest.mark.parametrize("ahead", [True, False])
def test_neighbour(skewed, ahead):
    shift = F.lead if ahead else F.lag
    by_city = Window.partitionBy("city").orderBy("date")
    wanted = skewed.withColumns({"n": shift("date").over(by_city), "v": shift("x").over(by_city)})
    got = q.neighbour(skewed, ["city"], "date", {"date": "n", "x": "v"}, ahead=ahead)
    assert as_set(got, "city", "date", "n", "v") == as_set(wanted, "city", "date", "n", "v")


def test_running_total(skewed):
    known = skewed.where("x is not null").groupBy("city", "x").count()
    wanted = known.withColumn("upto", F.sum("count").over(Window.partitionBy("city").orderBy("x")))
    got = q.running_total(known, ["city"], "x", {"count": "upto"}, F.floor(F.col("x") / 5))
    assert as_set(got, "city", "x", "upto") == as_set(wanted, "city", "x", "upto")


def test_rank_with_ties_and_nulls(skewed):
    wanted = skewed.withColumn("r", F.rank().over(Window.partitionBy("city").orderBy(F.desc_nulls_last("x"))))
    got = q.rank_by_value(skewed, ["city"], "x", "r")
    assert as_set(got, "city", "date", "r") == as_set(wanted, "city", "date", "r")


def test_asof_same_day_and_before_first(spark):
    days = spark.createDataFrame([(date(2001, m, d),) for m in range(1, 13) for d in (1, 10, 28)], "date date")
    events = [date(2001, 3, 10), date(2001, 3, 28), date(2001, 9, 15)]
    marks = spark.createDataFrame([(e,) for e in events], "event date")
    got = {r["date"]: r["last"] for r in q.asof_last(days, marks, "date", "event", "last").collect()}
    assert len(got) == 36
    for day, last in got.items():
        assert last == max((e for e in events if e <= day), default=None)


def test_islands(spark):
    days = [date(2026, 3, d) for d in (20, 21, 23)] + [date(2025, 12, 31), date(2026, 1, 1)]
    df = spark.createDataFrame([("a", d) for d in days], "city string, date date")
    got = [(r["start_date"], r["end_date"], r["gap_days"]) for r in q.islands(df, ["city"], "date").collect()]
    assert sorted(got) == [
        (date(2025, 12, 31), date(2026, 1, 1), 2),
        (date(2026, 3, 20), date(2026, 3, 21), 2),
        (date(2026, 3, 23), date(2026, 3, 23), 1),
    ]


def test_exact_quantiles_with_heavy_values(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([np.full(500, 4.0), rng.normal(size=301), rng.integers(0, 9, 100) / 4.0])
    df = spark.createDataFrame([(float(v), None if i % 7 else float(i)) for i, v in enumerate(values)], "a double, b double")
    probs = [0.0, 0.05, 0.5, 0.9, 1.0]
    got = {(r["feature"], r["prob"]): r["quantile"] for r in exact_quantiles(melt(df, ["a", "b"]), ["feature"], probs).collect()}
    b = [float(i) for i in range(len(values)) if i % 7 == 0]
    for p in probs:
        assert got["a", p] == pytest.approx(np.quantile(values, p), abs=1e-12)
        assert got["b", p] == pytest.approx(np.quantile(b, p), abs=1e-9)


def test_quantile_of_one_value(spark):
    df = spark.createDataFrame([(2.5,)], "a double")
    assert [r["quantile"] for r in exact_quantiles(melt(df, ["a"]), ["feature"], [0.3]).collect()] == [2.5]


def test_codes_of_values_with_a_common_prefix(spark):
    from barograph.operators.features import category_codes

    names = [f"COMMON_PREFIX_{i:04d}" for i in range(900)]
    rows = spark.createDataFrame([(n, "x" if i % 2 else None) for i, n in enumerate(names)], "a string, b string")
    codes = {(r["column"], r["value"]): r["code"] for r in category_codes(rows, ["a", "b"]).collect()}
    assert codes == {("a", n): i for i, n in enumerate(names)} | {("b", "x"): 0}


def test_one_outlier_does_not_fill_a_bucket(spark):
    from barograph.operators.quantiles import exact_quantiles, value_buckets

    rows = spark.range(20_000).select(F.lit("f").alias("feature"), F.col("id").cast("double").alias("value"))
    rows = rows.unionByName(spark.createDataFrame([("f", 1e9)], "feature string, value double"))
    largest = value_buckets(rows, ["feature"]).groupBy("_slot").count().agg(F.max("count")).first()[0]
    assert largest <= 2_000
    got = {r["prob"]: r["quantile"] for r in exact_quantiles(rows, ["feature"], [0.0, 0.5, 1.0]).collect()}
    assert got == {0.0: 0.0, 0.5: 10_000.0, 1.0: 1e9}
