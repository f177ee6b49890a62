"""Data-quality assertions: each returns check rows, nothing is raised or collected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph import schemas
from barograph.functions.numeric import count_if
from barograph.operators.explore import max_gap, unpivot

c = F.col


def assert_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls per column, all columns in one pass."""
    row = df.agg(*[count_if(c(x).isNull()).alias(x) for x in columns])
    checks = unpivot(row, {f"not_null:{x}": c(x) for x in columns}, "check", "n_bad")
    return checks.withColumn("passed", c("n_bad") == 0)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(c("_n") > 1)
    return repeated.agg(F.count(F.lit(1)).alias("n_bad")).select(
        F.lit(f"unique:{','.join(keys)}").alias("check"), "n_bad", (c("n_bad") == 0).alias("passed")
    )


def assert_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows with a value outside the list; null is accepted."""
    wrong = df.agg(count_if(~c(column).isin(list(values))).alias("n_bad"))
    return wrong.select(
        F.lit(f"accepted_values:{column}").alias("check"), "n_bad", (c("n_bad") == 0).alias("passed")
    )


def _outside(column: str, low: float | None, high: float | None):
    bad = F.lit(False)
    if low is not None:
        bad = bad | (c(column) < low)
    if high is not None:
        bad = bad | (c(column) > high)
    return bad


# Plausible range of each gated column.
RANGES = {
    "max_temp in [-5, 55]": [("max_temp", -5, 55)],
    "min_temp in [-15, 40]": [("min_temp", -15, 40)],
    "humidity in [0, 100]": [("humidity_9am", 0, 100), ("humidity_3pm", 0, 100)],
    "pressure_9am in [950, 1060]": [("pressure_9am", 950, 1060)],
    "rainfall >= 0": [("rainfall", 0, None)],
    "rain_tomorrow_proba in [0, 1]": [("rain_tomorrow_proba", 0, 1)],
    "heatwave_risk in [0, 1]": [("heatwave_risk", 0, 1)],
    "frost_risk in [0, 1]": [("frost_risk", 0, 1)],
    "storm_probability in [0, 1]": [("storm_probability", 0, 1)],
    "comfort_score in [0, 100]": [("comfort_score", 0, 100)],
    "max_temp_tomorrow in [0, 55]": [("max_temp_tomorrow", 0, 55)],
    "vpd >= 0": [("vpd_9am", 0, None), ("vpd_3pm", 0, None)],
    "shortwave_radiation_sum >= 0": [("shortwave_radiation_sum", 0, None)],
}
MAX_GAP_DAYS = 7


def quality_gates(df: DataFrame, expected_cities: int) -> DataFrame:
    """PASS or FAIL per gate. Range gates share one pass; keys, cities and date gaps need a
    grouping each."""
    kept = schemas.BASE_COLUMNS + schemas.ENRICHED_COLUMNS + schemas.TARGET_COLUMNS
    row = df.agg(
        F.sum(sum((c(x).isNull().cast("int") for x in kept), F.lit(0))).alias("no nulls"),
        *[
            count_if(_any([_outside(*rule) for rule in rules])).alias(gate)
            for gate, rules in RANGES.items()
        ],
        count_if(c("max_temp") < c("min_temp")).alias("max_temp >= min_temp"),
    )
    ranges = unpivot(row, {g: c(f"`{g}`") for g in row.columns}, "gate", "n_bad")
    duplicates = (
        df.groupBy("city", "date")
        .agg((F.count(F.lit(1)) - 1).alias("_extra"))
        .agg(F.coalesce(F.sum("_extra"), F.lit(0)).alias("n_bad"))
        .select(F.lit("no duplicate (city, date)").alias("gate"), "n_bad")
    )
    cities = df.agg(F.abs(F.countDistinct("city") - expected_cities).alias("n_bad")).select(
        F.lit(f"{expected_cities} cities").alias("gate"), "n_bad"
    )
    gaps = max_gap(df).agg(count_if(c("max_gap_days") > MAX_GAP_DAYS).alias("n_bad")).select(
        F.lit(f"no gap over {MAX_GAP_DAYS} days").alias("gate"), "n_bad"
    )
    gates = ranges.unionByName(duplicates).unionByName(cities).unionByName(gaps)
    return gates.withColumn("status", F.when(c("n_bad") == 0, "PASS").otherwise("FAIL"))


def _any(conditions):
    out = conditions[0]
    for condition in conditions[1:]:
        out = out | condition
    return out
