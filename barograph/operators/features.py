"""Features and labels of the forecast models, as Column expressions over row blocks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barograph.config import DEFAULTS, LabelRules, TrainingRules
from barograph.functions.rows import attach_row
from barograph.functions import calendar as cal
from barograph.functions import weather as w
from barograph.functions.numeric import flag
from barograph.operators.quantiles import exact_quantiles, melt
from barograph.sources.landing import stored
from barograph.operators.sequence import drop_halo, number_rows, row_blocks

LAGGED = ("max_temp", "min_temp", "rainfall", "pressure_3pm")
ROLLED = ("max_temp", "rainfall", "humidity_3pm")
LAGS, ROLL, MIN_ROLL = 2, 7, 3


def _windowed(
    df: DataFrame, build: Callable[..., dict[str, Column]], before: int = 0, after: int = 0
) -> DataFrame:
    blocks, city = row_blocks(df, ["city"], "date", before, after)
    return drop_halo(blocks.withColumns(build(city)))


def features_calendar(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"month": F.month("date"), "day_of_year": F.dayofyear("date"), "season": cal.season("date")}
    )


def _lags(city) -> dict[str, Column]:
    return {f"{c}_lag{n}": F.lag(c, n).over(city) for c in LAGGED for n in range(1, LAGS + 1)}


def features_lag(df: DataFrame) -> DataFrame:
    return _windowed(df, _lags, before=LAGS)


def _rolls(city) -> dict[str, Column]:
    frame = city.rowsBetween(-ROLL, -1)
    return {
        f"{c}_rolling{ROLL}": F.when(F.count(c).over(frame) >= MIN_ROLL, F.avg(c).over(frame))
        for c in ROLLED
    }


def features_rolling(df: DataFrame) -> DataFrame:
    """Mean of the seven rows before today; needs three readings."""
    return _windowed(df, _rolls, before=ROLL)


def features_derived(df: DataFrame) -> DataFrame:
    """Needs the lag and rolling columns."""
    return df.withColumns(
        {
            "pressure_tendency": F.col("pressure_3pm") - F.col("pressure_3pm_lag1"),
            "temp_anomaly": F.col("max_temp") - F.col(f"max_temp_rolling{ROLL}"),
        }
    )


def _hot(labels: LabelRules, shifted: Column) -> Column:
    return flag(shifted >= labels.heatwave_c)


def _hot_days(city, labels: LabelRules) -> dict[str, Column]:
    hot = [_hot(labels, F.lag("max_temp", n).over(city) if n else F.col("max_temp")) for n in range(3)]
    return {
        "hot_day": hot[0],
        "hot_day_lag1": hot[1],
        "hot_day_lag2": hot[2],
        "consec_hot_days": hot[0] + hot[1] + hot[2],
    }


def features_hot_days(df: DataFrame, labels: LabelRules = DEFAULTS.labels) -> DataFrame:
    """consec_hot_days counts hot days among today and the two rows before; it is not a streak."""
    return _windowed(df, lambda city: _hot_days(city, labels), before=2)


def features_rain_intensity(df: DataFrame) -> DataFrame:
    """mm per hour of precipitation; 0 when either is missing or there were no hours."""
    rate = F.try_divide(F.col("rainfall"), F.col("precipitation_hours"))
    return df.withColumn("rainfall_intensity", F.coalesce(rate, F.lit(0.0)))


def _labels(city, labels: LabelRules) -> dict[str, Column]:
    """Tomorrow is the next row of the city, whatever its date."""
    following = {
        c: F.lead(c).over(city)
        for c in ("rainfall", "max_temp", "min_temp", "weather_code", "wind_gust_speed")
    }
    rain = F.coalesce(following["rainfall"], F.lit(0.0))
    next_hot = _hot(labels, following["max_temp"]) == 1
    warm_spell = _hot_days(city, labels)["consec_hot_days"] >= 1
    frost = F.coalesce(following["min_temp"], F.lit(99.0)) <= labels.frost_c
    gusts = F.coalesce(following["wind_gust_speed"], F.lit(0.0)) > labels.storm_gust_kmh
    return {
        "rain_tomorrow": flag(rain > labels.rain_min_mm),
        "max_temp_tomorrow": following["max_temp"],
        "weather_type_tomorrow": w.weather_type(following["weather_code"]),
        "heatwave_risk": flag(next_hot & warm_spell),
        "frost_risk": flag(frost),
        "storm_label": flag((rain > labels.storm_rain_mm) & gusts),
    }


def labels(df: DataFrame, cfg: LabelRules = DEFAULTS.labels) -> DataFrame:
    return _windowed(df, lambda city: _labels(city, cfg), before=2, after=1)


def labels_train_set(df: DataFrame, keep_last: bool = False) -> DataFrame:
    """Drop the last day of each city, whose tomorrow is unknown."""
    if keep_last:
        return df
    last = df.groupBy("city").agg(F.max("date").alias("_last"))
    return df.join(last, "city").where(F.col("date") < F.col("_last")).drop("_last")


def feature_frame(
    raw: DataFrame, cfg: LabelRules = DEFAULTS.labels, keep_last: bool = False
) -> DataFrame:
    """All features and labels from one pass: every window shares the same blocks."""

    def build(city) -> dict[str, Column]:
        return {**_lags(city), **_rolls(city), **_hot_days(city, cfg), **_labels(city, cfg)}

    windowed = _windowed(raw, build, before=ROLL, after=1)
    frame = features_rain_intensity(features_derived(features_calendar(windowed))).withColumns(
        {"comfort_score": w.comfort_score(), "weather_type": w.weather_type("weather_code")}
    )
    return labels_train_set(frame, keep_last)


def category_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Codes 0..n-1 of the sorted distinct values of each column: (column, value, code).

    The distinct values are dealt into ranges of about equal size and stored with their range; then they
    are numbered inside it. So no task sorts all values of a column, whatever they have in common.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    distinct = (
        df.select(F.explode(pairs).alias("p")).select("p.*").where(F.col("value").isNotNull()).distinct()
    )
    ranged = distinct.repartitionByRange("column", "value").withColumn("_range", F.spark_partition_id())
    numbered = number_rows(
        stored(ranged, "category-ranges"), ["column"], "value", chunk=F.col("_range"), name="code"
    )
    return numbered.select("column", "value", F.col("code").cast("int").alias("code"))


def encode_categoricals(
    df: DataFrame, columns: Sequence[str], mappings: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Replace text by its code, -1 when missing or not in ``mappings``. Pass the mappings of the
    training set when scoring, so that codes mean the same."""
    columns = [c for c in columns if c in df.columns]
    mappings = category_codes(df, columns) if mappings is None else mappings
    encoded = df
    for c in columns:
        codes = mappings.where(F.col("column") == c).select(
            F.col("value").alias(c), F.col("code").alias("_code")
        )
        encoded = encoded.join(codes, c, "left").withColumn(c, F.coalesce("_code", F.lit(-1))).drop("_code")
    return encoded.select(*df.columns), mappings


def column_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact medians as one row with one column per feature."""
    medians = exact_quantiles(melt(df, columns), ["feature"], [0.5])
    return medians.agg(
        *[F.max(F.when(F.col("feature") == c, F.col("quantile"))).alias(c) for c in columns]
    )


def feature_matrix(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    medians: DataFrame | None = None,
    keys: Sequence[str] = ("city", "date"),
    rules: TrainingRules = DEFAULTS.training,
) -> DataFrame:
    """The configured columns as doubles, gaps filled with the median of the frame (or the given
    medians of the training set)."""
    wanted = list(rules.numerical + rules.categorical) if columns is None else list(columns)
    wanted = [c for c in wanted if c in df.columns]
    numbers = df.select(
        *[F.col(k).alias(f"key_{k}") for k in keys], *[F.col(c).cast("double").alias(c) for c in wanted]
    )
    medians = column_medians(numbers, wanted) if medians is None else medians
    filled = attach_row(numbers, medians.select(*[F.col(c).alias(f"_{c}") for c in wanted]))
    return filled.select(
        *[f"key_{k}" for k in keys], *[F.coalesce(c, f"_{c}").alias(c) for c in wanted]
    )


def align_features(df: DataFrame, expected: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Exactly the expected columns; one the frame lacks is 0."""
    return df.select(
        *keys, *[F.col(c) if c in df.columns else F.lit(0.0).alias(c) for c in expected]
    )
