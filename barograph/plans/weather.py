"""Weather marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barograph.functions import calendar as cal
from barograph.functions.numeric import band, flag, ratio, rows

# Limits of the daily categories.
RAIN_BANDS = [(2, "Light rain"), (10, "Moderate rain"), (30, "Heavy rain")]
TEMPERATURE_BANDS = [(10, "Cold"), (20, "Mild"), (30, "Warm"), (35, "Hot")]
COMFORT_BANDS = [(90, "Excellent"), (75, "Good"), (60, "Medium"), (40, "Low")]


def unknown_if_null(column: str, label: Column) -> Column:
    return F.when(F.col(column).isNull(), "Unknown").otherwise(label)


def daily_clean(weather_final: DataFrame) -> DataFrame:
    """One row per city and day with date parts, categories and risk flags: a pure projection."""
    day = F.col("weather_date")
    rain = F.coalesce("rainfall", "rain_sum", F.lit(0.0))
    return weather_final.withColumnRenamed("date", "weather_date").withColumns(
        {
            "year_month": cal.month_start(day),
            "year": F.year(day),
            "month": F.month(day),
            "quarter": F.quarter(day),
            "season": cal.season(day),
            "rainfall_clean": rain,
            "is_rainy_day": flag(F.col("rain_today") | (rain > 0)),
            "rainfall_category": F.when(rain == 0, "No rain").otherwise(
                band(rain, RAIN_BANDS, "Extreme rain", above=False)
            ),
            "is_hot_day": flag(F.col("max_temp") >= 35),
            "is_frost_day": flag(F.col("min_temp") <= 0),
            "temperature_category": unknown_if_null(
                "max_temp", band(F.col("max_temp"), TEMPERATURE_BANDS, "Extreme heat", above=False)
            ),
            "is_storm_risk_day": flag(F.col("storm_probability") >= 0.70),
            "is_strong_wind_day": flag(F.col("wind_gust_speed") >= 70),
            "comfort_category": unknown_if_null(
                "comfort_score", band(F.col("comfort_score"), COMFORT_BANDS, "Poor")
            ),
        }
    )




def averages(columns: dict[str, str]) -> list[Column]:
    return [F.avg(source).alias(name) for name, source in columns.items()]


def prefixed(*columns: str) -> dict[str, str]:
    return {f"avg_{c}": c for c in columns}


RISKS = ("comfort_score", "heatwave_risk", "frost_risk", "storm_probability")
PLACE = {"latitude": "latitude", "longitude": "longitude"}


def temperature_range() -> list[Column]:
    return [
        *averages(prefixed("min_temp", "max_temp")),
        F.min("min_temp").alias("min_temp_recorded"),
        F.max("max_temp").alias("max_temp_recorded"),
    ]


def rain_totals() -> list[Column]:
    return [
        F.sum("rainfall_clean").alias("total_rainfall"),
        F.avg("rainfall_clean").alias("avg_rainfall"),
        F.sum("is_rainy_day").alias("rainy_days"),
    ]


def risk_days(*names: str) -> list[Column]:
    return [F.sum(f"is_{n}_day").alias(f"{n}_days") for n in names]


def monthly_city(daily_clean: DataFrame) -> DataFrame:
    months = daily_clean.groupBy("year_month", "year", "month", "city", "state").agg(
        *averages(PLACE),
        rows().alias("n_days"),
        *temperature_range(),
        *rain_totals(),
        *averages(
            prefixed(
                "temp_9am", "temp_3pm", "humidity_9am", "humidity_3pm", "pressure_9am",
                "pressure_3pm", "cloud_9am", "cloud_3pm", "wind_speed_9am", "wind_speed_3pm",
                "evaporation", "sunshine_hours", "shortwave_radiation_sum", *RISKS,
            )
        ),
        F.max("wind_gust_speed").alias("max_wind_gust_speed"),
        *risk_days("hot", "frost", "storm_risk", "strong_wind"),
    )
    return months.withColumns(
        {
            "dry_days": F.col("n_days") - F.col("rainy_days"),
            "rainy_day_rate": ratio("rainy_days", "n_days"),
        }
    )


def state_monthly(daily_clean: DataFrame) -> DataFrame:
    """Monthly figures per state, built from city-months so that a state that holds most of the
    rows is spread over its cities before it is combined."""
    measures = {
        "min_temp": "avg_min_temp", "max_temp": "avg_max_temp", "rainfall_clean": "avg_rainfall",
        "humidity_3pm": "avg_humidity_3pm", "wind_speed_3pm": "avg_wind_speed_3pm",
        **{r: f"avg_{r}" for r in RISKS},
    }
    per_city = daily_clean.groupBy("year_month", "year", "month", "state", "city").agg(
        rows().alias("n_city_days"),
        *[F.sum(m).alias(f"_sum_{m}") for m in measures],
        *[F.count(m).alias(f"_n_{m}") for m in measures],
        F.min("min_temp").alias("min_temp_recorded"),
        F.max("max_temp").alias("max_temp_recorded"),
        F.max("wind_gust_speed").alias("max_wind_gust_speed"),
        F.sum("is_rainy_day").alias("rainy_days"),
        *risk_days("hot", "frost", "storm_risk"),
    )
    counts = ["n_city_days", "rainy_days", "hot_days", "frost_days", "storm_risk_days"]
    return (
        per_city.groupBy("year_month", "year", "month", "state")
        .agg(
            F.count("city").alias("n_cities"),
            *[F.sum(c).alias(c) for c in counts],
            *[ratio(F.sum(f"_sum_{m}"), F.sum(f"_n_{m}")).alias(n) for m, n in measures.items()],
            F.sum("_sum_rainfall_clean").alias("total_rainfall"),
            F.min("min_temp_recorded").alias("min_temp_recorded"),
            F.max("max_temp_recorded").alias("max_temp_recorded"),
            F.max("max_wind_gust_speed").alias("max_wind_gust_speed"),
        )
        .withColumn("rainy_day_rate", ratio("rainy_days", "n_city_days"))
    )


def yearly_city(daily_clean: DataFrame) -> DataFrame:
    years = daily_clean.groupBy("year", "city", "state").agg(
        *averages(PLACE),
        rows().alias("n_days"),
        *temperature_range(),
        *rain_totals(),
        *averages(prefixed("humidity_3pm", "wind_speed_3pm", *RISKS)),
        F.max("wind_gust_speed").alias("max_wind_gust_speed"),
        *risk_days("hot", "frost", "storm_risk"),
    )
    return years.withColumn("rainy_day_rate", ratio("rainy_days", "n_days"))


def seasonality(daily_clean: DataFrame) -> DataFrame:
    """Season figures per city; December counts in its own calendar year."""
    return daily_clean.groupBy("year", "season", "city", "state").agg(
        *averages(PLACE),
        rows().alias("n_days"),
        *rain_totals(),
        *averages(
            prefixed("min_temp", "max_temp", "humidity_3pm", "sunshine_hours", "wind_speed_3pm", *RISKS)
        ),
    )


def climate_normals(daily_clean: DataFrame) -> DataFrame:
    years = F.countDistinct("year")
    normal = {f"normal_{c}": c for c in ("min_temp", "max_temp", "humidity_3pm", "wind_speed_3pm", *RISKS)}
    return daily_clean.groupBy("month", "city", "state").agg(
        *averages(PLACE),
        rows().alias("n_observations"),
        years.alias("n_years"),
        F.avg("rainfall_clean").alias("normal_daily_rainfall"),
        ratio(F.sum("rainfall_clean"), years).alias("normal_monthly_rainfall"),
        *averages(normal),
    )


def comfort_segments(daily_clean: DataFrame) -> DataFrame:
    means = {"avg_rainfall": "rainfall_clean"} | prefixed("max_temp", "humidity_3pm", *RISKS)
    return daily_clean.groupBy(
        "year_month", "state", "comfort_category", "temperature_category", "rainfall_category"
    ).agg(
        rows().alias("n_city_days"),
        F.countDistinct("city").alias("n_cities"),
        *averages(means),
    )


SNAPSHOT = [
    "latitude", "longitude", "min_temp", "max_temp", "rain_today", "rain_tomorrow",
    "rain_tomorrow_proba", "max_temp_tomorrow", "weather_type_tomorrow", "comfort_score",
    "heatwave_risk", "frost_risk", "storm_probability", "predicted_at",
]


def current_snapshot(daily_clean: DataFrame) -> DataFrame:
    """Latest row per city and state. ``max_by`` combines per map task, so a city with a long
    history costs no more than one row per task in the shuffle."""
    newest = F.struct("weather_date", "predicted_at")
    kept = F.struct(
        F.col("weather_date").alias("latest_date"), F.col("rainfall_clean").alias("rainfall"), *SNAPSHOT
    )
    return (
        daily_clean.groupBy("city", "state")
        .agg(F.max_by(kept, newest).alias("last"))
        .select("city", "state", "last.*")
    )


def exploded(df: DataFrame, events: list[tuple[str, Column, Column]], kind: str, value: str) -> DataFrame:
    """One row per event that applies: (label, value, condition). The source is read once."""
    candidates = [
        F.when(condition, F.struct(F.lit(label).alias(kind), amount.alias(value)))
        for label, amount, condition in events
    ]
    return (
        df.withColumn("_event", F.explode(F.array_compact(F.array(*candidates))))
        .select("*", f"_event.{kind}", f"_event.{value}")
        .drop("_event")
    )


SEVERITY = {
    # Fixed values: (high, critical) limits of each extreme.
    "Extreme heat": (40, 45),
    "Extreme cold": (0, -5),
    "Heavy rain": (30, 50),
    "Strong wind": (70, 90),
}


def _severity() -> Column:
    value, kind = F.col("extreme_value"), F.col("extreme_type")
    level = F.lit("Medium")
    for label, (high, critical) in SEVERITY.items():
        cold = critical < high
        step = (
            F.when(value <= critical if cold else value >= critical, "Critical")
            .when(value <= high if cold else value >= high, "High")
            .otherwise("Medium")
        )
        level = F.when(kind == label, step).otherwise(level)
    return level


def weather_extremes(daily_clean: DataFrame) -> DataFrame:
    c = F.col
    events = [
        ("Extreme heat", c("max_temp"), c("max_temp") >= 35),
        ("Extreme cold", c("min_temp"), c("min_temp") <= 2),
        ("Heavy rain", c("rainfall"), c("rainfall") >= 20),
        ("Strong wind", c("wind_gust_speed"), c("wind_gust_speed") >= 60),
    ]
    base = daily_clean.select(
        "weather_date", "city", "state", "latitude", "longitude", "max_temp", "min_temp",
        c("rainfall_clean").alias("rainfall"), "wind_gust_speed", "humidity_3pm",
        "storm_probability", "heatwave_risk", "frost_risk",
    )
    return exploded(base, events, "extreme_type", "extreme_value").withColumn(
        "severity_level", _severity()
    )


def risk_alerts(daily_clean: DataFrame) -> DataFrame:
    """One row per risk score of at least 0.40, or comfort below 60."""
    base = daily_clean.select(
        "weather_date", "city", "state", "latitude", "longitude", "rain_tomorrow_proba",
        "heatwave_risk", "frost_risk", "storm_probability", "comfort_score",
    )
    scores = {
        "Rain risk": "rain_tomorrow_proba",
        "Storm risk": "storm_probability",
        "Heatwave risk": "heatwave_risk",
        "Frost risk": "frost_risk",
    }
    events = [(label, F.col(c), F.col(c) >= 0.40) for label, c in scores.items()]
    comfort = F.col("comfort_score")
    events.append(("Low comfort", 1 - comfort / 100.0, comfort < 60))
    return exploded(base, events, "alert_type", "alert_score").withColumn(
        "alert_level", band(F.col("alert_score"), [(0.80, "Critical"), (0.60, "High")], "Medium")
    )
