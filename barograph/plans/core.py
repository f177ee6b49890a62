"""Core dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.functions import calendar as cal

# Alert types with category and description.
ALERT_TYPES = [
    ("Rain risk", "Rain", "Risk based on rain_tomorrow_proba"),
    ("Storm risk", "Storm", "Risk based on storm_probability"),
    ("Heatwave risk", "Temperature", "Risk based on heatwave_risk"),
    ("Frost risk", "Temperature", "Risk based on frost_risk"),
    ("Low comfort", "Comfort", "Risk based on low comfort_score"),
]
# WMO weather codes with label, group and severity 0 to 3.
WEATHER_CODES = [
    (0, "Clear sky", "Clear", 0),
    (1, "Mainly clear", "Clear", 0),
    (2, "Partly cloudy", "Cloudy", 1),
    (3, "Overcast", "Cloudy", 1),
    (45, "Fog", "Fog", 1),
    (48, "Depositing rime fog", "Fog", 1),
    (51, "Drizzle: light", "Drizzle", 2),
    (53, "Drizzle: moderate", "Drizzle", 2),
    (55, "Drizzle: dense", "Drizzle", 2),
    (61, "Rain: slight", "Rain", 2),
    (63, "Rain: moderate", "Rain", 2),
    (65, "Rain: heavy", "Rain", 3),
    (71, "Snow fall: slight", "Snow", 2),
    (73, "Snow fall: moderate", "Snow", 2),
    (75, "Snow fall: heavy", "Snow", 3),
    (77, "Snow grains", "Snow", 2),
    (80, "Rain showers: slight", "Showers", 2),
    (81, "Rain showers: moderate", "Showers", 2),
    (82, "Rain showers: violent", "Showers", 3),
    (85, "Snow showers: slight", "Snow", 2),
    (86, "Snow showers: heavy", "Snow", 3),
    (95, "Thunderstorm: slight or moderate", "Thunderstorm", 3),
    (96, "Thunderstorm with slight hail", "Thunderstorm", 3),
    (99, "Thunderstorm with heavy hail", "Thunderstorm", 3),
]


def dim_alert_type(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        ALERT_TYPES, "alert_type string, alert_category string, alert_description string"
    )


def dim_weather_code(spark: SparkSession) -> DataFrame:
    codes = spark.createDataFrame(
        WEATHER_CODES, "weather_code int, description string, category string, severity_tier int"
    )
    return codes.select(
        "weather_code",
        "description",
        F.col("description").alias("weather_label"),
        "category",
        F.col("category").alias("weather_group"),
        "severity_tier",
    )


def dim_cities(stg_weather_raw: DataFrame) -> DataFrame:
    return stg_weather_raw.groupBy("city").agg(
        F.max("state").alias("state"),
        F.max("latitude").alias("latitude"),
        F.max("longitude").alias("longitude"),
        F.min("date").alias("first_observed_date"),
        F.max("date").alias("last_observed_date"),
        F.count(F.lit(1)).alias("total_records"),
    )


def dim_city(dim_cities: DataFrame) -> DataFrame:
    return dim_cities.select("city", "state", "latitude", "longitude")


def calendar_columns(date: str = "date") -> dict[str, object]:
    weekday = F.dayofweek(date) - 1
    return {
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "day_of_week": weekday,
        "iso_week": F.weekofyear(date),
        "quarter": F.quarter(date),
        "month_start": cal.month_start(date),
        "year_start": cal.year_start(date),
        "week_start": cal.week_start(date),
        "is_weekend": weekday.isin(0, 6),
        "season_southern": cal.season(date),
        "season_code_southern": cal.season_code(date),
        "season_northern": cal.season(date, northern=True),
        "season_code_northern": cal.season_code(date),
        "date_key": F.col(date),
        "year_month": cal.month_start(date),
    }


def dim_date(stg_weather_raw: DataFrame) -> DataFrame:
    """One row per observed day; joins read it instead of repeating date functions."""
    days = stg_weather_raw.select("date").distinct()
    return days.select("date", *[c.alias(n) for n, c in calendar_columns().items()])


# Constants of the geography dimension.
COUNTRY = {"country_code": "AU", "country_name": "Australia", "continent": "Oceania"}


def dim_geography(dim_cities: DataFrame, features_stats: DataFrame) -> DataFrame:
    climate = features_stats.groupBy("city").agg(
        F.avg("avg_max_temp").alias("annual_avg_max_temp"),
        F.sum("n_rainy_days").alias("annual_rainy_days"),
        F.max("avg_max_temp").alias("warmest"),
        F.min("avg_min_temp").alias("coldest"),
    )
    warm, cold, yearly = F.col("warmest"), F.col("coldest"), F.col("annual_avg_max_temp")
    # annual_rainy_days is a total over all years, as published.
    group = (
        F.when((warm >= 18) & (cold >= 18), "Tropical (A)")
        .when((F.col("annual_rainy_days") < 90) & (yearly > 18), "Arid (B)")
        .when((cold >= 0) & (cold < 18), "Temperate (C)")
        .when(cold < 0, "Continental (D)")
        .otherwise("Unknown")
    )
    return dim_cities.join(climate, "city", "left").select(
        *dim_cities.columns,
        "annual_avg_max_temp",
        "annual_rainy_days",
        *[F.lit(v).alias(k) for k, v in COUNTRY.items()],
        F.when(F.col("latitude") < 0, "Southern").otherwise("Northern").alias("hemisphere"),
        group.alias("koppen_group"),
        F.when(F.abs(warm - yearly) < 6, "Coastal").otherwise("Inland").alias("location_type"),
    )


# Readable group of each predicted type.
TYPE_GROUPS = {
    "Sunny": "Dry forecast",
    "Cloudy": "Cloudy forecast",
    "Rainy": "Rain forecast",
    "Stormy": "Storm forecast",
}


def dim_weather_type(stg_weather_predictions: DataFrame) -> DataFrame:
    kind = F.col("weather_type")
    names = F.create_map(*[F.lit(x) for pair in TYPE_GROUPS.items() for x in pair])
    known = F.when(kind.isNotNull(), F.coalesce(F.try_element_at(names, kind), kind))
    return (
        stg_weather_predictions.select(F.col("pred_weather_type_tomorrow").alias("weather_type"))
        .distinct()
        .withColumn("weather_type_group", F.coalesce(known, F.lit("Unknown")))
    )
