"""Parsing of landed weather payloads and monitoring documents.

A payload is exploded from an array of one small struct per day. Exploding the days next to the
hourly arrays would copy the whole document into every row.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barograph import schemas
from barograph.config import DEFAULTS, LabelRules
from barograph.functions import weather as w

# Provider variable behind each stored column.
DAILY = {
    "min_temp": "temperature_2m_min",
    "max_temp": "temperature_2m_max",
    "rainfall": "precipitation_sum",
    "rain_sum": "rain_sum",
    "precipitation_hours": "precipitation_hours",
    "evaporation": "et0_fao_evapotranspiration",
    "sunshine_hours": "sunshine_duration",
    "shortwave_radiation_sum": "shortwave_radiation_sum",
    "wind_gust_speed": "windgusts_10m_max",
    "wind_gust_dir": "winddirection_10m_dominant",
    "weather_code": "weathercode",
}
HOURLY = {
    "temp": "temperature_2m",
    "humidity": "relative_humidity_2m",
    "dew_point": "dew_point_2m",
    "wind_speed": "windspeed_10m",
    "wind_speed_100m": "windspeed_100m",
    "wind_dir": "winddirection_10m",
    "vpd": "vapour_pressure_deficit",
    "pressure": "pressure_msl",
    "surface_pressure": "surface_pressure",
    "cloud": "cloudcover",
}
HOURS = {"9am": 9, "3pm": 15}
MISSING_AT_OR_BELOW = -990

_numbers = T.ArrayType(T.DoubleType())
PAYLOAD = T.StructType(
    [
        T.StructField(
            "daily",
            T.StructType(
                [T.StructField("time", T.ArrayType(T.StringType()))]
                + [T.StructField(v, _numbers) for v in DAILY.values()]
            ),
        ),
        T.StructField("hourly", T.StructType([T.StructField(v, _numbers) for v in HOURLY.values()])),
    ]
)


def _converted(column: str, value: Column) -> Column:
    if column == "sunshine_hours":
        return w.hours(value)
    if column.startswith("wind_gust_dir") or column.startswith("wind_dir"):
        return w.compass(value)
    if column.startswith("cloud"):
        return w.okta(value)
    if column == "weather_code":
        return value.cast("int")
    return value


def payload_parse(
    df_json: DataFrame,
    locations: DataFrame,
    start: date,
    end: date,
    labels: LabelRules = DEFAULTS.labels,
) -> DataFrame:
    """(city, payload JSON) to daily rows: hours 9 and 15, converted units, requested days only."""

    def day(i: Column) -> Column:
        fields = [F.get(F.col("p.daily.time"), i).alias("date")]
        for column, variable in DAILY.items():
            value = F.get(F.col(f"p.daily.{variable}"), i)
            fields.append(_converted(column, value).alias(column))
        for suffix, hour in HOURS.items():
            for column, variable in HOURLY.items():
                value = F.get(F.col(f"p.hourly.{variable}"), i * 24 + hour)
                name = f"{column}_{suffix}"
                fields.append(_converted(name, value).alias(name))
        return F.struct(*fields)

    days = F.transform(F.sequence(F.lit(0), F.size("p.daily.time") - 1), day)
    rows = (
        df_json.select("city", F.from_json("payload", PAYLOAD).alias("p"))
        .where(F.size("p.daily.time") > 0)
        .select("city", F.inline(days))
        .withColumn("date", F.to_date("date"))
        .where(F.col("date").between(F.lit(start), F.lit(end)))
    )
    return _finish(rows, locations, labels)


def _finish(rows: DataFrame, locations: DataFrame, labels: LabelRules) -> DataFrame:
    out = rows.withColumn("rain_today", w.rain_flag("rainfall", labels.rain_min_mm)).join(
        locations.select("city", "state", "latitude", "longitude"), "city"
    )
    present = set(out.columns)
    return out.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.WEATHER_RAW.fields
        ]
    )


def payload_parse_map(
    df_json: DataFrame,
    locations: DataFrame,
    start: date,
    end: date,
    labels: LabelRules = DEFAULTS.labels,
) -> DataFrame:
    """(city, payload JSON) keyed by parameter and YYYYMMDD. Daily humidity and pressure stand in
    for the 9am and 3pm readings; readings at or below the sentinel are missing."""
    by_day = T.MapType(T.StringType(), T.DoubleType())
    schema = T.StructType(
        [
            T.StructField(
                "properties",
                T.StructType([T.StructField("parameter", T.MapType(T.StringType(), by_day))]),
            )
        ]
    )
    readings = (
        df_json.select("city", F.explode(F.from_json("payload", schema)["properties"]["parameter"]))
        .select("city", F.col("key").alias("parameter"), F.explode("value").alias("day", "reading"))
        .withColumn("date", F.to_date("day", "yyyyMMdd"))
        .where(F.col("date").between(F.lit(start), F.lit(end)))
    )
    clean = F.when(F.col("reading") > MISSING_AT_OR_BELOW, F.col("reading"))

    def reading(parameter: str) -> Column:
        return F.max(F.when(F.col("parameter") == parameter, clean))

    humidity, pressure = F.col("_rh"), w.hectopascal("_ps")
    rows = (
        readings.groupBy("city", "date")
        .agg(
            reading("T2M_MIN").alias("min_temp"),
            reading("T2M_MAX").alias("max_temp"),
            reading("PRECTOTCORR").alias("rainfall"),
            reading("RH2M").alias("_rh"),
            reading("PS").alias("_ps"),
            reading("WS10M_MAX").alias("_ws"),
            reading("WD10M").alias("_wd"),
            F.count(F.when(F.col("parameter") == "T2M_MAX", 1)).alias("_listed"),
        )
        .where(F.col("_listed") > 0)
        .withColumns(
            {
                "rain_sum": F.col("rainfall"),
                "wind_gust_speed": w.kmh("_ws"),
                "wind_gust_dir": w.compass("_wd"),
                **{f"humidity_{s}": humidity for s in HOURS},
                **{f"pressure_{s}": pressure for s in HOURS},
                **{f"surface_pressure_{s}": pressure for s in HOURS},
            }
        )
    )
    return _finish(rows, locations, labels)


def drift_json_explode(df: DataFrame) -> DataFrame:
    """One drift document per row (column ``value``) to one row per feature."""
    return (
        df.select(F.from_json("value", schemas.DRIFT_DOCUMENT).alias("d"))
        .select(F.to_date("d.date").alias("date"), F.explode("d.features").alias("feature_name", "s"))
        .select(
            "date",
            "feature_name",
            F.col("s.ks_stat").alias("ks_stat"),
            F.col("s.p_value").alias("p_value"),
            F.coalesce("s.drifted", F.lit(False)).alias("drifted"),
        )
    )


def json_list(column: str) -> Column:
    """A string array as JSON text with ', ' between items; null gives '[]'."""
    item = "substring(to_json(array(x)), 2, length(to_json(array(x))) - 2)"
    items = F.expr(f"transform(coalesce({column}, array()), x -> {item})")
    return F.concat(F.lit("["), F.concat_ws(", ", items), F.lit("]"))


def decision_json_row(df: DataFrame) -> DataFrame:
    """One decision document per row (column ``value``) to the stored decision row."""
    d = df.select(F.from_json("value", schemas.DECISION_DOCUMENT).alias("d")).select("d.*")
    flags = ("low_accuracy", "high_mae", "heavy_drift", "mild_drift")
    return d.select(
        F.to_date("date").alias("date"),
        "action",
        "reason",
        F.coalesce("n_drifted", F.lit(0)).alias("n_drifted"),
        json_list("drifted_features").alias("drifted_features"),
        *[F.coalesce(f, F.lit(False)).alias(f) for f in flags],
        "rain_accuracy_30d",
        "temp_mae_30d",
    )


def metrics_history(df: DataFrame) -> DataFrame:
    """JSON lines (column ``value``) of recorded metrics. The record carries its own ``row_num``,
    since the line order of a split file is not kept."""
    return df.select(F.from_json("value", schemas.METRICS_HISTORY).alias("r")).select("r.*")
