"""Weather rules as Column expressions; no Python code runs per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barograph.functions.numeric import clamp, col, round_half_even

# The 16 compass points, clockwise from north.
COMPASS = (
    "N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE",
    "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW",
)


def compass(degrees: Column | str) -> Column:
    """Degrees to a compass point; half sectors go to the even sector."""
    sector = F.rint(col(degrees) / 22.5).cast("int")
    return F.get(F.array(*[F.lit(p) for p in COMPASS]), F.pmod(sector, F.lit(16)))


def weather_type(code: Column | str) -> Column:
    """WMO code to one of five classes; anything not listed is sunny."""
    code = col(code)
    # Code ranges of each class.
    return (
        F.when(code.isNull(), "Unknown")
        .when(code.between(95, 99), "Stormy")
        .when(code.between(51, 67) | code.between(80, 86), "Rainy")
        .when(code.between(10, 19) | code.isin(45, 48), "Cloudy")
        .otherwise("Sunny")
    )


def _excess(c: Column, limit: float, slope: float) -> Column:
    """Penalty that grows with the part of ``c`` above ``limit``; 0 for null."""
    return F.greatest(F.coalesce(c, F.lit(limit)) - limit, F.lit(0.0)) * slope


def _deficit(c: Column, limit: float, slope: float) -> Column:
    return F.greatest(limit - F.coalesce(c, F.lit(limit)), F.lit(0.0)) * slope


def comfort_score(
    max_temp: Column | str = "max_temp",
    humidity: Column | str = "humidity_3pm",
    gust: Column | str = "wind_gust_speed",
    rain_today: Column | str = "rain_today",
    sunshine: Column | str = "sunshine_hours",
) -> Column:
    """Comfort from 0 to 100, one decimal. A missing reading costs nothing."""
    temp, hum, wind, sun = col(max_temp), col(humidity), col(gust), col(sunshine)
    # Limits and slopes of the score.
    heat = F.when(temp > 38, _excess(temp, 38.0, 4.0)).otherwise(_excess(temp, 30.0, 1.5))
    blow = F.when(wind > 50, _excess(wind, 50.0, 0.5)).otherwise(_excess(wind, 25.0, 0.3))
    wet = F.when(col(rain_today).cast("int") == 1, 15.0).otherwise(0.0)
    bonus = F.least((F.coalesce(sun, F.lit(0.0)) - 7.0) * 2.0, F.lit(10.0))
    score = (
        F.lit(100.0)
        - _deficit(temp, 10.0, 3.5)
        - heat
        - _excess(hum, 85.0, 0.6)
        - _deficit(hum, 25.0, 0.4)
        - blow
        - wet
        + F.greatest(bonus, F.lit(0.0))
    )
    return round_half_even(clamp(score, 0.0, 100.0), 1)


def rain_flag(rainfall: Column | str, wet_mm: float) -> Column:
    return (F.coalesce(col(rainfall), F.lit(0.0)) > wet_mm).cast("int")


def okta(percent: Column | str) -> Column:
    return col(percent) / 12.5


def hectopascal(kilopascal: Column | str) -> Column:
    return col(kilopascal) * 10.0


def kmh(metres_per_second: Column | str) -> Column:
    return col(metres_per_second) * 3.6


def hours(seconds: Column | str) -> Column:
    return col(seconds) / 3600.0
