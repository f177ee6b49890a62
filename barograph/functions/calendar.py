"""Calendar helpers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barograph.functions.numeric import col

# Season names of the southern and the northern year, first quarter = Dec-Feb.
SOUTHERN = ("Summer", "Autumn", "Winter", "Spring")
NORTHERN = ("Winter", "Spring", "Summer", "Autumn")
SEASON_CODES = ("DJF", "MAM", "JJA", "SON")


def season_index(date: Column | str) -> Column:
    """1 for Dec-Feb, 2 for Mar-May, 3 for Jun-Aug, 4 for Sep-Nov."""
    return F.floor((F.month(col(date)) % 12) / 3).cast("int") + 1


def _season_name(date: Column | str, names: tuple[str, ...]) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), season_index(date) - 1)


def season(date: Column | str, northern: bool = False) -> Column:
    return _season_name(date, NORTHERN if northern else SOUTHERN)


def season_code(date: Column | str) -> Column:
    return _season_name(date, SEASON_CODES)


def month_start(date: Column | str) -> Column:
    return F.trunc(col(date), "MM")


def year_start(date: Column | str) -> Column:
    return F.trunc(col(date), "YEAR")


def week_start(date: Column | str) -> Column:
    return F.trunc(col(date), "WEEK")


def iso_weekday(date: Column | str) -> Column:
    """Monday = 1 .. Sunday = 7."""
    return F.weekday(col(date)) + 1


def iso_year(date: Column | str) -> Column:
    return F.year(F.date_add(col(date), 4 - iso_weekday(date)))


def iso_year_week(date: Column | str) -> Column:
    week = F.lpad(F.weekofyear(col(date)).cast("string"), 2, "0")
    return F.concat(iso_year(date).cast("string"), F.lit("-W"), week)


def days_between(end: Column | str, start: Column | str) -> Column:
    return F.datediff(col(end), col(start))
