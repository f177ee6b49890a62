"""One-row tables as values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """The columns of a one-row table next to every row of ``df``.

    ``row`` is a scalar subquery: it runs once and its value becomes a constant of the plan, so
    there is no join. More than one row is an error at run time; none gives nulls.
    """
    packed = row.select(F.struct(*row.columns).alias("_row")).scalar()
    return df.withColumn("_row", packed).select(*df.columns, "_row.*")
