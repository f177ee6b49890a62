"""Ordered operators that never put one key's whole history in one task.

A plain ``Window.partitionBy(city)`` puts all rows of a city in one task, and a window without a
partition puts the whole table there. Each operator here first cuts the order column into chunks
(a year, a month, a value bucket), works inside the chunks in parallel, and then carries one small
row per chunk over the borders. Results equal those of the plain window. A row whose key or order
is null belongs to no sequence and is dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 4096


def number_rows(
    df: DataFrame, keys: Sequence[str], order: str, chunk: Column | None = None, name: str = "_seq"
) -> DataFrame:
    """0-based position of each row in its key, by ``order``.

    (keys, order) has to be unique. ``chunk`` must not decrease along ``order``; default is the
    year of a date. Positions are counted inside (keys, chunk); the chunk sizes, one row per key
    and chunk, give the offset.
    """
    keys = list(keys)
    chunk = F.year(order) if chunk is None else chunk
    inside = Window.partitionBy(*keys, "_chunk").orderBy(order)
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.select(*keys, chunk.alias("_chunk"))
        .groupBy(*keys, "_chunk")
        .count()
        .select(*keys, "_chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        df.withColumn("_chunk", chunk)
        .withColumn("_rank", F.row_number().over(inside))
        .join(offsets, [*keys, "_chunk"])
        .withColumn(name, F.col("_offset") + F.col("_rank") - 1)
        .drop("_chunk", "_rank", "_offset")
    )


def row_blocks(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    before: int = 0,
    after: int = 0,
    block_rows: int = BLOCK_ROWS,
) -> tuple[DataFrame, Window]:
    """Split each key into blocks of ``block_rows`` rows plus a halo, and give the window to use.

    The last ``before`` rows of a block are repeated in the next one and the first ``after`` rows
    in the previous one, so a ROWS frame or a lag/lead of that length sees the same rows as in the
    whole key. Call :func:`drop_halo` once the window columns are there. No task holds more than
    ``block_rows + before + after`` rows of a key.
    """
    if max(before, after) > block_rows:
        raise ValueError("a halo cannot be longer than a block")
    keys = list(keys)
    position = F.col("_seq") % block_rows
    home = F.floor(F.col("_seq") / block_rows)

    def copy(number: Column, halo: bool) -> Column:
        return F.struct(number.alias("_block"), F.lit(halo).alias("_halo"))

    copies = [copy(home, False)]
    if before:
        copies.append(F.when(position >= block_rows - before, copy(home + 1, True)))
    if after:
        copies.append(F.when((position < after) & (home > 0), copy(home - 1, True)))
    blocked = (
        number_rows(df, keys, order)
        .withColumn("_copy", F.explode(F.array_compact(F.array(*copies))))
        .select("*", "_copy._block", "_copy._halo")
        .drop("_copy")
    )
    return blocked, Window.partitionBy(*keys, "_block").orderBy("_seq")


def drop_halo(df: DataFrame) -> DataFrame:
    return df.where(~F.col("_halo")).drop("_seq", "_block", "_halo")


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    columns: dict[str, str],
    ahead: bool = True,
    chunk: Column | None = None,
) -> DataFrame:
    """LEAD (or LAG) by one row, with ``columns`` mapping a source column to its new name.

    Inside a chunk it is an ordinary lead; the last row of a chunk takes the first row of the next
    non-empty chunk, found on a table with one row per key and chunk.
    """
    keys = list(keys)
    chunk = F.year(order) if chunk is None else chunk
    payload = F.struct(*[F.col(source).alias(new) for source, new in columns.items()])
    base = df.withColumn("_chunk", chunk).withColumn("_payload", payload)
    inside = Window.partitionBy(*keys, "_chunk").orderBy(order)
    across = Window.partitionBy(*keys).orderBy("_chunk")
    edge = F.min_by if ahead else F.max_by
    shift = F.lead if ahead else F.lag
    edges = (
        base.groupBy(*keys, "_chunk")
        .agg(edge("_payload", order).alias("_edge"))
        .select(*keys, "_chunk", shift("_edge").over(across).alias("_edge"))
    )
    joined = base.withColumn("_next", shift("_payload").over(inside)).join(edges, [*keys, "_chunk"])
    picked = F.coalesce(F.col("_next"), F.col("_edge"))
    return joined.select(
        *df.columns, *[picked.getField(new).alias(new) for new in columns.values()]
    )


def running_total(
    df: DataFrame, keys: Sequence[str], order: str, values: dict[str, str], bucket: Column
) -> DataFrame:
    """Inclusive running sums of ``values`` (source column to new name) by ``order`` in each key.

    ``bucket`` must not decrease along ``order``. Sums run inside (keys, bucket); the bucket totals
    give what came before.
    """
    keys = list(keys)
    base = df.withColumn("_bucket", bucket)
    inside = (
        Window.partitionBy(*keys, "_bucket")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = (
        Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = base.groupBy(*keys, "_bucket").agg(
        *[F.sum(source).alias(f"_{new}") for source, new in values.items()]
    )
    carried = totals.select(
        *keys,
        "_bucket",
        *[F.coalesce(F.sum(f"_{new}").over(earlier), F.lit(0)).alias(f"_{new}") for new in values.values()],
    )
    summed = base
    for source, new in values.items():
        summed = summed.withColumn(new, F.sum(source).over(inside))
    joined = summed.join(carried, [*keys, "_bucket"])
    for new in values.values():
        joined = joined.withColumn(new, F.col(new) + F.col(f"_{new}"))
    return joined.drop("_bucket", *[f"_{new}" for new in values.values()])


def asof_last(dates: DataFrame, events: DataFrame, date: str, event: str, name: str) -> DataFrame:
    """For each date the last event date that is not after it (null if there is none).

    Both sides are distinct calendar days. Days and events meet in the same calendar month; earlier
    months pass on only their last event.
    """
    days = dates.select(F.col(date).alias("_day"), F.lit(None).cast("date").alias("_event"))
    marks = events.select(F.col(event).alias("_day"), F.col(event).alias("_event"))
    both = days.unionByName(marks).withColumn("_month", F.trunc("_day", "MM"))
    # The range frame includes an event of the same day, whatever order the two rows come in.
    inside = (
        Window.partitionBy("_month")
        .orderBy(F.unix_date("_day"))
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = Window.orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    monthly = both.groupBy("_month").agg(F.max("_event").alias("_last"))
    carried = monthly.select("_month", F.max("_last").over(earlier).alias("_carried"))
    return (
        both.withColumn("_here", F.max("_event").over(inside))
        .withColumn("_is_day", F.col("_event").isNull())
        .where("_is_day")
        .join(carried, "_month")
        .select(F.col("_day").alias(date), F.coalesce("_here", "_carried").alias(name))
    )


def islands(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """Contiguous runs of days per key: first day, last day and length."""
    keys = list(keys)
    numbered = number_rows(df.select(*keys, date).distinct(), keys, date)
    run = F.date_sub(F.col(date), F.col("_seq").cast("int"))
    return (
        numbered.groupBy(*keys, run.alias("_run"))
        .agg(
            F.min(date).alias("start_date"),
            F.max(date).alias("end_date"),
            F.count(F.lit(1)).alias("gap_days"),
        )
        .drop("_run")
    )


def rank_by_value(
    df: DataFrame, keys: Sequence[str], value: str, name: str, bucket_width: float = 1.0
) -> DataFrame:
    """RANK() by descending value in each key; equal values share a rank, nulls come last.

    Rows are first counted per distinct value, so the ordered step works on values, not on rows.
    """
    keys = list(keys)
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    known = running_total(
        counted.where(F.col(value).isNotNull()).withColumn("_order", -F.col(value)),
        keys,
        "_order",
        {"_n": "_upto"},
        F.floor(F.col("_order") / bucket_width),
    ).select(*keys, value, (F.col("_upto") - F.col("_n") + 1).alias(name))
    sizes = counted.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.sum("_n").alias("_known"))
    return (
        df.join(known, [*keys, value], "left")
        .join(sizes, keys, "left")
        .withColumn(
            name,
            F.when(F.col(value).isNull(), F.coalesce("_known", F.lit(0)) + 1).otherwise(F.col(name)),
        )
        .drop("_known")
    )
