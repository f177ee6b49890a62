"""Streaming jobs whose state is kept in the state store and moved on by event-time timers.

Rows wait in the state until the watermark has passed their hour; then a timer hands them over in
order. So a result does not depend on the order of arrival. The few waiting rows of a usual key are one
entry of the state with one timer; those of a busy key are entries per hour, and no task ever holds more
than ``HELD`` rows or the rows of one key and hour. Rows whose hour the watermark has passed are dropped.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from barograph.config import DEFAULTS
from barograph.operators.monitoring import RULES
from barograph.session import ship_package

c = F.col
HOUR = 3_600_000_000
DAY_MS = 86_400_000
#: Times that a key may leave waiting in its one entry; with more it has entries per hour.
FEW = 4096
#: Rows of one micro-batch that are held before they go to the entries per hour.
HELD = 262_144
#: Bytes of an entry that is closed; later times of its hour start another one.
PART = 65_536

_HEAD = T.StructType(
    [T.StructField("last", T.LongType()), T.StructField("hours", T.LongType()), T.StructField("few", T.BinaryType())]
)
_SLOT = T.StructType([T.StructField("hour", T.LongType()), T.StructField("part", T.LongType())])
_TIMES = T.StructType([T.StructField("times", T.BinaryType()), T.StructField("parts", T.LongType())])
_LAST = T.StructType([T.StructField("last", T.LongType())])


def _end_of_hour(time: int) -> int:
    return (time // HOUR + 1) * HOUR


class Cooldown(StatefulProcessor):
    """Times of a key, each accepted unless it follows the last accepted one within the cooldown. The
    state is that time and the waiting times. Repeated times count once.

    Waiting times are packed into the head of the key, with a timer at the end of the first hour, so a key
    costs a few calls of the state per micro-batch, whatever hours its rows have. Beyond ``FEW`` they are
    parked per hour, each with its timer, in parts that are written once when they are full. A key has
    either ``few`` times or parked ``hours``, never both.
    """

    def __init__(self, cooldown: int, every_row: bool):
        self.cooldown = cooldown
        self.every_row = every_row

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", _HEAD)
        self.parked = handle.getMapState("parked", _SLOT, _TIMES)

    def _head(self) -> tuple[int | None, int, array]:
        head = self.head.get()
        return (head[0], head[1], array("q", bytes(head[2]))) if head else (None, 0, array("q"))

    def _wake(self, end_of_hour: int) -> None:
        self.handle.registerTimer(end_of_hour // 1000)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        last, hours, waiting = self._head()
        for row in rows:
            if _end_of_hour(row["_t"]) <= passed:  # late: its hour is decided
                continue
            waiting.append(row["_t"])
            if len(waiting) == HELD:
                hours += self._park(waiting)
                waiting = array("q")
        if waiting and (hours or len(waiting) > FEW):
            hours += self._park(waiting)
            waiting = array("q")
        if waiting:
            self._wake(_end_of_hour(min(waiting)))
        if waiting or hours:
            self.head.update((last, hours, waiting.tobytes()))
        return iter(())

    def _park(self, times: array) -> int:
        """Add times to the entries of their hours; how many hours are new."""
        by_hour: dict[int, array] = defaultdict(lambda: array("q"))
        for time in times:
            by_hour[time // HOUR].append(time)
        fresh = 0
        for hour, some in by_hour.items():
            known = self.parked.getValue((hour, 0))
            if not known:
                fresh += 1
                self._wake((hour + 1) * HOUR)
            packed, parts = (bytes(known[0]), known[1]) if known else (b"", 0)
            packed += some.tobytes()
            if len(packed) >= PART:
                parts += 1
                self.parked.updateValue((hour, parts), (packed, 0))
                packed = b""
            self.parked.updateValue((hour, 0), (packed, parts))
        return fresh

    def _taken(self, hour: int) -> array:
        """The parked times of an hour, which leave the state."""
        packed, parts = self.parked.getValue((hour, 0))
        times = array("q", bytes(packed))
        for part in range(1, parts + 1):
            times.frombytes(bytes(self.parked.getValue((hour, part))[0]))
        for part in range(parts + 1):
            self.parked.removeKey((hour, part))
        return times

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        last, hours, waiting = self._head()
        if hours:
            due = self._taken(expiredTimerInfo.getExpiryTimeInMs() * 1000 // HOUR - 1)
            hours -= 1
        else:  # all that is due, at the first of its timers
            passed = timerValues.getCurrentWatermarkInMs() * 1000
            due = [time for time in waiting if _end_of_hour(time) < passed]
            if not due:
                return
            waiting = array("q", [time for time in waiting if _end_of_hour(time) >= passed])
            if waiting:
                self._wake(_end_of_hour(min(waiting)))
        for time in sorted(set(due)):
            accepted = last is None or time - last >= self.cooldown
            if accepted:
                last = time
            if accepted or self.every_row:
                yield Row(key=key[0], _t=time, accepted=accepted)
        self.head.update((last, hours, waiting.tobytes()))

    def close(self) -> None:
        pass


def stream_cooldown(
    src: DataFrame, key: str, cooldown_hours: int, watermark: str = "1 day", every_row: bool = False
) -> DataFrame:
    """(key, ts, accepted) of a stream with an event time ``ts``: the accepted times of each key or, with
    ``every_row``, all. A time is decided once the watermark has passed its hour."""
    ship_package(src.sparkSession)
    rows = src.withWatermark("ts", watermark).select(
        c(key).cast("string").alias("key"), "ts", F.unix_micros("ts").alias("_t")
    )
    schema = "key string, _t long, accepted boolean"
    decided = rows.groupBy("key").transformWithState(
        Cooldown(cooldown_hours * HOUR, every_row), T.StructType.fromDDL(schema), "append", "eventTime"
    )
    return decided.select("key", F.timestamp_micros("_t").alias("ts"), "accepted")


def stream_alert_dedup(src: DataFrame, key: str, cooldown_hours: int = 24, watermark: str = "1 day") -> DataFrame:
    """(alert_key, ts) of the alerts that are sent: one is silenced for a while after the last one that
    was sent."""
    return stream_cooldown(src, key, cooldown_hours, watermark).select(c("key").alias("alert_key"), "ts")


def stream_retrain_cooldown(
    src: DataFrame, model: str, days: int = RULES.cooldown_days, watermark: str = "1 day"
) -> DataFrame:
    """(model, ts, action) of a stream of retrain triggers: a trigger within ``days`` of the last retrain
    of its model is downgraded to an alert."""
    decided = stream_cooldown(src, model, 24 * days, watermark, every_row=True)
    action = F.when(c("accepted"), "trigger_retrain").otherwise("alert_only")
    return decided.select(c("key").alias("model"), "ts", action.alias("action"))


# ---------------------------------------------------------------- days


def _closed_days(src: DataFrame, keys: list, watermark: str, **measures) -> DataFrame:
    """One row per key and day, once the watermark has passed the day."""
    measures = {"n": F.count(F.lit(1)), **measures}
    return (
        src.withWatermark("ts", watermark)
        .groupBy(F.window("ts", "1 day").alias("day"), *keys)
        .agg(*[value.alias(name) for name, value in measures.items()])
        .withColumn("at", F.window_time("day"))
        .withColumn("d", F.unix_date(F.to_date("day.start")).cast("long"))
        .drop("day")
    )


class Outages(StatefulProcessor):
    """Days without rows between days with rows; the state is the last day with rows."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", _LAST)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last = self.last.get()[0] if self.last.exists() else None
        if last is not None:  # the open range is no longer open, or no range at all
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
        for day in sorted(row["d"] for row in rows):  # at most one row per day
            if last is not None and day > last + 1:
                yield Row(key=key[0], start=last + 1, end=day - 1)
            last = day
        self.last.update((last,))
        # the day after the last one is over, and Spark has handed over its rows if there are any
        self.handle.registerTimer((last + 2) * DAY_MS + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield Row(key=key[0], start=self.last.get()[0] + 1, end=None)

    def close(self) -> None:
        pass


def stream_outages(src: DataFrame, key: str, watermark: str = "1 day") -> DataFrame:
    """(key, start_date, end_date, gap_days): ranges of days without rows of a key.

    Two chained operators: days with rows close behind the watermark, then the last such day of a key
    meets the next one. A range that has not ended when the watermark passes its first day is
    emitted without an end, once; the whole range follows when the key comes back.
    """
    ship_package(src.sparkSession)
    days = _closed_days(src, [c(key).cast("string").alias("key")], watermark)
    schema = T.StructType.fromDDL("key string, start long, end long")
    found = days.select("key", "d", "at").groupBy("key").transformWithState(
        Outages(), schema, "append", "eventTime"
    )

    def as_date(name: str):
        return F.date_from_unix_date(c(name).cast("int"))

    return found.select(
        c("key").alias(key),
        as_date("start").alias("start_date"),
        as_date("end").alias("end_date"),
        (c("end") - c("start") + 1).alias("gap_days"),
    )


_DAY_KEY = T.StructType([T.StructField("d", T.LongType())])
_SUMS = T.StructType(
    [T.StructField("n", T.LongType()), T.StructField("hits", T.LongType()), T.StructField("error", T.DoubleType())]
)


class TwoWindows(StatefulProcessor):
    """Sums per day of the longer window, as a ring: entry d modulo its length."""

    def __init__(self, short: int, long: int):
        self.short, self.long = short, long

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.days = handle.getMapState("days", _DAY_KEY, T.StructType([T.StructField("day", T.LongType()), *_SUMS.fields]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        ring = {slot[0]: tuple(value) for slot, value in self.days.iterator()}
        for row in sorted(rows, key=lambda row: row["d"]):  # at most one row per day
            entry = (row["d"], row["n"], row["hits"], row["error"])
            ring[row["d"] % self.long] = entry
            self.days.updateValue((row["d"] % self.long,), entry)
            out = {"key": key[0], "d": row["d"]}
            for name, length in (("short", self.short), ("long", self.long)):
                inside = sorted(x for x in ring.values() if x[0] > row["d"] - length)
                n = sum(x[1] for x in inside)
                out |= {
                    f"n_{name}": n,
                    f"accuracy_{name}": sum(x[2] for x in inside) / n,
                    f"error_{name}": sum(x[3] for x in inside) / n,
                }
            yield Row(**out)

    def close(self) -> None:
        pass


def stream_accuracy_windows(
    src: DataFrame, key: str, short: int = RULES.early_window_days, long: int = RULES.drift_window_days,
    watermark: str = "1 day", rules=DEFAULTS.monitoring,
) -> DataFrame:
    """Share of good rows and mean of ``value`` over the last 7 and 30 days, one row per key and closed
    day with rows, and the warning of :func:`monitoring_decision` when only the short window is bad.

    A row enters one sum per day; the windows are sums over at most 30 such sums in one state.
    """
    ship_package(src.sparkSession)
    days = _closed_days(
        src, [c(key).cast("string").alias("key")], watermark,
        hits=F.sum(c("good").cast("long")), error=F.sum("value"),
    )
    measures = "n_short long, accuracy_short double, error_short double, n_long long, accuracy_long double, error_long double"
    found = days.groupBy("key").transformWithState(
        TwoWindows(short, long), T.StructType.fromDDL(f"key string, d long, {measures}"), "append", "eventTime"
    )
    bad = (c("accuracy_long") < rules.min_rain_accuracy) | (c("error_long") > rules.max_temp_mae)
    early = (c("accuracy_short") < rules.early_min_rain_accuracy) | (c("error_short") > rules.early_max_temp_mae)
    names = [part.split()[0] for part in measures.split(", ")]
    return found.select(
        c("key").alias(key), F.date_from_unix_date(c("d").cast("int")).alias("day"), *names,
        early.alias("early"), (early & ~bad).alias("early_warning"),
    )

