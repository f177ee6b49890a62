"""Streams with state per key, over micro-batches in any order, against plain rules."""

import random
from datetime import date, timedelta
from types import SimpleNamespace

import pytest

from barograph.operators.monitoring import alert_dedup
from barograph.queries import all_queries
from barograph.streaming import jobs, repair, stateful
from tests.test_streaming import T0, stream_of


def drained(spark, stream, label):
    return jobs.run_to_table(spark, stream, label, by_row=True).collect()


def chained(times, cooldown):
    sent = []
    for t in sorted(set(times)):
        if not sent or t - sent[-1] >= cooldown:
            sent.append(t)
    return sent


@pytest.fixture(scope="module")
def alerts():
    """Times of three keys, one of them busy, with repeats."""
    rng = random.Random(3)
    rows = [(T0 + timedelta(minutes=rng.randrange(20 * 1440), microseconds=rng.randrange(3)), rng.choice("aaaab")) for _ in range(500)]
    rows += rows[:20] + [(T0 + timedelta(days=5 * k), "c") for k in range(5)]
    rows.append((T0 + timedelta(days=40), "end"))  # moves the watermark past all others
    return rows


def dealt(rows, batches, seed):
    """The rows in batches whose times overlap by less than the watermark's delay."""
    rng = random.Random(seed)
    rows = sorted(rows, key=lambda r: (r[0] + timedelta(hours=rng.uniform(0, 40)), r[1]))
    size = -(-len(rows) // batches)
    parts = [rows[k : k + size] for k in range(0, len(rows), size)]
    for part in parts:
        rng.shuffle(part)
    return parts


def test_cooldown_over_shuffled_batches(spark, tmp_path, alerts):
    src = stream_of(spark, tmp_path, dealt(alerts, 4, 1), "ts timestamp, alert_key string")
    got = drained(spark, stateful.stream_alert_dedup(src, "alert_key", 24, "2 days"), "t-alerts")
    wanted = {(k, t) for k in "abc" for t in chained([t for t, key in alerts if key == k], timedelta(hours=24))}
    assert {(r["alert_key"], r["ts"]) for r in got} == wanted and len(got) == len(wanted)
    everything = spark.createDataFrame(alerts, "ts timestamp, alert_key string").where("alert_key <> 'end'")
    assert {tuple(r) for r in alert_dedup(everything).select("alert_key", "ts").collect()} == wanted


def test_late_rows_do_not_change_what_was_decided(spark, tmp_path):
    batches = [
        [(T0 + timedelta(hours=h), "k") for h in (1, 30)],
        [(T0 + timedelta(days=9), "k")],
        [(T0 + timedelta(hours=10), "k"), (T0 + timedelta(days=20), "k")],  # the first is late
    ]
    src = stream_of(spark, tmp_path, batches, "ts timestamp, alert_key string")
    got = drained(spark, stateful.stream_cooldown(src, "alert_key", 24, "1 day", every_row=True), "t-late")
    assert sorted((r["ts"], r["accepted"]) for r in got) == [
        (T0 + timedelta(hours=1), True), (T0 + timedelta(hours=30), True), (T0 + timedelta(days=9), True),
    ]


def test_retrains_in_cooldown_become_alerts(spark, tmp_path):
    days = [0, 3, 7, 8, 14, 15, 40]
    src = stream_of(spark, tmp_path, [[(T0 + timedelta(days=d), "m")] for d in days], "ts timestamp, model string")
    got = drained(spark, stateful.stream_retrain_cooldown(src, "model"), "t-retrain")
    actions = {(r["ts"] - T0).days: r["action"] for r in got}
    assert actions == {
        0: "trigger_retrain", 3: "alert_only", 7: "trigger_retrain", 8: "alert_only", 14: "trigger_retrain", 15: "alert_only",
    }


def test_alerts_of_the_last_day_are_decided_when_the_table_ends(spark, tmp_path):
    times = [("a", T0 + timedelta(hours=h)) for h in (0, 5, 30, 60, 61)] + [("b", T0 + timedelta(hours=61, minutes=30))]
    rows = [(n, t, n, key, 1.0) for n, (key, t) in enumerate(times)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double")
    events.write.parquet(str(tmp_path / "events.parquet"))
    got = all_queries()["stream_alert_dedup"](spark, str(tmp_path)).collect()
    wanted = {(k, t) for k in "ab" for t in chained([t for key, t in times if key == k], timedelta(hours=24))}
    assert {tuple(r) for r in got} == wanted and len(got) == len(wanted) == 4


class KeptState:
    """The state of one key in memory, counting the calls that go to the state store."""

    def __init__(self):
        self.calls, self.value, self.map, self.timers = 0, None, {}, set()

    def getValueState(self, name, schema):
        return SimpleNamespace(get=self.called(lambda: self.value), update=self.called(lambda v: setattr(self, "value", v)),
                               exists=self.called(lambda: self.value is not None))

    def getMapState(self, name, key, value):
        return SimpleNamespace(getValue=self.called(self.map.get), updateValue=self.called(self.map.__setitem__),
                               removeKey=self.called(self.map.pop))

    def called(self, step):
        def call(*args):
            self.calls += 1
            return step(*args)
        return call

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)


def judged(batches, cooldown, watermarks):
    """(time, accepted) of a key's micro-batches of times in microseconds, and the calls of its state."""
    state, out = KeptState(), []
    processor = stateful.Cooldown(cooldown, every_row=True)
    processor.init(state)
    before = 0
    for times, mark in zip([*batches, []], [*watermarks, 10**12], strict=True):
        values = SimpleNamespace(getCurrentWatermarkInMs=lambda: before)
        assert not list(processor.handleInputRows(("k",), iter([{"_t": t} for t in times]), values))
        values = SimpleNamespace(getCurrentWatermarkInMs=lambda: mark)
        for at in sorted(t for t in state.timers if t < mark):
            state.timers.discard(at)
            expired = SimpleNamespace(getExpiryTimeInMs=lambda: at)
            out += [(r["_t"], r["accepted"]) for r in processor.handleExpiredTimer(("k",), values, expired)]
        before = mark
    assert not state.map and not state.timers
    return out, state.calls


def test_calls_of_the_state_do_not_grow_with_the_hours():
    hours = [k * 7 * stateful.HOUR + 5 for k in range(300)]
    out, calls = judged([hours], 24 * stateful.HOUR, [0])
    sent = chained([t for t, _ in out], 24 * stateful.HOUR)
    assert out == [(t, t in sent) for t in hours]
    assert calls <= 10


@pytest.mark.parametrize("few, held, part", [(4096, 262_144, 65_536), (50, 64, 100), (3, 8, 24), (0, 1, 8)])
def test_busy_keys_wait_per_hour_with_the_same_result(monkeypatch, few, held, part):
    for name, value in (("FEW", few), ("HELD", held), ("PART", part)):
        monkeypatch.setattr(stateful, name, value)
    rng = random.Random(few)
    batches, marks = [], []
    for n in range(4):  # batches overlap by less than the watermark's delay
        size = 200 if n % 2 else 20
        batches.append([(10 * n + 3) * stateful.HOUR + rng.randrange(20 * stateful.HOUR) // 1000 * 1000 for _ in range(size)])
        batches[-1] += batches[-1][:5]
        marks.append(((10 * n + 13) * stateful.HOUR) // 1000 - 1)
    out, _ = judged(batches, 24 * stateful.HOUR, marks)
    times = sorted({t for batch in batches for t in batch})
    sent = chained(times, 24 * stateful.HOUR)
    assert out == [(t, t in sent) for t in times]


def test_outages_close_when_a_key_comes_back(spark, tmp_path):
    def at(day, key="a"):
        return (T0 + timedelta(days=day, hours=5), key)

    batches = [[at(2), at(0), at(0, "b")], [at(6), at(3)], [at(12), at(12, "b")], [at(30)]]
    src = stream_of(spark, tmp_path, batches, "ts timestamp, key string")
    rows = drained(spark, stateful.stream_outages(src, "key", "1 day"), "t-outages")
    first = T0.date()
    ranges = {(r["key"], (r["start_date"] - first).days, r["end_date"] and (r["end_date"] - first).days) for r in rows}
    closed = {r for r in ranges if r[2] is not None}
    assert closed == {("a", 1, 1), ("a", 4, 5), ("a", 7, 11), ("b", 1, 11)}
    assert all(r["gap_days"] == (r["end_date"] - r["start_date"]).days + 1 for r in rows if r["end_date"])
    opened = {r for r in ranges if r[2] is None}
    assert {("a", 13, None), ("b", 13, None)} <= opened
    assert all(any(o[:2] == x[:2] for x in closed) for o in opened if o[1] < 13)  # an open range ends later


def test_both_windows_equal_sums_over_the_rows(spark, tmp_path):
    rng = random.Random(5)
    rows = [(T0 + timedelta(days=rng.randrange(60), minutes=rng.randrange(1440)), rng.choice("xy"), rng.random() < 0.8, float(rng.randrange(5))) for _ in range(400)]
    rows.append((T0 + timedelta(days=90), "x", True, 1.0))
    rows.sort()
    parts = [rows[k : k + 100] for k in range(0, len(rows), 100)]
    for part in parts:
        rng.shuffle(part)
    src = stream_of(spark, tmp_path, parts, "ts timestamp, key string, good boolean, value double")
    got = {(r["key"], r["day"]): r for r in drained(spark, stateful.stream_accuracy_windows(src, "key"), "t-windows")}
    days = {(key, t.date()) for t, key, *_ in rows if t.date() < date(2026, 3, 30)}
    assert set(got) == days
    for key, day in days:
        for name, length in (("short", 7), ("long", 30)):
            inside = [(g, v) for t, k, g, v in rows if k == key and 0 <= (day - t.date()).days < length]
            row = got[key, day]
            assert row[f"n_{name}"] == len(inside)
            assert row[f"accuracy_{name}"] == pytest.approx(sum(g for g, _ in inside) / len(inside))
            assert row[f"error_{name}"] == pytest.approx(sum(v for _, v in inside) / len(inside))
        assert row["early_warning"] == (
            (row["accuracy_short"] < 0.7 or row["error_short"] > 4) and not (row["accuracy_long"] < 0.75 or row["error_long"] > 3)
        )


def test_late_days_are_counted_again(spark, tmp_path):
    def at(day, key, hour=1):
        return (T0 + timedelta(days=day, hours=hour), key)

    batches = [
        [at(0, "a"), at(0, "b"), at(1, "a"), (None, "a"), (T0, None)],
        [at(4, "a")],
        [at(0, "late"), at(0, "a", 2), at(5, "b")],
        [at(1, "late"), at(0, "later"), at(9, "a")],
    ]
    src = stream_of(spark, tmp_path, batches, "ts timestamp, city string")
    log = repair.stream_late_repair(src, "city", expected=2)
    counts = {(r["day"] - T0.date()).days: tuple(r)[1:] for r in log.counts().collect()}
    assert counts == {
        0: (4, 5, False, True), 1: (2, 2, False, True), 4: (1, 1, True, False), 5: (1, 1, True, False),
    }
    assert sorted((r["ts"].day, r["city"], r["batch"]) for r in log.late().collect()) == [
        (1, "a", 2), (1, "late", 2), (1, "later", 3), (2, "late", 3),
    ]
    assert sorted(((r["day"] - T0.date()).days, r["n_rows"], r["batch"]) for r in log.retractions().collect()) == [
        (0, 2, 1), (0, 4, 2), (1, 1, 1),
    ]
    rows = [r for batch in batches for r in batch if None not in r]
    for day, (n_keys, n_rows, *_) in counts.items():
        of_day = [key for t, key in rows if t.date() == (T0 + timedelta(days=day)).date()]
        assert (n_keys, n_rows) == (len(set(of_day)), len(of_day))
