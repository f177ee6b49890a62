"""Many run dates in one job against one date at a time, and the laws behind the drift test."""

import math
import random
import struct
from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barograph.operators import monitoring as m
from barograph.operators.quantiles import exact_quantiles, ordered_key

FIRST = date(2025, 1, 1)
RAW = "date date, city string, max_temp double, humidity_3pm double, rain_today int"
PRED = "date date, city string, rain_tomorrow int, max_temp_tomorrow double"


@pytest.fixture(scope="module")
def weather(spark):
    """Half a year of two cities; the forecasts are good, then bad for ten days, then good."""
    rng = random.Random(4)
    raw, pred = [], []
    for k in range(180):
        day = FIRST + timedelta(days=k)
        for city in "ab":
            if rng.random() < 0.05:
                continue
            warm = 25 + 5 * (k > 120) + rng.gauss(0, 3)
            raw.append((day, city, round(warm, 1), None if rng.random() < 0.1 else float(rng.randrange(100)), int(rng.random() < 0.4)))
    known = {(d, c): r for d, c, *_, r in raw}
    temps = {(d, c): t for d, c, t, *_ in raw}
    for day, city, *_ in raw:
        following = min((d for d, c in known if c == city and d > day), default=None)
        if following is None:
            continue
        bad = 60 <= (day - FIRST).days < 70
        rain = known[following, city]
        pred.append((day, city, 1 - rain if bad else rain, temps[following, city] + (9 if bad else 1)))
    return spark.createDataFrame(raw, RAW).repartition(3), spark.createDataFrame(pred, PRED)


@pytest.fixture(scope="module")
def runs(spark):
    days = [5, 33, 45, 60, 64, 66, 67, 70, 80, 100, 130, 150, 170]
    return [FIRST + timedelta(days=k) for k in days]


def frame(spark, runs):
    return spark.createDataFrame([(d,) for d in runs], "date date")


def test_drift_of_every_date_equals_the_single_date(spark, weather, runs):
    raw, _ = weather
    features = ["max_temp", "humidity_3pm"]
    got = {tuple(r) for r in m.ks_drift_history(raw, frame(spark, runs), features).collect()}
    wanted = {tuple(r) for d in runs for r in m.ks_drift(raw, d, features).collect()}
    assert got == wanted and any(r[-1] for r in got) and not all(r[-1] for r in got)


def test_metrics_of_every_date_equal_what_the_date_saw(spark, weather, runs):
    raw, pred = weather
    got = {r["date"]: r for r in m.verifiable_metrics_history(raw, pred, frame(spark, runs)).collect()}
    for run in runs:
        one = m.verifiable_metrics(raw.where(F.col("date") <= F.lit(run)), pred, run).first()
        for name in ("status", "rain_accuracy_30d", "temp_mae_30d", "rain_accuracy_7d", "temp_mae_7d"):
            assert got[run][name] == one[name], (run, name)


def test_every_action_occurs(spark, weather, runs):
    raw, pred = weather
    rules = m.RULES.__class__(features=("max_temp", "humidity_3pm"), drift_features_alert=1, drift_features_retrain=2)
    retrain = spark.createDataFrame([(FIRST + timedelta(days=65),)], "retrain_date date")
    rows = {r["date"]: r for r in m.monitoring_run(raw, pred, retrain, frame(spark, runs), rules).collect()}
    reasons = {d: r["reason_text"] for d, r in rows.items()}
    assert {r["action"] for r in rows.values()} == {"insufficient_data", "alert_only", "trigger_retrain", "no_action"}
    assert "early_warning_7d" in reasons.values() and "mild_drift_on_1_features" in reasons.values()
    assert "retrain_needed_but_cooldown_active" in reasons.values()
    early = [d for d, text in reasons.items() if text == "early_warning_7d"]
    assert all(rows[d]["early_warning"] and not rows[d]["low_accuracy"] and not rows[d]["high_mae"] for d in early)


def test_no_dates_and_no_rows(spark, weather):
    raw, pred = weather
    none = frame(spark, [])
    assert m.ks_drift_history(raw, none, ["max_temp"]).count() == 0
    assert m.verifiable_metrics_history(raw, pred, none).count() == 0
    row = m.verifiable_metrics_history(raw.where("false"), pred, frame(spark, [FIRST])).first()
    assert (row["status"], row["rain_accuracy_30d"]) == ("no_data", None)


def test_law_of_large_samples():
    # one sample of n values, to the digits of published tables
    for n, d, p in ((100, 0.1340, 0.05), (100, 0.1608, 0.01), (1000, 0.04270, 0.05)):
        size = 2 * n  # two samples of 2 n values have the effective size n
        assert m.ks_large_p(size, size, round(d * size * size)) == pytest.approx(p, rel=0.03)
    for x, p in ((0.5, 0.9639), (0.8276, 0.5), (1.3581, 0.05), (1.6276, 0.01), (1.9495, 0.001)):
        n = 10**7
        gap = round(x / math.sqrt(n / 2) * n * n)
        assert m.ks_large_p(n, n, gap) == pytest.approx(p, abs=2e-4)
    values = [m.ks_large_p(10**7, 3 * 10**6, int(k * 10**10)) for k in range(1, 400)]
    assert values == sorted(values, reverse=True) and 0 <= values[-1] < 1e-3 and 0.9 < values[0] <= 1
    assert m.ks_p(100, 90, 900) == m.ks_exact_p(100, 90, 900)
    near = m.ks_exact_p(20_000, 19_000, 4_000_000), m.ks_large_p(20_000, 19_000, 4_000_000)
    assert near[0] == pytest.approx(near[1], abs=0.005)


def doubles(bits):
    return struct.unpack("<d", struct.pack("<Q", bits))[0]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(allow_nan=True, allow_infinity=True, width=64), min_size=2, max_size=60))
def test_bucket_keys_keep_the_order(spark, values):
    edges = [s * 2.0**k * f for k in (-1074, -1022, -3, 0, 1, 52, 1023) for f in (1, 1 - 2**-53, 1 + 2**-52) for s in (1, -1)]
    df = spark.createDataFrame([(v,) for v in [*values, *edges, 0.0, -0.0, math.inf, -math.inf, math.nan]], "v double")
    for bits in (4, 12):
        keys = [r["k"] for r in df.orderBy("v").select(ordered_key("v", bits).alias("k")).collect()]
        assert keys == sorted(keys)


def test_quantiles_of_wide_and_tight_values(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    groups = {
        "tight": 1000 + rng.integers(0, 50, 3000) / 10,
        "wide": np.concatenate([rng.normal(size=500), [1e300, -1e300, 0.0, 5e-324]]),
        "same": np.full(40, -7.25),
        "dense": 1 + rng.random(4000) * 1e-6,
    }
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]
    long = spark.createDataFrame(rows, "g string, value double").repartition(5)
    got = {(r["g"], r["prob"]): r["quantile"] for r in exact_quantiles(long, ["g"], probs).collect()}
    for g, values in groups.items():
        for p in probs:
            assert got[g, p] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)
