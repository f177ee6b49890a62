"""Worked examples of the weather rules, the decision rule and the gate."""

from datetime import date

import pytest
from pyspark.sql import types as T

from barograph import schemas
from barograph.functions import calendar as cal
from barograph.functions import numeric as n
from barograph.functions import weather as w
from barograph.operators import features as f
from barograph.operators import monitoring as m

WEATHER = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in ("max_temp", "humidity_3pm", "wind_gust_speed")]
    + [T.StructField("rain_today", T.IntegerType()), T.StructField("sunshine_hours", T.DoubleType())]
)


def test_wmo_codes(spark):
    codes = {0: "Sunny", 2: "Sunny", 45: "Cloudy", 51: "Rainy", 80: "Rainy", 95: "Stormy", 99: "Stormy",
             3: "Sunny", 71: "Sunny", 85: "Rainy", None: "Unknown"}
    df = spark.createDataFrame([(c,) for c in codes], "code int")
    got = {r["code"]: r["kind"] for r in df.withColumn("kind", w.weather_type("code")).collect()}
    assert got == codes


@pytest.mark.parametrize(
    "row, low, high",
    [
        ((22.0, 50.0, 10.0, 0, 8.0), 90.0, 100.0),
        ((45.0, 90.0, 60.0, 1, 0.0), 0.0, 50.0),
        ((-10.0, 100.0, 100.0, 1, 0.0), 0.0, 0.0),
        ((None, None, None, None, None), 100.0, 100.0),
    ],
)
def test_comfort(spark, row, low, high):
    df = spark.createDataFrame([row], WEATHER)
    assert low <= df.select(w.comfort_score()).first()[0] <= high


def test_comfort_penalties_by_hand(spark):
    df = spark.createDataFrame([(40.0, 90.0, 30.0, 1, 9.0), (5.0, 20.0, 55.0, 0, 7.0)], WEATHER)
    # 100 - 2*4 - 5*0.6 - 5*0.3 - 15 + 4 ; 100 - 5*3.5 - 5*0.4 - 5*0.5
    assert [r[0] for r in df.select(w.comfort_score()).collect()] == [76.5, 78.0]


def test_compass_half_sectors_go_even(spark):
    df = spark.createDataFrame([(0.0,), (11.25,), (33.75,), (359.0,), (180.0,), (None,)], "d double")
    assert [r[0] for r in df.select(w.compass("d")).collect()] == ["N", "N", "NE", "N", "S", None]


def test_numbers(spark):
    df = spark.createDataFrame([(0.285, 2.5), (1.005, 3.5), (-0.125, -2.5)], "a double, b double")
    got = df.select(n.round_half_up("a", 2), n.round_half_even("b", 0)).collect()
    # 0.285 and 1.005 are stored below the half, -0.125 is exactly on it.
    assert [tuple(r) for r in got] == [(0.28, 2.0), (1.0, 4.0), (-0.13, -2.0)]
    bad = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.5,), (None,)], "x double")
    assert [r[0] for r in bad.select(n.finite("x")).collect()] == [None, None, 1.5, None]
    zero = spark.createDataFrame([(1.0, 0.0)], "a double, b double")
    assert zero.select(n.ratio("a", "b")).first()[0] is None


def test_calendar(spark):
    df = spark.createDataFrame([(date(2021, 1, 3),), (date(2020, 12, 31),), (date(2018, 12, 31),)], "d date")
    got = [tuple(r) for r in df.select(cal.iso_year_week("d"), cal.season("d"), cal.season("d", northern=True)).collect()]
    assert got == [("2020-W53", "Summer", "Winter"), ("2020-W53", "Summer", "Winter"), ("2019-W01", "Summer", "Winter")]


@pytest.fixture(scope="module")
def ten_days(spark):
    temps = [25.0, 26.0, 28.0, 38.0, 39.0, 24.0, 20.0, 18.0, 15.0, 30.0]
    rows = []
    for i, t in enumerate(temps):
        row = {c: 10.0 for c in schemas.RAW_NUMBERS} | {c: "N" for c in schemas.RAW_TEXTS}
        row |= {"date": date(2023, 1, i + 1), "city": "A", "max_temp": t, "min_temp": 1.0 if i == 4 else 12.0,
                "rainfall": 5.0 if i == 2 else 0.0, "precipitation_hours": 3.0 if i == 2 else 0.0,
                "rain_today": int(i == 2), "weather_code": 61 if i == 2 else 0, "wind_gust_speed": 30.0}
        rows.append(tuple(row[c] for c in schemas.RAW_COLUMNS))
    return spark.createDataFrame(rows, schemas.WEATHER_RAW)


def test_feature_frame(ten_days):
    kept = f.feature_frame(ten_days, keep_last=True).orderBy("date").collect()
    assert len(kept) == 10 and f.feature_frame(ten_days).count() == 9
    assert kept[2]["rainfall_intensity"] == pytest.approx(5 / 3)
    assert kept[1]["rain_tomorrow"] == 1 and kept[1]["weather_type_tomorrow"] == "Rainy"
    assert sum(r["frost_risk"] for r in kept) == 1 and kept[3]["frost_risk"] == 1
    assert kept[3]["heatwave_risk"] == 1 and kept[2]["heatwave_risk"] == 0
    assert [r["consec_hot_days"] for r in kept][3:7] == [1, 2, 2, 1]
    last = kept[-1]
    assert (last["max_temp_tomorrow"], last["weather_type_tomorrow"], last["rain_tomorrow"]) == (None, "Unknown", 0)
    assert kept[2]["max_temp_rolling7"] is None and kept[3]["max_temp_rolling7"] == pytest.approx(79 / 3)


def test_codes_of_training_are_reused(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "city string")
    encoded, mapping = f.encode_categoricals(train, ["city"])
    assert sorted(r[0] for r in encoded.collect()) == [-1, 0, 1]
    score, _ = f.encode_categoricals(spark.createDataFrame([("b",), ("new",)], "city string"), ["city"], mapping)
    assert sorted(r[0] for r in score.collect()) == [-1, 1]


def decide(spark, acc, mae, drifted=0, retrained=None, acc7=None, mae7=None):
    day = date(2026, 5, 10)
    metrics = spark.createDataFrame(
        [(day, acc, mae, acc7, mae7)],
        "date date, rain_accuracy_30d double, temp_mae_30d double, rain_accuracy_7d double, temp_mae_7d double",
    )
    drift = spark.createDataFrame(
        [(day, f"f{i}", 0.1, 0.01, True) for i in range(drifted)] + [(day, "calm", 0.0, 0.9, False)], schemas.DRIFT_REPORTS
    )
    retrain = spark.createDataFrame([(retrained, "", "x")] if retrained else [], schemas.RETRAIN_EVENTS)
    row = m.monitoring_decision(metrics, drift, retrain).first()
    return row["action"], row["reason_text"]


def test_decision_branches(spark):
    assert decide(spark, 0.85, 2.0, drifted=3) == ("alert_only", "mild_drift_on_3_features")
    action, reason = decide(spark, 0.85, 2.0, drifted=4)
    assert action == "trigger_retrain" and "drift on 4 features" in reason
    assert decide(spark, None, None) == ("insufficient_data", "insufficient_data_for_metrics")
    assert decide(spark, 0.70, 2.0) == ("trigger_retrain", "rain_accuracy 70.0% < 75%")
    assert decide(spark, 0.70, 2.0, retrained=date(2026, 5, 5)) == ("alert_only", "retrain_needed_but_cooldown_active")
    assert decide(spark, 0.70, 2.0, retrained=date(2026, 5, 3))[0] == "trigger_retrain"
    assert decide(spark, 0.85, 3.5) == ("trigger_retrain", "temp_mae 3.50C > 3.0C")
    assert decide(spark, 0.85, 2.0) == ("no_action", "all_metrics_nominal")
    assert decide(spark, 0.85, 2.0, acc7=0.65) == ("alert_only", "early_warning_7d")
    assert decide(spark, 0.85, 2.0, mae7=4.5) == ("alert_only", "early_warning_7d")


def test_baseline_gate(spark):
    runs = spark.createDataFrame(
        [(0.77, 0.76, 1.6, 1.7), (0.77, 0.74, 1.6, 1.6), (0.77, 0.77, 1.6, 1.9), (None, 0.7, 1.6, None)],
        "old_rain_accuracy double, new_rain_accuracy double, old_temp_mae double, new_temp_mae double",
    )
    assert [r["degraded"] for r in m.baseline_gate(runs).collect()] == [False, True, True, False]


def test_metrics_need_thirty_rows(spark):
    raw = spark.createDataFrame([(date(2026, 5, 1), "A", 1, 20.0)], "date date, city string, rain_today int, max_temp double")
    pred = spark.createDataFrame(
        [(date(2026, 5, 1), "A", 1, 20.0)], "date date, city string, rain_tomorrow int, max_temp_tomorrow double"
    )
    row = m.verifiable_metrics(raw, pred, date(2026, 5, 10)).first()
    assert (row["status"], row["reason"], row["rain_accuracy_30d"]) == ("no_data", "insufficient_rows (1 < 30)", None)


def test_alert_dedup_against_a_plain_fold(spark):
    import random
    from datetime import datetime, timedelta

    rng = random.Random(5)
    start = datetime(2026, 1, 1)
    alerts = []
    for key, count, step in (("busy", 1500, 60), ("rare", 20, 4000), ("once", 1, 1)):
        t = start
        for _ in range(count):
            t += timedelta(minutes=rng.randint(0, step))
            alerts.append((key, t))
    wanted, last = [], {}
    for key, t in sorted(set(alerts), key=lambda a: a[1]):
        if key not in last or t - last[key] >= timedelta(hours=24):
            last[key] = t
            wanted.append((key, t))
    df = spark.createDataFrame(alerts, "alert_key string, ts timestamp")
    assert sorted(map(tuple, m.alert_dedup(df).collect())) == sorted(wanted)


def test_exact_ks_p_values():
    from itertools import combinations

    from barograph.operators.monitoring import ks_exact_p

    def counted(n, m, gap):
        """Over all orders of the joint sample."""
        hits = total = 0
        for places in combinations(range(n + m), n):
            x = y = most = 0
            for k in range(n + m):
                x, y = (x + 1, y) if k in places else (x, y + 1)
                most = max(most, abs(x * m - y * n))
            hits, total = hits + (most >= gap), total + 1
        return hits / total

    assert round(ks_exact_p(10, 10, 60), 4) == 0.0524
    for n, m in ((3, 3), (4, 6), (5, 7), (6, 4)):
        for gap in range(0, n * m + 1):
            assert abs(ks_exact_p(n, m, gap) - counted(n, m, gap)) < 1e-12
    assert round(ks_exact_p(750, 750, 51 * 750), 4) == 0.0623
    assert ks_exact_p(20_000, 20_000, 20_000 * 20_000) == 1.0 - 0.0 or ks_exact_p(20_000, 20_000, 20_000**2) <= 1e-12


def test_exploration_keeps_every_value(spark):
    from datetime import date

    from barograph.operators import explore as e

    rows = spark.createDataFrame(
        [(date(1980, 1, 1), "Elsewhere", -20.0), (date(2030, 1, 1), "NATION_1", 5.0), (date(2030, 1, 2), "NATION_1", 60.0),
         (date(2030, 1, 3), "NATION_1", None)],
        "date date, city string, t double",
    )
    assert sorted((r["bin"], r["n"]) for r in e.histogram(rows, "t", 4).collect()) == [(0, 1), (1, 1), (3, 1)]
    beyond = {r["bin"]: r["n"] for r in e.histogram(rows, "t", 5, low=-5.0, high=45.0).collect()}
    assert beyond == {-1: 1, 1: 1, 5: 1}
    assert e.log_histogram(rows, "t", 3).agg({"n": "sum"}).first()[0] == 2
    assert set(e.pivot_city_year(rows).columns) == {"city", "1980", "2030"}
    assert set(e.pivot_city_date(rows, "t").columns) == {"date", "Elsewhere", "NATION_1"}
    same = spark.createDataFrame([(2.0,), (2.0,)], "t double")
    assert [(r["bin"], r["n"]) for r in e.histogram(same, "t", 3).collect()] == [(0, 2)]


def test_student_p_values():
    from barograph.functions.numeric import student_p

    # published two-sided values
    for t, dof, p in ((2.228, 10, 0.05), (12.706, 1, 0.05), (1.96, 1e7, 0.05), (3.169, 10, 0.01), (0.0, 5, 1.0), (-2.776, 4, 0.05)):
        assert abs(student_p(t, dof) - p) < 5e-5
    assert student_p(60.0, 20_000) < 1e-12
