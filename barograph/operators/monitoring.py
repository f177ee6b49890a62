"""Drift, rolling accuracy, the retrain decision, and alert suppression."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from datetime import date

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barograph.config import DEFAULTS, MonitoringRules, TrainingRules
from barograph.functions.rows import attach_row
from barograph.functions.numeric import as_int, flag, ratio, round_half_even, snap
from barograph.operators.quantiles import melt, value_buckets
from barograph.operators.sequence import asof_last, neighbour, running_total
from barograph.session import ship_package
from barograph.sources.landing import stored

RULES = DEFAULTS.monitoring
MINUTE = 60_000_000  # microseconds
c = F.col


def stale_predictions(raw: DataFrame, pred: DataFrame) -> DataFrame:
    """Cities whose newest prediction is not for their newest observation, or is missing."""
    latest_raw = raw.groupBy("city").agg(F.max("date").alias("latest_raw"))
    latest_pred = pred.groupBy("city").agg(F.max("date").alias("latest_pred"))
    return latest_raw.join(latest_pred, "city", "left").where(
        ~F.col("latest_raw").eqNullSafe(F.col("latest_pred"))
    )


def _windows(as_of: date, window: int) -> tuple[Column, Column]:
    """Membership of the recent window [t - w, t - 1] and of the baseline [t - 2w, t - w - 1]."""
    age = F.datediff(F.lit(as_of), F.col("date"))
    return age.between(1, window), age.between(window + 1, 2 * window)


def ks_exact_p(n: int, m: int, gap: int) -> float:
    """Exact two-sided p-value of two samples of n and m values whose distribution functions differ by
    ``gap / (n m)`` at most.

    Orders of the joint sample are lattice paths; those that stay inside the gap are counted column
    by column. A column is one running sum over the band inside the gap, kept in range by a factor.
    """
    a, b = sorted((n, m))
    if gap <= 0:
        return 1.0
    low, ways, log_scale = 0, np.ones(min(b, (gap - 1) // a) + 1), 0.0
    for i in range(1, a + 1):
        first, last = max(0, (i * b - gap) // a + 1), min(b, -(-(i * b + gap) // a) - 1)
        if last < first:
            return 1.0
        column = np.zeros(last - first + 1)
        known = ways[first - low : last - low + 1]
        column[: len(known)] = known
        ways, low = np.cumsum(column), first
        top = ways[-1]
        if top == 0:
            return 1.0
        ways /= top
        log_scale += math.log(top)
    if low + len(ways) - 1 < b:
        return 1.0
    inside = log_scale + math.log(ways[b - low]) + math.lgamma(a + 1) + math.lgamma(b + 1) - math.lgamma(a + b + 1)
    return min(1.0, max(0.0, -math.expm1(inside)))


#: Samples beyond this size take the law of large samples.
EXACT_SIZE = 60_000


def ks_large_p(n: int, m: int, gap: int) -> float:
    """Two-sided p-value of large samples: the law of one sample of the effective size n m / (n + m), as
    statistics packages give it, from its limit at a shifted point (the error falls with the size to
    the power 1.5). The limit is summed in the form that converges at once on either side of 1."""
    size = round(n * m / (n + m))
    x = gap / (n * m) * math.sqrt(size)
    x += 1 / (6 * math.sqrt(size)) + (x - 1) / (4 * size)
    if x <= 0:
        return 1.0
    if x > 1:
        terms = (2 * (-1) ** (k - 1) * math.exp(-2 * (k * x) ** 2) for k in range(1, 8))
        return min(1.0, max(0.0, sum(terms)))
    below = sum(math.exp(-((2 * k - 1) * math.pi / x) ** 2 / 8) for k in range(1, 8))
    return min(1.0, max(0.0, 1 - math.sqrt(2 * math.pi) / x * below))


def ks_p(n: int, m: int, gap: int) -> float:
    """The p-value of two samples: exact where the larger has at most ``EXACT_SIZE`` values."""
    return ks_exact_p(n, m, gap) if max(n, m) <= EXACT_SIZE else ks_large_p(n, m, gap)


def ks_p_values(rows: DataFrame) -> DataFrame:
    """Add ``_p`` to rows with sizes _n, _m and the largest gap _gap."""

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sizes = zip(frame["_n"], frame["_m"], frame["_gap"], strict=True)
            yield frame.assign(_p=[ks_p(int(n), int(m), int(gap)) for n, m, gap in sizes])

    ship_package(rows.sparkSession)
    return rows.mapInPandas(add, rows.withColumn("_p", F.lit(0.0)).schema)


def ks_drift(
    raw: DataFrame,
    as_of: date,
    features: Sequence[str] = RULES.features,
    window: int = RULES.drift_window_days,
    min_n: int = RULES.min_values_for_ks,
    alpha: float = RULES.ks_alpha,
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test per feature, recent window against the one before.

    Rows are reduced to counts per distinct value first; the two running counts are then taken in
    value buckets, so neither rows nor values of a feature meet in one task.
    """
    recent, baseline = _windows(as_of, window)
    long = melt(
        raw.where(recent | baseline).withColumn("_recent", recent), features, keys=["_recent"]
    )
    counts = long.groupBy("feature", "value").agg(
        F.sum(as_int(F.col("_recent"))).alias("_r"), F.sum(as_int(~F.col("_recent"))).alias("_b")
    )
    slotted = value_buckets(counts, ["feature"])
    running = running_total(
        slotted, ["feature"], "value", {"_r": "_r_upto", "_b": "_b_upto"}, F.col("_slot")
    )
    sizes = counts.groupBy("feature").agg(F.sum("_r").alias("_n"), F.sum("_b").alias("_m"))
    # |r / n - b / m| in whole numbers, times n m
    gap = F.abs(F.col("_r_upto") * F.col("_m") - F.col("_b_upto") * F.col("_n"))
    found = (
        running.join(sizes.where((F.col("_n") >= min_n) & (F.col("_m") >= min_n)), "feature")
        .groupBy("feature", "_n", "_m")
        .agg(F.max(gap).cast("long").alias("_gap"))
        .select("feature", F.col("_n").cast("long"), F.col("_m").cast("long"), "_gap")
    )
    return _ks_result(found.withColumn("date", F.lit(as_of)), alpha)


def _ks_result(found: DataFrame, alpha: float) -> DataFrame:
    """(date, feature_name, ks_stat, p_value, drifted) from sizes and gaps."""
    return (
        ks_p_values(found)
        .withColumn("_d", snap(F.col("_gap") / (F.col("_n") * F.col("_m"))))
        .select(
            "date",
            F.col("feature").alias("feature_name"),
            round_half_even("_d", 4).alias("ks_stat"),
            round_half_even("_p", 4).alias("p_value"),
            (F.col("_p") < alpha).alias("drifted"),
        )
    )


def ks_drift_history(
    raw: DataFrame,
    dates: DataFrame,
    features: Sequence[str] = RULES.features,
    window: int = RULES.drift_window_days,
    min_n: int = RULES.min_values_for_ks,
    alpha: float = RULES.ks_alpha,
) -> DataFrame:
    """:func:`ks_drift` for every distinct ``date`` of ``dates`` in one job.

    Rows are counted once per feature, value and day. The two windows of a date are differences of
    running counts over days, so they cost the same whatever the number of dates. Values are cut into
    ascending ranges; a range takes the counts of the ranges below it per date and gives its largest
    gap, so neither the values nor the rows of a feature meet in one task.
    """
    runs = dates.select("date").where("date IS NOT NULL").distinct()
    span = runs.agg(F.date_sub(F.min("date"), 2 * window).alias("_from"), F.max("date").alias("_to"))
    seen = attach_row(raw.select("date", *features), span).where("date >= _from AND date < _to")
    long = melt(seen, features, keys=["date"])
    counts = value_buckets(long.groupBy("feature", "value", "date").agg(F.count(F.lit(1)).alias("_k")), ["feature"])
    counts = stored(counts, "drift-counts")

    # per range and day, then per range and run: counts of the two windows, and those of lower ranges
    ages = F.explode(F.sequence(F.lit(1), F.lit(2 * window))).alias("_age")
    daily = counts.groupBy("feature", "_slot", "date").agg(F.sum("_k").alias("_k"))
    by_run = (
        daily.select("feature", "_slot", "_k", "date", ages)
        .withColumn("date", F.date_add("date", c("_age")))
        .join(runs, "date")
        .groupBy("feature", "date", "_slot")
        .agg(
            F.sum(F.when(c("_age") <= window, c("_k")).otherwise(0)).alias("_r"),
            F.sum(F.when(c("_age") > window, c("_k")).otherwise(0)).alias("_b"),
        )
    )
    lower = Window.partitionBy("feature", "date").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("feature", "date")
    offsets = by_run.select(
        "feature", "_slot", "date",
        F.coalesce(F.sum("_r").over(lower), F.lit(0)).alias("_r0"),
        F.coalesce(F.sum("_b").over(lower), F.lit(0)).alias("_b0"),
        F.sum("_r").over(whole).alias("_n"),
        F.sum("_b").over(whole).alias("_m"),
    ).where((c("_n") >= min_n) & (c("_m") >= min_n))

    def widest(key: tuple, rows: pd.DataFrame, at: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(at):
            return pd.DataFrame({"feature": [], "date": [], "_n": [], "_m": [], "_gap": []})
        values, place = np.unique(rows["value"].to_numpy(), return_inverse=True)
        day = rows["date"].to_numpy("datetime64[D]").astype(int)
        run = at["date"].to_numpy("datetime64[D]").astype(int)
        first = min(day.min(), run.min() - 2 * window)
        upto = np.zeros((len(values), max(day.max(), run.max()) - first + 2), np.int64)
        np.add.at(upto, (place, day - first + 1), rows["_k"].to_numpy())
        upto = upto.cumsum(axis=1)  # rows of a value before each day
        end, middle, start = (upto[:, run - shift - first] for shift in (0, window, 2 * window))
        r = (end - middle).cumsum(axis=0) + at["_r0"].to_numpy()
        b = (middle - start).cumsum(axis=0) + at["_b0"].to_numpy()
        gap = np.abs(r * at["_m"].to_numpy() - b * at["_n"].to_numpy()).max(axis=0)
        return pd.DataFrame({"feature": key[0], "date": at["date"], "_n": at["_n"], "_m": at["_m"], "_gap": gap})

    ship_package(raw.sparkSession)
    own = counts.toDF(*counts.columns)  # columns of its own, since the offsets come from the same table
    gaps = own.groupBy("feature", "_slot").cogroup(offsets.toDF(*offsets.columns).groupBy("feature", "_slot")).applyInPandas(
        widest, "feature string, date date, _n long, _m long, _gap long"
    )
    found = gaps.groupBy("feature", "date", "_n", "_m").agg(F.max("_gap").alias("_gap"))
    return _ks_result(found, alpha)


def drift_window_completeness(
    raw: DataFrame, as_of: date, n_cities: int, rules: MonitoringRules = RULES
) -> DataFrame:
    """Rows found against rows expected in both drift windows."""
    recent, baseline = _windows(as_of, rules.drift_window_days)
    expected = float(max(rules.drift_window_days * n_cities, 1))
    row = raw.where(recent | baseline).agg(
        (F.count(F.when(recent, 1)) / expected).alias("completeness_recent"),
        (F.count(F.when(baseline, 1)) / expected).alias("completeness_baseline"),
    )
    limit = rules.min_window_completeness
    low = (F.col("completeness_recent") < limit) | (F.col("completeness_baseline") < limit)
    return row.withColumn("warning", low)


def _window_rows(raw: DataFrame, pred: DataFrame, as_of: date, days: int) -> DataFrame:
    """Observations from ``days`` before the run on, each with its prediction if there is one."""
    since = F.date_sub(F.lit(as_of), days)
    said = pred.where(F.col("date") >= since).select("date", "city", "rain_tomorrow", "max_temp_tomorrow")
    return (
        raw.where(F.col("date") >= since)
        .select("date", "city", "rain_today", "max_temp")
        .join(said, ["date", "city"], "left")
    )


def verifiable_metrics(
    raw: DataFrame, pred: DataFrame, as_of: date, rules: MonitoringRules = RULES
) -> DataFrame:
    """Rain accuracy and temperature error over 30 and 7 days, checked against the next row of the
    city. One row per run; with too few rows the status is no_data."""
    rows = neighbour(
        _window_rows(raw, pred, as_of, rules.drift_window_days),
        ["city"],
        "date",
        {"rain_today": "_rained", "max_temp": "_reached"},
    )
    early = F.col("date") >= F.date_sub(F.lit(as_of), rules.early_window_days)
    hit = as_int(F.col("_rained") == F.col("rain_tomorrow")).cast("double")
    miss = F.abs(F.col("_reached") - F.col("max_temp_tomorrow"))
    n = F.col("_rows")
    enough = n >= rules.min_rows_for_metrics
    measures = rows.agg(
        F.count(F.lit(1)).alias("_rows"),
        round_half_even(F.avg(hit), 4).alias("rain_accuracy_30d"),
        round_half_even(F.avg(miss), 2).alias("temp_mae_30d"),
        round_half_even(F.avg(F.when(early, hit)), 4).alias("rain_accuracy_7d"),
        round_half_even(F.avg(F.when(early, miss)), 2).alias("temp_mae_7d"),
    )
    names = ("rain_accuracy_30d", "temp_mae_30d", "rain_accuracy_7d", "temp_mae_7d")
    short = F.format_string(
        f"insufficient_rows (%d < {rules.min_rows_for_metrics})", n
    )
    return measures.select(
        F.lit(as_of).alias("date"),
        F.when(enough, "computed").otherwise("no_data").alias("status"),
        *[F.when(enough, F.col(c)).alias(c) for c in names],
        F.when(~enough, short).alias("reason"),
    )


def verifiable_metrics_history(
    raw: DataFrame, pred: DataFrame, dates: DataFrame, rules: MonitoringRules = RULES
) -> DataFrame:
    """:func:`verifiable_metrics` as each distinct ``date`` of ``dates`` saw it, in one job: rows after the
    run, and next rows after it, are not known yet. Rows are added up per day before they meet the runs."""
    runs = dates.select("date").where("date IS NOT NULL").distinct()
    said = pred.select("date", "city", "rain_tomorrow", "max_temp_tomorrow")
    rows = neighbour(
        raw.select("date", "city", "rain_today", "max_temp").join(said, ["date", "city"], "left"),
        ["city"],
        "date",
        {"rain_today": "_rained", "max_temp": "_reached", "date": "_known"},
    )
    hit = as_int(c("_rained") == c("rain_tomorrow"))
    miss = F.abs(c("_reached") - c("max_temp_tomorrow"))
    daily = rows.groupBy("date", "_known").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum(hit).alias("_hits"),
        F.count(hit).alias("_judged"),
        F.sum(miss).alias("_miss"),
        F.count(miss).alias("_measured"),
    )
    ages = F.explode(F.sequence(F.lit(0), F.lit(rules.drift_window_days))).alias("_age")
    by_run = daily.select("*", ages).withColumn("date", F.date_add("date", c("_age"))).join(runs, "date")

    def share(total: str, n: str, days: int) -> Column:
        inside = (c("_known") <= c("date")) & (c("_age") <= days)
        return ratio(F.sum(F.when(inside, c(total))), F.sum(F.when(inside, c(n))))

    long, short = rules.drift_window_days, rules.early_window_days
    found = by_run.groupBy("date").agg(
        F.sum("_rows").alias("_rows"),
        round_half_even(share("_hits", "_judged", long), 4).alias("rain_accuracy_30d"),
        round_half_even(share("_miss", "_measured", long), 2).alias("temp_mae_30d"),
        round_half_even(share("_hits", "_judged", short), 4).alias("rain_accuracy_7d"),
        round_half_even(share("_miss", "_measured", short), 2).alias("temp_mae_7d"),
    )
    n = F.coalesce("_rows", F.lit(0))
    enough = n >= rules.min_rows_for_metrics
    names = ("rain_accuracy_30d", "temp_mae_30d", "rain_accuracy_7d", "temp_mae_7d")
    return runs.join(found, "date", "left").select(
        "date", F.when(enough, "computed").otherwise("no_data").alias("status"),
        *[F.when(enough, c(name)).alias(name) for name in names],
    )


def monitoring_run(
    raw: DataFrame, pred: DataFrame, retrain: DataFrame, dates: DataFrame, rules: MonitoringRules = RULES
) -> DataFrame:
    """The decision of every run date from what the run itself computes: both accuracy windows, drift, and
    the retrain cooldown."""
    metrics = verifiable_metrics_history(raw, pred, dates, rules)
    drift = ks_drift_history(
        raw, dates, rules.features, rules.drift_window_days, rules.min_values_for_ks, rules.ks_alpha
    )
    return monitoring_decision(metrics, drift, retrain, rules)


def prediction_coverage_gap(
    raw: DataFrame, pred: DataFrame, as_of: date, rules: MonitoringRules = RULES
) -> DataFrame:
    """How many cities have an observation without a prediction in the window."""
    rows = _window_rows(raw, pred, as_of, rules.drift_window_days)
    return rows.agg(
        F.countDistinct(F.when(F.col("rain_tomorrow").isNull(), F.col("city"))).alias(
            "cities_without_predictions"
        )
    )


def retrain_cooldown(
    retrain: DataFrame, dates: DataFrame, days: int = RULES.cooldown_days
) -> DataFrame:
    """For each run date whether the last retrain up to then is less than ``days`` old."""
    last = asof_last(
        dates, retrain.where(F.col("retrain_date").isNotNull()).select("retrain_date").distinct(),
        "date", "retrain_date", "last_retrain_date",
    )
    age = F.datediff("date", "last_retrain_date")
    return last.withColumn("in_cooldown", F.coalesce(age < days, F.lit(False)))


def monitoring_decision(
    metrics: DataFrame, drift: DataFrame, retrain: DataFrame, rules: MonitoringRules = RULES
) -> DataFrame:
    """The ordered decision rule for every run date of ``metrics``, all dates in one job.

    ``reason`` is a list when a retrain is triggered for several causes; ``reason_text`` joins it.
    """
    drifted = drift.where("drifted").groupBy("date").agg(
        F.array_sort(F.collect_set("feature_name")).alias("drifted_features")
    )
    cooldown = retrain_cooldown(retrain, metrics.select("date").distinct(), rules.cooldown_days)
    for column in ("rain_accuracy_7d", "temp_mae_7d"):
        if column not in metrics.columns:
            metrics = metrics.withColumn(column, F.lit(None).cast("double"))
    c = F.col
    n = c("n_drifted")

    def below(column: str, limit: float) -> Column:
        return F.coalesce(c(column) < limit, F.lit(False))

    def above(column: str, limit: float) -> Column:
        return F.coalesce(c(column) > limit, F.lit(False))

    flagged = (
        metrics.join(drifted, "date", "left")
        .join(cooldown, "date", "left")
        .withColumn("drifted_features", F.coalesce("drifted_features", F.array().cast("array<string>")))
        .withColumn("n_drifted", F.size("drifted_features"))
        .withColumns(
            {
                "low_accuracy": below("rain_accuracy_30d", rules.min_rain_accuracy),
                "high_mae": above("temp_mae_30d", rules.max_temp_mae),
                "heavy_drift": n >= rules.drift_features_retrain,
                "mild_drift": n.between(rules.drift_features_alert, rules.drift_features_retrain - 1),
                "early_warning": below("rain_accuracy_7d", rules.early_min_rain_accuracy)
                | above("temp_mae_7d", rules.early_max_temp_mae),
            }
        )
    )
    unknown = c("rain_accuracy_30d").isNull() & c("temp_mae_30d").isNull()
    needed = c("low_accuracy") | c("high_mae") | c("heavy_drift")
    causes = F.array_compact(
        F.array(
            F.when(
                c("low_accuracy"),
                F.format_string(
                    f"rain_accuracy %.1f%% < {rules.min_rain_accuracy * 100:.0f}%%",
                    c("rain_accuracy_30d") * 100,
                ),
            ),
            F.when(c("high_mae"), F.format_string(f"temp_mae %.2fC > {rules.max_temp_mae}C", c("temp_mae_30d"))),
            F.when(
                c("heavy_drift"),
                F.format_string(f"drift on %d features (>={rules.drift_features_retrain})", n),
            ),
        )
    )

    def outcome(action: str, reason: Column) -> Column:
        return F.struct(F.lit(action).alias("action"), reason.alias("reason"))

    def because(text: str) -> Column:
        return F.array(F.lit(text))

    decision = (
        F.when(unknown, outcome("insufficient_data", because("insufficient_data_for_metrics")))
        .when(needed & c("in_cooldown"), outcome("alert_only", because("retrain_needed_but_cooldown_active")))
        .when(needed, outcome("trigger_retrain", causes))
        .when(
            c("mild_drift"),
            outcome("alert_only", F.array(F.format_string("mild_drift_on_%d_features", n))),
        )
        .when(c("early_warning"), outcome("alert_only", because("early_warning_7d")))
        .otherwise(outcome("no_action", because("all_metrics_nominal")))
    )
    return flagged.withColumn("_d", decision).select(
        "date",
        "_d.action",
        "_d.reason",
        F.array_join("_d.reason", " | ").alias("reason_text"),
        "rain_accuracy_30d",
        "temp_mae_30d",
        "rain_accuracy_7d",
        "temp_mae_7d",
        "drifted_features",
        "n_drifted",
        "low_accuracy",
        "high_mae",
        "heavy_drift",
        "mild_drift",
        "early_warning",
        "in_cooldown",
    )


def metrics_history_append(history: DataFrame, snapshot: DataFrame) -> DataFrame:
    """History with one more run; nothing is ever removed, so a date can occur twice.

    The new row takes the next row number.
    """
    top = history.agg(F.coalesce(F.max("row_num"), F.lit(-1)).alias("_top"))
    fresh = (
        attach_row(snapshot, top)
        .withColumn("row_num", F.col("_top") + 1)
        .select(*history.columns)
    )
    return history.unionByName(fresh)


def baseline_gate(runs: DataFrame, rules: TrainingRules = DEFAULTS.training) -> DataFrame:
    """Whether new models are worse than the baseline beyond the tolerance, and why.

    ``runs`` has old_/new_ rain_accuracy and temp_mae; a missing side passes.
    """
    old_acc, new_acc = F.col("old_rain_accuracy"), F.col("new_rain_accuracy")
    old_mae, new_mae = F.col("old_temp_mae"), F.col("new_temp_mae")
    worse_rain = F.coalesce(new_acc < snap(old_acc - rules.accuracy_tolerance), F.lit(False))
    worse_temp = F.coalesce(new_mae > snap(old_mae + rules.mae_tolerance), F.lit(False))
    issues = F.array_compact(
        F.array(
            F.when(worse_rain, F.format_string("rain_accuracy degraded: %.3f vs baseline %.3f", new_acc, old_acc)),
            F.when(worse_temp, F.format_string("temp_mae degraded: %.2f vs baseline %.2f", new_mae, old_mae)),
        )
    )
    return runs.withColumn("degraded", worse_rain | worse_temp).withColumn("issues", issues)


def baseline_delta(old: DataFrame, new: DataFrame) -> DataFrame:
    """new - old for every metric both runs have."""
    return new.select("metric", F.col("value").alias("_new")).join(
        old.select("metric", F.col("value").alias("_old")), "metric"
    ).select("metric", round_half_even(F.col("_new") - F.col("_old"), 6).alias("delta"))


def _next_at_or_after(times: DataFrame, wait: int) -> DataFrame:
    """(alert_key, _t, _next): the first time of the key that is at least ``wait`` after ``_t``.

    Times and the moments asked for meet in the same minute; a moment whose minute has no later time
    takes the first time of the next minute of its hour that has any, and so on over hours. So no
    task sees more than the times of a key and minute, the minutes of a key and hour, or the hours of
    a key.
    """
    both = times.select("alert_key", c("_t").alias("_v"), F.lit(None).cast("long").alias("_from")).unionByName(
        times.select("alert_key", (c("_t") + wait).alias("_v"), c("_t").alias("_from"))
    )
    is_time = F.when(c("_from").isNull(), c("_v"))
    both = both.withColumns({"_minute": F.floor(c("_v") / MINUTE), "_hour": F.floor(c("_v") / (60 * MINUTE))})
    inside = Window.partitionBy("alert_key", "_minute").orderBy(F.desc("_v")).rangeBetween(Window.unboundedPreceding, 0)
    asked = both.withColumn("_next", F.min(is_time).over(inside)).where("_from IS NOT NULL")

    minutes = both.groupBy("alert_key", "_hour", "_minute").agg(F.min(is_time).alias("_first"))
    later = (
        Window.partitionBy("alert_key", "_hour").orderBy(F.desc("_minute")).rowsBetween(Window.unboundedPreceding, -1)
    )
    after_minute = minutes.withColumn("_in_hour", F.min("_first").over(later))
    hours = minutes.groupBy("alert_key", "_hour").agg(F.min("_first").alias("_first"))
    later = Window.partitionBy("alert_key").orderBy(F.desc("_hour")).rowsBetween(Window.unboundedPreceding, -1)
    after_hour = hours.select("alert_key", "_hour", F.min("_first").over(later).alias("_after_hour"))
    return (
        asked.join(after_minute.select("alert_key", "_minute", "_in_hour"), ["alert_key", "_minute"])
        .join(after_hour, ["alert_key", "_hour"])
        .select("alert_key", c("_from").alias("_t"), F.coalesce("_next", "_in_hour", "_after_hour").alias("_next"))
    )


def alert_dedup(alerts: DataFrame, cooldown_hours: int = 24) -> DataFrame:
    """(alert_key, ts) that are sent: one is silenced for 24 h after the last one that was *sent*.

    Every alert points at the first one that may follow it. The alerts sent are those on the chain from
    the first alert of a key; it is marked in rounds that double the length of the pointers, so the
    number of rounds is the logarithm of the longest chain, whatever a key's number of alerts. Each
    round is one stored table. Rows without a key or time are skipped; repeated times count once.
    """
    wait = cooldown_hours * 60 * MINUTE
    times = (
        alerts.select("alert_key", F.unix_micros(c("ts").cast("timestamp")).alias("_t"))
        .where("alert_key IS NOT NULL AND _t IS NOT NULL")
        .distinct()
    )
    times = stored(times, "alert-times")
    spans = times.groupBy("alert_key").agg(F.min("_t").alias("_start"), F.max("_t").alias("_end"))
    longest = spans.agg(F.max(F.floor((c("_end") - c("_start")) / wait))).first()[0] or 0
    rows = _next_at_or_after(times, wait).join(spans.drop("_end"), "alert_key")
    rows = stored(rows.select("alert_key", "_t", "_next", (c("_t") == c("_start")).alias("_sent")), "alert-chains")
    for _ in range(int(longest).bit_length()):  # chains have at most longest + 1 alerts
        far = rows.select("alert_key", c("_t").alias("_next"), c("_next").alias("_far"))
        reached = rows.where("_sent AND _next IS NOT NULL").select("alert_key", c("_next").alias("_t"))
        marked = reached.distinct().withColumn("_reached", F.lit(True))
        rows = stored(
            rows.join(far, ["alert_key", "_next"], "left")
            .join(marked, ["alert_key", "_t"], "left")
            .select("alert_key", "_t", c("_far").alias("_next"), (c("_sent") | c("_reached").isNotNull()).alias("_sent")),
            "alert-chains",
        )
    return rows.where("_sent").select("alert_key", F.timestamp_micros("_t").alias("ts"))
