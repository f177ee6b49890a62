"""Boosted trees against a plain booster, and the registered training queries."""

import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from barograph import queries
from barograph.operators import boosting as b
from barograph.query_sets import learning

NAMES = [f"x{i}" for i in range(6)]


def sample(n=300, seed=1, classes=0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, len(NAMES))), 1)
    signal = x[:, 0] - x[:, 1] * x[:, 2] + rng.normal(size=n) / 2
    y = np.digitize(signal, [-0.5, 0.5]).astype(float) if classes else (signal > 0).astype(float)
    keys = rng.integers(-(2**62), 2**62, n)
    return x, y, rng.integers(1, 4, n).astype(float), keys


def table(spark, x, y, w, keys, parts):
    rows = [(int(k), [float(v) for v in r], float(a), float(e)) for k, r, a, e in zip(keys, x, y, w, strict=True)]
    return spark.createDataFrame(rows, "key long, features array<double>, y double, w double").repartition(parts)


def plain_booster(bins, y, w, keys, objective, rules):
    """Row by row and node by node: sums, gains and leaves written out."""
    n, n_bins = len(y), rules.bins
    margins = [list(objective.base) for _ in range(n)]
    unit = b.UNIT * objective.scale
    out = []
    for number in range(rules.rounds):
        g, h = objective.gradients(np.array(margins), y, w)
        g, h = np.rint(g / unit).astype(int).tolist(), np.rint(h / unit).astype(int).tolist()
        used = b.row_sample(keys, number, rules).tolist()
        trees = []
        for k in range(objective.outputs):
            columns = b.tree_columns(len(bins), number, k, rules).tolist()
            splits, leaves = {}, {}

            def grow(rows, node, level, k=k, columns=columns, splits=splits, leaves=leaves):
                seen = [i for i in rows if used[i]]
                total = [sum(g[i][k] for i in seen) * unit, sum(h[i][k] for i in seen) * unit]
                best = (b.LEAST_GAIN, None, None)
                if level < rules.depth:
                    for column in columns:
                        for cut in range(n_bins):
                            left = [i for i in seen if bins[column][i] <= cut]
                            lg, lh = sum(g[i][k] for i in left) * unit, sum(h[i][k] for i in left) * unit
                            rg, rh = total[0] - lg, total[1] - lh
                            if lh < rules.least_hessian or rh < rules.least_hessian:
                                continue
                            gain = lg**2 / (lh + rules.l2) + rg**2 / (rh + rules.l2) - total[0] ** 2 / (total[1] + rules.l2)
                            if gain > best[0] * (1 + 1e-12):
                                best = (gain, column, cut)
                if best[1] is None:
                    for i in rows:
                        leaves[i] = -rules.learning_rate * total[0] / (total[1] + rules.l2)
                    return
                splits[level, node] = best[1:]
                grow([i for i in rows if bins[best[1]][i] <= best[2]], 2 * node, level + 1)
                grow([i for i in rows if bins[best[1]][i] > best[2]], 2 * node + 1, level + 1)

            grow(range(n), 0, 0)
            for i in range(n):
                margins[i][k] += leaves[i]
            trees.append(splits)
        out.append(trees)
    return out, np.array(margins)


def splits_of(tree):
    found = {}
    for at in np.flatnonzero(tree.gains > 0):
        level = int(at + 1).bit_length() - 1
        found[level, int(at) - (1 << level) + 1] = (int(tree.columns[at]), int(tree.bins[at]))
    return found


@pytest.mark.parametrize("kind", ["binary", "regression", "classes"])
def test_trees_equal_a_plain_booster_and_do_not_depend_on_the_way(spark, kind):
    x, y, w, keys = sample(160, classes=3 if kind == "classes" else 0)
    if kind == "regression":
        y = y * 7 + x[:, 3]
    if kind != "binary":
        w = np.ones(len(y))
    rules = b.BoostRules(rounds=4, depth=3, bins=8, learning_rate=0.3, in_task_rows=10**6, kept_rounds=2)
    rows = table(spark, x, y, w, keys, 3)
    limits = b.column_limits(rows, "features", NAMES, rules.bins)
    binned = b.with_bins(rows, "features", limits)
    objective = b.objective_of(binned, kind, 3)
    here = b.boosted(binned, NAMES, limits, objective, rules)
    spread = b.boosted(binned, NAMES, limits, objective, replace(rules, in_task_rows=5))
    bins = b.binned(x, limits)
    wanted, margins = plain_booster(bins, y, w, keys, objective, rules)
    for ours, others, plain in zip(here.rounds, spread.rounds, wanted, strict=True):
        for tree, other, splits in zip(ours, others, plain, strict=True):
            assert splits_of(tree) == splits
            for part in ("columns", "bins", "leaves", "gains"):
                assert np.array_equal(getattr(tree, part), getattr(other, part))
    assert np.allclose(here.predicted(bins), objective.predicted(margins), atol=1e-12)


def test_bins_follow_limits(spark):
    x, y, w, keys = sample(500)
    x[:, 4] = 3.0
    rows = table(spark, x, y, w, keys, 4)
    limits = b.column_limits(rows, "features", NAMES, 16)
    assert len(limits[4]) == 0 and all(len(limit) <= 15 and (np.diff(limit) > 0).all() for limit in limits)
    got = {r["key"]: list(r["bins"]) for r in b.with_bins(rows, "features", limits).collect()}
    for key, row in zip(keys.tolist(), x.tolist(), strict=True):
        assert got[key] == [sum(limit < value for limit in limits[i].tolist()) for i, value in enumerate(row)]
    counts = np.bincount(b.binned(x, limits)[0], minlength=16)
    assert counts.max() < 3 * len(x) / 16  # quantiles: no bin takes most rows


def test_predictions_learn_the_signal(spark):
    x, y, w, keys = sample(2000, seed=3)
    rows = table(spark, x, y, np.ones(len(y)), keys, 4)
    limits = b.column_limits(rows, "features", NAMES, 32)
    binned = b.with_bins(rows, "features", limits)
    model = b.boosted(binned, NAMES, limits, b.objective_of(binned, "binary"), b.BoostRules(rounds=40, depth=4, bins=32))
    fresh = sample(1000, seed=4)
    scored = b.with_predictions(table(spark, *fresh, 2), {"p": model}, "features").collect()
    hits = [(r["p"][0] >= 0.5) == (r["y"] == 1) for r in scored]
    assert sum(hits) / len(hits) > 0.8
    top = sorted(model.importances(), key=model.importances().get)[-3:]
    assert set(top) == {"x0", "x1", "x2"} and math.isclose(sum(model.importances().values()), 1.0)
    bins = b.with_bins(table(spark, *fresh, 2), "features", limits)
    again = {r["key"]: r["p"] for r in b.with_predictions(bins, {"p": model}, "bins", binary=True).collect()}
    assert all(again[r["key"]] == r["p"] for r in scored)


def test_few_rows(spark):
    x, y, w, keys = sample(4)
    rows = table(spark, x, y, w, keys, 2)
    limits = b.column_limits(rows, "features", NAMES, 8)
    binned = b.with_bins(rows, "features", limits)
    rules = b.BoostRules(rounds=3, depth=2, bins=8)
    empty = b.boosted(binned.where("false"), NAMES, limits, b.Objective("regression", (2.5,)), rules)
    assert empty.rounds == [] and empty.predicted(b.binned(x, limits)).tolist() == [[2.5]] * 4
    same = binned.withColumn("y", F.lit(1.0))
    flat = b.boosted(same, NAMES, limits, b.objective_of(same, "regression"), rules)
    assert flat.predicted(b.binned(x, limits)).tolist() == [[1.0]] * 4


def test_registered_models_are_the_configured_ones():
    assert learning.RULES == queries.SETTINGS.training
    rules = {t: learning.l.boost_rules(t, learning.RULES) for t in learning.RULES.targets}
    assert {t: (r.rounds, r.depth) for t, r in rules.items()} == {
        "rain_tomorrow": (300, 6), "max_temp_tomorrow": (300, 6), "weather_type_tomorrow": (400, 6),
        "heatwave_risk": (200, 4), "frost_risk": (200, 4), "storm_label": (300, 6),
    }


def test_a_query_fits_only_its_targets(spark, folder, monkeypatch):
    monkeypatch.setattr(queries, "_contexts", {})
    small = replace(learning.RULES, trees=2, rare_trees=2, multiclass_trees=2, depth=2, rare_depth=1)
    monkeypatch.setattr(learning, "RULES", small)
    fitted = []
    train = learning.l.train_target
    monkeypatch.setattr(learning.l, "train_target", lambda rows, p, t, rules: fitted.append(t) or train(rows, p, t, rules))
    run = queries.all_queries()
    assert run["train_regression"](spark, folder).count() == 1
    assert fitted == ["max_temp_tomorrow"]
    assert run["train_binary"](spark, folder).count() == 4
    assert run["feature_importances"](spark, folder).count() == 80
    assert run["predictions"](spark, folder).count() > 0
    assert run["model_metrics"](spark, folder).count() == 23
    assert sorted(fitted) == sorted(small.targets)
