"""Training, scoring and evaluation of the six forecast models."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.config import DEFAULTS, TrainingRules
from barograph.functions.rows import attach_row
from barograph.functions.numeric import count_if, ratio, round_half_even, round_half_up
from barograph.operators.boosting import (
    Boosted, BoostRules, Objective, boosted, column_limits, objective_of, with_bins, with_predictions,
)
from barograph.operators.features import (
    align_features, category_codes, column_medians, encode_categoricals, feature_matrix,
)
from barograph.operators.quantiles import value_buckets
from barograph.operators.sequence import number_rows, running_total
from barograph.sources.landing import stored

c = F.col
RULES = DEFAULTS.training
RARE = ("heatwave_risk", "frost_risk")


def target_mask(df: DataFrame, targets: Sequence[str] = RULES.targets) -> DataFrame:
    """Rows on which every target is known."""
    return df.dropna(subset=list(targets))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Negatives per positive, the weight given to a positive row."""
    row = df.agg(
        count_if(c(label) == 0).alias("negatives"), count_if(c(label) == 1).alias("positives")
    )
    return row.withColumn("ratio", ratio("negatives", F.greatest(c("positives"), F.lit(1))))


def stratified_split(
    df: DataFrame, label: str, keys: Sequence[str], test: float = RULES.test_share, seed: int = RULES.seed
) -> DataFrame:
    """Add ``is_test``: the same share of every label, repeatable for a seed.

    Per label the rows with the smallest hashes of their key are the test. Only labels and hashes are
    numbered, inside (label, hash prefix), to find the last hash of the test; the rows themselves
    are compared with it and stay where they are. Rows without a label have no part.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[c(k).cast("string") for k in keys]))
    hashed = df.where(c(label).isNotNull()).withColumn("_digest", digest)
    numbered = number_rows(hashed.select(label, "_digest"), [label], "_digest", chunk=F.substring("_digest", 1, 3))
    sizes = hashed.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    last = (
        numbered.join(sizes, label)
        .where(c("_seq") < F.round(c("_n") * test))
        .groupBy(label)
        .agg(F.max("_digest").alias("_last"))
    )
    return (
        hashed.join(last, label, "left")
        .withColumn("is_test", F.coalesce(c("_digest") <= c("_last"), F.lit(False)))
        .drop("_digest", "_last")
    )


def rank_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """AUC as the share of (positive, negative) pairs in the right order, ties counted half.

    Rows are reduced to counts per distinct score before anything is ordered.
    """
    counts = df.groupBy(score).agg(
        count_if(c(label) == 1).alias("_pos"), count_if(c(label) == 0).alias("_neg")
    )
    slotted = value_buckets(counts, [], score)
    running = running_total(slotted, [], score, {"_neg": "_below"}, c("_slot"))
    won = c("_pos") * (c("_below") - c("_neg") / 2)
    return running.agg(
        ratio(F.sum(won), F.sum("_pos").cast("double") * F.sum("_neg")).alias("auc_roc")
    )


def binary_metrics(df: DataFrame, label: str, score: str, threshold: float = RULES.rain_threshold) -> DataFrame:
    said, was = c(score) >= threshold, c(label) == 1
    tp, fp, fn = count_if(said & was), count_if(said & ~was), count_if(~said & was)
    row = df.agg(
        round_half_up(F.avg((said == was).cast("double")), 4).alias("accuracy"),
        round_half_up(F.coalesce(ratio(2 * tp, 2 * tp + fp + fn), F.lit(0.0)), 4).alias("f1"),
        round_half_up(F.avg(c(label).cast("double")), 4).alias("pos_rate"),
    )
    auc = rank_auc(df, label, score).select(round_half_up("auc_roc", 4).alias("auc_roc"))
    return attach_row(row, auc)


def multiclass_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Accuracy, macro and weighted F1 over all classes that occur on either side."""
    cells = df.groupBy(c(label).alias("_was"), c(pred).alias("_said")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    hit = F.when(c("_was") == c("_said"), c("_n")).otherwise(0)
    as_label = cells.select(c("_was").alias("_class"), c("_n").alias("_support"), F.lit(0).alias("_claimed"), hit.alias("_hit"))
    as_pred = cells.select(c("_said").alias("_class"), F.lit(0).alias("_support"), c("_n").alias("_claimed"), F.lit(0).alias("_hit"))
    classes = as_label.unionByName(as_pred).groupBy("_class").agg(
        F.sum("_support").alias("_support"), F.sum("_claimed").alias("_claimed"), F.sum("_hit").alias("_hit")
    )
    f1 = classes.withColumn("_f1", F.coalesce(ratio(2 * c("_hit"), c("_support") + c("_claimed")), F.lit(0.0)))
    return f1.agg(
        round_half_up(ratio(F.sum("_hit"), F.sum("_support")), 4).alias("accuracy"),
        round_half_up(F.avg("_f1"), 4).alias("f1_macro"),
        round_half_up(ratio(F.sum(c("_f1") * c("_support")), F.sum("_support")), 4).alias("f1_weighted"),
        F.count(F.lit(1)).alias("n_classes"),
    )


def regression_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    error = c(label) - c(pred)
    known = df.where(error.isNotNull())
    return known.agg(
        round_half_up(F.avg(F.abs(error)), 3).alias("mae"),
        round_half_up(1 - ratio(F.avg(error * error), F.var_pop(label)), 4).alias("r2"),
        round_half_up(F.sqrt(F.avg(error * error)), 3).alias("rmse"),
    )


@dataclass
class Prepared:
    """What scoring needs from training besides the trees."""

    columns: list[str]
    mappings: DataFrame
    medians: DataFrame
    limits: list[np.ndarray]


def prepare(frame: DataFrame, rules: TrainingRules = RULES) -> tuple[DataFrame, Prepared]:
    """(city, date, key, bins, targets) of a feature frame, as a table: encoded, filled and binned once
    for all models. Codes, medians and limits are fitted here and used again for scoring."""
    columns = [x for x in rules.numerical + rules.categorical if x in frame.columns]
    categories = [x for x in rules.categorical if x in frame.columns]
    mappings = stored(category_codes(frame, categories), "category-codes")
    encoded, _ = encode_categoricals(frame, categories, mappings)
    medians = stored(column_medians(encoded, columns), "medians")
    prepared = Prepared(columns, mappings, medians, [])
    vectors = stored(_vectors(frame, prepared, rules), "vectors")
    prepared.limits = column_limits(vectors, "features", columns, BoostRules.bins)
    keyed = vectors.withColumn("key", F.xxhash64("city", "date"))
    return stored(with_bins(keyed, "features", prepared.limits), "binned"), prepared


def _vectors(
    frame: DataFrame, prepared: Prepared, rules: TrainingRules = RULES, carry: Sequence[str] = ()
) -> DataFrame:
    """``features``, an array of doubles, next to city, date, ``carry`` and whatever targets the frame has."""
    targets = [t for t in rules.targets if t in frame.columns] + list(carry)
    named = {t: f"target_{t}" for t in targets}
    base = frame.withColumns({named[t]: c(t) for t in targets} | {"_city": c("city")})
    encoded, _ = encode_categoricals(base, rules.categorical, prepared.mappings)
    keys = ["_city", "date", *named.values()]
    matrix = feature_matrix(encoded, prepared.columns, prepared.medians, keys=keys)
    matrix = matrix.withColumnsRenamed({f"key_{k}": k for k in keys})
    aligned = align_features(matrix, prepared.columns, keys).na.fill(0.0, subset=prepared.columns)
    out = aligned.select(*keys, F.array(*prepared.columns).alias("features"))
    return out.withColumnsRenamed({"_city": "city", **{v: k for k, v in named.items()}})


def boost_rules(target: str, rules: TrainingRules = RULES) -> BoostRules:
    """The configured ensemble of a target."""
    rounds, depth = rules.trees, rules.depth
    if target in RARE:
        rounds, depth = rules.rare_trees, rules.rare_depth
    elif target == "weather_type_tomorrow":
        rounds = rules.multiclass_trees
    return BoostRules(
        rounds=rounds, depth=depth, learning_rate=rules.learning_rate, subsample=rules.subsample,
        column_share=rules.column_share, seed=rules.seed,
    )


def _fitted(
    rows: DataFrame, target: str, kind: str, prepared: Prepared, rules: TrainingRules, labels: Sequence[str] = ()
) -> Boosted:
    objective = objective_of(rows, kind, len(labels))
    return boosted(rows, prepared.columns, prepared.limits, objective, boost_rules(target, rules), labels)


def train_binary(df: DataFrame, label: str, prepared: Prepared, rules: TrainingRules = RULES) -> Boosted:
    """Boosted trees with positives weighted by the class ratio (at least 1 for rare events)."""
    weights = class_weights(df, label)
    factor = c("ratio") if label == "rain_tomorrow" else F.greatest(c("ratio"), F.lit(1.0))
    rows = attach_row(df, weights.select(factor.alias("_ratio"))).select(
        "key", "bins", c(label).cast("double").alias("y"), F.when(c(label) == 1, c("_ratio")).otherwise(1.0).alias("w")
    )
    return _fitted(rows, label, "binary", prepared, rules)


def train_regression(df: DataFrame, label: str, prepared: Prepared, rules: TrainingRules = RULES) -> Boosted:
    rows = df.select("key", "bins", c(label).cast("double").alias("y"), F.lit(1.0).alias("w"))
    return _fitted(rows, label, "regression", prepared, rules)


def train_multiclass(df: DataFrame, label: str, prepared: Prepared, rules: TrainingRules = RULES) -> Boosted:
    """One tree per class and round; the classes are the labels that occur, in alphabetical order."""
    labels = sorted(row[0] for row in df.select(label).distinct().collect())  # one row per class
    number = F.array_position(F.array(*map(F.lit, labels)), c(label)) - 1
    rows = df.select("key", "bins", number.cast("double").alias("y"), F.lit(1.0).alias("w"))
    return _fitted(rows, label, "classes", prepared, rules, labels)


def class_name(probabilities: str, labels: Sequence[str]) -> Column:
    """The label of the greatest probability, the first of equal ones."""
    best = F.array_position(probabilities, F.array_max(probabilities)) - 1
    return F.get(F.array(*map(F.lit, labels)), best.cast("int"))


def feature_importance_top20(model: Boosted) -> DataFrame:
    """The 20 columns whose splits gain most on average, one row each."""
    spark = SparkSession.getActiveSession()
    table = spark.createDataFrame(list(model.importances().items()), "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(20).select(
        "feature", round_half_even("importance", 6).alias("importance")
    )


def score_predictions(
    frame: DataFrame, models: dict[str, Boosted], prepared: Prepared, rules: TrainingRules = RULES
) -> DataFrame:
    """The eleven prediction columns for every row of a feature frame.

    One array of features is assembled and passed through all models at once. ``frame`` carries the
    formula-based comfort score.
    """
    vectors = _vectors(frame.drop(*rules.targets), prepared, rules, carry=["comfort_score"])
    scored = with_predictions(vectors, {f"out_{name}": model for name, model in models.items()}, "features")

    def value(name: str) -> Column:
        return c(f"out_{name}")[0]

    rain = value("rain_tomorrow")
    return scored.select(
        "date",
        "city",
        (rain >= rules.rain_threshold).cast("int").alias("rain_tomorrow"),
        round_half_even(rain, 4).alias("rain_tomorrow_proba"),
        round_half_even(value("max_temp_tomorrow"), 1).alias("max_temp_tomorrow"),
        class_name("out_weather_type_tomorrow", models["weather_type_tomorrow"].labels).alias("weather_type_tomorrow"),
        "comfort_score",
        round_half_even(value("heatwave_risk"), 4).alias("heatwave_risk"),
        round_half_even(value("frost_risk"), 4).alias("frost_risk"),
        round_half_even(value("storm_label"), 4).alias("storm_probability"),
        F.current_timestamp().alias("predicted_at"),
    )


@dataclass
class Trained:
    """The model of one target, its split rows with predictions, and its test metrics."""

    model: Boosted
    scored: DataFrame
    metrics: DataFrame


def train_target(binned: DataFrame, prepared: Prepared, target: str, rules: TrainingRules = RULES) -> Trained:
    """Split, fit and evaluate one target over the rows of :func:`prepare`."""
    by = target if target != "max_temp_tomorrow" else "_all"
    data = binned.withColumn("_all", F.lit(0)) if by == "_all" else binned
    split = stored(stratified_split(data, by, ["city", "date"], rules.test_share, rules.seed), f"split-{target}")
    train = split.where(~c("is_test"))
    fit = {"max_temp_tomorrow": train_regression, "weather_type_tomorrow": train_multiclass}.get(target, train_binary)
    model = fit(train, target, prepared, rules)
    rows = split.select("city", "date", "is_test", "bins", c(target).alias("was"))
    scored = stored(with_predictions(rows, {"said": model}, "bins", binary=True), f"scored-{target}")
    test = scored.where("is_test")
    if target == "max_temp_tomorrow":
        metrics = regression_metrics(test.withColumn("_said", c("said")[0]), "was", "_said")
    elif target == "weather_type_tomorrow":
        metrics = multiclass_metrics(test.withColumn("_said", class_name("said", model.labels)), "was", "_said")
    else:
        metrics = binary_metrics(test.withColumn("_said", c("said")[0]), "was", "_said")
    return Trained(model, scored, metrics)


def losses(trained: Trained) -> DataFrame:
    """(n_train, n_test, loss, constant_loss) of one model: the mean loss it was fitted for over the
    training rows, and that of the constant it started from."""
    objective: Objective = trained.model.objective
    start = objective.predicted(np.array([objective.base]))[0].tolist()

    def loss(said: Column) -> Column:
        was = c("was")
        if objective.kind == "regression":
            return F.pow(was - said[0], 2)
        if objective.kind == "binary":
            p = F.greatest(F.lit(1e-15), F.least(said[0], F.lit(1 - 1e-15)))
            return -F.when(was == 1, F.log(p)).otherwise(F.log(1 - p))
        at = F.array_position(F.array(*map(F.lit, trained.model.labels)), was)
        return -F.log(F.greatest(F.element_at(said, at.cast("int")), F.lit(1e-15)))

    weight = F.lit(1.0)
    if objective.kind == "binary":  # positives weigh as in training
        counts = trained.scored.where("NOT is_test").agg(
            (count_if(c("was") == 0) / F.greatest(count_if(c("was") == 1), F.lit(1))).alias("_ratio")
        )
        rows = attach_row(trained.scored, counts)
        weight = F.when(c("was") == 1, F.greatest(c("_ratio"), F.lit(1.0))).otherwise(1.0)
    else:
        rows = trained.scored
    constant = F.array(*map(F.lit, start))
    seen = ~c("is_test")
    return rows.agg(
        count_if(seen).alias("n_train"),
        count_if(c("is_test")).alias("n_test"),
        F.avg(F.when(seen, weight * loss(c("said")))).alias("loss"),
        F.avg(F.when(seen, weight * loss(constant))).alias("constant_loss"),
    )


def train_targets(
    binned: DataFrame, prepared: Prepared, targets: Sequence[str], rules: TrainingRules = RULES
) -> dict[str, Trained]:
    """Several targets at a time: models do not depend on each other, and each keeps one task busy while
    its table is small."""
    if not targets:
        return {}
    with ThreadPoolExecutor(len(targets)) as pool:
        runs = {t: pool.submit(train_target, binned, prepared, t, rules) for t in targets}
        return {t: run.result() for t, run in runs.items()}


def train_all(
    frame: DataFrame, rules: TrainingRules = RULES
) -> tuple[dict[str, Boosted], Prepared, dict[str, DataFrame]]:
    """All six models with their test metrics."""
    binned, prepared = prepare(target_mask(frame, rules.targets), rules)
    fitted = train_targets(binned, prepared, rules.targets, rules)
    return {t: x.model for t, x in fitted.items()}, prepared, {t: x.metrics for t, x in fitted.items()}
