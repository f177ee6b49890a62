"""Gradient boosted trees on histograms of binned columns.

Columns are binned once, to one byte each. A round grows one tree per output (one per class for
several classes); a tree grows level by level from the sums of gradients and second derivatives per
(node, column, bin). Per level only the smaller child of a split is summed, the larger one is the
parent less its sibling.

Gradients count in whole units, so sums do not depend on the order of rows or tasks. A table of up
to ``in_task_rows`` binned rows is grown by one task, several models at a time; a larger one stays
spread out: each level is one pass that sums histograms per task, adds them per column in a shuffle
and returns the best split of every column. Both ways give the same trees, bit for bit.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.session import ship_package
from barograph.sources.landing import stored

c = F.col
#: Gradients are whole multiples of this share of their scale.
UNIT = 2.0**-20
LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class BoostRules:
    rounds: int = 300
    depth: int = 6
    learning_rate: float = 0.05
    subsample: float = 0.8
    column_share: float = 0.8
    seed: int = 42
    bins: int = 64
    l2: float = 1.0
    least_hessian: float = 1.0  # second derivatives a child has at least
    in_task_rows: int = 1 << 18  # more rows are grown by passes over all tasks
    kept_rounds: int = 10  # rounds between two stored tables of margins

    @property
    def leaves(self) -> int:
        return 1 << self.depth


# ---------------------------------------------------------------- columns to bytes


def column_limits(df: DataFrame, features: str, names: Sequence[str], bins: int) -> list[np.ndarray]:
    """Ascending limits of every column: a value belongs to the bin whose number is the count of
    limits below it. Few distinct values have a bin each; the limits of many are quantiles from a
    mergeable sketch. At most ``bins`` - 1 numbers a column reach the driver."""
    steps = [i / bins for i in range(1, bins)] + [1.0]
    row = df.agg(
        *[F.percentile_approx(c(features)[i], steps, 50 * bins).alias(f"_{i}") for i in range(len(names))]
    ).first()
    return [np.unique(np.array(values or [0.0]))[:-1] for values in row]


def binned(matrix: np.ndarray, limits: Sequence[np.ndarray]) -> np.ndarray:
    """(columns, rows) bytes of a (rows, columns) matrix."""
    out = np.empty(matrix.shape[::-1], np.uint8)
    for i, column in enumerate(limits):
        out[i] = np.searchsorted(column, matrix[:, i], "left")
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _bytes(bins: np.ndarray) -> pa.Array:
    """One binary value per row of (columns, rows) bytes."""
    return pa.array([row.tobytes() for row in np.ascontiguousarray(bins.T)], pa.binary())


def _bins(column: pa.Array, width: int) -> np.ndarray:
    flat = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
    return np.ascontiguousarray(flat.reshape(len(column), width).T)


def with_bins(df: DataFrame, features: str, limits: Sequence[np.ndarray], name: str = "bins") -> DataFrame:
    """``features`` (array of doubles) replaced by ``name``, one byte per column."""
    rest = [field for field in df.schema.fields if field.name != features]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = [batch.column(f.name) for f in rest]
            arrays.append(_bytes(binned(_matrix(batch.column(features), len(limits)), limits)))
            yield pa.RecordBatch.from_arrays(arrays, names=[*[f.name for f in rest], name])

    ship_package(df.sparkSession)
    schema = df.select(*[f.name for f in rest], F.lit(b"").alias(name)).schema
    return df.mapInArrow(run, schema)


# ---------------------------------------------------------------- objectives


@dataclass(frozen=True)
class Objective:
    """What is fitted: ``binary``, ``regression`` or ``classes``; a label is a number, for classes
    from 0. ``base`` is the constant every row starts from, ``scale`` the size of gradients."""

    kind: str
    base: tuple[float, ...]
    scale: float = 1.0

    @property
    def outputs(self) -> int:
        return len(self.base)

    def gradients(self, margins: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and second derivatives, (rows, outputs)."""
        if self.kind == "regression":
            return (margins - y[:, None]) * w[:, None], np.repeat(w[:, None], 1, axis=1)
        p = self.predicted(margins)
        if self.kind == "binary":
            return (p - y[:, None]) * w[:, None], np.maximum(p * (1 - p), 1e-16) * w[:, None]
        told = y[:, None] == np.arange(self.outputs)
        return (p - told) * w[:, None], np.maximum(2 * p * (1 - p), 1e-16) * w[:, None]

    def predicted(self, margins: np.ndarray) -> np.ndarray:
        """Values, probabilities of the label 1, or probabilities of the classes."""
        if self.kind == "regression":
            return margins
        if self.kind == "binary":
            return 1 / (1 + np.exp(-margins))
        e = np.exp(margins - margins.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def units(self, values: np.ndarray) -> np.ndarray:
        return np.rint(values / (UNIT * self.scale))


def objective_of(rows: DataFrame, kind: str, classes: int = 1) -> Objective:
    """The constant start from the weighted labels of all rows."""
    if kind == "classes":
        counts = dict(rows.groupBy("y").agg(F.sum("w")).collect())  # one row per class
        whole = sum(counts.values())
        shares = [max(counts.get(float(k), 0.0) / whole, 1e-9) for k in range(classes)]
        return Objective(kind, tuple(float(np.log(s)) for s in shares))
    mean, spread, most = rows.agg(F.sum(c("y") * c("w")) / F.sum("w"), F.stddev_pop("y"), F.max("w")).first()
    if kind == "binary":
        mean = min(max(mean, 1e-6), 1 - 1e-6)
        return Objective(kind, (float(np.log(mean / (1 - mean))),), float(2 ** np.ceil(np.log2(max(most, 1.0)))))
    return Objective(kind, (float(mean),), float(2 ** np.ceil(np.log2(max(spread or 1.0, 1e-3)))))


# ---------------------------------------------------------------- one tree


@dataclass
class Tree:
    """A full tree: inner nodes level by level, then leaves. A row goes right where its bin is above
    the node's; a node that was not split sends all rows left."""

    columns: np.ndarray
    bins: np.ndarray
    leaves: np.ndarray
    gains: np.ndarray

    @staticmethod
    def empty(rules: BoostRules) -> Tree:
        inner = rules.leaves - 1
        return Tree(
            np.zeros(inner, np.int16), np.full(inner, 255, np.uint8), np.zeros(rules.leaves), np.zeros(inner)
        )

    def step(self, bins: np.ndarray, node: np.ndarray, level: int) -> np.ndarray:
        """Places in the next level of rows at places ``node`` of a level."""
        at = (1 << level) - 1 + node
        right = bins[self.columns[at], np.arange(bins.shape[1])] > self.bins[at]
        return 2 * node + right

    def values(self, bins: np.ndarray) -> np.ndarray:
        node = np.zeros(bins.shape[1], np.int64)
        for level in range(int(len(self.leaves)).bit_length() - 1):
            node = self.step(bins, node, level)
        return self.leaves[node]


@dataclass
class Split:
    """The best split of one node; ``left`` and ``whole`` are (gradients, second derivatives)."""

    gain: float
    column: int
    bin: int
    left: tuple[float, float]
    whole: tuple[float, float]


def best_splits(sums: np.ndarray, columns: np.ndarray, rules: BoostRules, scale: float) -> list[Split]:
    """The best split of every node from sums[gradient or second, node, column, bin]. Ties go to the
    first column and bin."""
    g, h = sums.astype(float) * (UNIT * scale)
    whole_g, whole_h = g[:, 0].sum(axis=1), h[:, 0].sum(axis=1)
    left_g, left_h = g.cumsum(axis=2), h.cumsum(axis=2)
    right_g, right_h = whole_g[:, None, None] - left_g, whole_h[:, None, None] - left_h
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left_g**2 / (left_h + rules.l2) + right_g**2 / (right_h + rules.l2)
        gain -= (whole_g**2 / (whole_h + rules.l2))[:, None, None]
    gain[(left_h < rules.least_hessian) | (right_h < rules.least_hessian)] = -np.inf
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(axis=1)
    out = []
    for node, at in enumerate(best):
        column, bin_ = divmod(int(at), gain.shape[2])
        left = (float(left_g[node, column, bin_]), float(left_h[node, column, bin_]))
        whole = (float(whole_g[node]), float(whole_h[node]))
        out.append(Split(float(flat[node, at]), int(columns[column]), bin_, left, whole))
    return out


def leaf(sums: tuple[float, float], rules: BoostRules) -> float:
    return -rules.learning_rate * sums[0] / (sums[1] + rules.l2)


def placed(tree: Tree, level: int, splits: dict[int, Split], rules: BoostRules) -> list[tuple[int, bool]]:
    """Write the splits of a level into the tree. Returns the nodes that were split, each with whether
    its left child is the smaller one; the others become leaves."""
    going = []
    below = rules.depth - level - 1
    for node, split in sorted(splits.items()):
        if not split.gain > LEAST_GAIN:
            tree.leaves[node << below + 1] = leaf(split.whole, rules)
            continue
        at = (1 << level) - 1 + node
        tree.columns[at], tree.bins[at], tree.gains[at] = split.column, split.bin, split.gain
        right = (split.whole[0] - split.left[0], split.whole[1] - split.left[1])
        if below:
            going.append((node, split.left[1] <= right[1]))
        else:
            tree.leaves[2 * node], tree.leaves[2 * node + 1] = leaf(split.left, rules), leaf(right, rules)
    return going


def tree_columns(width: int, number: int, output: int, rules: BoostRules) -> np.ndarray:
    """The columns a tree may use, in ascending order."""
    rng = np.random.default_rng([rules.seed, number, output])
    return np.sort(rng.permutation(width)[: max(1, round(rules.column_share * width))])


def row_sample(keys: np.ndarray, number: int, rules: BoostRules) -> np.ndarray:
    """Which rows a round uses, by a scramble of their key and the round."""
    with np.errstate(over="ignore"):
        x = keys.view(np.uint64) ^ (np.uint64(0x9E3779B97F4A7C15) * np.uint64(rules.seed * 1_000_003 + number + 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(11)).astype(float) < rules.subsample * 2.0**53


def histograms(
    bins: np.ndarray, columns: np.ndarray, slot: np.ndarray, slots: int, g: np.ndarray, h: np.ndarray, n_bins: int
) -> np.ndarray:
    """sums[gradient or second, slot, column, bin] over the rows whose slot is not negative."""
    rows = np.flatnonzero(slot >= 0)
    place = slot[rows].astype(np.int32) * n_bins
    g, h = g[rows], h[rows]
    out = np.empty((2, slots, len(columns), n_bins))
    for i, column in enumerate(columns):
        at = place + bins[column].take(rows)
        out[0, :, i] = np.bincount(at, g, slots * n_bins).reshape(slots, n_bins)
        out[1, :, i] = np.bincount(at, h, slots * n_bins).reshape(slots, n_bins)
    return out.astype(np.int64)  # whole numbers below 2^53


def _slots(node: np.ndarray, wanted: Sequence[int], level: int) -> np.ndarray:
    of = np.full(1 << level, -1, np.int32)
    of[list(wanted)] = np.arange(len(wanted))
    return of[node]


# ---------------------------------------------------------------- growing in a task


def _grown_here(
    bins: np.ndarray, g: np.ndarray, h: np.ndarray, used: np.ndarray, columns: np.ndarray, rules: BoostRules, scale: float
) -> tuple[Tree, np.ndarray]:
    """A tree from rows in memory, and the leaf of every row."""
    tree = Tree.empty(rules)
    node = np.zeros(bins.shape[1], np.int64)
    sums = histograms(bins, columns, np.where(used, 0, -1), 1, g, h, rules.bins)
    nodes = [0]
    for level in range(rules.depth):
        splits = dict(zip(nodes, best_splits(sums, columns, rules, scale), strict=True)) if nodes else {}
        going = placed(tree, level, splits, rules)
        node = tree.step(bins, node, level)
        if not going:
            nodes, sums = [], sums[:, :0]
            continue
        small = [2 * n + (not left) for n, left in going]
        slot = np.where(used, _slots(node, small, level + 1), -1)
        part = histograms(bins, columns, slot, len(small), g, h, rules.bins)
        rest = sums[:, [nodes.index(n) for n, _ in going]] - part
        nodes = [m for n, left in going for m in ((2 * n + (not left)), 2 * n + left)]
        sums = np.stack([part, rest], axis=2).reshape(2, len(nodes), len(columns), rules.bins)
    return tree, node


def boosted_here(
    bins: np.ndarray, y: np.ndarray, w: np.ndarray, keys: np.ndarray, objective: Objective, rules: BoostRules
) -> list[list[Tree]]:
    """All rounds over rows in memory."""
    margins = np.tile(np.array(objective.base), (len(y), 1))
    out = []
    for number in range(rules.rounds):
        g, h = map(objective.units, objective.gradients(margins, y, w))
        used = row_sample(keys, number, rules)
        trees = []
        for k in range(objective.outputs):
            columns = tree_columns(len(bins), number, k, rules)
            tree, leaves = _grown_here(bins, g[:, k], h[:, k], used, columns, rules, objective.scale)
            margins[:, k] += tree.leaves[leaves]
            trees.append(tree)
        out.append(trees)
    return out


# ---------------------------------------------------------------- growing by passes


def _added(margins: np.ndarray, bins: np.ndarray, rounds: Sequence[Sequence[Tree]]) -> np.ndarray:
    for trees in rounds:
        for k, tree in enumerate(trees):
            margins[:, k] += tree.values(bins)
    return margins


def _read(batch: pa.RecordBatch, width: int, outputs: int) -> tuple[np.ndarray, ...]:
    """(bins, y, w, keys, margins) of a batch of the state table."""
    margins = np.frombuffer(b"".join(batch.column("margins").to_pylist()), float).reshape(-1, outputs).copy()
    y, w, keys = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("y", "w", "key"))
    return _bins(batch.column("bins"), width), y, w, keys, margins


_SUMS = "output int, node int, at int, g array<long>, h array<long>"


def _level_sums(
    state: DataFrame, width: int, objective: Objective, rules: BoostRules, since: list, trees: list[Tree],
    number: int, level: int, wanted: list[list[int]], parents: DataFrame | None, going: list[list[tuple[int, bool]]],
) -> DataFrame:
    """(output, node, column place, g, h): histograms of all nodes of a level. A task sums the wanted
    nodes of its rows; per column, the sums of all tasks meet, and the siblings of the wanted nodes
    are what is left of their parents."""
    columns = [tree_columns(width, number, k, rules) for k in range(objective.outputs)]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            bins, y, w, keys, margins = _read(batch, width, objective.outputs)
            margins = _added(margins, bins, since)
            g, h = map(objective.units, objective.gradients(margins, y, w))
            used = row_sample(keys, number, rules)
            for k, tree in enumerate(trees):
                if not wanted[k]:
                    continue
                node = np.zeros(len(y), np.int64)
                for above in range(level):
                    node = tree.step(bins, node, above)
                slot = np.where(used, _slots(node, wanted[k], level), -1)
                sums = histograms(bins, columns[k], slot, len(wanted[k]), g[:, k], h[:, k], rules.bins)
                total[k] = total[k] + sums if k in total else sums
        for k, sums in total.items():
            _, slots, places, _ = sums.shape
            node, at = np.repeat(wanted[k], places), np.tile(np.arange(places), slots)
            yield pa.record_batch(
                {
                    "output": pa.array(np.full(len(node), k), pa.int32()),
                    "node": pa.array(node, pa.int32()),
                    "at": pa.array(at, pa.int32()),
                    "g": list(sums[0].reshape(-1, rules.bins)),
                    "h": list(sums[1].reshape(-1, rules.bins)),
                }
            )

    sides = [{n: left for n, left in some} for some in going]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small: dict[tuple, np.ndarray] = {}
        above: dict[tuple, np.ndarray] = {}
        for batch in batches:
            keys = zip(*[batch.column(x).to_pylist() for x in ("output", "node", "at", "parent")], strict=True)
            both = [np.stack(pair) for pair in zip(
                *[_matrix(batch.column(x), rules.bins) for x in ("g", "h")], strict=True
            )]
            for (k, node, at, parent), sums in zip(keys, both, strict=True):
                into = above if parent else small
                into[k, node, at] = into[k, node, at] + sums if (k, node, at) in into else sums
        rows = dict(small)
        for (k, node, at), sums in above.items():
            if node in sides[k]:
                child = 2 * node + (not sides[k][node])
                rows[k, child ^ 1, at] = sums - small.get((k, child, at), 0)
                rows.setdefault((k, child, at), np.zeros_like(sums))
        if rows:
            names = list(zip(*rows, strict=True))
            sums = np.stack(list(rows.values()))
            yield pa.record_batch(
                {
                    "output": pa.array(names[0], pa.int32()),
                    "node": pa.array(names[1], pa.int32()),
                    "at": pa.array(names[2], pa.int32()),
                    "g": list(sums[:, 0]),
                    "h": list(sums[:, 1]),
                }
            )

    sums = state.mapInArrow(part, _SUMS).withColumn("parent", F.lit(False))
    if parents is not None:
        sums = sums.unionByName(parents.withColumn("parent", F.lit(True)))
    return stored(sums.repartition("output", "at").mapInArrow(add, _SUMS), "histograms")


def _column_splits(level: DataFrame, columns: list[np.ndarray], rules: BoostRules, scale: float) -> DataFrame:
    """The best split of every node by each column."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g, h = (_matrix(batch.column(x), rules.bins) for x in ("g", "h"))
            sums = np.stack([g, h])[:, :, None, :]
            found = best_splits(sums, np.zeros(1, int), rules, scale)
            outputs, places = batch.column("output").to_pylist(), batch.column("at").to_pylist()
            yield pa.record_batch(
                {
                    "output": batch.column("output"),
                    "node": batch.column("node"),
                    "gain": [s.gain for s in found],
                    "column": pa.array([int(columns[k][at]) for k, at in zip(outputs, places, strict=True)], pa.int32()),
                    "bin": pa.array([s.bin for s in found], pa.int32()),
                    "numbers": [[*s.left, *s.whole] for s in found],
                }
            )

    return level.mapInArrow(find, "output int, node int, gain double, column int, bin int, numbers array<double>")


def boosted_by_passes(
    rows: DataFrame, width: int, objective: Objective, rules: BoostRules
) -> list[list[Tree]]:
    """All rounds over a table (key, bins, y, w): one pass per level, one table of margins every few
    rounds. The driver holds trees and the best split of every node."""
    out: list[list[Tree]] = []
    start = np.array(objective.base).tobytes()
    state = rows.select("key", "bins", "y", "w", F.lit(start).alias("margins"))
    state_schema = state.schema
    since = 0
    for number in range(rules.rounds):
        if number - since >= rules.kept_rounds:
            recent = out[since:]

            def renew(batches: Iterator[pa.RecordBatch], recent=recent) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    bins, *_, margins = _read(batch, width, objective.outputs)
                    margins = _added(margins, bins, recent)
                    arrays = [batch.column(n) for n in ("key", "bins", "y", "w")]
                    arrays.append(pa.array([row.tobytes() for row in margins], pa.binary()))
                    yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

            state = stored(state.mapInArrow(renew, state_schema), "boosting-state")
            since = number
        trees = [Tree.empty(rules) for _ in range(objective.outputs)]
        columns = [tree_columns(width, number, k, rules) for k in range(objective.outputs)]
        wanted: list[list[int]] = [[0] for _ in trees]
        going: list[list[tuple[int, bool]]] = [[] for _ in trees]
        level_sums = None
        for level in range(rules.depth):
            level_sums = _level_sums(
                state, width, objective, rules, out[since:], trees, number, level, wanted, level_sums, going
            )
            # the first column wins a tie, as within a task
            best = F.max_by(F.struct("gain", "column", "bin", "numbers"), F.struct("gain", -c("column")))
            found = _column_splits(level_sums, columns, rules, objective.scale).groupBy("output", "node").agg(best.alias("s"))
            splits: list[dict[int, Split]] = [{} for _ in trees]
            for row in found.collect():  # one per node of the level
                s = row["s"]
                splits[row["output"]][row["node"]] = Split(
                    s["gain"], s["column"], s["bin"], tuple(s["numbers"][:2]), tuple(s["numbers"][2:])
                )
            going = [placed(tree, level, splits[k], rules) for k, tree in enumerate(trees)]
            wanted = [[2 * n + (not left) for n, left in some] for some in going]
            if not any(wanted):
                break
        out.append(trees)
    return out


# ---------------------------------------------------------------- models


@dataclass
class Boosted:
    """A fitted ensemble: limits of the columns, what it predicts, and its trees by round."""

    names: list[str]
    limits: list[np.ndarray]
    objective: Objective
    rounds: list[list[Tree]]
    labels: list[str] = field(default_factory=list)

    def predicted(self, bins: np.ndarray) -> np.ndarray:
        margins = np.tile(np.array(self.objective.base), (bins.shape[1], 1))
        return self.objective.predicted(_added(margins, bins, self.rounds))

    def importances(self) -> dict[str, float]:
        """The mean gain of a column's splits, as shares of one."""
        gains, splits = np.zeros(len(self.names)), np.zeros(len(self.names))
        for tree in (tree for trees in self.rounds for tree in trees):
            split = tree.gains > 0
            np.add.at(gains, tree.columns[split], tree.gains[split])
            np.add.at(splits, tree.columns[split], 1)
        mean = gains / np.maximum(splits, 1)
        return dict(zip(self.names, (mean / (mean.sum() or 1.0)).tolist(), strict=True))


def boosted(
    rows: DataFrame, names: Sequence[str], limits: Sequence[np.ndarray], objective: Objective, rules: BoostRules,
    labels: Sequence[str] = (),
) -> Boosted:
    """Fit a table (key, bins, y, w) of labelled rows; rows without a label must be gone. A table without
    rows gives the constant model."""
    width = len(names)
    rows = rows.select("key", "bins", c("y").cast("double"), c("w").cast("double"))
    if rows.limit(rules.in_task_rows + 1).count() > rules.in_task_rows:
        rounds = boosted_by_passes(rows, width, objective, rules)
    else:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(batches)
            if not len(table):
                return
            y, w, keys = (table[name].to_numpy() for name in ("y", "w", "key"))
            trees = boosted_here(_bins(table["bins"], width), y, w, keys, objective, rules)
            yield pa.record_batch({"model": [pickle.dumps(trees)]})

        ship_package(rows.sparkSession)
        found = rows.coalesce(1).mapInArrow(_with_rows(run), "model binary").collect()
        rounds = pickle.loads(found[0]["model"]) if found else []
    return Boosted(list(names), list(limits), objective, rounds, list(labels))


def _with_rows(run: Callable) -> Callable:
    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [batch for batch in batches if batch.num_rows]
        if batches:
            yield from run(batches)

    return checked


def with_predictions(df: DataFrame, models: dict[str, Boosted], column: str, binary: bool = False) -> DataFrame:
    """The rows with one array<double> column per model: the value, the probability of the label 1, or
    the probabilities of the classes. ``column`` holds an array of doubles in the order of the models'
    columns or, if ``binary``, their bins; it is dropped. All models see a row in one pass."""
    rest = [f.name for f in df.schema.fields if f.name != column]
    shared = df.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            arrays = [batch.column(name) for name in rest]
            for model in models.values():
                width = len(model.names)
                bins = (
                    _bins(batch.column(column), width)
                    if binary
                    else binned(_matrix(batch.column(column), width), model.limits)
                )
                arrays.append(pa.array(list(model.predicted(bins)), pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(arrays, names=[*rest, *models])

    ship_package(df.sparkSession)
    schema = df.select(*rest, *[F.array(F.lit(0.0)).alias(name) for name in models]).schema
    return df.mapInArrow(run, schema)
