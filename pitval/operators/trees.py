"""Second-order boosted trees, fitted on counts.

Each feature is cut at exact quantiles of the training rows, and from then on a row is its
numbers of bins and its label. A level of a tree takes one aggregation: for every node, feature
and bin the sum of the gradients and the number of rows (the hessian of the squared error), at
most ``nodes x features x bins`` sums, from which the best split of each node follows. Splits
gain ``G^2 / (H + penalty)`` on either side; a leaf is ``-G / (H + penalty)`` times the rate,
also in the first tree, which starts from the mean of the labels.

Labels, gradients and leaves are whole numbers of a fixed fraction of a unit, so sums are exact
and a model does not depend on how rows are placed. Several groups of rows, each with features
of its own, are fitted in the same passes. Rows lie in blocks of ``BLOCK_ROWS``, a row of the table
each, feature by feature: a pass reads the bins as they are and adds up sums in a task, and only
these sums move. A pass of boosting has little to do and there are many, so it is a plain job on
blocks, without a query to plan. The state of the rows is cached from tree to tree, and made from the
written blocks and all trees every ``WRITTEN_TREES`` trees, so that what it is made from stays short.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from pitval import constants as C
from pitval.functions.numeric import finite
from pitval.operators.quantiles import values_at_ranks
from pitval.operators.skew import with_position
from pitval.session import materialize

# Ship the helpers with the task, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WRITTEN_TREES = 10
BLOCK_ROWS = 1 << 16
#: Binary digits of the greatest label, as a whole number; 2^34 rows of it still sum to a long.
LABEL_BITS = 28
#: Tasks whose sums meet in the driver at once; those of more meet in tasks first.
SENT_AT_ONCE = 64
_LEAST_GAIN = 1e-6
_NEVER = 1 << 14  # no bin is above it


@dataclass
class Tree:
    """Splits by heap number (the root is 1, the children of k are 2k and 2k + 1), leaves by the numbers after."""

    features: list[int]
    bins: list[int]
    leaves: list[int]


@dataclass
class BoostedModel:
    """A sum of trees over imputed features, in fractions ``1 / scale`` of a unit."""

    features: list[str]
    means: list[float]
    cuts: list[list[float]]
    scale: float
    base: int
    trees: list[Tree] = field(default_factory=list)

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        total = _tree_sums(self, df)
        return df.withColumn(out, (F.lit(self.base) + total) / F.lit(self.scale))


def _prepared(train: DataFrame, names: Sequence[str], label: str, by: str | None, order: Sequence[str]) -> DataFrame:
    """(grp, x, y, place): ``place`` numbers the rows by group and ``order``, if there is one."""
    group = F.lit(None).cast("string") if by is None else F.col(by).cast("string")
    values = F.array(*[finite(F.col(c).cast("double")) for c in names])
    kept = {f"_o{i}": F.col(c) for i, c in enumerate(order)}
    rows = train.select(group.alias("grp"), values.alias("x"), F.col(label).cast("double").alias("y"), *[c.alias(n) for n, c in kept.items()])
    rows = rows.filter("y is not null")
    if not order:
        return materialize(rows.withColumn("place", F.lit(0).cast("long")), "tree-rows")
    hashed = rows.withColumn("_hash", F.xxhash64("x", "y"))
    return materialize(with_position(hashed, ["grp", *kept, "_hash"], "place").select("grp", "x", "y", "place"), "tree-rows")


def _cuts(rows: DataFrame, means: Mapping[str | None, list], bins: int) -> dict[tuple[str | None, int], list[float]]:
    """The values of each group and feature after which a split may come."""
    long = rows.select("grp", F.posexplode("x").alias("feature", "v"))
    fill = F.coalesce(*[
        F.when(F.col("grp").eqNullSafe(F.lit(g)), F.element_at(F.array(*[F.lit(m).cast("double") for m in own]), F.col("feature") + 1))
        for g, own in means.items()
    ])
    filled = long.withColumn("v", F.coalesce("v", fill))
    parts = F.sequence(F.lit(1).cast("long"), F.lit(bins - 1).cast("long"))
    ranks = F.array_distinct(F.transform(parts, lambda j: F.floor((j * F.col("n") + (bins - 1)) / bins)))
    # At most (bins - 1) values a feature and group.
    found = values_at_ranks(filled, "v", ranks, ["grp", "feature"]).select("grp", "feature", "v").distinct().collect()
    cuts: dict[tuple[str | None, int], list[float]] = {}
    for row in sorted(found, key=lambda r: r["v"]):
        cuts.setdefault((row["grp"], row["feature"]), []).append(row["v"])
    return cuts


def _binned(rows: DataFrame, groups: Sequence[str | None], models: Mapping[str | None, BoostedModel], names: Sequence[str]) -> DataFrame:
    """Blocks of rows of a group: (grp as a number, rows, sum of the labels, bins by feature, labels as
    whole numbers, places)."""
    plans = {
        g: (number, [names.index(c) for c in m.features], [(mean, np.array(cut)) for mean, cut in zip(m.means, m.cuts, strict=True)], m.scale)
        for number, (g, m) in enumerate((g, models[g]) for g in groups)
    }
    kind = _bin_type(models)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple]] = {}

        def block(number: int) -> pa.RecordBatch:
            bins, y, place = (np.concatenate(parts, axis=-1) for parts in zip(*waiting.pop(number), strict=True))
            made = [number, len(y), int(y.sum()), bins.tobytes(), y.tobytes(), place.tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(made, _BLOCK_TYPES, strict=True)], _BLOCK_NAMES)

        for batch in batches:
            own = np.array(batch.column("grp").to_pylist(), object)
            values = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(names))
            labels, places_of = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "place"))
            for group, (number, places, features, scale) in plans.items():
                at = np.flatnonzero(np.array([g == group for g in own], bool))
                if not len(at):
                    continue
                bins = np.zeros((len(places), len(at)), kind)
                for line, place, (mean, cut) in zip(bins, places, features, strict=True):
                    x = values[at, place]
                    line[:] = np.searchsorted(cut, np.where(np.isnan(x), mean, x), side="left")
                waiting.setdefault(number, []).append((bins, np.floor(labels[at] * scale + 0.5).astype(np.int64), places_of[at]))
                if sum(len(y) for _, y, _ in waiting[number]) >= BLOCK_ROWS:
                    yield block(number)
        for number in list(waiting):
            yield block(number)

    return rows.mapInArrow(work, "grp int, n long, total long, bins binary, y binary, place binary")


_BLOCK_NAMES = ["grp", "n", "total", "bins", "y", "place"]
_BLOCK_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]


def _bin_type(models: Mapping[str | None, BoostedModel]) -> type:
    most = max((len(cut) for m in models.values() for cut in m.cuts), default=0)
    return np.uint8 if most < 256 else np.uint16 if most < 1 << 16 else np.int32


def _blocks(batch: pa.RecordBatch, kind: type, numbers: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(group, bins by feature and row, the numbers of a column) of each block."""
    for g, n, bins, own in zip(*(batch.column(c) for c in ("grp", "n", "bins", numbers)), strict=True):
        matrix = np.frombuffer(bins.as_buffer(), kind)
        yield g.as_py(), matrix.reshape(len(matrix) // n.as_py(), n.as_py()), np.frombuffer(own.as_buffer(), np.int64)


def _reached(bins: np.ndarray, tree: Tree, levels: int) -> np.ndarray:
    """The heap number of each row after ``levels`` splits; ``bins`` has a line for each feature."""
    if levels > 6:
        node, rows = np.ones(bins.shape[1], np.int64), np.arange(bins.shape[1])
        features, limits = np.array(tree.features), np.array(tree.bins)
        for _ in range(levels):
            node = 2 * node + (bins[features[node], rows] > limits[node] if len(bins) else False)
        return node
    # Few nodes: a comparison of a whole feature for each is faster than a look at each row's own.
    node = np.ones(bins.shape[1], np.uint8)
    for level in range(levels):
        right = np.zeros(bins.shape[1], bool)
        for k in range(1 << level, 2 << level):
            if tree.bins[k] != _NEVER:
                right |= (bins[tree.features[k]] > tree.bins[k]) & (node == k)
        node = 2 * node + right
    return node


def _tree_sums(model: BoostedModel | ForestModel, df: DataFrame) -> Column:
    """For each row the sum of the leaves that it reaches."""
    cuts, trees = [np.array(c) for c in model.cuts], model.trees
    depth = len(trees[0].features).bit_length() - 1 if trees else 0

    @pandas_udf(T.LongType())
    def total(values: pd.Series) -> pd.Series:
        x = np.array(values.tolist(), float).reshape(len(values), len(cuts))
        bins = np.stack([np.searchsorted(c, x[:, i], side="left") for i, c in enumerate(cuts)]) if cuts else np.zeros((0, len(x)), int)
        made = np.zeros(len(x), np.int64)
        for tree in trees:
            made += np.array(tree.leaves)[_reached(bins, tree, depth).astype(np.int64) - (1 << depth)]
        return pd.Series(made)

    values = [F.coalesce(finite(F.col(c).cast("double")), F.lit(m)) for c, m in zip(model.features, model.means, strict=True)]
    return total(F.array(*values).cast("array<double>"))


def _sums(bins: np.ndarray, cells: int, first: np.ndarray, value: np.ndarray, weight: np.ndarray | None, into: tuple[np.ndarray, np.ndarray]) -> None:
    """Adds the sums and counts of a block to ``into``, a line of ``cells`` for each feature. A row's cell is
    its ``first`` plus its bin. Sums of a block are whole numbers far below 2^53, so they are exact."""
    for line, total, count in zip(bins, *into, strict=True):
        cell = first + line
        total += np.bincount(cell, value, cells).astype(np.int64)
        count += np.bincount(cell, weight, cells).astype(np.int64)


def _rows_of(state: DataFrame, kind: type) -> RDD:
    """(group, bins by feature and row, labels) of each written block."""

    def block(row: tuple) -> tuple[int, np.ndarray, np.ndarray]:
        g, n, bins, y = row
        matrix = np.frombuffer(bins, kind)
        return g, matrix.reshape(len(matrix) // n, n), np.frombuffer(y, np.int64)

    return state.select("grp", "n", "bins", "y").rdd.map(block)


def _gradients(blocks: RDD, bases: Sequence[int], grown: Sequence[Sequence[Tree]], depth: int) -> RDD:
    """Blocks with the gradients of models with the trees ``grown``."""
    grown = [list(own) for own in grown]

    def work(block: tuple) -> tuple[int, np.ndarray, np.ndarray]:
        g, bins, y = block
        gradient = bases[g] - y
        for tree in grown[g]:
            gradient += _leaves(bins, tree, depth)
        return g, bins, gradient

    return blocks.map(work)


def _added(state: RDD, trees: Sequence[Tree], depth: int) -> RDD:
    """``state`` with the leaves of a tree of each group added to the gradients."""
    return state.map(lambda block: (block[0], block[1], block[2] + _leaves(block[1], trees[block[0]], depth)))


def _leaves(bins: np.ndarray, tree: Tree, depth: int) -> np.ndarray:
    return np.array(tree.leaves, np.int64)[_reached(bins, tree, depth).astype(np.int64) - (1 << depth)]


def _cells(state: RDD, trees: Sequence[Tree], level: int, bins: int) -> pa.Table:
    """(grp, node, feature, bin, total, rows): sums of the gradients, one row for each cell with rows."""
    nodes = 1 << level

    def add(sums: dict, block: tuple) -> dict:
        g, matrix, gradient = block
        if g not in sums:
            sums[g] = tuple(np.zeros((len(matrix), nodes * bins), np.int64) for _ in range(2))
        first = (_reached(matrix, trees[g], level).astype(np.int64) - nodes) * bins
        _sums(matrix, nodes * bins, first, gradient.astype(np.float64), None, sums[g])
        return sums

    def met(sums: dict, more: dict) -> dict:
        for g, own in more.items():
            sums[g] = tuple(a + b for a, b in zip(sums[g], own, strict=True)) if g in sums else own
        return sums

    made = state.treeAggregate({}, add, met, 1 if state.getNumPartitions() <= SENT_AT_ONCE else 2)
    parts: list[list[np.ndarray]] = [[] for _ in _CELL_NAMES]
    for g, (total, count) in made.items():
        feature, cell = np.nonzero(count)
        own = [np.full(len(cell), g), nodes + cell // bins, feature, cell % bins, total[feature, cell], count[feature, cell]]
        for part, column in zip(parts, own, strict=True):
            part.append(column)
    return pa.table([np.concatenate(part or [np.zeros(0, np.int64)]) for part in parts], _CELL_NAMES)


_CELL_NAMES = ["grp", "node", "feature", "bin", "total", "rows"]


def _best_splits(cells: pa.Table, penalty: float, least: Sequence[float]) -> dict[tuple[int, int], tuple]:
    """Per (group, node) the feature and bin of the best split and the sums of both sides."""
    group, node, feature, bin_, total, count = (cells.column(n).to_numpy() for n in ("grp", "node", "feature", "bin", "total", "rows"))
    order = np.lexsort((bin_, feature, node, group))
    group, node, feature, bin_, total, count = (a[order] for a in (group, node, feature, bin_, total, count))
    new = np.append(True, (np.diff(group) != 0) | (np.diff(node) != 0) | (np.diff(feature) != 0))
    run = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    whole_g, whole_n = np.add.reduceat(total, starts)[run], np.add.reduceat(count, starts)[run]
    sum_g, sum_n = np.cumsum(total), np.cumsum(count)
    left_g = sum_g - (sum_g - total)[starts][run]
    left_n = sum_n - (sum_n - count)[starts][run]

    def gain(g: np.ndarray, n: np.ndarray) -> np.ndarray:
        g = g.astype(np.float64)
        return g * g / (n + penalty)

    with np.errstate(invalid="ignore", divide="ignore"):
        score = gain(left_g, left_n) + gain(whole_g - left_g, whole_n - left_n)
    allowed = (whole_n > left_n) & (score - gain(whole_g, whole_n) > np.array(least)[group])
    best: dict[tuple[int, int], tuple] = {}
    for k in np.flatnonzero(allowed)[np.lexsort((bin_[allowed], feature[allowed], -score[allowed]))].tolist():
        key = (int(group[k]), int(node[k]))
        if key not in best:
            best[key] = (int(feature[k]), int(bin_[k]), (int(left_g[k]), int(left_n[k])), (int(whole_g[k] - left_g[k]), int(whole_n[k] - left_n[k])))
    return best


def _grown(
    state: RDD, groups: int, depth: int, rate: float, penalty: float, least: Sequence[float], bins: int
) -> list[Tree]:
    """The next tree of each group."""
    inner = 1 << depth
    trees = [Tree([0] * inner, [_NEVER] * inner, [0] * inner) for _ in range(groups)]
    sums: list[dict[int, tuple[int, int]]] = [{} for _ in range(groups)]
    open_ = {(g, 1) for g in range(groups)}
    for level in range(depth):
        cells = _cells(state, trees, level, bins)
        if not level:
            # Any feature has the sums of all rows.
            for g, feature, total, count in zip(*(cells.column(n).to_pylist() for n in ("grp", "feature", "total", "rows")), strict=True):
                if not feature:
                    old = sums[g].get(1, (0, 0))
                    sums[g][1] = (old[0] + total, old[1] + count)
        best = _best_splits(cells, penalty, least) if cells.num_rows else {}
        reached = set()
        for g, node in open_:
            if (g, node) in best:
                feature, bin_, left, right = best[g, node]
                trees[g].features[node], trees[g].bins[node] = feature, bin_
                sums[g][2 * node], sums[g][2 * node + 1] = left, right
                reached |= {(g, 2 * node), (g, 2 * node + 1)}
            else:
                # A node without a split is its own left child from here on.
                for below in range(depth - level):
                    sums[g][node << (below + 1)] = sums[g].get(node, (0, 0))
        open_ = reached
        if not open_:
            break
    for tree, own in zip(trees, sums, strict=True):
        for k in range(inner):
            total, count = own.get(inner + k, (0, 0))
            tree.leaves[k] = int(np.floor(-float(total) / (count + penalty) * rate + 0.5))
    return trees


def _started(
    train: DataFrame, feature_sets: Mapping[str | None, Sequence[str]], label: str, by: str | None, bins: int, kind: type,
    order: Sequence[str] = (),
) -> tuple[dict, DataFrame]:
    """Models without a tree, and the rows of their groups as bins. ``order`` also numbers the rows."""
    names = list(dict.fromkeys(c for columns in feature_sets.values() for c in columns))
    rows = _prepared(train, names, label, by, order)
    wanted = rows.filter(F.col("grp").isin([g for g in feature_sets if g is not None])) if by else rows
    first = wanted.groupBy("grp").agg(
        F.max(F.abs("y")).alias("most"), *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(len(names))]
    ).collect()
    facts = {r["grp"]: r for r in first}
    groups = list(feature_sets)
    if not set(groups) <= set(facts):
        raise ValueError("no training rows with a label")
    means = {g: [facts[g][f"m{i}"] for i in range(len(names))] for g in groups}
    cuts = _cuts(wanted, means, bins)
    models = {}
    for g in groups:
        known = [i for i, c in enumerate(names) if c in feature_sets[g] and means[g][i] is not None]
        scale = 2.0 ** (LABEL_BITS - int(np.ceil(np.log2(facts[g]["most"]))) if facts[g]["most"] else 0)
        models[g] = kind([names[i] for i in known], [means[g][i] for i in known], [cuts[g, i] for i in known], scale, 0)
    state = materialize(_binned(wanted, groups, models, names), "tree-state")
    totals = {r["grp"]: r for r in state.groupBy("grp").agg(F.sum("total").alias("y"), F.sum("n").alias("n")).collect()}
    for number, g in enumerate(groups):
        models[g].base = int(np.floor(totals[number]["y"] / totals[number]["n"] + 0.5))
    return models, state


def fit_boosted_sets(
    train: DataFrame,
    feature_sets: Mapping[str | None, Sequence[str]],
    label: str = "outcome",
    by: str | None = None,
    trees: int = C.BOOSTED_TREES["trees"],
    depth: int = C.BOOSTED_TREES["depth"],
    rate: float = C.BOOSTED_TREES["rate"],
    penalty: float = C.BOOSTED_TREES["penalty"],
    bins: int = C.BOOSTED_TREES["bins"],
) -> dict[str | None, BoostedModel]:
    """A model for each value of ``by`` (under None, without it), each on features of its own."""
    models, state = _started(train, feature_sets, label, by, bins, BoostedModel)
    groups = list(models)
    blocks, bases = _rows_of(state, _bin_type(models)), [models[g].base for g in groups]
    least = [_LEAST_GAIN * models[g].scale * models[g].scale for g in groups]
    older, current = None, _gradients(blocks, bases, [[] for _ in groups], depth).persist(StorageLevel.MEMORY_AND_DISK)
    for k in range(trees):
        made = _grown(current, len(groups), depth, rate, penalty, least, bins)
        if older is not None:
            older.unpersist()
        for g, tree in zip(groups, made, strict=True):
            models[g].trees.append(tree)
        older = current
        if k % WRITTEN_TREES == WRITTEN_TREES - 1:
            current = _gradients(blocks, bases, [models[g].trees for g in groups], depth)
        else:
            current = _added(current, made, depth)
        current.persist(StorageLevel.MEMORY_AND_DISK)
    for state_ in (older, current):
        if state_ is not None:
            state_.unpersist()
    return models


# ---- forest -------------------------------------------------------------------------

#: A row's number and a tree's number give the draws of the row, by quadratic steps modulo a prime.
_PRIME = (1 << 31) - 1
#: Of a bootstrap sample of many rows, a row is drawn 0, 1, 2, ... times with these chances.
DRAWS = [int(sum(math.exp(-1) / math.factorial(k) for k in range(n + 1)) * _PRIME) for n in range(9)]


def _rest(x: np.ndarray) -> np.ndarray:
    """``x`` modulo ``_PRIME``, for 0 <= x < 2^62: two folds in place of a division."""
    x = (x & _PRIME) + (x >> 31)
    x = (x & _PRIME) + (x >> 31)
    return np.where(x >= _PRIME, x - _PRIME, x)


def draws(place: np.ndarray, tree: int) -> np.ndarray:
    """How often a tree's bootstrap sample holds each row."""
    p = _rest(place)
    x = _rest((p + 1) * 40692 + (tree + 1) * 69621)
    x = _rest(x * x)
    x = _rest(x + p + 7 * tree + 1)
    x = _rest(_rest(x * x) * 48271)
    drawn = np.zeros(len(x), np.int8)
    for limit in DRAWS:
        drawn += x >= limit
    return drawn


@dataclass
class ForestModel:
    """The mean of trees over imputed features, in fractions ``1 / scale`` of a unit."""

    features: list[str]
    means: list[float]
    cuts: list[list[float]]
    scale: float
    base: int
    trees: list[Tree] = field(default_factory=list)

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, _tree_sums(self, df) / F.lit(len(self.trees) * self.scale))


def fit_forest_sets(
    train: DataFrame,
    feature_sets: Mapping[str | None, Sequence[str]],
    label: str = "outcome",
    by: str | None = None,
    trees: int = C.FOREST["trees"],
    depth: int = C.FOREST["depth"],
    bins: int = C.FOREST["bins"],
    order: Sequence[str] = ("entity_id", "period"),
) -> dict[str | None, ForestModel]:
    """A forest for each value of ``by``, any feature at any split; all trees grow a level in one pass.

    How often a tree draws a row is a function of the row's place in ``order`` (of the columns
    there are) and the tree's number, so the forest does not depend on how rows are placed. A task
    sends one table of sums for each tree; the sums of a tree meet in one place, and
    come back as its splits.
    """
    order = [c for c in order if c in train.columns]
    models, state = _started(train, feature_sets, label, by, bins, ForestModel, order or [label])
    groups = list(models)
    widths, kind = [len(models[g].features) for g in groups], _bin_type(models)
    bases = [models[g].base for g in groups]
    least = [_LEAST_GAIN * models[g].scale * models[g].scale for g in groups]
    inner = 1 << depth
    grown = [[Tree([0] * inner, [_NEVER] * inner, [0] * inner) for _ in range(trees)] for _ in groups]
    sums: dict[tuple[int, int, int], tuple[int, int]] = {}
    open_ = {(g, t, 1) for g in range(len(groups)) for t in range(trees)}

    for level in range(depth):

        nodes = 1 << level

        def send(batches: Iterator[pa.RecordBatch], level: int = level, nodes: int = nodes) -> Iterator[pa.RecordBatch]:
            parts = [b for b in batches if b.num_rows]
            blocks: dict[int, list[tuple]] = {}
            for batch in parts:
                for (g, matrix, y), place in zip(_blocks(batch, kind, "y"), batch.column("place"), strict=True):
                    blocks.setdefault(g, []).append((matrix, y - bases[g], np.frombuffer(place.as_buffer(), np.int64)))
            for g, own in blocks.items():
                for t in range(trees):
                    sums = tuple(np.zeros((widths[g], nodes * bins), np.int64) for _ in range(2))
                    for matrix, value, place in own:
                        drawn = draws(place, t)
                        at = np.flatnonzero(drawn)
                        weight = drawn[at].astype(np.float64)
                        mine = matrix[:, at]
                        first = (_reached(mine, grown[g][t], level).astype(np.int64) - nodes) * bins
                        _sums(mine, nodes * bins, first, value[at] * weight, weight, sums)
                    total, count = (a.reshape(widths[g], nodes, bins).transpose(1, 0, 2).reshape(-1) for a in sums)
                    found = np.flatnonzero(count)
                    blob = np.stack([found, total[found], count[found]]).tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([g], pa.int32()), pa.array([t], pa.int32()), pa.array([blob], pa.binary())], ["grp", "tree", "sums"]
                    )

        def split(key: tuple, table: pa.Table) -> pa.Table:
            g, t = (k.as_py() for k in key)
            width = widths[g]
            totals, counts = (np.zeros(nodes * width * bins, np.int64) for _ in range(2))
            for blob in table.column("sums").to_pylist():
                found, total, count = np.frombuffer(blob, np.int64).reshape(3, -1)
                totals[found] += total
                counts[found] += count
            found = np.flatnonzero(counts)
            cells = pa.table({
                "grp": np.full(len(found), g), "node": nodes + found // bins // width if width else found, "feature": found // bins % max(width, 1),
                "bin": found % bins, "total": totals[found], "rows": counts[found],
            })
            rows = [(node, f, b, *left, *right) for (_, node), (f, b, left, right) in _best_splits(cells, 0.0, least).items()]
            first = cells.filter(pa.compute.equal(cells.column("feature"), 0))
            rows += [(0, 0, 0, int(np.sum(first.column("total"))), int(np.sum(first.column("rows"))), 0, 0)]
            made = pa.array([[int(v) for v in row] for row in rows], pa.list_(pa.int64()))
            return pa.table({"grp": pa.array([g] * len(rows), pa.int32()), "tree": pa.array([t] * len(rows), pa.int32()), "made": made})

        sent = state.mapInArrow(send, "grp int, tree int, sums binary")
        # At most a split for every node of the level and tree.
        rows = sent.groupBy("grp", "tree").applyInArrow(split, "grp int, tree int, made array<long>").collect()
        best = {}
        for row in rows:
            node, feature, bin_, *sides = row["made"]
            if node:
                best[row["grp"], row["tree"], node] = (feature, bin_, tuple(sides[:2]), tuple(sides[2:]))
            elif not level:
                sums[row["grp"], row["tree"], 1] = tuple(sides[:2])
        reached = set()
        for g, t, node in open_:
            if (g, t, node) in best:
                feature, bin_, left, right = best[g, t, node]
                grown[g][t].features[node], grown[g][t].bins[node] = feature, bin_
                sums[g, t, 2 * node], sums[g, t, 2 * node + 1] = left, right
                reached |= {(g, t, 2 * node), (g, t, 2 * node + 1)}
            else:
                for below in range(depth - level):
                    sums[g, t, node << (below + 1)] = sums.get((g, t, node), (0, 0))
        open_ = reached
    for g, name in enumerate(groups):
        for t, tree in enumerate(grown[g]):
            for k in range(inner):
                total, count = sums.get((g, t, inner + k), (0, 0))
                tree.leaves[k] = bases[g] + (int(np.floor(float(total) / count + 0.5)) if count else 0)
        models[name].trees = grown[g]
    return models
