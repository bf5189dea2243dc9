"""Per-role regressions: fit on one frame, predict another.

Linear models are solved on moments: the sums and cross products of all features and the
label, from two aggregations whatever the number of fits. A fit on some of the features is a
sub-matrix of the same moments, a fit per role is a group of the same aggregation. Trees
share histograms. Only coefficients and summaries of ``features`` size reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitval import constants as C
from pitval.functions.numeric import finite
from pitval.operators.skew import with_position
from pitval.operators.trees import BoostedModel, ForestModel, fit_boosted_sets, fit_forest_sets


#: Coordinate descent ends when no weight changes by more, relative to the greatest one.
SOLVED = 1e-12


@dataclass
class LinearModel:
    """Weights of raw features; a missing value counts as the training mean."""

    features: list[str]
    means: list[float]
    weights: list[float]
    offset: float
    strength: float

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        made = F.lit(self.offset)
        for name, mean, weight in zip(self.features, self.means, self.weights, strict=True):
            value = F.coalesce(finite(F.col(name).cast("double")), F.lit(mean))
            made = made + F.lit(weight) * (value - F.lit(mean))
        return df.withColumn(out, made)


def _numeric(train: DataFrame, features: Sequence[str], label: str, keep: Sequence[str] = ()) -> DataFrame:
    return train.select(
        *keep,
        *[finite(F.col(c).cast("double")).alias(f"_x_{c}") for c in features],
        F.col(label).cast("double").alias("_y"),
    ).filter("_y is not null")


@dataclass
class _Summary:
    rows: int
    label_std: float
    features: list[str]
    correlations: list[float]


def _summary(rows: DataFrame, features: Sequence[str]) -> _Summary:
    """Row count, label spread, features with any value and their correlation to the
    label: one aggregation, one row."""
    aggregates = [F.count(F.lit(1)).alias("n"), F.stddev_pop("_y").alias("s")]
    for i, c in enumerate(features):
        spread = F.stddev_pop(f"_x_{c}") * F.stddev_pop("_y")
        related = F.try_divide(F.covar_pop(f"_x_{c}", "_y"), spread)
        aggregates += [F.count(f"_x_{c}").alias(f"c{i}"), related.alias(f"r{i}")]
    row = rows.agg(*aggregates).first()
    used = [i for i in range(len(features)) if row[f"c{i}"] > 0]
    correlations = [abs(row[f"r{i}"] or 0.0) for i in used]
    return _Summary(
        row["n"],
        row["s"] or 0.0,
        [features[i] for i in used],
        [0.0 if math.isnan(r) else r for r in correlations],
    )


@dataclass
class Moments:
    """Centred cross products of the features and, last, the label.

    Features are centred on the mean of their known values and a missing one counts as the
    mean, so it adds nothing. Features without any value are left out.
    """

    features: list[str]
    rows: int
    means: np.ndarray
    products: np.ndarray

    def subset(self, features: Sequence[str]) -> Moments:
        """The moments of some of the features."""
        names = [c for c in features if c in self.features]
        at = [*(self.features.index(c) for c in names), len(self.features)]
        return Moments(names, self.rows, self.means[at], self.products[np.ix_(at, at)])

    def ridge(self, alpha: float = C.RIDGE_ALPHA) -> LinearModel:
        """Least squares on standardized features, with ``alpha`` times the squared weights."""
        spreads = np.sqrt(np.diag(self.products)[:-1] / self.rows)
        spreads[spreads == 0] = 1.0
        gram = self.products[:-1, :-1] / np.outer(spreads, spreads)
        solved = np.linalg.solve(gram + alpha * np.eye(len(gram)), self.products[:-1, -1] / spreads)
        weights = solved / spreads
        return LinearModel(self.features, self.means[:-1].tolist(), weights.tolist(), float(self.means[-1]), alpha)


def moments_by(
    train: DataFrame, features: Sequence[str], label: str = "outcome", by: str | None = None
) -> dict[object, Moments]:
    """Moments for each value of ``by`` (one, under None, without it): one aggregation for the
    means, one for the centred products. Groups without a labelled row are not there."""
    names = list(dict.fromkeys(features))
    group = F.lit(None).cast("string") if by is None else F.col(by)
    rows = _numeric(train.withColumn("_group", group), names, label, keep=["_group"])
    inputs = [f"_x_{c}" for c in names] + ["_y"]
    first = rows.groupBy("_group").agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(inputs)]).collect()
    if not first:
        return {}
    centre = F.coalesce(*[
        F.when(F.col("_group").eqNullSafe(F.lit(r["_group"])), F.array(*[F.lit(r[f"m{i}"]).cast("double") for i in range(len(inputs))]))
        for r in first
    ])
    centred = rows.withColumn("_centre", centre).select(
        "_group", *[F.coalesce(F.col(c) - F.col("_centre")[i], F.lit(0.0)).alias(f"z{i}") for i, c in enumerate(inputs)]
    )
    pairs = [(i, j) for i in range(len(inputs)) for j in range(i, len(inputs))]
    sums = centred.groupBy("_group").agg(*[F.sum(F.col(f"z{i}") * F.col(f"z{j}")).alias(f"p{i}_{j}") for i, j in pairs])
    products = {r["_group"]: r for r in sums.collect()}
    made = {}
    for row in first:
        whole = np.zeros((len(inputs), len(inputs)))
        for i, j in pairs:
            whole[i, j] = whole[j, i] = products[row["_group"]][f"p{i}_{j}"]
        known = [i for i in range(len(inputs)) if row[f"m{i}"] is not None]
        means = np.array([row[f"m{i}"] for i in known])
        made[row["_group"]] = Moments([names[i] for i in known[:-1]], row["n"], means, whole[np.ix_(known, known)])
    return made


def fit_ridge_sets(
    train: DataFrame,
    feature_sets: Mapping[str, Sequence[str]],
    label: str = "outcome",
    alpha: float = C.RIDGE_ALPHA,
    by: str | None = None,
) -> dict[str, LinearModel]:
    """A ridge regression for each set of features, all from the same moments.

    With ``by``, the name of a set is the value of that column whose rows train it.
    """
    every = [c for columns in feature_sets.values() for c in columns]
    found = moments_by(train, every, label, by)
    models = {}
    for name, columns in feature_sets.items():
        moments = found.get(name if by else None)
        if moments is None:
            raise ValueError("no training rows with a label")
        models[name] = moments.subset(columns).ridge(alpha)
    return models


def fit_ridge(
    train: DataFrame, features: Sequence[str], label: str = "outcome", alpha: float = C.RIDGE_ALPHA
) -> LinearModel:
    """Ridge on mean-imputed, standardized features."""
    return fit_ridge_sets(train, {"all": features}, label, alpha)["all"]


def fit_boosted_trees(
    train: DataFrame, features: Sequence[str], label: str = "outcome", **settings
) -> BoostedModel:
    """Shallow boosted trees with a low learning rate, on imputed features."""
    return fit_boosted_sets(train, {None: features}, label, **settings)[None]


def fit_forest(train: DataFrame, features: Sequence[str], label: str = "outcome", **settings) -> ForestModel:
    """Random forest that may split on any feature, on imputed features."""
    return fit_forest_sets(train, {None: features}, label, **settings)[None]


def fit_elastic_net(
    train: DataFrame,
    features: Sequence[str],
    label: str = "outcome",
    folds: int = C.ELASTIC_FOLDS,
    strengths: int = C.ELASTIC_STRENGTHS,
    mix: float = C.ELASTIC_MIX,
    order: Sequence[str] = ("entity_id", "period"),
) -> LinearModel:
    """Elastic net whose strength is chosen by cross-validation on the training rows.

    Features are imputed and standardized once. One aggregation then gives the moments of
    every fold; the path of strengths, from the smallest one that zeroes every coefficient
    down by three decades, is solved on those moments, whatever the number of rows. Folds are
    contiguous in the order of those of the columns ``order`` that there are, the first ones
    longer by a row if need be; rows alike in them are ordered by a hash of what they hold.
    """
    order = [c for c in order if c in train.columns]
    rows = _numeric(train.withColumns({f"_o{i}": F.col(c) for i, c in enumerate(order)}), features, label, [f"_o{i}" for i in range(len(order))])
    summary = _summary(rows, list(features))
    if summary.rows == 0:
        raise ValueError("no training rows with a label")
    names = summary.features
    first = rows.agg(
        *[F.avg(f"_x_{c}").alias(f"m{i}") for i, c in enumerate(names)],
        *[F.sqrt(F.var_pop(f"_x_{c}") * F.count(f"_x_{c}") / F.count(F.lit(1))).alias(f"s{i}") for i, c in enumerate(names)],
        F.avg("_y").alias("y"),
    ).first()
    means = np.array([first[f"m{i}"] for i in range(len(names))])
    spreads = np.array([first[f"s{i}"] or 1.0 for i in range(len(names))])
    scaled = [
        ((F.coalesce(F.col(f"_x_{c}"), F.lit(float(m))) - F.lit(float(m))) / F.lit(float(s))).alias(f"z{i}")
        for i, (c, m, s) in enumerate(zip(names, means, spreads, strict=True))
    ]
    rows = with_position(rows.withColumn("_hash", F.xxhash64(*rows.columns)), [*(f"_o{i}" for i in range(len(order))), "_hash"], "_place")
    size, longer = divmod(summary.rows, folds)
    place, edge = F.col("_place"), longer * (size + 1)
    fold = F.when(place < edge, F.floor(place / (size + 1))).otherwise(longer + F.floor((place - edge) / max(size, 1))).alias("fold")
    columns = [*(f"z{i}" for i in range(len(names))), "y"]
    made = rows.select(*scaled, (F.col("_y") - F.lit(float(first["y"]))).alias("y"), fold)
    pairs = [(a, b) for a in range(len(columns)) for b in range(a, len(columns))]
    sums = made.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(c).alias(f"t{a}") for a, c in enumerate(columns)],
        *[F.sum(F.col(columns[a]) * F.col(columns[b])).alias(f"p{a}_{b}") for a, b in pairs],
    ).collect()
    moments = []
    for row in sums:
        products = np.zeros((len(columns), len(columns)))
        for a, b in pairs:
            products[a, b] = products[b, a] = row[f"p{a}_{b}"]
        moments.append(_Moments(row["n"], np.array([row[f"t{a}"] for a in range(len(columns))]), products))
    whole = _total(moments)
    gram, target, _ = whole.centred()
    top = max(np.abs(target).max(initial=0.0), 1e-9) / mix
    path = top * np.logspace(0, -3, strengths)
    errors = np.zeros(strengths)
    for held in moments:
        rest = _total([m for m in moments if m is not held])
        if rest.n:
            errors += [held.error(w, c) for w, c in rest.solved(path, mix)]
    best = int(errors.argmin())
    weights, offset = whole.solved(path[: best + 1], mix)[-1]
    weights = weights / spreads
    return LinearModel(names, means.tolist(), weights.tolist(), float(first["y"] + offset), float(path[best]))


@dataclass
class _Moments:
    """Count, sums and products of the scaled features and, last, the label."""

    n: int
    sums: np.ndarray
    products: np.ndarray

    def centred(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        means = self.sums / self.n
        spread = self.products / self.n - np.outer(means, means)
        return spread[:-1, :-1], spread[:-1, -1], means

    def solved(self, path: Sequence[float], mix: float) -> list[tuple[np.ndarray, float]]:
        """Weights and offset per strength by coordinate descent, each from the one before."""
        gram, target, means = self.centred()
        weights, found = np.zeros(len(target)), []
        for strength in path:
            for _ in range(1000):
                change = 0.0
                for j in range(len(weights)):
                    if gram[j, j] <= 0:
                        continue
                    pull = target[j] - gram[j] @ weights + gram[j, j] * weights[j]
                    new = np.sign(pull) * max(abs(pull) - strength * mix, 0.0) / (gram[j, j] + strength * (1 - mix))
                    change = max(change, abs(new - weights[j]))
                    weights[j] = new
                if change <= SOLVED * max(1.0, np.abs(weights).max(initial=0.0)):
                    break
            found.append((weights.copy(), float(means[-1] - means[:-1] @ weights)))
        return found

    def error(self, weights: np.ndarray, offset: float) -> float:
        """Mean squared error of a linear model on these rows."""
        w = np.append(-weights, 1.0)
        return (w @ self.products @ w - 2 * offset * (w @ self.sums) + self.n * offset**2) / self.n


def _total(parts: Sequence[_Moments]) -> _Moments:
    return _Moments(sum(p.n for p in parts), sum(p.sums for p in parts), sum(p.products for p in parts))


@dataclass
class BlendModel:
    """The mean of the predictions of several models."""

    parts: list

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        names = [f"_part{i}" for i in range(len(self.parts))]
        made = df
        for name, part in zip(names, self.parts, strict=True):
            made = part.predict(made, name)
        mean = sum((F.col(n) for n in names[1:]), F.col(names[0])) / len(names)
        return made.withColumn(out, mean).drop(*names)


def fit_blend(train: DataFrame, features: Sequence[str], label: str = "outcome", **boosted) -> BlendModel:
    """The mean of the ridge and the boosted-tree prediction."""
    return BlendModel([fit_ridge(train, features, label), fit_boosted_trees(train, features, label, **boosted)])


Model = LinearModel | BoostedModel | ForestModel | BlendModel
Fit = Callable[[DataFrame, Sequence[str], str], Model]


def fit_models(
    train: DataFrame, models: Mapping[str, tuple[Sequence[str], Fit]], label: str = "outcome", by: str = "role"
) -> dict[str, Model]:
    """A model for each value of ``by``: (features, fit). All ridge models come from the same
    moments, all boosted ones and all forests from the same passes, also those of blends."""

    def sets(kind: Fit) -> dict[str, Sequence[str]]:
        return {name: columns for name, (columns, fit) in models.items() if fit is kind}

    made: dict[str, Model] = {}
    if linear := sets(fit_ridge):
        made |= fit_ridge_sets(train, linear, label, by=by)
    if boosted := sets(fit_boosted_trees):
        made |= fit_boosted_sets(train, boosted, label, by=by)
    if forests := sets(fit_forest):
        made |= fit_forest_sets(train, forests, label, by=by)
    if blends := sets(fit_blend):
        parts = [fit(train, blends, label, by=by) for fit in (fit_ridge_sets, fit_boosted_sets)]
        made |= {name: BlendModel([own[name] for own in parts]) for name in blends}
    for name, (columns, fit) in models.items():
        if name not in made:
            made[name] = fit(train.filter(F.col(by) == name), columns, label)
    return made


def fit_predict(
    train: DataFrame, test: DataFrame, features: Sequence[str], fit: Fit = fit_ridge,
    label: str = "outcome", out: str = "prediction",
) -> DataFrame:
    return fit(train, features, label).predict(test, out)


def impute_scale_statistics(train: DataFrame, features: Sequence[str]) -> DataFrame:
    """Per feature the mean of its known values and the population standard deviation
    after filling with that mean. One row per feature."""
    filled_std = [
        F.sqrt(F.var_pop(x) * F.count(x) / F.count(F.lit(1))).alias(f"s_{c}")
        for c, x in ((c, finite(F.col(c).cast("double"))) for c in features)
    ]
    means = [F.avg(finite(F.col(c).cast("double"))).alias(f"m_{c}") for c in features]
    one = train.agg(*means, *filled_std)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"), F.col(f"m_{c}").alias("mean"), F.col(f"s_{c}").alias("std")
            )
            for c in features
        ]
    )
    return one.select(F.explode(rows).alias("r")).select("r.*")
