"""Models against closed forms and plain-Python solvers."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitval.operators import models as md
from pitval.plans import evaluate as ev


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(240, 3)) * [1.0, 5.0, 0.2] + [0.0, 3.0, 1.0]
    y = 2 * x[:, 0] - 0.3 * x[:, 1] + rng.normal(size=240) * 0.5 + 4
    rows = [
        (i, float(a) if i % 9 else None, float(b), float(c) if i % 13 else float("inf"), None, float(t))
        for i, ((a, b, c), t) in enumerate(zip(x, y, strict=True))
    ]
    df = spark.createDataFrame(rows, "i long, a double, b double, c double, empty double, outcome double")
    return df.repartition(3).cache(), rows


def standardized(rows, cut):
    x = np.array([[np.nan if v is None or np.isinf(v) else v for v in r[1:4]] for r in rows], dtype=float)
    y = np.array([r[5] for r in rows])
    mean = np.nanmean(x[:cut], axis=0)
    x = np.where(np.isnan(x), mean, x)
    return (x - mean) / x[:cut].std(axis=0), y


def predictions(model, df):
    return np.array([r.prediction for r in model.predict(df).orderBy("i").collect()])


def test_ridge_matches_the_closed_form(data):
    df, rows = data
    z, y = standardized(rows, 200)
    zt, yt = z[:200], y[:200]
    w = np.linalg.solve(zt.T @ zt + np.eye(3), zt.T @ (yt - yt.mean()))
    model = md.fit_ridge(df.filter("i < 200"), ["a", "b", "c", "empty"])
    assert model.features == ["a", "b", "c"]
    assert predictions(model, df) == pytest.approx(yt.mean() + z @ w, abs=1e-9)


def test_elastic_net_solves_the_usual_problem(data):
    """The chosen strength, put into coordinate descent, gives the same predictions."""
    df, rows = data
    z, y = standardized(rows, 240)
    model = md.fit_elastic_net(df, ["a", "b", "c"], folds=3, strengths=4)
    mix, strength = 0.5, model.strength
    w = np.zeros(3)
    for _ in range(3000):
        for j in range(3):
            rest = y - y.mean() - z @ w + z[:, j] * w[j]
            rho = z[:, j] @ rest / len(y)
            w[j] = np.sign(rho) * max(abs(rho) - strength * mix, 0) / (1 + strength * (1 - mix))
    assert predictions(model, df) == pytest.approx(y.mean() + z @ w, abs=1e-6)


def test_trees_learn_and_the_blend_averages(data):
    df, rows = data
    y = np.array([r[5] for r in rows])
    boosted = md.fit_boosted_trees(df, ["a", "b", "c"], trees=8)
    forest = md.fit_forest(df, ["a", "b", "c"], trees=10)
    for model in (boosted, forest):
        assert ((predictions(model, df) - y) ** 2).mean() < y.var() * 0.7
    blend = md.fit_blend(df, ["a", "b", "c"], trees=8)
    both = (predictions(md.fit_ridge(df, ["a", "b", "c"]), df) + predictions(boosted, df)) / 2
    assert predictions(blend, df) == pytest.approx(both, abs=1e-9)


def test_constant_label_and_no_rows(spark, data):
    df, _ = data
    flat = md.fit_ridge(df.withColumn("outcome", F.lit(2.0)), ["a", "b"])
    assert predictions(flat, df) == pytest.approx(np.full(240, 2.0))
    with pytest.raises(ValueError, match="no training rows"):
        md.fit_ridge(df.filter("i < 0"), ["a"])


def test_role_evaluation_and_ablation(data):
    df, rows = data
    prepared = df.withColumns(
        {"role": F.lit("bat"), "period": (2020 + F.col("i") % 3).cast("int"), "entity_id": F.floor(F.col("i") / 3)}
    )
    got = {r.model: r for r in ev.evaluate_role(prepared, "bat", ["a", "b"], [2022]).collect()}
    assert set(got) == {"bat: naive_mean", "bat: naive_last", "bat: model"}
    assert got["bat: model"].r2 > got["bat: naive_mean"].r2
    assert all(r.n == 80 for r in got.values())
    prior = {(r[0] // 3, 2020 + r[0] % 3): r[5] for r in rows}
    errors = [abs(v - prior[e, 2021]) for (e, p), v in prior.items() if p == 2022]
    assert got["bat: naive_last"].mae == pytest.approx(np.mean(errors))
    sets = {"both": ["a", "b"], "one": ["b"]}
    scores = {r.model: r.r2 for r in ev.ablate(prepared, sets, [2022]).collect()}
    assert scores["both"] > scores["one"]
