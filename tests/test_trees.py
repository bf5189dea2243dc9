"""Quantiles, boosted trees against plain Python."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from pitval.operators import models as md
from pitval.operators import quantiles, trees


def plain_boosting(rows, features, count, depth, rate, bins=256, penalty=1.0):
    """Predictions of ``rows`` (x..., y) after ``count`` trees, one row at a time."""
    means = [np.mean([r[0][i] for r in rows if r[0][i] is not None]) for i in range(features)]
    x = [[means[i] if r[0][i] is None else r[0][i] for i in range(features)] for r in rows]
    n = len(x)
    cuts = []
    for i in range(features):
        ordered = sorted(v[i] for v in x)
        cuts.append(sorted({ordered[math.ceil(j * n / bins) - 1] for j in range(1, bins)}))
    most = max(abs(r[1]) for r in rows)
    scale = 2.0 ** (28 - math.ceil(math.log2(most)))
    y = [math.floor(r[1] * scale + 0.5) for r in rows]
    margin = [math.floor(sum(y) / n + 0.5)] * n

    def gain(g, h):
        return float(g) * float(g) / (h + penalty)

    for _ in range(count):
        g = [m - t for m, t in zip(margin, y, strict=True)]

        def leaf(at, level, g=g):
            total = sum(g[k] for k in at)
            best = None
            if level < depth:
                for i in range(features):
                    for c in cuts[i]:
                        left = [k for k in at if x[k][i] <= c]
                        if not left or len(left) == len(at):
                            continue
                        gl = sum(g[k] for k in left)
                        score = gain(gl, len(left)) + gain(total - gl, len(at) - len(left))
                        if score - gain(total, len(at)) > 1e-6 * scale * scale and (best is None or score > best[0]):
                            best = (score, left, [k for k in at if x[k][i] > c])
            if best:
                leaf(best[1], level + 1)
                leaf(best[2], level + 1)
            else:
                value = math.floor(-float(total) / (len(at) + penalty) * rate + 0.5)
                for k in at:
                    margin[k] += value

        leaf(list(range(n)), 0)
    return [m / scale for m in margin]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    made = []
    for _ in range(90):
        a, b = rng.choice([None, rng.random()]), rng.randint(0, 5)
        made.append(((a, float(b), rng.gauss(0, 100)), (a or 0) * 3 + (b > 2) * 2 + rng.gauss(0, 0.3)))
    return made


def frame(spark, rows, **more):
    data = [(k, *r[0], r[1]) for k, r in enumerate(rows)]
    return spark.createDataFrame(data, "i long, a double, b double, c double, outcome double")


def predicted(model, df):
    return [r["prediction"] for r in model.predict(df).orderBy("i").collect()]


def test_boosting_against_plain_python(spark, rows):
    df = frame(spark, rows)
    model = md.fit_boosted_trees(df, ["a", "b", "c"], trees=4, depth=2, rate=0.3)
    assert predicted(model, df) == plain_boosting(rows, 3, 4, 2, 0.3)
    few = md.fit_boosted_trees(df, ["a", "b", "c"], trees=2, depth=3, rate=0.5, bins=4)
    assert predicted(few, df) == plain_boosting(rows, 3, 2, 3, 0.5, bins=4)


def test_the_placement_of_rows_does_not_show(spark, rows, monkeypatch):
    df = frame(spark, rows)
    whole = md.fit_boosted_trees(df.coalesce(1), ["a", "b", "c"], trees=5)
    monkeypatch.setattr(trees, "WRITTEN_TREES", 2)
    assert md.fit_boosted_trees(df.repartition(7), ["a", "b", "c"], trees=5).trees == whole.trees


def test_a_pass_of_boosting_plans_no_query(spark, rows, monkeypatch):
    """Also where the sums of many tasks meet in steps; the trees are the same."""
    df, calls = frame(spark, rows), []
    whole = md.fit_boosted_trees(df.coalesce(1), ["a", "b", "c"], trees=4)
    planned = DataFrame.mapInArrow
    monkeypatch.setattr(DataFrame, "mapInArrow", lambda self, *a, **k: calls.append(1) or planned(self, *a, **k))
    monkeypatch.setattr(trees, "SENT_AT_ONCE", 1)
    made = md.fit_boosted_trees(df.repartition(7), ["a", "b", "c"], trees=4)
    assert len(calls) == 1 and made.trees == whole.trees


def test_groups_are_fitted_as_if_alone(spark, rows):
    df = frame(spark, rows).withColumn("role", F.when(F.col("i") % 3 == 0, "x").otherwise("y"))
    both = trees.fit_boosted_sets(df, {"x": ["a", "b"], "y": ["c", "b"]}, by="role", trees=3)
    for role, columns in (("x", ["a", "b"]), ("y", ["c", "b"])):
        own = df.filter(F.col("role") == role)
        alone = md.fit_boosted_trees(own, columns, trees=3)
        assert predicted(both[role], own) == predicted(alone, own)


def test_nothing_to_split(spark, rows):
    df = frame(spark, rows).withColumn("outcome", F.lit(2.5)).withColumn("none", F.lit(None).cast("double"))
    assert set(predicted(md.fit_boosted_trees(df, ["a", "none"], trees=2), df)) == {2.5}
    assert set(predicted(md.fit_boosted_trees(df.withColumn("outcome", F.lit(0)), ["a"], trees=2), df)) == {0.0}
    with pytest.raises(ValueError, match="no training rows"):
        md.fit_boosted_trees(df.filter("i < 0"), ["a"])


@pytest.mark.parametrize("kind", ["few", "wide", "dense"])
def test_values_at_ranks(spark, monkeypatch, kind):
    monkeypatch.setattr(quantiles, "RANGES", 5)
    rng = random.Random(3)
    draw = {"few": lambda: float(rng.randint(0, 3)), "wide": lambda: rng.choice([-1, 1]) * 10 ** rng.uniform(-250, 308), "dense": lambda: 1 + rng.random() * 1e-13}[kind]
    rows = [(g, draw() if rng.random() < 0.9 else rng.choice([None, float("nan")])) for g in ("p", "q", None) for _ in range(25)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = quantiles.values_at_ranks(df, "v", F.sequence(F.lit(1).cast("long"), F.col("n")), ["g"]).collect()
    want = []
    for g in ("p", "q", None):
        values = sorted(v for h, v in rows if h == g and v is not None and v == v)
        want += [(g, k, v) for k, v in enumerate(values, 1)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_medians(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 9.0), ("a", 2.0), ("b", 4.0), ("b", 7.0), ("c", None)], "g string, v double")
    assert sorted(map(tuple, quantiles.exact_median(df, "v", ["g"]).collect())) == [("a", 2.0), ("b", 5.5)]
    assert quantiles.exact_median(df, "v").collect()[0][0] == 4.0
    none = df.filter("g = 'c'")
    assert quantiles.exact_median(none, "v").collect()[0][0] is None and quantiles.exact_median(none, "v", ["g"]).collect() == []


def plain_forest(rows, features, count, depth, bins=256):
    """Predictions of ``rows`` after ``count`` trees on samples drawn by place and tree."""
    means = [np.mean([r[0][i] for r in rows if r[0][i] is not None]) for i in range(features)]
    x = [[means[i] if r[0][i] is None else r[0][i] for i in range(features)] for r in rows]
    n = len(x)
    cuts = []
    for i in range(features):
        ordered = sorted(v[i] for v in x)
        cuts.append(sorted({ordered[math.ceil(j * n / bins) - 1] for j in range(1, bins)}))
    scale = 2.0 ** (28 - math.ceil(math.log2(max(abs(r[1]) for r in rows))))
    y = [math.floor(r[1] * scale + 0.5) for r in rows]
    base = math.floor(sum(y) / n + 0.5)
    total = [0] * n

    for t in range(count):
        w = trees.draws(np.arange(n), t).tolist()

        def leaf(at, everyone, level, w=w):
            g, c = sum(w[k] * (y[k] - base) for k in at), sum(w[k] for k in at)
            best = None
            if level < depth:
                for i in range(features):
                    for cut in cuts[i]:
                        left = [k for k in at if x[k][i] <= cut]
                        gl, cl = sum(w[k] * (y[k] - base) for k in left), sum(w[k] for k in left)
                        if not cl or cl == c:
                            continue
                        score = float(gl) * gl / cl + float(g - gl) * (g - gl) / (c - cl)
                        if score - float(g) * g / c > 1e-6 * scale * scale and (best is None or score > best[0]):
                            best = (score, i, cut)
            if best:
                _, i, cut = best
                for side in (True, False):
                    leaf([k for k in at if (x[k][i] <= cut) == side], [k for k in everyone if (x[k][i] <= cut) == side], level + 1)
            else:
                for k in everyone:
                    total[k] += base + math.floor(g / c + 0.5)

        leaf([k for k in range(n) if w[k]], list(range(n)), 0)
    return [v / (count * scale) for v in total]


def test_forest_against_plain_python(spark, rows):
    df = frame(spark, rows).withColumnRenamed("i", "entity_id")
    model = md.fit_forest(df, ["a", "b", "c"], trees=4, depth=3)
    got = [r["prediction"] for r in model.predict(df).orderBy("entity_id").collect()]
    assert got == plain_forest(rows, 3, 4, 3)


def test_a_forest_does_not_depend_on_placement(spark, rows):
    df = frame(spark, rows).withColumnRenamed("i", "entity_id").withColumn("role", F.when(F.col("entity_id") % 3 == 0, "x").otherwise("y"))
    sets = {"x": ["a", "b"], "y": ["c", "b"]}
    whole = trees.fit_forest_sets(df.coalesce(1), sets, by="role", trees=6, depth=3)
    dealt = trees.fit_forest_sets(df.repartition(5), sets, by="role", trees=6, depth=3)
    assert {k: m.trees for k, m in whole.items()} == {k: m.trees for k, m in dealt.items()}
    assert whole["x"].trees != whole["y"].trees


def test_blends_of_several_roles_share_their_passes(spark, rows, monkeypatch):
    df = frame(spark, rows).withColumn("role", F.when(F.col("i") % 3 == 0, "x").otherwise("y"))
    calls = []
    few = lambda *a, **k: calls.append(a[1]) or trees.fit_boosted_sets(*a, **(k | {"trees": 2}))
    monkeypatch.setattr(md, "fit_boosted_sets", few)
    made = md.fit_models(df, {"x": (["a", "b"], md.fit_blend), "y": (["c", "b"], md.fit_blend)})
    assert len(calls) == 1 and set(calls[0]) == {"x", "y"}
    for role, columns in (("x", ["a", "b"]), ("y", ["c", "b"])):
        own = df.filter(F.col("role") == role)
        parts = [predicted(md.fit_ridge(own, columns), own), predicted(md.fit_boosted_trees(own, columns, trees=2), own)]
        assert predicted(made[role], own) == pytest.approx([(a + b) / 2 for a, b in zip(*parts, strict=True)], abs=1e-9)


def test_rows_lie_in_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(trees, "BLOCK_ROWS", 20)
    _, state = trees._started(frame(spark, rows).coalesce(1), {None: ["a", "b"]}, "outcome", None, 256, trees.BoostedModel)
    assert state.count() < len(rows) and sum(r["n"] for r in state.select("n").collect()) == len(rows)


def test_draws_are_those_of_a_division():
    place, p = np.array([0, 1, 5, (1 << 31) - 2, (1 << 31) - 1, 1 << 40]), (1 << 31) - 1
    for tree in (0, 7, 299):
        want = []
        for k in place.tolist():
            x = ((k % p + 1) * 40692 + (tree + 1) * 69621) % p
            x = (x * x % p + k % p + 7 * tree + 1) % p
            want.append(sum(limit <= x * x % p * 48271 % p for limit in trees.DRAWS))
        assert trees.draws(place, tree).tolist() == want
