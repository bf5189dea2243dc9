"""Costs, surplus, metrics and skew helpers."""

from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pitval.operators import metrics as mt
from pitval.operators import skew
from pitval.operators.costs import cost_precedence, with_surplus
from pitval.plans.resolution import method_summary, resolved_rate

COST = "entity_id long, period int, cost double"


def test_manual_costs_win_even_when_empty(spark):
    auto = spark.createDataFrame([(1, 2026, 10.0), (2, 2026, 10.0), (3, 2026, 30.0)], COST)
    manual = spark.createDataFrame(
        [(1, 2026, 20.0, 0), (2, 2026, None, 0), (3, 2027, 5.0, 0), (3, 2027, 6.0, 1)], COST + ", seq long"
    )
    costs = cost_precedence(auto, manual)
    got = {(r.entity_id, r.period): (r.cost, r.is_manual) for r in costs.collect()}
    assert got == {
        (1, 2026): (20.0, True), (2, 2026): (None, True), (3, 2026): (30.0, False), (3, 2027): (6.0, True),
    }
    rows = spark.createDataFrame(
        [(1, 0.0, 20), (2, 0.0, 20), (3, 0.0, 20), (4, 1.0, None)],
        "entity_id long, outcome_year1 double, age int",
    )
    valued = with_surplus(rows, costs, 2026)
    got = {r.entity_id: (r.surplus_value, r.cost_estimated) for r in valued.collect()}
    assert got == {
        1: (-(20.0 + 2 * 760_000), True),
        2: (-3 * 760_000.0, True),
        3: (-(30.0 + 6.0 + 760_000), True),
    }


def test_no_estimate_flag_when_every_year_is_known(spark):
    costs = spark.createDataFrame([(1, y, 1.0) for y in (2026, 2027, 2028)], COST)
    rows = spark.createDataFrame([(1, 1.0, 20)], "entity_id long, outcome_year1 double, age int")
    assert with_surplus(rows, costs, 2026).first().cost_estimated is False


def test_regression_metrics(spark):
    data = [("a", 1.0, 2.0), ("a", 3.0, 3.0), ("b", 5.0, 5.0)]
    df = spark.createDataFrame(data, "model string, y double, p double")
    got = {r.model: r for r in mt.regression_metrics(df, "y", "p", ["model"]).collect()}
    assert (got["a"].mae, got["a"].n) == (0.5, 2)
    assert got["a"].rmse == pytest.approx(0.5**0.5)
    assert got["a"].r2 == pytest.approx(0.5)
    assert got["b"].r2 is None


def test_spearman_with_ties_and_a_hot_value(spark):
    rng = random.Random(7)
    data = [(5.0 if rng.random() < 0.4 else float(rng.randint(0, 60)), float(rng.randint(0, 9))) for _ in range(700)]
    data += [(float(x), x / 10) for x in range(60)] + [(None, 1.0)]
    frame = pd.DataFrame(data, columns=["x", "y"]).dropna()
    expected = frame.x.rank().corr(frame.y.rank())
    df = spark.createDataFrame(data, "x double, y double")
    assert mt.spearman(df, "x", "y").first().rho == pytest.approx(expected, abs=1e-12)


def test_precision_and_hit_rate(spark):
    df = spark.createDataFrame([(i, float(i), float(i - 5)) for i in range(10)], "entity_id long, s double, v double")
    assert mt.precision_at_k(df, "s", "v", 3).first().rate == 1.0
    assert mt.precision_at_k(df, "s", "v", 8).first().rate == 0.5
    assert mt.hit_rate(df, "v").first().rate == 0.4


def test_hashed_pairs_are_distinct_and_as_many_as_exist(spark):
    for n, k, expected in ((3, 500, 3), (40, 500, 500), (1, 5, 0), (0, 5, 0)):
        got = [tuple(r) for r in mt.hashed_pairs(spark.range(n).withColumnRenamed("id", "entity_id"), k).collect()]
        assert len(got) == len(set(got)) == expected
        assert all(a < b for a, b in got)


def test_summary_percentages(spark):
    df = spark.createDataFrame([("exact", 1), ("exact", 2), ("fuzzy", 3), ("unresolved", None)], "method string, entity_id long")
    assert {r.method: (r.n, r.percent) for r in method_summary(df).collect()} == {
        "exact": (2, 50.0), "fuzzy": (1, 25.0), "unresolved": (1, 25.0),
    }
    assert tuple(resolved_rate(df).first()) == (3, 4, 75.0)


def test_salted_join_equals_a_plain_join(spark):
    rng = random.Random(2)
    left = [(1 if rng.random() < 0.5 else rng.choice([None, *range(2, 40)]), i) for i in range(2000)]
    right = [(k, f"v{k}{j}") for k in range(0, 30) for j in range(1 + k % 2)]
    ldf = spark.createDataFrame(left, "k long, i long")
    rdf = spark.createDataFrame(right, "k long, v string")
    for how in ("left", "inner"):
        plain = sorted(map(tuple, ldf.join(rdf, ["k"], how).collect()), key=repr)
        assert sorted(map(tuple, skew.salted_join(ldf, rdf, ["k"], how, share=0.1).collect()), key=repr) == plain


def test_crowded_buckets_hold_every_hot_key(spark):
    df = spark.range(3000).withColumn("k", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")))
    got = {r._crowded: r._salts for r in skew.crowded_buckets(df, ["k"], 0.01).collect()}
    hot = spark.range(1).select(F.pmod(F.xxhash64(F.lit(7).cast("long")), F.lit(skew.KEY_BUCKETS))).first()[0]
    assert list(got) == [hot]
    assert 33 <= got[hot] <= 36


def test_positions_are_the_global_order(spark):
    rng = random.Random(4)
    data = [(rng.choice([0.0, 1.0, 2.0]), i) for i in rng.sample(range(5000), 900)]
    df = spark.createDataFrame(data, "v double, i long")
    got = sorted((r.position, r.v, r.i) for r in skew.with_position(df, ["v", "i"]).collect())
    assert got == [(n, *row) for n, row in enumerate(sorted(data))]


def test_running_totals(spark):
    data = [(i, i % 4 + 1) for i in random.Random(5).sample(range(1000), 300)]
    df = spark.createDataFrame(data, "i long, w long")
    got = {r.i: (r.before, r.total) for r in skew.with_running_total(df, ["i"], "w", "before", "total").collect()}
    total, so_far = sum(w for _, w in data), 0
    for i, w in sorted(data):
        assert got[i] == (so_far, total)
        so_far += w
