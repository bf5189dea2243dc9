"""As-of reads and training rows."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from pitval.operators import asof, dedupe
from pitval.operators import features as ft


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def dated(spark):
    data = [(1, "2024-01-01", 1.0), (2, "2024-01-01", 2.0), (1, "2024-01-05", 3.0)]
    return spark.createDataFrame(data, "entity_id long, d string, v double").withColumn(
        "as_of_date", F.to_date("d")
    )


def test_snapshot_is_one_date_for_the_whole_table(spark):
    table = dated(spark)
    assert rows(asof.snapshot_as_of(table, "2024-01-04"), "entity_id", "v") == [(1, 1.0), (2, 2.0)]
    assert rows(asof.snapshot_as_of(table, dt.date(2024, 1, 5)), "entity_id", "v") == [(1, 3.0)]
    assert rows(asof.snapshot_as_of(table), "entity_id", "v") == [(1, 3.0)]
    assert rows(asof.snapshot_as_of(table, "2023-12-31"), "entity_id") == []


def test_latest_per_key_keeps_entities_of_older_snapshots(spark):
    got = asof.latest_per_key_as_of(dated(spark), ["entity_id"])
    assert rows(got, "entity_id", "v") == [(1, 3.0), (2, 2.0)]


def test_snapshot_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    dated(spark).select("entity_id", "v", "as_of_date").write.partitionBy("as_of_date").parquet(path)
    plan = asof.snapshot_as_of(spark.read.parquet(path), "2024-01-04")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text and "Subquery" in text.split("PartitionFilters", 1)[1]


def test_asof_prior_is_strict_and_keeps_left_rows(spark):
    left = spark.createDataFrame([(1, 2020), (1, 2022), (2, 2022)], "entity_id long, period int")
    history = spark.createDataFrame(
        [(1, 2020, 5.0), (1, 2021, 7.0)], "entity_id long, period int, def_runs double"
    )
    args = (left, history, "entity_id", "period", "period", "def_runs", "prior")
    expected = [(1, 2020, None), (1, 2022, 7.0), (2, 2022, None)]
    for join in (asof.asof_prior, asof.attach_prior_by_period):
        got = join(*args).collect()
        assert sorted(((r.entity_id, r.period, r.prior) for r in got), key=repr) == expected


def test_both_asof_joins_match_brute_force(spark):
    rng = random.Random(3)
    left = [(rng.randint(1, 6), rng.randint(0, 12), i) for i in range(300)]
    seen = {(rng.randint(1, 6), rng.randint(0, 12)) for _ in range(40)}
    history = [(k, p, None if (k + p) % 5 == 0 else float(10 * k + p)) for k, p in seen]
    expected = []
    for k, p, i in left:
        earlier = [(q, v) for key, q, v in history if key == k and q < p]
        expected.append((i, max(earlier, key=lambda e: e[0])[1] if earlier else None))
    ldf = spark.createDataFrame(left, "k long, p int, i int")
    rdf = spark.createDataFrame(history, "k long, p int, v double")
    for join in (asof.asof_prior, asof.attach_prior_by_period):
        got = join(ldf, rdf, "k", "p", "p", "v", "prior")
        assert sorted((r.i, r.prior) for r in got.collect()) == sorted(expected), join.__name__


def test_a_key_that_owns_all_rows_spans_tasks(spark):
    """Long gaps without history, null values, and a key before and after the hot one."""
    rng = random.Random(4)
    history = [(5, p, None if p % 11 == 0 else float(p)) for p in rng.sample(range(3000), 40)] + [(4, 7, 1.0), (6, 9, 2.0)]
    left = [(5, p, p) for p in range(3000)] + [(4, 3, 9001), (4, 8, 9002), (6, 9, 9003), (6, 10, 9004), (7, 1, 9005), (None, 1, 9006)]
    expected = []
    for k, p, i in left:
        earlier = [(q, v) for key, q, v in history if key == k and q < p]
        expected.append((i, max(earlier, key=lambda e: e[0])[1] if earlier else None))
    ldf = spark.createDataFrame(left, "k long, p int, i int")
    rdf = spark.createDataFrame(history, "k long, p int, v double")
    got = asof.asof_prior(ldf, rdf, "k", "p", "p", "v", "prior").collect()
    assert sorted((r.i, r.prior) for r in got) == sorted(expected)


OUTCOMES = "entity_id long, period int, stint int, role string, outcome double, def_runs double, cost double"


def test_training_rows_do_not_fan_out(spark):
    outcomes = spark.createDataFrame(
        [
            (1, 2020, 1, "bat", 1.5, None, None),
            (1, 2020, 2, "bat", 2.0, 1.0, 5.0),
            (1, 2020, 3, "bat", None, None, 4.0),
        ],
        OUTCOMES,
    )
    features = spark.createDataFrame([(1, 2020, "bat", 10.0)], "entity_id long, period int, role string, pa double")
    assert rows(ft.training_rows(features, outcomes), "entity_id", "pa", "outcome") == [(1, 10.0, 3.5)]
    assert rows(ft.cost_by_entity(outcomes, 2020), "entity_id", "cost") == [(1, 5.0)]


def test_lag1_needs_the_very_next_period(spark):
    made = [(1, p, 1, "bat", float(p), None, None) for p in (2019, 2021, 2022)]
    outcomes = spark.createDataFrame(made, OUTCOMES)
    features = spark.createDataFrame(
        [(1, p, "bat", 1.0) for p in (2019, 2021, 2022)], "entity_id long, period int, role string, pa double"
    )
    got = ft.lag1_rows(features, outcomes)
    assert rows(got, "period", "target_period", "outcome_this_period", "outcome") == [(2021, 2022, 2021.0, 2022.0)]


def test_prior_fielding_is_for_one_role_only(spark):
    base = spark.createDataFrame(
        [(1, 2021, "bat"), (1, 2021, "pitch")], "entity_id long, period int, role string"
    )
    history = spark.createDataFrame([(1, 2020, 3.0)], "entity_id long, period int, def_runs double")
    got = ft.with_prior_fielding(base, history).select("role", "prior_def_runs").collect()
    assert {r.role: r.prior_def_runs for r in got} == {"bat": 3.0, "pitch": None}


def test_prior_outcome_defaults_to_zero(spark):
    base = spark.createDataFrame([(1, 2021), (1, 2023)], "entity_id long, period int")
    totals = spark.createDataFrame([(1, 2020, 2.5)], "entity_id long, period int, outcome double")
    assert rows(ft.prior_outcome_or_zero(base, totals), "period", "prediction") == [(2021, 2.5), (2023, 0.0)]


def test_dedupe_prefers_volume_and_drops_rows_before_the_shuffle(spark):
    data = [(1, 5.0, "a"), (1, 9.0, "b"), (1, None, "c"), (2, None, "d")]
    df = spark.createDataFrame(data, "k long, v double, t string")
    got = dedupe.highest_volume(df, ["k"], "v", [F.col("t")])
    assert rows(got, "k", "t") == [(1, "b"), (2, "d")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
