"""The pair search against all pairs compared in Python."""

from __future__ import annotations

import random

import pytest

from pitval.operators.pairs import PAIR_COLUMNS, closest_pairs

SCHEMA = (
    "entity_id long, group_code string, name string, primary_pos string, other_pos string, "
    "surplus_value double"
)


def codes(row):
    return {c for c in [row[3], *((row[4] or "").split(","))] if c}


def brute(data, n, fit=True, group=None):
    found = []
    valued = sorted((r for r in data if r[5] is not None), key=lambda r: (r[5], r[0]))
    for i, low in enumerate(valued):
        for up in valued[i + 1 :]:
            if low[1] is not None and low[1] == up[1]:
                continue
            if fit and not codes(low) & codes(up):
                continue
            if group is not None and (low[1] == group) == (up[1] == group):
                continue
            found.append((up[5] - low[5], -low[5], -low[0], up[5], up[0], low, up))
    found.sort(key=lambda f: f[:5])
    out = []
    for gap, *_, low, up in found[:n]:
        low_is_a = low[1] == group if group is not None else low[0] < up[0]
        a, b = (low, up) if low_is_a else (up, low)
        out.append((a[0], a[1], a[2], a[3], a[5], b[0], b[1], b[2], b[3], b[5], gap))
    return out


def make(seed, size, values, groups=("A", "B", None)):
    rng = random.Random(seed)
    positions = ["1B", "2B", "OF", "C", None]
    return [
        (
            i,
            rng.choice(groups),
            f"n{i}",
            rng.choice(positions),
            ",".join(rng.sample(["1B", "OF", "SS", ""], rng.randint(0, 3))) or None,
            rng.choice(values) if rng.random() > 0.03 else None,
        )
        for i in rng.sample(range(10 * size), size)
    ]


CASES = {
    "spread": (250, [i * 0.37 for i in range(5000)]),
    "ties": (200, [0.0, 1.0, 1.5]),
    "equal": (120, [7.0]),
    "wide": (150, [1e9 + i for i in range(40)] + [-1e9]),
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("mode", ["fit", "any", "group"])
def test_matches_all_pairs(spark, case, mode):
    size, values = CASES[case]
    data = make(size, size, values)
    df = spark.createDataFrame(data, SCHEMA)
    fit, group = mode != "any", "B" if mode == "group" else None
    for n in (1, 7):
        got = [tuple(r) for r in closest_pairs(df, n, fit, group, block_rows=16).collect()]
        assert got == brute(data, n, fit, group)


def test_one_group_holding_nearly_everything(spark):
    data = [(i, "A", f"n{i}", "OF", None, float(i % 3)) for i in range(200)]
    data.append((999, "B", "x", "OF", None, 1.0))
    df = spark.createDataFrame(data, SCHEMA)
    got = [tuple(r) for r in closest_pairs(df, 10, block_rows=32).collect()]
    assert got == brute(data, 10)


def test_unknown_groups_still_pair(spark):
    data = [(1, None, "a", "C", None, 1.0), (2, None, "b", "C", None, 2.0)]
    got = closest_pairs(spark.createDataFrame(data, SCHEMA), 5).collect()
    assert [(r.entity_id_a, r.entity_id_b) for r in got] == [(1, 2)]


def test_group_member_is_side_a(spark):
    data = [(1, "A", "a", "C", None, 1.0), (2, "B", "b", "C", None, 2.0)]
    got = closest_pairs(spark.createDataFrame(data, SCHEMA), 5, group="B").collect()
    assert [(r.entity_id_a, r.group_code_a, r.entity_id_b) for r in got] == [(2, "B", 1)]


def test_no_entities_give_no_rows_and_all_columns(spark):
    got = closest_pairs(spark.createDataFrame([], SCHEMA), 5)
    assert got.columns == PAIR_COLUMNS
    assert len(got.columns) == 11
    assert got.count() == 0


def test_no_cartesian_product_in_the_plan(spark):
    data = make(5, 60, [float(i) for i in range(50)])
    plan = closest_pairs(spark.createDataFrame(data, SCHEMA), 5)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
