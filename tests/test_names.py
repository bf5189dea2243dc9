"""The resolution ladder and the fuzzy join."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pitval.functions.similarity import best_scores, token_set_score
from pitval.operators import fuzzy, resolve
from pitval.operators.resolve import resolve_mentions
from pitval.session import materialize

REGISTRY = "entity_id long, first_name string, last_name string"
OUTCOMES = "entity_id long, period int, group_code string"
OVERRIDES = "player_name string, group_code string, entity_id long, seq long"
MENTIONS = "feed_id long, player_name string, group_code string"


def test_one_mention_per_rule(spark):
    registry = spark.createDataFrame(
        [
            (1, "Solo", "Name"), (2, "Pat", "Twin"), (3, "Pat", "Twin"), (4, "Sam", "Team"),
            (5, "Sam", "Team"), (6, "Old", "Pair"), (7, "Old", "Pair"), (8, "Christopher", "Longname"),
            (9, "Gabriel", "Rodrigues"), (10, "Both", "Same"), (11, "Both", "Same"), (12, "Anton", "Nogroupson"),
        ],
        REGISTRY,
    )
    outcomes = spark.createDataFrame(
        [
            (2, 2026, "NYM"), (3, 2020, "NYM"), (4, 2025, "TBR"), (5, 2025, "SEA"), (8, 2024, "SDP"),
            (9, 2024, "BOS"), (10, 2025, "SEA"), (11, 2025, "SEA"), (12, 2025, None),
        ],
        OUTCOMES,
    )
    overrides = spark.createDataFrame(
        [("Nick Name", "SEA", 77, 0), ("New Kid", "MIN", 5, 1), ("New Kid", "MIN", None, 2), ("Blank Group", None, 78, 3)],
        OVERRIDES,
    )
    cases = {
        "  ": ("SEA", None, "empty_name", 0.0, 0),
        "Nick Name": ("SEA ", 77, "manual_override", 100.0, 1),
        "New Kid": ("MIN", None, "rookie_pending", 0.0, 0),
        "Blank Group": (None, 78, "manual_override", 100.0, 1),
        "Sólo Name Jr.": ("XYZ", 1, "exact", 100.0, 1),
        "Pat Twin": ("SEA", 2, "active_narrow", 95.0, 2),
        "Sam Team": ("TB", 4, "team_narrow", 92.0, 2),
        "Sam  Team": ("KC", None, "ambiguous", 0.0, 2),
        "Sam Team.": (None, None, "ambiguous", 0.0, 2),
        "Both Same": ("SEA", None, "ambiguous", 0.0, 2),
        "Old Pair": ("SEA", None, "ambiguous", 0.0, 2),
        "Zzz Qqq": ("SEA", None, "unresolved", None, 0),
        "Cristopher Longname": ("SD", 8, "fuzzy", 100 - 100 / 39, 1),
        "Christopher Longnam": (None, 8, "fuzzy", 100 - 100 / 39, 1),
        "Gabriel Rodriguez": ("MIN", None, "unresolved", 100 - 200 / 34, 0),
        "Anton Nogroupsen": ("MIN", 12, "fuzzy", 100 - 200 / 32, 1),
        "Old Pairs": ("SEA", None, "unresolved", None, 0),
    }
    mentions = spark.createDataFrame(
        [(i, name, case[0]) for i, (name, case) in enumerate(cases.items())], MENTIONS
    )
    day = dt.date(2026, 3, 1)
    got = resolve_mentions(mentions, registry, outcomes, overrides, 2026, resolved_at=day)
    by_id = {r.feed_id: r for r in got.collect()}
    assert len(by_id) == len(cases)
    for i, (name, (_, entity, method, score, count)) in enumerate(cases.items()):
        row = by_id[i]
        assert (row.entity_id, row.method, row.candidate_count) == (entity, method, count), name
        if score is None:
            active = ["pat twin", "sam team", "christopher longname", "gabriel rodrigues", "both same", "anton nogroupson"]
            score = max(token_set_score(name.lower(), other) for other in active)
            assert 0 < score < 88
        assert row.score == pytest.approx(score), name
        assert row.resolved_at == day


def test_nobody_active_scores_zero(spark):
    registry = spark.createDataFrame([(1, "Some", "One")], REGISTRY)
    outcomes = spark.createDataFrame([(1, 2001, "A")], OUTCOMES)
    mentions = spark.createDataFrame([(1, "Some Onee", "A")], MENTIONS)
    got = resolve_mentions(mentions, registry, outcomes, spark.createDataFrame([], OVERRIDES), 2026).first()
    assert (got.method, got.score, got.entity_id) == ("unresolved", 0.0, None)


def test_copies_of_one_mention_all_resolve(spark):
    registry = spark.createDataFrame([(1, "Some", "One")], REGISTRY)
    outcomes = spark.createDataFrame([(1, 2026, "A")], OUTCOMES)
    mentions = spark.range(500).select(
        F.col("id").alias("feed_id"), F.lit("some one").alias("player_name"), F.lit("A").alias("group_code")
    )
    got = resolve_mentions(mentions, registry, outcomes, spark.createDataFrame([], OVERRIDES), 2026)
    assert got.filter("method = 'exact' and entity_id = 1").select("feed_id").distinct().count() == 500


def random_names(rng, n):
    stems = ["jose", "maria", "christopher", "lee", "o", "de la cruz", "anderson", "ng", "rodriguez", "a b", "li"]
    names = set()
    while len(names) < n:
        name = " ".join(rng.choices(stems, k=rng.randint(1, 3)))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(name))
            kind = rng.random()
            if kind < 0.4:
                name = name[:at] + rng.choice("abcxyz ") + name[at:]
            elif kind < 0.8:
                name = name[:at] + name[at + 1 :]
        name = " ".join(name.split())
        if name:
            names.add(name)
    return sorted(names)


@pytest.mark.parametrize("threshold", [88, 80, 95, 60])
def test_fuzzy_pairs_equal_the_full_cross(spark, threshold):
    rng = random.Random(threshold)
    queries, names = random_names(rng, 220), random_names(rng, 220)
    queries += ["x", "aaaaaaaaaaaa", "ab ab ab", "jose " * 12 + "end"]
    names += ["y", "aaaaaaaaaaaaa", "abab", "jose " * 11 + "ends here"]
    queries = sorted({" ".join(q.split()) for q in queries})
    names = sorted({" ".join(q.split()) for q in names})
    expected = {
        (q, n): token_set_score(q, n)
        for q in queries
        for n in names
        if token_set_score(q, n) >= threshold
    }
    made = fuzzy.fuzzy_pairs(
        spark.createDataFrame([(q,) for q in queries], "norm string"),
        spark.createDataFrame([(n,) for n in names], "norm string"),
        threshold,
    )
    got = {(r.left_norm, r.right_norm): r.score for r in made.collect()}
    assert got.keys() == expected.keys()
    assert all(abs(got[k] - expected[k]) < 1e-9 for k in got)
    assert len(expected) > 200


def test_best_fuzzy_takes_the_lowest_id_of_the_best(spark):
    registry = spark.createDataFrame(
        [(9, "jose ramirez"), (4, "jose ramirez"), (2, "jose ramirezz"), (1, "")], "entity_id long, norm string"
    )
    asked = spark.createDataFrame([("ramirez jose",), ("",), ("nobody here",)], "norm string")
    got = fuzzy.best_fuzzy(asked, registry).collect()
    assert [tuple(r) for r in got] == [("ramirez jose", 4, 100.0)]


def test_thresholds_out_of_range_are_refused(spark):
    empty = spark.createDataFrame([], "norm string")
    for threshold in (0, 101):
        with pytest.raises(ValueError, match="threshold"):
            fuzzy.fuzzy_pairs(empty, empty, threshold)


@pytest.mark.parametrize("block", [2048, 40])
def test_the_best_score_below_the_threshold(spark, monkeypatch, block):
    monkeypatch.setattr(fuzzy, "BLOCK_NAMES", block)
    monkeypatch.setattr(fuzzy, "SEARCHED_PAIRS", 0 if block < 100 else 1 << 28)
    rng = random.Random(block)
    names = random_names(rng, 150)
    queries = [*random_names(rng, 60), "zzz 99", "é漢", "qqq www", "x"]
    best = {q: max(token_set_score(q, n) for n in names) for q in queries}
    open_ = {q: s for q, s in best.items() if s < 88}
    made = fuzzy.best_below(
        spark.createDataFrame([(q,) for q in open_], "norm string"), spark.createDataFrame([(n,) for n in names], "norm string")
    )
    got = {r.left_norm: r.score for r in made.collect()}
    assert got.keys() == open_.keys() and all(abs(got[q] - open_[q]) < 1e-9 for q in got)
    assert min(open_.values()) < 30 and len(open_) > 10


def test_no_names_to_be_near_to(spark):
    asked = spark.createDataFrame([("a b",)], "norm string")
    assert [tuple(r) for r in fuzzy.best_below(asked, spark.createDataFrame([], "norm string")).collect()] == [("a b", 0.0)]


def test_the_best_scores_of_a_block(spark):
    """Shared words, names beyond 64 characters, blanks and other scripts against one comparison at a time."""
    rng = random.Random(11)
    words = ["hot", "bolt", "é漢", "zzz", "x", *(str(i) for i in range(20))]
    names = [" ".join(rng.choice(words) + rng.choice(["", "q"]) for _ in range(rng.randint(1, 5))) for _ in range(80)]
    names += ["".join(rng.choice("abcé ") for _ in range(90)) for _ in range(10)] + ["", " "]
    queries, known = names[::2], names[1::2]
    assert best_scores(queries, known) == [max(token_set_score(q, n) for n in known) for q in queries]
    assert best_scores(["a"], []) == [0.0] and best_scores([], ["a"]) == []


def test_a_search_of_few_bytes_is_dealt_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(fuzzy, "BLOCK_NAMES", 10)
    made = []

    def kept(df, label):
        made.append((label, df))
        return materialize(df, label)

    monkeypatch.setattr(fuzzy, "materialize", kept)
    names = spark.createDataFrame([(f"n{i}",) for i in range(100)], "norm string")
    fuzzy.best_below(spark.createDataFrame([(f"zz {i}",) for i in range(100)], "norm string"), names).collect()
    searched = [df for label, df in made if label == "nearest-scores"]
    assert searched and "REPARTITION_BY_NUM" in searched[0]._jdf.queryExecution().toString()


def test_a_name_is_normalized_once(spark, monkeypatch):
    labels = []

    def kept(df, label):
        labels.append(label)
        return materialize(df, label)

    monkeypatch.setattr(resolve, "materialize", kept)
    mentions = spark.createDataFrame([(1, "Al Bo", None), (1, "Al Bo", None), (None, "zq", "SD")], "feed_id long, player_name string, group_code string")
    registry = spark.createDataFrame([(7, "al", "bo"), (None, "al", "bx")], "entity_id long, first_name string, last_name string")
    outcomes = spark.createDataFrame([(7, 5, "SDP")], "entity_id long, period int, group_code string")
    listed = spark.createDataFrame([], "player_name string, group_code string, entity_id long")
    made = resolve_mentions(mentions, registry, outcomes, listed, 5).select("feed_id", "entity_id", "method").collect()
    assert sorted(map(tuple, made), key=repr) == [(1, 7, "exact"), (1, 7, "exact"), (None, None, "unresolved")]
    assert {"keyed", "names", "recent", "active-names"} <= set(labels)
