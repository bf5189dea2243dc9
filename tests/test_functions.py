from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from pitval.functions import numeric, similarity, text, value


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("José Ramírez Jr.", "jose ramirez"),
        ("Max Muncy (LAD)", "max muncy"),
        ("Tre' Morgan", "tre morgan"),
        (None, ""),
        ("   ", ""),
        ("Ken Griffey Jr. III", "ken griffey jr"),
        ("A.J.  Smith-Shawver", "aj smith-shawver"),
        ("O’Neil (x) Cruz", "oneil cruz"),
        ("Ronald Acuña\tJr", "ronald acuna"),
        ("Jr", "jr"),
        ("é ö", "e o"),
        ("İnan Ş", "inan s"),
    ],
)
def test_normalize_name(spark, raw, expected):
    assert one(spark, text.normalize_name(F.lit(raw).cast("string"))) == (expected,)


def test_accent_table_covers_the_latin_letters_with_marks(spark):
    marked = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿāčěğńřşťž"
    plain = "AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyyacegnrstz"
    assert one(spark, text.strip_accents(F.lit(marked))) == (plain,)


def test_alias_set(spark):
    got = one(spark, *[text.alias_set(F.lit(c)) for c in ("TB", " sd ", "NYM", "", "TBD")])
    assert [set(x) for x in got] == [{"TBR", "TB", "TBD"}, {"SDP", "SD"}, {"NYM"}, set(), {"TBD"}]


def test_requested_by_is_the_reverse_of_alias_set(spark):
    codes = ["TB", "TBR", "TBD", "SD", "SDP", "NYM", "ARI"]
    for recorded in codes:
        asked = set(one(spark, text.requested_by(F.lit(recorded)))[0])
        for wanted in codes:
            accepted = set(one(spark, text.alias_set(F.lit(wanted)))[0])
            assert (wanted in asked) == (recorded in accepted), (recorded, wanted)


def test_eligible_set(spark):
    null = F.lit(None).cast("string")
    got = one(
        spark,
        text.eligible_set(F.lit("1B"), F.lit("3B,,OF")),
        text.eligible_set(null, null),
        text.eligible_set(F.lit(""), F.lit("1B, 2B,1B")),
    )
    assert [set(x) for x in got] == [{"1B", "3B", "OF"}, set(), {"1B", " 2B"}]


@pytest.mark.parametrize(
    ("age", "rate"), [(27, 0.0), (20, 0.0), (28, 0.01), (30, 0.07), (31, 0.10), (41, 0.40), (45, 0.40)]
)
def test_decline_rate(spark, age, rate):
    assert one(spark, value.decline_rate(F.lit(age)))[0] == pytest.approx(rate, abs=1e-12)


def test_value_path_and_surplus(spark):
    path = value.value_path(F.lit(4.0), F.lit(29))
    assert one(spark, *path) == pytest.approx((4.0, 3.72, 3.348))
    flat = [F.lit(1.0)] * 3
    got = one(spark, value.surplus(flat, [F.lit(760_000.0)] * 3))[0]
    assert round(got, 2) == 19_986_117.97


def test_negative_value_shrinks_toward_zero(spark):
    first, second, third = one(spark, *value.value_path(F.lit(-2.0), F.lit(35)))
    assert first < second < third < 0


def test_finite_and_numbers(spark):
    inf, nan = float("inf"), float("nan")
    assert one(spark, *[numeric.finite(F.lit(x)) for x in (inf, -inf, nan, 1.5)]) == (None, None, None, 1.5)
    assert one(spark, *[numeric.to_id(F.lit(x)) for x in ("12.0", "12", "x")]) == (12, 12, None)
    assert one(spark, numeric.rate_per_nine(F.lit(3.0), F.lit(0.0))) == (None,)


def brute_lcs(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        previous = row
        row = [0]
        for j, y in enumerate(b):
            row.append(previous[j] + 1 if x == y else max(previous[j + 1], row[j]))
    return row[-1]


def test_lcs_matches_the_table_recurrence():
    rng = random.Random(1)
    for _ in range(500):
        a = "".join(rng.choices("abc ", k=rng.randint(0, 90)))
        b = "".join(rng.choices("abc ", k=rng.randint(0, 90)))
        assert similarity.lcs_length(a, b) == brute_lcs(a, b)


@pytest.mark.parametrize(
    ("a", "b", "score"),
    [
        ("jose ramirez", "ramirez jose", 100.0),
        ("jose", "jose ramirez", 100.0),
        ("", "jose", 0.0),
        (None, "jose", 0.0),
        ("abc", "xyz", 0.0),
        ("matthew boyd", "matt boyd", 100 - 100 * 3 / 21),
        ("max anderson", "tim anderson", 100 - 100 * 4 / 24),
        ("a bcdefghijk", "b bcdefghijk", 100 - 100 * 2 / 24),
        ("a bcdefghijklmnop", "bcdefghijklmnop xyzxyzxyz", 100 - 100 * 2 / 32),
    ],
)
def test_token_set_ratio(spark, a, b, score):
    got = one(spark, similarity.token_set_ratio(F.lit(a).cast("string"), F.lit(b)))[0]
    assert got == pytest.approx(score, abs=1e-9)


def test_both_forms_of_the_similarity(spark):
    """The Column expression and the Arrow batches, also on names of several lanes, against one pair at a time."""
    rng = random.Random(17)
    stems = ["jose", "maria", "a", "bb", "christopher", "o", "é漢", "anderson", "xx" * 40, "y" * 130, "yx" * 35]

    def name():
        made = " ".join(rng.choices(stems, k=rng.randint(0, 5)))
        at = rng.randint(0, len(made))
        return rng.choice([made, made, made[:at] + rng.choice("abq ") + made[at:], f" {made}  "])

    pairs = [(name(), name()) for _ in range(300)] + [(None, "a"), ("", None), ("a", "a")]
    df = spark.createDataFrame(pairs, "l string, r string")
    scores = (f(F.col("l"), F.col("r")) for f in (similarity.token_set_ratio, similarity.token_set_ratio_batch))
    for row in df.select("l", "r", *[c.alias(f"s{i}") for i, c in enumerate(scores)]).collect():
        assert row["s0"] == row["s1"] == similarity.token_set_score(row["l"], row["r"])
    plan = df.select(similarity.token_set_ratio(F.col("l"), F.col("r")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
