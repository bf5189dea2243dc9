from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, chunk string, kept string, text_hash string, ids string, n_words string"
SYLLABLES = ["an", "the", "ti", "on", "er", "sh", "ou", "bl", "re", "st", "é", "ñ"]


def sentence(rng: random.Random, words: int) -> str:
    made = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(words)]
    return " ".join(w if k % 9 else w.capitalize() + "." for k, w in enumerate(made))


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names the operators use themselves."""

    def make(rows):
        full = [(i, t, "en", "s", len(t) if t is not None else None, "a", "b", "c", "d", "e") for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows, characters of several bytes."""
    rng = random.Random(5)
    passage = sentence(rng, 70)
    base = sentence(rng, 300)
    rows = [(1, None), (2, ""), (3, "   \n\t "), (4, "one two"), (5, base), (6, base), (7, base[:600] + " changed " + base[600:])]
    rows += [(i, sentence(rng, 40) + "\n" + passage + "\n" + sentence(rng, 40)) for i in range(10, 16)]
    rows += [(20, "x" * 30_000), (21, "ab" * 5_000 + "é漢🙂" * 50), (22, sentence(rng, 20_000))]
    rows += [(30, passage), (30, passage), (None, passage + " tail"), (None, None), (31, "line\nline\nline\n" + sentence(rng, 30))]
    rows += [(40, " ".join(["same words come again and"] * 30)), (41, "ÀÉ! ABC-def_GHI\u2028x"), (42, "\x1c\x1d\x85word\u00a0word")]
    return rows
