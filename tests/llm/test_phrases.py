"""Phrases against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark import cloudpickle

from pitval.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, longest=3, least=10, covered=50):
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            counts.update((lang, *words[k : k + m]) for m in range(1, longest + 1) for k in range(len(words) - m + 1))
    out = []
    found = {key: a for key, a in counts.items() if len(key) > 2 and a >= least}
    for (lang, *words), a in found.items():
        size = len(words)
        holders = [
            b for (other, *longer), b in found.items()
            if other == lang and len(longer) > size and any(longer[k : k + size] == words for k in range(len(longer) - size + 1))
        ]
        if any(100 * b >= covered * a for b in holders):
            continue
        cuts = [(10**6 * a * a // (counts[lang, *words[:k]] * counts[lang, *words[k:]]), k) for k in range(1, size)]
        score, k = min(cuts)
        out.append((lang, " ".join(words), a, counts[lang, *words[:k]], counts[lang, *words[k:]], total[lang], score))
    return sorted(out)


def texts(rng, count):
    common = ["the", "of", "New", "york", "city", "é", "漢", "x\x00y", " z", "state"]
    rows = []
    for _ in range(count):
        words = []
        while len(words) < rng.randint(0, 120):
            words += rng.choice([["new", "YORK", "city"], ["new", "york"], ["of", "the"], [rng.choice(common)], [f"r{rng.randint(0, 400)}"], ["a", "a", "a", "a"]])
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", " ", ". ", ",", "\n", "\r\n", "! "]) for w in words)
        rows.append((rng.choice(["en", "en", "en", "de", "a\nb", None]), text))
    return rows


def make(spark, rows):
    return spark.createDataFrame([(None, t, lang, 1, "w", "k") for lang, t in rows], "doc_id long, text string, lang string, block int, word string, keys string")


@pytest.mark.parametrize("sizes", [(2_000_000, 1_000_000, 4 << 20), (300, 50, 100)])
@pytest.mark.parametrize("longest", [3, 5])
def test_phrases(spark, monkeypatch, sizes, longest):
    """One block, and many small ones with many buckets and texts cut in parts."""
    for name, value in zip(("BLOCK_WORDS", "BUCKET_ENTRIES", "_SEGMENT_BYTES"), sizes, strict=True):
        monkeypatch.setattr(phrases, name, value)
    rng = random.Random(61)
    rows = texts(rng, 150)
    rows += [("en", None), ("en", ""), (None, " . \n"), ("en", "same words here " * 400), ("fr", "new york"), *[("fr", "ça va bien")] * 12]
    rows += [("en", " ".join(f"w{k % 37}" for k in range(6000)))]
    got = phrases.collocations(make(spark, rows).repartition(3), longest).collect()
    assert sorted(map(tuple, got)) == expected(rows, longest)


@pytest.mark.parametrize("rows", [
    [("en", "alpha beta gamma delta. omega")] * 12,
    [("en", ". . , . , , ! ."), ("en", " ".join(["one two. " + "p q r s t u v w " * 9, "three four"] * 4))] * 3,
    [("en", "p q r s t u v w " * 40), ("de", "p q, " + "r s t " * 40 + ". r s t")],
])
def test_a_block_is_cut_at_an_end(spark, monkeypatch, rows):
    """Words that only stand behind the cut leave the block; a piece longer than a block stays whole."""
    monkeypatch.setattr(phrases, "BLOCK_WORDS", 6)
    monkeypatch.setattr(phrases, "_SEGMENT_BYTES", 40)
    cloudpickle.register_pickle_by_value(phrases)  # else tasks have the module's own sizes
    try:
        got = phrases.collocations(make(spark, rows).coalesce(1)).collect()
    finally:
        cloudpickle.unregister_pickle_by_value(phrases)
    assert sorted(map(tuple, got)) == expected(rows)


def test_ranks(spark, tmp_path, monkeypatch):
    rng = random.Random(62)
    rows = texts(rng, 100)
    make(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(phrases, "TOP", 7)
    want = []
    for lang in {r[0] for r in expected(rows)}:
        own = sorted((r for r in expected(rows) if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        want += [(lang, k, *r[1:]) for k, r in enumerate(own[:7], 1)]
    assert sorted(map(tuple, phrases.op11(spark, str(tmp_path)).collect())) == sorted(want)


def test_heaps_do_not_show(spark, monkeypatch):
    rng = random.Random(63)
    rows = [(rng.choice("aaab"), f"p {k}", rng.randint(1, 9), 1, 1, 1, rng.randint(1, 20)) for k in range(900)]
    found = spark.createDataFrame(rows, "lang string, phrase string, a long, l long, r long, n long, score long")
    whole = sorted(map(tuple, phrases.first_per_lang(found, 5).collect()))
    monkeypatch.setattr(phrases, "RANKED", 2)
    assert sorted(map(tuple, phrases.first_per_lang(found, 5).collect())) == whole and len(whole) == 10
    for lang in "ab":
        own = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1]))[:5]
        assert [r[:7] for r in sorted(whole, key=lambda r: r[7]) if r[0] == lang] == own


def test_products_beyond_64_bits(spark):
    rows = [(1, "en", "a b", "b", 3_000_000_000, [4_000_000_000, 3_000_000_000], [5_000_000_000, 3_000_000_000])]
    made = spark.createDataFrame(rows, "id long, lang string, phrase string, last string, a long, heads array<long>, tails array<long>")
    got = made.select(phrases._cut(2, 1).alias("c")).first()["c"]
    assert got["score"] == 10**6 * 3_000_000_000**2 // (4_000_000_000 * 5_000_000_000)


def test_an_empty_table(spark):
    assert phrases.collocations(make(spark, [])).collect() == []


def test_packing():
    for values in ([], [0], [-1, 5, 1 << 40], [3, 3, 9]):
        own = np.array(values, np.int64)
        assert phrases.unpacked(phrases.packed(own)).tolist() == values
        assert phrases.unpacked(phrases.packed(own, True), True).tolist() == values
