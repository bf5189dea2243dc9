"""Which rows stay when near copies go: one of each group, whatever the ids are."""

from __future__ import annotations

import random

import xxhash

from pitval.llm import simhash
from tests.llm.conftest import sentence


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def group_of(rows):
    """The group of each row of (id, text): fingerprints at 4 bits or fewer link."""
    own = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if root[i] != root[j] and (own[i] ^ own[j]).bit_count() <= 4:
                root = [root[j] if r == root[i] else r for r in root]
    return root


def edited(rng, text, changes):
    w = text.split()
    for k in rng.sample(range(len(w)), changes):
        w[k] = f"changed{rng.randint(0, 10**9)}"
    return " ".join(w)


def test_rows_without_an_id_of_their_own_stay(make_docs):
    """Unrelated texts with a null id, or with one id, are documents of their own."""
    rng = random.Random(11)
    texts = [sentence(rng, 80) for _ in range(8)]
    rows = [(None, t) for t in texts[:4]] + [(7, t) for t in texts[4:7]] + [(8, texts[7])]
    rows += [(None, texts[0]), (None, texts[4]), (9, texts[1]), (8, texts[7])]
    got = simhash.keep_one(make_docs(rows)).select("doc_id", "text").collect()
    want = [(9 if k == 1 else i, t) for k, (i, t) in enumerate(rows[:8])]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_one_of_each_group_stays(make_docs, odd_rows):
    rng = random.Random(12)
    rows = [(i, t) for i, t in odd_rows if i != 22]
    for k in range(30):
        text = sentence(rng, 250)
        rows += [(1000 + 10 * k, text), (1001 + 10 * k, edited(rng, text, 1)), (1002 + 10 * k, edited(rng, text, 3)), (1003 + 10 * k, text)]
    root = group_of(rows)
    # A repeated id has one text here, so the id names the row.
    want = {min(((i is None, i or 0) for (i, _), r in zip(rows, root, strict=True) if r == own)) for own in set(root)}
    got = [(r["doc_id"] is None, r["doc_id"] or 0) for r in simhash.keep_one(make_docs(rows)).collect()]
    assert sorted(got) == sorted(want)
    assert len(want) < len(rows) - 40


def test_columns_keep_their_names(spark):
    docs = spark.createDataFrame([(1, "one two", 5, 6, 7), (2, "one two", 5, 6, 7)], "doc_id long, text string, row_hash int, _row int, _kept int")
    (row,) = simhash.keep_one(docs).collect()
    assert row.asDict() == {"doc_id": 1, "text": "one two", "row_hash": 5, "_row": 6, "_kept": 7}


def test_an_empty_table(make_docs):
    assert simhash.keep_one(make_docs([])).collect() == []
