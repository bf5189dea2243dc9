"""Exact copies by chunk recipes, against plain grouping of texts."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from pitval.llm import chunk_dedup
from tests.llm.conftest import sentence


def expected(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        first = True
        for i in ids:
            out.append((i, keep, len(ids), i == keep and first, hashlib.sha256(text.encode()).hexdigest()))
            first = first and i != keep
    return sorted(out, key=repr)


def narrow(chunk, seed):
    """Identifiers that collide until the third seed."""
    made = chunk_dedup.digest(chunk, seed)
    return made if seed >= 2 else bytes(15) + bytes([made[0] & 3])


@pytest.mark.parametrize("name", [chunk_dedup.digest, narrow])
def test_exact_copies(make_docs, odd_rows, name):
    rng = random.Random(41)
    long = sentence(rng, 3000)
    rows = [*odd_rows, (50, long), (51, long + "x"), (52, "x" + long), (53, long), (54, long[:9000] + long[9001:]), (55, " ".join(reversed(long.split())))]
    rows += [(56, long), (56, long), (57, long[4000:] + long[:4000])]
    got = chunk_dedup.exact_copies(make_docs(rows), name).collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows)


def test_a_seed_without_collisions(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    assert chunk_dedup.verified_seed(docs) == 0
    assert chunk_dedup.verified_seed(docs, narrow) == 2


def test_cuts_against_a_plain_version():
    rng = random.Random(42)
    gear = chunk_dedup._GEAR.tolist()
    texts = [sentence(rng, n).encode() for n in (1, 30, 2000, 4000)] + [b"", b"a" * 30_000, bytes(rng.randrange(256) for _ in range(40_000))]
    data = np.frombuffer(b"".join(texts), np.uint8)
    begin, places = 0, chunk_dedup.cut_places(data)
    for text in texts:
        want, last = [], 0
        for k in range(len(text)):
            window = text[max(0, k - chunk_dedup.WINDOW + 1) : k + 1]
            value = sum(gear[b] << (len(window) - 1 - j) for j, b in enumerate(window)) & 0xFFFFFFFF
            size = k + 1 - last
            if size == chunk_dedup.GREATEST or (size >= chunk_dedup.LEAST and not value >> (32 - chunk_dedup.CUT_BITS)):
                last = k + 1
                want.append(last)
        if last < len(text):
            want.append(len(text))
        own = places[(places > begin) & (places <= begin + len(text))].tolist()
        assert [e - begin for e in chunk_dedup.cuts(own, begin, begin + len(text))] == want
        begin += len(text)


def test_blocks_of_a_long_text_do_not_show(monkeypatch):
    data = np.random.default_rng(1).integers(97, 123, 50_000).astype(np.uint8)
    whole = chunk_dedup.cut_places(data).tolist()
    monkeypatch.setattr(chunk_dedup, "_SCAN_BYTES", 1000)
    assert chunk_dedup.cut_places(data).tolist() == whole and len(whole) > 20


def test_chunks_are_shared_and_texts_come_back(make_docs):
    rng = random.Random(43)
    long = sentence(rng, 4000)
    rows = [(1, long), (2, "before " + long), (3, long + " after"), (4, ""), (5, None)]
    docs = make_docs(rows)
    store = chunk_dedup.chunks(docs).collect()
    assert sum(len(r["bytes"]) for r in store) < 1.2 * len(long.encode())
    got = chunk_dedup.restored(chunk_dedup.recipes(docs), chunk_dedup.chunks(docs)).collect()
    assert sorted(map(tuple, got)) == [(i, t or "") for i, t in rows]


def test_one_row_of_each_text_stays(make_docs):
    rng = random.Random(44)
    a, b, c = (sentence(rng, 50) for _ in range(3))
    rows = [(1, a), (9, a), (3, a), (None, b), (None, b), (2, c), (None, c), (None, None), (5, "")]
    docs = make_docs(rows)
    kept = chunk_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.select("doc_id", "text").collect()), key=repr) == sorted([(9, a), (None, b), (2, c), (5, "")], key=repr)


def test_an_empty_table(make_docs):
    docs = make_docs([])
    assert chunk_dedup.exact_copies(docs).collect() == []
    assert chunk_dedup.keep_one(docs).collect() == []
