"""The manifest against a plain tree."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from pitval.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, idx int, n int, digest string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def paths(digests):
    """The root over ``digests``, and per digest its steps (place, run)."""
    steps = [[] for _ in digests]
    at = list(range(len(digests)))
    while len(digests) > 1:
        runs = [digests[k : k + 3] for k in range(0, len(digests), 3)]
        for s, k in zip(steps, range(len(at)), strict=True):
            s.append((at[k] % 3, runs[at[k] // 3]))
            at[k] //= 3
        digests = [h(*run) for run in runs]
    return digests[0], steps


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    ordered = {g: sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in names}
    low = {g: paths([leaf(r) for r in ordered[g]]) for g in names}
    root, high = paths([low[g][0] for g in names])
    out = []
    for g, above in zip(names, high, strict=True):
        subroot, steps = low[g]
        for row, own in zip(ordered[g], steps, strict=True):
            text = row[4]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            digest, proof = leaf((*row[:4], text)), ""
            for place, run in own + above:
                proof += "".join(run[:place] + run[place + 1 :])
                digest = h(*run[:place], digest, *run[place + 1 :])
            out.append((row[0], leaf(row), subroot, root, h(proof), digest, digest == root))
    return sorted(out, key=repr)


def run(spark, tmp_path, rows):
    spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    return sorted(map(tuple, merkle.op13(spark, str(tmp_path)).collect()), key=repr)


def test_groups_of_many_sizes(spark, tmp_path):
    """Groups below, at and above a block, one of them most of the rows; ids repeated and null."""
    rng = random.Random(51)
    rows, at = [], 0
    for name, size in (("a", 1), ("b", 2), ("é", 3), ("z", 4), ("", 9), (None, 10), ("A", 243), ("B", 244), ("hot", 1600)):
        for _ in range(size):
            at += 1
            text = "\n".join("x" * rng.randint(0, 9) + "é" for _ in range(rng.randint(0, 3)))
            rows.append((at, name, rng.choice(["en", None]), rng.choice([len(text), None]), rng.choice([text, text, None, ""])))
    rows += [(None, "hot", None, None, None), (None, "hot", None, None, None), (5, "hot", "en", 1, "1:x"), (5, "hot", "en", 1, "y\nz"), (5, "hot", "en", 1, "y\nz")]
    rng.shuffle(rows)
    got = run(spark, tmp_path, rows)
    assert got == expected(rows)
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("size", [0, 1, 2, 40])
def test_few_rows_and_one_group(spark, tmp_path, size):
    rows = [(i, "s", "en", 3, f"text\n{i}" * 50_000 if i == 1 else "a\nb") for i in range(size)]
    assert run(spark, tmp_path, rows) == (expected(rows) if rows else [])


def test_each_row_a_group_of_its_own(spark, tmp_path):
    rows = [(i, f"s{i}", None, None, "t") for i in range(300)]
    assert run(spark, tmp_path, rows) == expected(rows)


def test_other_columns_and_a_proof_by_hand(spark):
    names = ["more", "idx", "n", "task", "_row", "_slot", "_part", "size", "first", "offset", "member", "Others", "proof"]
    leaves = spark.createDataFrame([(k, "g", h(str(k)), *names) for k in range(5)], "id long, grp string, digest string, " + ", ".join(f"{n} string" for n in names))
    rows = {r["id"]: r for r in merkle.manifest(leaves).collect()}
    low = [h(str(k)) for k in range(5)]
    assert rows[4]["proof"] == f"1{low[3]},1{h(*low[:3])}" and all(rows[4][n] == n for n in names[:-1])
    assert {r["root"] for r in rows.values()} == {h(h(*low[:3]), h(*low[3:]))} == {r["subroot"] for r in rows.values()}
    one = spark.createDataFrame([(low[4], rows[4]["proof"])], "d string, p string")
    assert one.select(merkle.folded(F.col("d"), F.col("p"))).first()[0] == rows[4]["root"]
