"""Benchmark items without an id."""

from __future__ import annotations

import random

from pitval.llm import decontaminate
from tests.llm.conftest import sentence


def test_items_without_an_id_contaminate(spark, make_docs):
    rng = random.Random(21)
    leaked, named, clean = (sentence(rng, 60) for _ in range(3))
    docs = make_docs([(1, leaked), (2, named), (3, clean), (4, leaked + " " + named)])
    items = spark.createDataFrame([(None, leaked), (None, leaked[: len(leaked) // 2]), (5, named)], "item_id long, text string")
    got = {r["doc_id"]: (r["n_hit"], r["n_items"], r["contaminated"]) for r in decontaminate.hits(docs, items).collect()}
    # As count(*) over distinct (doc_id, item) in the SQL: all items without an id count as one.
    assert got == {1: (60, 1, True), 2: (60, 1, True), 3: (0, 0, False), 4: (120, 2, True)}
    assert [r["doc_id"] for r in decontaminate.drop_contaminated(docs, items).collect()] == [3]
