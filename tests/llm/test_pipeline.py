"""The five stages of the pipeline, one after another, against plain Python."""

from __future__ import annotations

import random

import corpus_pipeline
from pitval.llm import pieces, quality_lines
from tests.llm.conftest import sentence
from tests.llm.test_near_copies import edited, fingerprint, group_of
from tests.llm.test_texts import base_figures, contaminated


def cut(rows, length=100):
    """The texts without passages of ``length`` bytes that stand earlier."""
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        own, gone = text.encode(), bytearray(len(text.encode()))
        for p in range(len(own) - length + 1):
            if own[p : p + length] in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(own[p : p + length])
        out.append((i, bytes(b for b, g in zip(own, gone, strict=True) if not g).decode()))
    return out


def near(rng, text):
    """A copy of ``text`` with a changed word, whose fingerprint links."""
    while True:
        made = edited(rng, text, 1)
        if 0 < (fingerprint(made) ^ fingerprint(text)).bit_count() <= 4:
            return made


def plain(rng, words):
    return sentence(rng, words).replace("é", "e").replace("ñ", "n")


def expected(good, items):
    """Ids of pieces by (doc_id, text) of the rows that the stages after the first one keep."""
    from sentencepiece import SentencePieceProcessor

    root = group_of(good)
    one = [min((good[k] for k in range(len(good)) if root[k] == r), key=lambda x: (x[0] is None, x[0] or 0)) for r in dict.fromkeys(root)]
    left = cut(one)
    clean = {r[0] for r in contaminated(left, items) if not r[5]}
    library = SentencePieceProcessor(model_file=pieces.tokenizer_path("piece_bpe_32k.model"))
    return {i: library.encode(t) for i, t in left if i in clean}


def write(spark, folder, rows, items, labels, more=""):
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "text", "'en' lang", "'s' source", "cast(length(text) as long) n_chars", *filter(None, more.split(";"))
    ).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def base_good(rows):
    return [r for r in rows if (f := base_figures(r[1]))[0] >= 10 and 100 * f[4] <= 20 * f[0]]


def test_the_stages_in_their_order(spark, tmp_path):
    rng = random.Random(31)
    own = [plain(rng, 200) for _ in range(5)]
    passage, item = (plain(rng, 40) for _ in range(2))
    rows = [
        (1, own[0]), (2, near(rng, own[0])), (3, "too short"), (4, "again and again " * 30),
        (5, own[1] + " " + passage), (6, passage + " " + own[2]), (7, own[3][:300] + " " + item), (8, own[4]),
        (9, own[4]),
    ]
    # One judgement only: no field is fitted, so the base rule alone decides.
    write(spark, tmp_path, rows, [(1, item)], [(1, 1, 0)])
    want = expected(base_good(rows), [(1, item)])
    assert set(want) == {1, 5, 6, 8} and len(want[6]) < len(expected([rows[5]], [(1, item)])[6])

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: r["ids"] for r in got} == want
    assert all(r["n_pieces"] == len(r["ids"]) for r in got)


def test_nulls_long_texts_and_clashing_columns(spark, tmp_path):
    rng = random.Random(32)
    own = [plain(rng, 200) for _ in range(3)]
    rows = [(1, None), (2, ""), (3, own[0]), (4, own[0]), (5, own[1]), (None, own[2]), (6, plain(rng, 20_000)), (7, own[0]), (7, own[0])]
    items = [(1, plain(rng, 20)), (None, own[1]), (2, None)]
    write(spark, tmp_path, rows, items, [(3, 1, 0)], "'a' _row;'b' _kept;'c' row_hash;'d' chunk;'e' kept;1 ids;2 n_words;'f' fingerprint")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    named = [(k, t) for k, (_, t) in enumerate(items)]
    assert {r["doc_id"]: r["ids"] for r in got} == expected(base_good(rows), named)
    assert {r["doc_id"] for r in got} == {3, 6, None} and len(got) == 3


def test_empty_tables(spark, tmp_path):
    rng = random.Random(33)
    write(spark, tmp_path / "none", [], [], [])
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).collect() == []
    rows = [(1, plain(rng, 100))]
    write(spark, tmp_path / "docs", rows, [], [])
    assert {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, str(tmp_path / "docs")).collect()} == expected(rows, [])


def test_both_judgements(spark, tmp_path):
    """With a fitted field, the first stage keeps what the operator says and the others work on that."""
    rng = random.Random(34)
    menu = ["Home | About | Contact", "Sign up now >>>", "Click here!!!", "Share | Print", "(c) 2020 * * *"]
    rows, labels = [], []
    for k in range(60):
        bad = k % 2
        lines = [rng.choice(menu) + f" {rng.randint(0, 9999)}" if bad else plain(rng, 30) for _ in range(12)]
        rows.append((k, "\n".join(lines)))
        labels.append((k, 1 - bad, 0))
    write(spark, tmp_path, rows, [], labels)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {r["doc_id"] for r in quality_lines.keep_good(docs, spark.read.parquet(f"{tmp_path}/labels.parquet")).collect()}
    assert kept == {k for k in range(0, 60, 2)}
    got = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == expected([r for r in rows if r[0] in kept], [])
