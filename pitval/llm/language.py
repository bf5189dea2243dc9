"""Language identification: known words first, then shorter and shorter character n-grams.

The model has, per language, log frequencies of words and of the character n-grams of
words (with their edges marked). A text's words are scored one by one: a known word by
its word frequencies, any other by its longest n-grams that the model knows, from five
characters down to one. The language with the best sum wins.

It is fitted on at most ``SAMPLE`` labelled documents of each language, taken in the order
of a hash of their ids; rows held out by ``held_out`` are never among them. Only text and
language are looked at in fitting, and only the text in predicting.

Words are runs of letters (``str.isalpha``) in lower case; numbers, also ½ or ①, and combining
marks part them. Defined cases: ``und`` with score 0 for a null text, a text without a letter, or
where no row has a language; ties go to the language first in the alphabet. Rows without an id
are predicted but not fitted on. Of rows that share an id and a language one is fitted on,
that whose text has the least hash. Other columns change nothing.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitval.llm.common import hash_order, in_pieces, read, share_for
from pitval.session import materialize

SAMPLE = 600
LONGEST = 5
#: A word or n-gram must occur so often in the sample to be known.
LEAST_COUNT = 3
#: Evidence grows with the words of a text, but not its certainty beyond so many.
WORDS_OF_CERTAINTY = 20
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")
KEPT_WORDS = 400_000


def words_of(text: str) -> Counter:
    """The words of a text and how often each occurs."""
    counts = Counter(_WORD.findall(text.lower()))
    for odd in [w for w in counts if not w.isalpha()]:
        times = counts.pop(odd)
        for part in "".join(c if c.isalpha() else " " for c in odd).split():
            counts[part] += times
    return counts


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class Model:
    """Log frequencies by row, a column per language, and the rows of words and n-grams."""

    languages: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    table: np.ndarray
    seen: dict[str, np.ndarray] = field(default_factory=dict)

    def of_word(self, word: str) -> np.ndarray:
        row = self.words.get(word)
        if row is not None:
            return self.table[row]
        marked = f"<{word}>"
        for size in range(min(LONGEST, len(marked)), 0, -1):
            rows = [r for k in range(len(marked) - size + 1) if (r := self.grams.get(marked[k : k + size])) is not None]
            if rows:
                return self.table[rows].mean(axis=0)
        return np.zeros(len(self.languages), np.float32)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages:
            return UNKNOWN, 0.0
        counts = words_of(text)
        if not counts:
            return UNKNOWN, 0.0
        seen = self.seen
        if len(seen) > KEPT_WORDS:
            seen.clear()
        rows = []
        for word in counts:
            row = seen.get(word)
            if row is None:
                row = seen[word] = self.of_word(word)
            rows.append(row)
        weights = np.fromiter(counts.values(), float, len(counts))
        mean = weights @ np.array(rows) / weights.sum()
        chances = np.exp((mean - mean.max()) * min(weights.sum(), WORDS_OF_CERTAINTY))
        best = int(mean.argmax())
        return self.languages[best], float(chances[best] / chances.sum())


def fit(counts: list[tuple[str, str, int]]) -> Model:
    """From (language, word, times) rows."""
    languages = sorted({lang for lang, _, _ in counts})
    column = {lang: i for i, lang in enumerate(languages)}
    words: dict[str, list[int]] = {}
    grams: dict[str, list[int]] = {}
    for lang, word, times in counts:
        own = column[lang]
        words.setdefault(word, [0] * len(languages))[own] += times
        marked = f"<{word}>"
        for size in range(1, LONGEST + 1):
            for k in range(len(marked) - size + 1):
                grams.setdefault(marked[k : k + size], [0] * len(languages))[own] += times
    parts, rows, begin = [], [], 0
    for of in (words, grams):
        known = sorted(k for k, n in of.items() if sum(n) >= LEAST_COUNT)
        rows.append({k: begin + i for i, k in enumerate(known)})
        begin += len(known)
        found = np.array([of[k] for k in known], float).reshape(len(known), len(languages))
        whole = np.array(list(of.values()), float).reshape(len(of), len(languages)).sum(axis=0)
        parts.append(np.log(found + 1) - np.log(whole + len(known) + 1))
    return Model(languages, *rows, np.concatenate(parts).astype(np.float32))


def train(docs: DataFrame) -> Model:
    """Fitted on a bounded sample of the rows that are not held out."""
    fit_on = F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    labelled = docs.select("doc_id", "text", "lang").where(fit_on)
    # Languages are the model's columns: few. An estimate will do, as some 4 x SAMPLE ids are ranked.
    ids = labelled.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("ids")).collect()
    if not ids:
        return fit([])
    place = hash_order("doc_id")
    cut = F.create_map(*[F.lit(x) for r in ids for x in (r["lang"], share_for(SAMPLE, r["ids"]))])[F.col("lang")]
    near = labelled.where(place < cut).groupBy("lang", "doc_id").agg(F.min(F.xxhash64("text")).alias("text_hash"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(place, "doc_id"))
    first = materialize(near.withColumn("rank", rank).where(F.col("rank") <= SAMPLE).drop("rank"), "language-sample")
    # At most SAMPLE rows a language.
    hashed = labelled.withColumn("text_hash", F.xxhash64("text"))
    texts = hashed.join(F.broadcast(first), ["lang", "doc_id", "text_hash"]).dropDuplicates(["lang", "doc_id"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "text"):
            found: dict[str, Counter] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found.setdefault(lang, Counter()).update(words_of(text))
            rows = [(lang, word, n) for lang, own in found.items() for word, n in own.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.string(), pa.string(), pa.int64()))], ["lang", "word", "n"])

    words = texts.select("lang", F.col("text").cast("string").alias("text")).mapInArrow(count, "lang string, word string, n bigint")
    rows = words.groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow().to_pydict()
    return fit(sorted(zip(rows["lang"], rows["word"], rows["n"], strict=True)))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "text"):
            made = [model.predict(t) for t in batch.column("text").to_pylist()]
            langs, scores = zip(*made, strict=True)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(langs), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    chosen = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    schema = T.StructType([chosen.schema["doc_id"], T.StructField("held_out", T.BooleanType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return chosen.mapInArrow(work, schema)


def op7(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text", "lang")
    return predict(docs, train(docs))
