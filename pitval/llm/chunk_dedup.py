"""Exact copies by content-defined chunk recipes.

A text's bytes are cut where a hash of the last ``WINDOW`` bytes says so, so equal stretches
of text are cut alike wherever they stand. A chunk's identifier is its 128-bit hash, and it
is verified: the bytes of all chunks are compared by identifier, each distinct chunk moving
once from each task. If two chunks of different bytes ever share an identifier, all is done
again with the next seed. From then on equal identifiers mean equal bytes, a text is the
ordered list of its identifiers (its recipe), and two texts are equal if their recipes are:
only recipes are grouped and joined, 16 bytes for about a kilobyte of text.

A recipe that very many rows share is counted before it moves, and the join of rows and
groups reads two written tables, so that it can be split where one group holds many rows.

Defined cases: a null text counts as empty, which has an empty recipe. Of equal texts the
largest doc_id stays; a null id is less than any other. Rows of one id and one text: one of
them stays, the others go. An empty table gives an empty result. ``exact_copies`` reads
doc_id and text only; ``keep_one`` keeps all columns, whatever their names. A very long text
is cut in blocks of bounded size; its recipe is one row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitval.llm.common import free_name, in_pieces, read, utf8
from pitval.session import materialize

#: Bytes that decide a cut, the least and the greatest chunk, and the bits that must be zero at a cut.
WINDOW, LEAST, GREATEST, CUT_BITS = 32, 256, 8192, 10
_SCAN_BYTES = 1 << 20
_MASK = np.uint32(((1 << CUT_BITS) - 1) << (32 - CUT_BITS))
_GEAR = np.random.default_rng(7).integers(0, 1 << 32, 256, np.uint32, endpoint=False)

Digest = Callable[[memoryview, int], bytes]


def digest(chunk: memoryview, seed: int) -> bytes:
    return xxhash.xxh3_128_digest(chunk, seed)


def cut_places(data: np.ndarray) -> np.ndarray:
    """Places after which a cut may fall: those where the hash of the last WINDOW bytes has
    zeros in its upper bits. Sums over 1, 2, 4, ... bytes are doubled, not rolled."""
    found = []
    for first in range(0, len(data), _SCAN_BYTES):
        low = max(0, first - WINDOW + 1)
        value = _GEAR[data[low : first + _SCAN_BYTES]]
        for width in (1, 2, 4, 8, 16):
            older = value[:-width] << np.uint32(width)
            value = value.copy()
            value[width:] += older
        hits = np.flatnonzero((value & _MASK) == 0) + low
        found.append(hits[hits >= first])
    return np.concatenate(found) + 1 if found else np.zeros(0, np.int64)


def cuts(places: Sequence[int], begin: int, end: int) -> list[int]:
    """The ends of the chunks of the text at ``begin``..``end``, given the places of all cuts in it.

    LEAST is not less than WINDOW, so no cut depends on bytes before the text.
    """
    ends, last = [], begin
    for place in places:
        while place - last > GREATEST:
            last += GREATEST
            ends.append(last)
        if place - last >= LEAST:
            last = place
            ends.append(last)
    while end - last > GREATEST:
        last += GREATEST
        ends.append(last)
    if last < end:
        ends.append(end)
    return ends


def _chunked(column: pa.Array) -> tuple[np.ndarray, list[list[int]]]:
    """The bytes of a column end to end, and the ends of the chunks of each text in them."""
    data, starts = utf8(column)
    places = cut_places(data)
    bounds = np.searchsorted(places, starts, side="right")
    own = places.tolist()
    edges = starts.tolist()
    return data, [cuts(own[bounds[k] : bounds[k + 1]], edges[k], edges[k + 1]) for k in range(len(edges) - 1)]


def _names(data: np.ndarray, ends: list[list[int]], name: Digest, seed: int) -> Iterator[list[tuple[bytes, memoryview]]]:
    """The identifier and the bytes of each chunk, text by text."""
    view, begin = memoryview(data), 0
    for own in ends:
        made = []
        for end in own:
            chunk = view[begin:end]
            made.append((name(chunk, seed), chunk))
            begin = end
        yield made


def _text(docs: DataFrame) -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")


def recipes(docs: DataFrame, keys: Sequence[str] = ("doc_id",), seed: int = 0, name: Digest = digest) -> DataFrame:
    """The ``keys``, the hash of the text and its recipe, for every row."""
    kinds = dict(docs.dtypes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "text"):
            made = [b"".join(key for key, _ in own) for own in _names(*_chunked(batch.column("text")), name, seed)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keys), batch.column("text_sha256"), pa.array(made, pa.binary())],
                [*keys, "text_sha256", "recipe"],
            )

    rows = docs.select(*keys, F.sha2(_text(docs), 256).alias("text_sha256"), _text(docs))
    return rows.mapInArrow(work, ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", text_sha256 string, recipe binary")


def chunks(docs: DataFrame, seed: int = 0, name: Digest = digest) -> DataFrame:
    """The distinct chunks of all texts: identifier and bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "text"):
            # Copies within the batch go at once, after a look at their bytes.
            seen: dict[bytes, list[memoryview]] = {}
            for own in _names(*_chunked(batch.column("text")), name, seed):
                for key, chunk in own:
                    alike = seen.setdefault(key, [])
                    if chunk not in alike:
                        alike.append(chunk)
            kept = [(key, chunk) for key, alike in seen.items() for chunk in alike]
            yield pa.RecordBatch.from_arrays(
                [pa.array([key for key, _ in kept], pa.binary()), pa.array([bytes(chunk) for _, chunk in kept], pa.binary())],
                ["chunk_id", "bytes"],
            )

    return docs.select(_text(docs)).mapInArrow(work, "chunk_id binary, bytes binary").distinct()


def verified_seed(docs: DataFrame, name: Digest = digest) -> int:
    """The first seed under which no two different chunks share an identifier."""
    seed = 0
    while chunks(docs, seed, name).groupBy("chunk_id").count().where("count > 1").limit(1).count():
        seed += 1
    return seed


def _grouped(docs: DataFrame, keys: Sequence[str], name: Digest) -> DataFrame:
    """The ``keys``, text_sha256, recipe and a hash of the recipe, for every row; written."""
    made = recipes(docs, keys, verified_seed(docs, name), name)
    return materialize(made.withColumn("recipe_hash", F.xxhash64("recipe")), "recipes")


def exact_copies(docs: DataFrame, name: Digest = digest) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of ``docs`` (doc_id, text, ...)."""
    made = _grouped(docs, ["doc_id"], name)
    # Rows that an id and a text share are counted once, and come back as so many rows.
    rows = materialize(made.groupBy("recipe_hash", "recipe", "doc_id", "text_sha256").agg(F.count("*").alias("rows")), "rows")
    sized = rows.groupBy("recipe_hash", "recipe").agg(F.max("doc_id").alias("keep_id"), F.sum("rows").alias("group_size"))
    many = materialize(sized, "groups")
    joined = rows.join(many, ["recipe_hash", "recipe"])
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))
    first = (F.col("copy") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return joined.withColumn("copy", again).select("doc_id", "keep_id", "group_size", first.alias("kept"), "text_sha256")


def keep_one(docs: DataFrame, name: Digest = digest) -> DataFrame:
    """The rows of ``docs`` without exact copies, with all their columns.

    Of equal texts the row with the largest doc_id stays; of those left, the one whose whole
    row has the greatest hash. Rows that are equal in every column are one row.
    """
    key = free_name("row_hash", docs.columns)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    hashed = docs.withColumn(key, F.xxhash64(*columns, *(c.isNull() for c in columns)))
    made = _grouped(hashed, ["doc_id", key], name)
    last = F.max(F.struct("doc_id", F.col(key).alias("row")))
    kept = made.groupBy("recipe_hash", "recipe").agg(last.alias("k")).select(F.col("k.row").alias(key)).distinct()
    return hashed.join(materialize(kept, "kept-rows"), key, "left_semi").dropDuplicates([key]).select(*columns)


def restored(made: DataFrame, store: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The texts of recipes, put together again from a table of chunks (identifier, bytes).

    The ``keys`` must name a row. One row's chunks meet in one place, as its text does.
    """
    length = F.octet_length("recipe")
    places = F.when(length > 0, F.sequence(F.lit(0), (length / 16).cast("int") - 1))
    parts = made.select(*keys, F.posexplode_outer(F.transform(places, lambda i: F.substring("recipe", i * 16 + 1, F.lit(16)))).alias("place", "chunk_id"))
    met = parts.join(store, "chunk_id", "left")
    gathered = met.groupBy(*keys).agg(F.array_sort(F.collect_list(F.when(F.col("bytes").isNotNull(), F.struct("place", "bytes")))).alias("parts"))
    whole = F.aggregate("parts", F.lit(b""), lambda text, part: F.concat(text, part["bytes"]))
    return gathered.select(*keys, F.decode(whole, "UTF-8").alias("text"))


def op12(spark, folder):
    return exact_copies(read(spark, folder, "documents"))


SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t.text) AS text_sha256
FROM t JOIN g ON t.text = g.text
"""
