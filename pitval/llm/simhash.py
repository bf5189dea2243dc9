"""SimHash near copies by multi-index hashing.

A text's fingerprint has bit b set if more than half of its shingle hashes do. Two
fingerprints link if they differ in at most ``distance`` bits; the components of these
links are the groups of near copies.

Links are found exactly. The 64 bits are cut into segments, each with a radius; the radii
plus one sum to more than ``distance``, so of two linked fingerprints at least one pair of
segments lies within its radius. Each fingerprint stands in one table row per segment and
asks for every value of the small Hamming ball around its own. Of two values at distance
one, only the one that lacks the bit asks, so each pair meets once. Whole distances are
verified inside the join. Equal fingerprints are one node, so exact copies cost one row.

Defined cases: a null text, or one without words, has fingerprint zero, linked like any
other. Fewer words than a shingle: the whole sequence is the only shingle. Rows that
repeat a doc_id are each fingerprinted and joined through their fingerprints. A null
doc_id counts only where a component has no other (its id is then null). Other columns
are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitval.llm.common import free_name, in_pieces, read
from pitval.session import materialize

SHINGLE_WORDS = 4
HASH_SEED = 42
DISTANCE = 4
#: Fingerprints up to this many are cut in three segments, more in two wide ones; the links are the same.
THREE_SEGMENTS_UP_TO = 1 << 26
#: (first bit, bits, radius): radii plus one sum to 5.
THREE_SEGMENTS = ((0, 22, 1), (22, 22, 1), (44, 20, 0))
TWO_SEGMENTS = ((0, 33, 2), (33, 31, 1))


def shingle_hashes(text: bytes, size: int) -> list[int]:
    """XXH64 of each shingle of an encoded text. ``bytes`` methods touch ASCII only: they
    lower-case A-Z and split at space and \\t to \\r."""
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return [digest(joined, HASH_SEED)]
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: 1 - size].tolist(), ends[size - 1 :].tolist(), strict=True)
    return [digest(joined[a:b], HASH_SEED) for a, b in spans]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints of consecutive runs of hashes, ``counts`` long each.

    Bits are spread to bytes and added eight counters at a time in 64-bit words; after at
    most 255 rows the bytes are widened, before any can overflow.
    """
    found = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return found
    sizes = counts[some]
    blocks = -(-sizes // 255)
    of_run = np.repeat(np.arange(len(some)), blocks)
    within = np.arange(len(of_run)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    starts = (np.cumsum(sizes) - sizes)[of_run] + within * 255
    spread = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    partial = np.add.reduceat(spread.view(np.uint64), starts, axis=0)
    totals = np.add.reduceat(
        partial.view(np.uint8).astype(np.int64), np.cumsum(blocks) - blocks, axis=0
    )
    bits = np.packbits(2 * totals > sizes[:, None], axis=1)
    found[some] = bits.reshape(-1).view(">u8").astype(np.uint64)
    return found


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``keys``, which are whole numbers, and the fingerprint as a signed long, of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "text", 1 << 20):
            hashes = [shingle_hashes(t or b"", size) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            counts = np.fromiter(map(len, hashes), np.int64, len(hashes))
            flat = np.fromiter((h for own in hashes for h in own), np.uint64, int(counts.sum()))
            made = majority(flat, counts).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(made)], [*keys, "fingerprint"])

    chosen = docs.select(*(F.col(k).cast("long").alias(k) for k in keys), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(work, ", ".join(f"{k} bigint" for k in [*keys, "fingerprint"]))


def _asked(value: F.Column, bits: int, radius: int) -> F.Column:
    """The values a segment asks for: its own, and those of its ball that it must ask for."""

    def set_bit(i: F.Column) -> F.Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), i.cast("int"))

    places = F.sequence(F.lit(0), F.lit(bits - 1))
    lacks = F.filter(places, lambda i: value.bitwiseAND(set_bit(i)) == 0)
    asked = F.array(value)
    if radius >= 1:
        asked = F.concat(asked, F.transform(lacks, lambda i: value.bitwiseOR(set_bit(i))))
    if radius >= 2:
        # Two bits differ: the side that lacks the lower of them asks.
        asked = F.concat(
            asked,
            F.flatten(
                F.transform(
                    lacks,
                    lambda i: F.transform(
                        F.filter(places, lambda j: j > i),
                        lambda j: value.bitwiseXOR(set_bit(i)).bitwiseXOR(set_bit(j)),
                    ),
                )
            ),
        )
    return asked


def links(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints that differ in at most ``distance`` bits, each once."""
    if distance != DISTANCE:
        raise ValueError("the segments are cut for a distance of 4")
    segments = THREE_SEGMENTS if nodes.count() <= THREE_SEGMENTS_UP_TO else TWO_SEGMENTS
    fp = F.col("fingerprint")

    def value(start: int, bits: int) -> F.Column:
        return F.shiftrightunsigned(fp, start).bitwiseAND(F.lit((1 << bits) - 1))

    def key(number: int, value_: F.Column) -> F.Column:
        return value_.bitwiseOR(F.lit(number << 40))

    rows = F.array(*[key(n, value(s, b)) for n, (s, b, _) in enumerate(segments)])
    table = nodes.select(fp.alias("b"), F.explode(rows).alias("key"))

    def ball(number: int, start: int, bits: int, radius: int) -> F.Column:
        own = value(start, bits)
        return F.transform(
            _asked(own, bits, radius),
            lambda v: F.struct(key(number, v).alias("key"), (v == own).alias("own")),
        )

    balls = F.concat(*[ball(n, *segment) for n, segment in enumerate(segments)])
    probes = nodes.select(fp.alias("a"), F.explode(balls).alias("p")).select("a", "p.key", "p.own")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    # Equal segments meet from both sides; one of them is enough.
    once = ~F.col("own") | (F.col("a") < F.col("b"))
    found = probes.join(table, "key").where(near & once)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node that each node of ``edges`` (a, b) can reach.

    Alternates the large-star and the small-star step until the edges are stars. A step
    takes one aggregation and one join, so that a node with very many neighbours is
    never gathered in one place, and each round is cut off by a written table.
    """

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if not large:
            both = both.where("b < a")
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        joined = both.join(least, "a")
        linked = joined.where("b > a") if large else joined
        kept = linked.select(F.col("m").alias("a"), "b")
        if not large:
            kept = kept.union(least.select(F.col("m").alias("a"), F.col("a").alias("b")))
        return kept.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    current, before = edges, None
    while True:
        current = materialize(star(star(current, large=True), large=False), "links")
        now = state(current)
        if now == before or not now[0]:
            break
        before = now
    return current.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        current.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )


def _grouped(docs: DataFrame, size: int, distance: int, keys: Sequence[str] = ("doc_id",)) -> tuple[DataFrame, DataFrame]:
    """The ``keys`` and fingerprint of every row, and (fingerprint, root, component_id).

    Tables that meet on a component or a fingerprint are written first: a join of two plain
    tables can be split where one component or fingerprint holds very many rows, one above an
    aggregation can't.
    """
    made = materialize(fingerprints(docs, size, keys), "fingerprints")
    nodes = materialize(made.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")), "nodes")
    roots = components(materialize(links(nodes, distance), "links"))
    linked = materialize(
        roots.join(nodes, F.col("node") == F.col("fingerprint")).select("fingerprint", "root", "least_id"), "linked"
    )
    least = materialize(linked.groupBy("root").agg(F.min("least_id").alias("component_id")), "components")
    found = linked.join(least, "root").select(F.col("fingerprint").alias("node"), "root", "component_id")
    ids = nodes.join(found, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"),
        F.coalesce("component_id", "least_id").alias("component_id"),
    )
    return made, materialize(ids, "component-ids")


def near_copies(docs: DataFrame, size: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint hex, component_id) of every row of ``docs`` (doc_id, text, ...)."""
    made, ids = _grouped(docs, size, distance)
    return made.join(ids, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _row_hash(docs: DataFrame) -> F.Column:
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # The hash passes over nulls, so their places count too.
    return F.xxhash64(*columns, *(c.isNull() for c in columns))


def row_keys(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the whole row, and the text of every row."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _row_hash(docs).alias("row_hash"),
        F.col("text").cast("string").alias("text"),
    )


def one_of_each(docs: DataFrame, roots: DataFrame) -> DataFrame:
    """One row of ``docs`` for each root of ``roots`` (doc_id, row_hash, root).

    The row with the least id stays, rows without an id come last, and of those left the least
    hash decides, so the choice is the same at each run. Equal rows are one row.
    """
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_hash")
    name = free_name("row_hash", docs.columns)
    kept = roots.groupBy("root").agg(F.min(order).alias("k")).select(F.col("k.row_hash").alias(name)).distinct()
    rows = docs.withColumn(name, _row_hash(docs)).join(materialize(kept, "kept-rows"), name, "left_semi")
    return rows.dropDuplicates([name]).select(*[F.col(f"`{c}`") for c in docs.columns])


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near copies: one row of each group, as ``one_of_each`` chooses it."""
    made, ids = _grouped(row_keys(docs), SHINGLE_WORDS, DISTANCE, ("doc_id", "row_hash"))
    return one_of_each(docs, made.join(ids, "fingerprint").select("doc_id", "row_hash", "root"))


def op6(spark, folder):
    return near_copies(read(spark, folder, "documents"))
