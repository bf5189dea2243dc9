"""Phrases that stand together more often than their parts suggest, by set-oriented mining (SETM).

The occurrence relation of length k has a row (piece, position, group) for each place where a
frequent phrase of k words stands, sorted by piece and position; a position counts on by one
in a piece and by one more between pieces. From length to length:

1. the relation is merge-joined with itself on the adjacent position, which gives the phrases
   of one word more, each a pair (left, right) of groups of the length before;
2. these are counted by group over the whole corpus;
3. occurrences of phrases that are not frequent go (a semi-join), and what is left is written
   as the next relation.

Relations are kept in blocks of some ``BLOCK_WORDS`` words, a row each, as compressed columns.
A block counts its own groups first and sends each bucket of groups one message; a bucket
counts what it got and tells each block which of its groups are frequent, and their ids. So a
word or phrase that is everywhere costs one entry a block, the occurrences never leave their
block's row, and no bucket holds more than its share of the groups. Ids are given by rank in
a bucket, so a repeated task gives the same ones; nothing is decided on hashes.

Scores are exact (decimal division). Defined cases: a null text has no words, a null language
is ``und``. Pieces never cross texts. Repeated rows and rows without an id count like any
others, as only language and text are read. A very long text is cut into several blocks, at
the ends of pieces; a single piece stays in one block. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitval.llm.common import in_pieces, read
from pitval.session import materialize

#: Where pieces end, what parts words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
LONGEST, LEAST_COUNT, COVERED, TOP = 3, 10, 50, 2000

BLOCK_WORDS = 2_000_000
#: About so many entries of blocks are counted in one bucket.
BUCKET_ENTRIES = 1_000_000
#: Phrases of a heap, as a multiple of those that are wanted of it.
RANKED = 16
_SEGMENT_BYTES = 4 << 20

#: No byte of UTF-8 text, so it can stand for the end of a piece.
_END = b"\xff"
_TABLE = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + PIECE_ENDS + BLANKS, b"abcdefghijklmnopqrstuvwxyz" + _END * len(PIECE_ENDS) + b" " * len(BLANKS)
)


def packed(values: np.ndarray, sorted_: bool = False) -> bytes:
    """Whole numbers as a compressed column: bytes of equal weight together."""
    values = np.diff(values.astype(np.int64), prepend=0) if sorted_ else values.astype(np.int64)
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(blob: bytes, sorted_: bool = False) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    values = np.ascontiguousarray(planes.T).view(np.int64).reshape(-1)
    return np.cumsum(values) if sorted_ else values


# ---- words ---------------------------------------------------------------------------


class _Numbers(dict):
    """The number of each word of one language in a block; a new word gets the next one."""

    def __init__(self, keys: list[bytes], lang: bytes):
        super().__init__({_END: -1})
        self.keys_, self.lang = keys, lang + b"\n"

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.keys_)
        self.keys_.append(self.lang + word)
        return number


class _Block:
    """Words of consecutive texts as numbers, -1 at the ends of pieces."""

    def __init__(self):
        self.keys: list[bytes] = []
        self.by_lang: dict[bytes, _Numbers] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def numbers(self, lang: bytes) -> _Numbers:
        if lang not in self.by_lang:
            self.by_lang[lang] = _Numbers(self.keys, lang)
        return self.by_lang[lang]

    def add(self, lang: bytes, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.numbers(lang).__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def cut(self, lang: bytes) -> _Block | None:
        """Moves what follows the last end of a piece to a new block; None if no piece has ended."""
        made, items = _Block(), np.concatenate(self.parts)
        ends = np.flatnonzero(items < 0)
        if not len(ends):
            return None
        last, prefix = int(ends[-1]) + 1, len(lang) + 1
        made.add(lang, [self.keys[k][prefix:] for k in items[last:].tolist()])
        self.parts, self.size = [items[:last]], last
        # Words are numbered as they come, so those that only stand behind the cut have the last numbers.
        del self.keys[int(items[:last].max()) + 1 :]
        return made


def _segments(text: bytes) -> Iterator[bytes]:
    """A text in parts that begin with a blank, but for the first."""
    begin = 0
    while len(text) - begin > _SEGMENT_BYTES:
        end = text.find(b" ", begin + _SEGMENT_BYTES)
        if end < 0:
            break
        yield text[begin:end]
        begin = end
    yield text[begin:]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    block = _Block()
    for batch in in_pieces(batches, "text"):
        langs = batch.column("lang").cast(pa.binary()).to_pylist()
        for lang, text in zip(langs, batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
            for segment in _segments(text.translate(_TABLE)):
                block.add(lang, segment.replace(_END, b" \xff ").split())
                if block.size >= BLOCK_WORDS and (rest := block.cut(lang)):
                    yield block
                    block = rest
            block.add(lang, [_END])
    if block.size:
        yield block


def occurrences(docs: DataFrame) -> DataFrame:
    """The words of all texts: block, places, word numbers, and the words with their counts. Written."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for k, block in enumerate(_blocks(batches)):
            items = np.concatenate(block.parts)
            at = np.flatnonzero(items >= 0)
            counts = np.bincount(items[at], minlength=len(block.keys))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([first + k]), pa.array([len(at)]), pa.array([packed(at, True)], pa.binary()),
                    pa.array([packed(items[at])], pa.binary()), pa.array([block.keys], pa.list_(pa.binary())), pa.array([packed(counts)], pa.binary()),
                ],
                ["block", "words", "at", "item", "keys", "counts"],
            )

    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    made = rows.mapInArrow(work, "block long, words long, at binary, item binary, keys array<binary>, counts binary")
    return materialize(made, "word-occurrences")


# ---- one count for a bucket of groups -------------------------------------------------

REPLY = "block long, locals binary, ids binary"


def _dealt(buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that puts buckets together, the buckets there are, and where each begins (one more)."""
    order = np.argsort(buckets, kind="stable")
    found, starts = np.unique(buckets[order], return_index=True)
    return order, found, np.append(starts, len(order))


def _replies(blocks: list[int], sizes: np.ndarray, locals_: np.ndarray, ids: np.ndarray) -> dict[str, list]:
    """For each message, which of its entries are frequent (``ids`` of at least 0)."""
    out: dict[str, list] = {"block": [], "locals": [], "ids": []}
    begin = 0
    for block, size in zip(blocks, sizes.tolist(), strict=True):
        own = slice(begin, begin + size)
        keep = ids[own] >= 0
        if keep.any():
            out["block"].append(block)
            out["locals"].append(packed(locals_[own][keep], True))
            out["ids"].append(packed(ids[own][keep]))
        begin += size
    return out


def _answer(schema: pa.Schema, replies: dict[str, list], groups: dict[str, list]) -> pa.Table:
    """A row for each reply, and one with the bucket's groups."""
    made = {name: [] for name in schema.names}
    for columns in (replies, {k: [v] for k, v in groups.items()}):
        rows = len(next(iter(columns.values())))
        for name in schema.names:
            made[name] += columns.get(name, [None] * rows)
    return pa.table([pa.array(made[n], schema.field(n).type) for n in schema.names], schema)


def counted_words(occurring: DataFrame, buckets: int, least: int) -> DataFrame:
    """Replies to the blocks, and per bucket the frequent words and the words of each language. Written."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                keys = batch.column("keys").slice(row, 1).flatten()
                counts = unpacked(batch.column("counts")[row].as_py())
                hashes = np.fromiter(map(xxhash.xxh64_intdigest, keys.to_pylist()), np.uint64, len(keys))
                order, found, starts = _dealt((hashes % np.uint64(buckets)).astype(np.int64))
                pieces = [order[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found), pa.array([batch.column("block")[row].as_py()] * len(found), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(starts, pa.int32()), keys.take(pa.array(order))),
                        pa.array([packed(p, True) for p in pieces], pa.binary()), pa.array([packed(counts[p]) for p in pieces], pa.binary()),
                    ],
                    ["bucket", "block", "keys", "locals", "counts"],
                )

    schema = pa.schema(
        [("block", pa.int64()), ("locals", pa.binary()), ("ids", pa.binary()), ("made", pa.list_(pa.int64())), ("langs", pa.list_(pa.string())),
         ("words", pa.list_(pa.string())), ("totals", pa.list_(pa.int64())), ("all_langs", pa.list_(pa.string())), ("all_words", pa.list_(pa.int64()))]
    )

    def count(key: tuple, table: pa.Table) -> pa.Table:
        keys = table.column("keys").combine_chunks()
        coded = keys.flatten().dictionary_encode()
        index = coded.indices.to_numpy()
        counts = np.concatenate([unpacked(c) for c in table.column("counts").to_pylist()])
        locals_ = np.concatenate([unpacked(c, True) for c in table.column("locals").to_pylist()])
        totals = np.bincount(index, counts).astype(np.int64)
        frequent = np.flatnonzero(totals >= least)
        frequent = frequent[pc.sort_indices(coded.dictionary.take(pa.array(frequent))).to_numpy()]
        ids = np.full(len(totals), -1, np.int64)
        ids[frequent] = (key[0].as_py() << 32) + np.arange(len(frequent))
        names = coded.dictionary.to_pylist()
        by_lang: dict[str, int] = {}
        for name, total in zip(names, totals.tolist(), strict=True):
            lang = name.rpartition(b"\n")[0].decode()
            by_lang[lang] = by_lang.get(lang, 0) + total
        parts = [names[k].rpartition(b"\n") for k in frequent.tolist()]
        groups = {
            "made": ids[frequent], "langs": [p[0].decode() for p in parts], "words": [p[2].decode() for p in parts], "totals": totals[frequent],
            "all_langs": list(by_lang), "all_words": list(by_lang.values()),
        }
        sizes = pc.list_value_length(keys).to_numpy()
        return _answer(schema, _replies(table.column("block").to_pylist(), sizes, locals_, ids[index]), groups)

    sent = occurring.select("block", "keys", "counts").mapInArrow(send, "bucket long, block long, keys array<binary>, locals binary, counts binary")
    told = sent.groupBy("bucket").applyInArrow(
        count, f"{REPLY}, made array<long>, langs array<string>, words array<string>, totals array<long>, all_langs array<string>, all_words array<long>"
    )
    return materialize(told, "word-counts")


def _adjacent(at: np.ndarray, item: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The merge-join of a relation, sorted by ``at``, with itself on the next position: place and pair."""
    both = np.flatnonzero(at[1:] == at[:-1] + 1)
    return at[both], item[both] * size + item[both + 1]


def counted_pairs(relation: DataFrame, buckets: int, least: int) -> DataFrame:
    """Replies to the blocks, and per bucket the frequent groups of one word more. Written."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpacked(row["ids"])
                _, pair = _adjacent(unpacked(row["at"], True), unpacked(row["item"]), len(ids))
                if not len(pair):
                    continue
                pair, counts = np.unique(pair, return_counts=True)
                left, right = ids[pair // len(ids)], ids[pair % len(ids)]
                mixed = left.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + right.view(np.uint64)
                mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                order, found, starts = _dealt(((mixed >> np.uint64(16)) % np.uint64(buckets)).astype(np.int64))
                pieces = [order[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found), pa.array([row["block"]] * len(found), pa.int64()),
                        *(pa.array([packed(v[p]) for p in pieces], pa.binary()) for v in (left, right)),
                        pa.array([packed(p, True) for p in pieces], pa.binary()), pa.array([packed(counts[p]) for p in pieces], pa.binary()),
                    ],
                    ["bucket", "block", "left", "right", "locals", "counts"],
                )

    longs = pa.list_(pa.int64())
    schema = pa.schema(
        [("block", pa.int64()), ("locals", pa.binary()), ("ids", pa.binary()), ("made", longs), ("lefts", longs), ("rights", longs), ("totals", longs)]
    )

    def count(key: tuple, table: pa.Table) -> pa.Table:
        left, right, counts = (np.concatenate([unpacked(v) for v in table.column(n).to_pylist()]) for n in ("left", "right", "counts"))
        messages = [unpacked(v, True) for v in table.column("locals").to_pylist()]
        order = np.lexsort((right, left))
        new = np.append(True, (np.diff(left[order]) != 0) | (np.diff(right[order]) != 0))
        starts = np.flatnonzero(new)
        totals = np.add.reduceat(counts[order], starts)
        frequent = totals >= least
        made = (key[0].as_py() << 32) + np.arange(int(frequent.sum()))
        by_run = np.full(len(starts), -1, np.int64)
        by_run[frequent] = made
        ids = np.empty(len(order), np.int64)
        ids[order] = by_run[np.cumsum(new) - 1]
        first = order[starts[frequent]]
        groups = {"made": made, "lefts": left[first], "rights": right[first], "totals": totals[frequent]}
        sizes = np.array([len(m) for m in messages])
        return _answer(schema, _replies(table.column("block").to_pylist(), sizes, np.concatenate(messages), ids), groups)

    sent = relation.mapInArrow(send, "bucket long, block long, left binary, right binary, locals binary, counts binary")
    told = sent.groupBy("bucket").applyInArrow(count, f"{REPLY}, made array<long>, lefts array<long>, rights array<long>, totals array<long>")
    return materialize(told, "group-counts")


def semi_joined(relation: DataFrame, replies: DataFrame, words: bool) -> DataFrame:
    """The next relation: (block, at, item, ids) of the occurrences of frequent groups. Written.

    ``words``: the relation's own items are the groups; else the pairs of adjacent ones.
    """

    def work(own: pa.Table, told: pa.Table) -> pa.Table:
        out: dict[str, list] = {"block": [], "at": [], "item": [], "ids": []}
        if own.num_rows and told.num_rows:
            (row,) = own.to_pylist()
            at, item = unpacked(row["at"], True), unpacked(row["item"])
            if not words:
                at, pair = _adjacent(at, item, len(unpacked(row["ids"])))
                item = np.unique(pair, return_inverse=True)[1].reshape(-1)
            locals_, ids = (np.concatenate([unpacked(v, n == "locals") for v in told.column(n).to_pylist()]) for n in ("locals", "ids"))
            number = np.full(int(item.max(initial=-1)) + 1, -1, np.int64)
            number[locals_] = np.arange(len(locals_))
            item = number[item]
            keep = item >= 0
            out = {"block": [row["block"]], "at": [packed(at[keep], True)], "item": [packed(item[keep])], "ids": [packed(ids)]}
        return pa.table({k: pa.array(v, pa.int64() if k == "block" else pa.binary()) for k, v in out.items()})

    columns = ["block", "at", "item"] if words else ["block", "at", "item", "ids"]
    left = relation.select(*columns).groupBy("block")
    made = left.cogroup(replies.where("block is not null").select("block", "locals", "ids").groupBy("block"))
    return materialize(made.applyInArrow(work, "block long, at binary, item binary, ids binary"), "occurrences")


# ---- all lengths ---------------------------------------------------------------------


@dataclass
class Mined:
    """Words of each language (lang, n), and the frequent phrases by length.

    A length has id, lang, phrase, its last word, count ``a``, and the counts of its first
    and of its last 1, 2, ... words.
    """

    words: DataFrame
    lengths: list[DataFrame]
    #: (id, most): the greatest count of a longer phrase that holds the phrase, by its length.
    longer: list[DataFrame]


def _arrays(told: DataFrame, **columns: str) -> DataFrame:
    """One row for each element of the arrays ``columns`` (name: array) of the buckets' rows."""
    rows = told.where("block is null").select(F.explode(F.arrays_zip(*[F.col(c).alias(n) for n, c in columns.items()])).alias("x"))
    return rows.select("x.*")


def mine(docs: DataFrame, longest: int = LONGEST, least: int = LEAST_COUNT) -> Mined:
    """All phrases of up to ``longest`` words that stand ``least`` times or more in a language."""
    occurring = occurrences(docs)
    sizes = occurring.agg(F.sum("words").alias("words"), F.sum(F.size("keys")).alias("entries")).first()
    told = counted_words(occurring, 1 + (sizes["entries"] or 0) // BUCKET_ENTRIES, least)
    words = _arrays(told, lang="all_langs", n="all_words").groupBy("lang").agg(F.sum("n").alias("n"))
    own = _arrays(told, id="made", lang="langs", word="words", a="totals")
    lengths = [materialize(own.select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "a", F.array("a").alias("heads"), F.array("a").alias("tails")), "phrases")]
    relation, longer = semi_joined(occurring, told, words=True), []
    for length in range(2, longest + 1):
        told = counted_pairs(relation, 1 + (sizes["words"] or 0) // BUCKET_ENTRIES, least)
        pairs = materialize(_arrays(told, id="made", left="lefts", right="rights", a="totals"), "pairs")
        left = lengths[-1].select(F.col("id").alias("left"), "lang", "phrase", "heads")
        right = lengths[-1].select(F.col("id").alias("right"), "last", "tails")
        made = pairs.join(left, "left").join(right, "right")
        lengths.append(
            materialize(
                made.select(
                    "id", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "a",
                    F.concat("heads", F.array("a")).alias("heads"), F.concat("tails", F.array("a")).alias("tails"),
                ),
                "phrases",
            )
        )
        parts = pairs.select(F.explode(F.array("left", "right")).alias("id"), "a")
        longer.append(materialize(parts.groupBy("id").agg(F.max("a").alias("most")), "longer"))
        if length < longest:
            relation = semi_joined(relation, told, words=False)
    return Mined(words, lengths, longer)


def _exact(count: Column) -> Column:
    return count.cast("decimal(14,0)")


def _cut(length: int, first: int) -> Column:
    """The score of a phrase cut after its ``first`` words, the place and both counts."""
    left, right = F.col("heads")[first - 1], F.col("tails")[length - first - 1]
    both = F.lit(1_000_000).cast("decimal(7,0)") * _exact(F.col("a")) * _exact(F.col("a"))
    score = F.call_function("div", both, _exact(left) * _exact(right))
    return F.struct(score.cast("long").alias("score"), F.lit(first).alias("k"), left.alias("l"), right.alias("r"))


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST_COUNT, covered: int = COVERED) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of all phrases that no longer one covers.

    A phrase goes if a longer one holds it and has ``covered`` percent of its count or more.
    That one need not be more than a word longer: the phrases between are no rarer than it.
    """
    mined = mine(docs, longest, least)
    made = []
    for length in range(2, longest + 1):
        rows = mined.lengths[length - 1]
        if length < longest:
            rows = rows.join(mined.longer[length - 1], "id", "left").where(f"most is null or 100 * most < {covered} * a")
        worst = F.array_min(F.array(*[_cut(length, k) for k in range(1, length)]))
        made.append(rows.select("lang", "phrase", "a", worst.alias("cut")))
    whole = reduce(DataFrame.union, made).join(mined.words, "lang")
    return whole.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))


def first_per_lang(found: DataFrame, most: int) -> DataFrame:
    """The first ``most`` phrases of each language, with their rank.

    Phrases are dealt to heaps of some ``RANKED`` firsts first, and only the first ones of each
    heap go on, until one heap a language is left: no task sorts a language that is everywhere.
    """
    order = (F.desc("score"), F.desc("a"), "phrase")

    def ranked(df: DataFrame, *keys: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return df.withColumn("rank", place).where(F.col("rank") <= most)

    heaps = found.count() // (RANKED * most)
    while heaps > 1:
        dealt = found.withColumn("heap", F.pmod(F.xxhash64("phrase"), F.lit(heaps)))
        found = materialize(ranked(dealt, "lang", "heap").drop("heap", "rank"), "first-phrases")
        heaps //= RANKED
    return ranked(found, "lang")


def op11(spark, folder):
    found = materialize(collocations(read(spark, folder, "documents")), "collocations")
    ranked = first_per_lang(found, TOP)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _ngram(size: int) -> str:
    words = " || ' ' || ".join(f"w[i + {k}]" for k in range(size))
    return f"""f{size} AS (
  SELECT lang, phrase, count(*) AS a FROM (
    SELECT lang, unnest(list_transform(range(1, len(w) - {size - 2}), lambda i: {words})) AS phrase FROM piece)
  GROUP BY lang, phrase)"""


SQL = f"""
WITH doc AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_CAPITALS}', '{_CAPITALS.lower()}') AS text FROM documents),
part AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS part FROM doc),
piece AS (SELECT lang, regexp_extract_all(part, '[^\\x20\\x09]+') AS w FROM part),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM piece GROUP BY lang),
{', '.join(_ngram(k) for k in (1, 2, 3))},
two AS (SELECT *, string_split(phrase, ' ') AS w FROM f2 WHERE a >= {LEAST_COUNT}),
three AS (SELECT *, string_split(phrase, ' ') AS w FROM f3 WHERE a >= {LEAST_COUNT}),
cut AS (
  SELECT t.lang, t.phrase, t.a, 1 AS k, x.a AS l, y.a AS r FROM two t
  JOIN f1 x ON x.lang = t.lang AND x.phrase = w[1] JOIN f1 y ON y.lang = t.lang AND y.phrase = w[2]
  WHERE NOT EXISTS (SELECT 1 FROM three z WHERE z.lang = t.lang AND 100 * z.a >= {COVERED} * t.a
                    AND (z.w[1] || ' ' || z.w[2] = t.phrase OR z.w[2] || ' ' || z.w[3] = t.phrase))
  UNION ALL
  SELECT t.lang, t.phrase, t.a, 1, x.a, y.a FROM three t
  JOIN f1 x ON x.lang = t.lang AND x.phrase = w[1] JOIN f2 y ON y.lang = t.lang AND y.phrase = w[2] || ' ' || w[3]
  UNION ALL
  SELECT t.lang, t.phrase, t.a, 2, x.a, y.a FROM three t
  JOIN f2 x ON x.lang = t.lang AND x.phrase = w[1] || ' ' || w[2] JOIN f1 y ON y.lang = t.lang AND y.phrase = w[3]),
scored AS (SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cut),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM worst)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= {TOP}
"""
