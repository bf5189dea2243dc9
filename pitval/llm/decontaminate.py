"""Benchmark decontamination by winnowing, in DataFrame functions only.

Texts are words: A-Z lower-cased, then runs of characters other than ASCII space, signs and
capitals. Any 13 consecutive words hold nine 5-word grams; the least of their hashes is
the window's fingerprint. A text keeps the fingerprints of all its windows, about one
for every five words, and two texts that share 13 words share a fingerprint.

1. One scan cuts documents into words and keeps their fingerprints that may be an item's: a
   filter of fixed size (``FILTER_SLOTS``, two places a fingerprint) drops nearly all others
   before they become rows. Texts without any left are not moved again.
2. The fingerprints left are joined with those of the items; only ids come out.
3. In documents with a match, each place of a matched gram is extended to every 13-word
   window around it, and those windows are joined with the items' own, word for word.

An item of fewer than 13 words is one window of its own length and has a leg of its own: its
fingerprint is the least of its grams (of five words, or of its length if that is less), and
documents pass all their grams of that size through a second filter, of short items only.
Documents are winnowed for the whole windows whether or not there are short items.

The items' tables are broadcast only if measured under ``BROADCAST_BYTES``, otherwise the
joins shuffle. Items with a common window are kept once as a set, however many
documents hold it.

Defined cases: a null or empty text has no words: nothing is hit, and the list of items is
empty. Items without words have no window. Items with a null id hit like any other; as in the SQL,
all of them count as one in n_items and are not in the hashed list of ids. Repeated rows get equal results; rows that
share a doc_id but not a text are judged apart. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitval.llm.common import read
from pitval.session import materialize

WINDOW_WORDS = 13
GRAM_WORDS = 5
#: 5-word grams in a window of 13.
GRAMS = WINDOW_WORDS - GRAM_WORDS + 1
BROADCAST_BYTES = 32 << 20
#: Places of a filter, seven to a byte. More fingerprints than fit only let more of the documents' through.
SLOT_BITS = 7
FILTER_SLOTS = SLOT_BITS << 16
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """The words of a text in order; an empty array for null."""
    # lower() is the faster one, but it also touches letters beyond A-Z.
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, CAPITALS, CAPITALS.lower()))
    return F.coalesce(F.array_remove(F.split(lowered, SEPARATORS), ""), F.array().cast("array<string>"))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row: inside a function of an array, a plain
    expression would be computed again for every element."""
    return F.transform(F.array(value), use)[0]


def _upto(last: Column) -> Column:
    """0..last, empty if last is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def grams(tokens: Column, size: int) -> Column:
    """Hashes of every ``size`` consecutive words."""
    return F.transform(_upto(F.size(tokens) - size), lambda i: F.xxhash64(F.slice(tokens, i + 1, size)))


def winnowed(hashes: Column) -> Column:
    """The least of every GRAMS consecutive hashes, distinct."""

    def least(of: Column, other: Column, apart: int) -> Column:
        return F.zip_with(of, F.slice(other, apart + 1, F.greatest(F.size(other) - apart, F.lit(0))), lambda x, y: F.least(x, y))

    def windows(h: Column) -> Column:
        """By doubling: the least of 2, 4 and 8 hashes, then of 9. The last ones lack neighbours and go."""
        eight = bound(least(h, h, 1), lambda two: bound(least(two, two, 2), lambda four: least(four, four, 4)))
        return F.slice(least(eight, h, GRAMS - 1), 1, F.greatest(F.size(h) - GRAMS + 1, F.lit(0)))

    return bound(hashes, lambda h: F.array_distinct(windows(h)))


def _slots(print_: Column) -> list[Column]:
    """The two places of a fingerprint in a filter."""
    return [F.pmod(part, F.lit(FILTER_SLOTS)).cast("int") for part in (print_, F.shiftright(print_, 32))]


class Filter:
    """A fixed number of bits that says of a fingerprint that it may be, or is not, one of ``prints``."""

    def __init__(self, prints: DataFrame):
        marks = bytearray(-(-FILTER_SLOTS // SLOT_BITS))
        places = prints.select(F.explode(F.array(*_slots(F.col("print")))).alias("place")).distinct()
        for row in places.toLocalIterator():  # FILTER_SLOTS at most
            marks[row["place"] // SLOT_BITS] |= 1 << row["place"] % SLOT_BITS
        self.marks = F.lit(marks)

    def may_hold(self, print_: Column) -> Column:
        def marked(place: Column) -> Column:
            byte = F.substring(self.marks, F.floor(place / SLOT_BITS).cast("int") + 1, 1)
            return F.getbit(F.ascii(byte.cast("string")), place % SLOT_BITS) == 1  # seven bits are ASCII

        first, second = map(marked, _slots(print_))
        return first & second


def _maybe_broadcast(df: DataFrame, size: int) -> DataFrame:
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


class Benchmark:
    """The items' fingerprints, windows and sets of items."""

    def __init__(self, items: DataFrame):
        tokens = items.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w")).where("size(w) > 0")
        tokens = materialize(tokens.withColumn("n", F.least(F.size("w"), F.lit(WINDOW_WORDS))), "items")
        gram = grams(F.col("w"), GRAM_WORDS)
        least = F.when(F.col("n") == WINDOW_WORDS, winnowed(gram)).otherwise(F.array(F.array_min(gram)))
        for size in range(1, GRAM_WORDS):
            least = F.when(F.col("n") == size, F.array(F.xxhash64("w"))).otherwise(least)
        prints = tokens.select((F.col("n") < WINDOW_WORDS).alias("short"), F.explode(least).alias("print")).distinct()
        prints = materialize(prints, "item-prints")
        self.prints = prints.select("print").distinct()
        self.whole, self.short = Filter(prints.where("not short")), Filter(prints.where("short"))
        window = F.transform(_upto(F.size("w") - F.col("n")), lambda i: F.concat_ws(" ", F.slice("w", i + 1, F.col("n"))))
        by_window = (
            tokens.select("item", F.explode(F.array_distinct(window)).alias("window"))
            .groupBy("window")
            .agg(F.array_sort(F.collect_set("item")).alias("items"), F.max(F.col("item").isNull().cast("int")).alias("nameless"))
        )
        both = materialize(by_window.withColumn("set_id", F.xxhash64("items", "nameless")), "item-windows")
        self.windows = both.select("window", "set_id")
        self.sets = both.select("set_id", "items", "nameless").dropDuplicates(["set_id"])
        # A row's own cost counts as 16 bytes.
        name_bytes = F.aggregate("items", F.lit(16).cast("long"), lambda total, x: total + 16 + F.octet_length(x))
        sizes = both.select(F.sum(F.octet_length("window") + 24).alias("windows"), F.sum(name_bytes).alias("sets")).first()
        self.print_bytes, self.window_bytes, self.set_bytes = 24 * prints.count(), sizes["windows"] or 0, sizes["sets"] or 0
        #: Lengths of the windows there are; at most 13 values.
        self.lengths = sorted(r["n"] for r in tokens.select("n").distinct().collect())

    def offered(self, tokens: Column) -> Column:
        """The fingerprints of a document that may be an item's."""
        short = sorted({min(n, GRAM_WORDS) for n in self.lengths if n < WINDOW_WORDS})
        parts = [F.filter(grams(tokens, size), self.short.may_hold) for size in short if size < GRAM_WORDS]

        def of_five(gram: Column) -> Column:
            legs = [F.filter(winnowed(gram), self.whole.may_hold)] if WINDOW_WORDS in self.lengths else []
            legs += [F.filter(gram, self.short.may_hold)] if GRAM_WORDS in short else []
            return F.concat(*legs)

        if self.lengths and self.lengths[-1] >= GRAM_WORDS:
            parts.append(bound(grams(tokens, GRAM_WORDS), of_five))
        return F.array_distinct(F.concat(*parts)) if parts else F.array().cast("array<bigint>")

def _extended(tokens: Column, matched: Column, bench: Benchmark) -> Column:
    """(start, size, window) of every window around the places of matched grams."""
    found = []
    for n in bench.lengths:
        size = min(n, GRAM_WORDS)
        hashes, leg = grams(tokens, size), bench.short if n < WINDOW_WORDS else bench.whole
        places = F.array_compact(F.transform(hashes, lambda h, i: F.when(leg.may_hold(h) & F.array_contains(matched, h), i)))
        last = F.size(tokens) - n
        starts = F.flatten(F.transform(places, _around(n - size, last)))
        found.append(F.transform(F.array_distinct(starts), _cut(tokens, n)))
    return F.concat(*found)


def _around(reach: int, last: Column):
    def starts(place: Column) -> Column:
        low, high = F.greatest(place - reach, F.lit(0)), F.least(place, last)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    return starts


def _cut(tokens: Column, n: int):
    def window(start: Column) -> Column:
        return F.struct(
            start.alias("start"), F.lit(n).alias("size"), F.concat_ws(" ", F.slice(tokens, start + 1, n)).alias("window")
        )

    return window


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Of every row of ``docs`` (doc_id, text): n_words, n_hit, n_items, items_sha256, contaminated; and text_hash."""
    bench = Benchmark(items)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    keys = ["doc_id", "text_hash"]

    def first(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), bench.offered(w).alias("prints"))

    scanned = texts.select(*keys, "text", bound(words(F.col("text")), first).alias("x")).select(*keys, "text", "x.*")
    # Of texts without a fingerprint that may match, only the number of words is kept.
    scanned = scanned.withColumn("text", F.when(F.size("prints") > 0, F.col("text")))
    rows = materialize(scanned, "document-prints")
    some = rows.where(F.size("prints") > 0)
    matched = (
        some.select(*keys, F.explode("prints").alias("print"))
        .join(_maybe_broadcast(bench.prints, bench.print_bytes), "print")
        .groupBy(*keys)
        .agg(F.collect_set("print").alias("matched"))
        .select(F.col("doc_id").alias("m_id"), F.col("text_hash").alias("m_hash"), "matched")
    )
    same = some.doc_id.eqNullSafe(F.col("m_id")) & (some.text_hash == F.col("m_hash"))
    none = F.array().cast("array<struct<start:int,size:int,window:string>>")

    def work(w: Column) -> Column:
        return _extended(w, F.col("matched"), bench) if bench.lengths else none

    found = (
        some.join(matched, same)
        .select(*keys, F.explode(bound(words(F.col("text")), work)).alias("x"))
        .select(*keys, "x.start", "x.size", "x.window")
        .distinct()
        .join(_maybe_broadcast(bench.windows, bench.window_bytes), "window")
    )
    covered = F.aggregate(
        F.array_sort(F.collect_set(F.struct("start", "size"))),
        F.struct(F.lit(0).alias("until"), F.lit(0).alias("total")),
        lambda acc, x: F.struct(
            F.greatest(acc.until, x.start + x.size).alias("until"),
            (acc.total + F.greatest(F.lit(0), x.start + x.size - F.greatest(acc.until, x.start))).alias("total"),
        ),
        lambda acc: acc.total.cast("long"),
    )
    per_doc = found.groupBy(*keys).agg(covered.alias("n_hit"), F.collect_set("set_id").alias("sets"))
    listed = (
        per_doc.select(*keys, "n_hit", F.explode("sets").alias("set_id"))
        .join(_maybe_broadcast(bench.sets, bench.set_bytes), "set_id")
        .groupBy(*keys)
        .agg(F.first("n_hit").alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.max("nameless").alias("nameless"))
        .select(
            F.col("doc_id").alias("h_id"), F.col("text_hash").alias("h_hash"), "n_hit",
            (F.size("items") + F.col("nameless")).cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        )
    )
    same = rows.doc_id.eqNullSafe(F.col("h_id")) & (rows.text_hash == F.col("h_hash"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.drop("text", "prints").join(listed, same, "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"), "text_hash",
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    bad = hits(docs, items).where("contaminated").select("doc_id", "text_hash").distinct().alias("bad")
    same = F.expr("d.doc_id <=> bad.doc_id and xxhash64(d.text) = bad.text_hash")
    return docs.alias("d").join(bad, same, "left_anti")


def op1(spark, folder):
    return hits(read(spark, folder, "documents"), read(spark, folder, "benchmark")).drop("text_hash")


SQL = """
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS window
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS window
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM w, (SELECT DISTINCT n FROM bw) AS sizes)),
hit AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.window = bw.window AND dw.n = bw.n),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM w LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""
