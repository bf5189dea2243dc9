"""Best fuzzy match of each name, exact at a score threshold, without comparing all pairs.

A score of at least ``t`` can only come from two places, and each has its own index.

*Shared words.* The legs that need a shared word reach ``t`` only if the words one side
shares make up at least ``t / (200 - t)`` of its joined length. A word longer than the
part that may be missing is therefore shared for certain, and the rarest such word is the
only one looked up. A side with no such word is looked up by its rare words, as many as
outweigh the part that may be missing. Both directions are searched.

*Few edits.* An inserted or deleted character changes the count of one character by one,
whatever the order of the words. Cut the alphabet into ``m`` groups: two names within
``m - 1`` edits have equal counts of all characters of one group. ``m`` is that of the pair
of lengths (an even difference of lengths takes an even number of edits), so a name is
looked up once for every length a partner can have, by the characters that fall in each group.

Before a pair leaves its join, fixed-width signatures reject it in generated code. Words
hash to bits, so the bits one side lacks bound the number of words it misses. Bigrams flip
bits, and an edit changes at most three bigrams, so two names within ``d`` edits differ in
at most ``3d`` bits. Both tests only ever let too much through.

"Rare first" needs frequencies only of common words. Those holding at least
``HOT_SHARE`` of all entries are counted; there can be at most ``1 / HOT_SHARE`` of them,
which bounds the one table that is broadcast here. The same counts spread a common entry
over salts, so no task receives a whole common word. Equal names are scored once: both
sides are reduced to distinct names first.

Both indexes hold for any threshold, but the lower it is the less they save. The best score of a
name that has none at the threshold is found with falling thresholds, and for what is left
then by a search of blocks against blocks, in which a bound of the score, from the counts of
characters, decides which pairs are scored at all.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitval import constants as C
from pitval.functions.similarity import best_scores, token_set_ratio_batch
from pitval.functions.text import name_tokens
from pitval.operators.skew import shuffle_width
from pitval.session import materialize

HOT_SHARE = 1e-3
LANES = 4  # 64-bit words of the bigram signature
#: Characters in the order in which they are dealt to groups; any others follow by code point.
ALPHABET = " eaoirnlstdhcmugpybkvwfzjxq0123456789"
#: Thresholds tried for names without a match, before blocks are searched.
FALLING = (76.0, 64.0)
BLOCK_NAMES = 2048
LEAST_TASKS = 64
#: The bound of a pair is a few dozen nanoseconds, so many pairs are searched sooner than indexed.
SEARCHED_PAIRS = 1 << 34
_SLACK = 1e-6


def max_edits(total: Column, threshold: float) -> Column:
    """Most inserts plus deletes that still reach the threshold for this total length."""
    return F.floor(total * (1 - threshold / 100.0) + _SLACK)


def partner_lengths(length: Column, threshold: float) -> Column:
    """The lengths, as an array, that a name within the edit limit can have."""
    low = F.ceil(length * threshold / (200.0 - threshold) - _SLACK)
    high = F.floor(length * (200.0 - threshold) / threshold + _SLACK)
    return F.sequence(F.greatest(low, F.lit(1)).cast("int"), high.cast("int"))


def groups_needed(left: Column, right: Column, threshold: float) -> Column:
    """Groups of characters for names of these lengths: one more than the edits they may be apart.

    Each edit changes the length by one, so the edits are even if the difference is."""
    most = max_edits(left + right, threshold)
    return (most - F.pmod(most - F.abs(left - right), F.lit(2)) + 1).cast("int")


def padded_grams(words: Column, size: int) -> Column:
    """All grams of every word padded with ``size - 1`` blanks on each side, with repeats."""
    pads = F.lit(" " * (size - 1))

    def cut(word: Column) -> Column:
        padded = F.concat(pads, word, pads)
        return F.transform(
            F.sequence(F.lit(1), F.length(word) + size - 1),
            lambda i: F.substring(padded, i, F.lit(size)),
        )

    return F.flatten(F.transform(words, cut))


def _bit(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(number, F.lit(64)).cast("int"))


def _parity(grams: Column, lane: int) -> Column:
    """64 bits of the bigram signature: a bigram flips one bit of one lane."""
    hashes = F.transform(grams, lambda g: F.xxhash64(g))
    mine = F.filter(hashes, lambda h: F.pmod(F.shiftright(h, 8), F.lit(LANES)) == lane)
    return F.aggregate(mine, F.lit(0).cast("long"), lambda acc, h: acc.bitwiseXOR(_bit(h)))


def _letters(text: Column) -> Column:
    """The characters of a text as places in the alphabet, sorted."""
    place = lambda c: F.call_function("instr", F.lit(ALPHABET), c)
    characters = F.filter(F.split(text, ""), lambda c: c != "")
    return F.array_sort(F.transform(characters, lambda c: F.when(place(c) > 0, place(c)).otherwise(F.ascii(c) + len(ALPHABET))))


def with_signatures(names: DataFrame) -> DataFrame:
    """Distinct names with their words, joined length, word bits and bigram bits.

    Names are few bytes and many expressions, so they are spread over all tasks first."""
    spread = names.select("norm").repartition(shuffle_width(names), "norm")
    words = spread.select("norm", name_tokens(F.col("norm")).alias("words"))
    bigrams = padded_grams(F.col("words"), 2)
    word_bits = F.aggregate(
        "words", F.lit(0).cast("long"), lambda acc, w: acc.bitwiseOR(_bit(F.xxhash64(w)))
    )
    return words.withColumns(
        {
            "len": F.length(F.concat_ws(" ", "words")),
            "letters": _letters(F.concat_ws(" ", "words")),
            "bits": word_bits,
            **{f"sig{i}": _parity(bigrams, i) for i in range(LANES)},
        }
    )


SIGNATURES = ["len", "bits", *[f"sig{i}" for i in range(LANES)]]


def _side(df: DataFrame, name: str, *more: str) -> DataFrame:
    """Columns of one side of a pair under the side's prefix, next to ``entry``."""
    return df.select(*[F.col(c).alias(f"{name}_{c}") for c in ("norm", *more)], "entry")


def hot_entries(entries: DataFrame, share: float = HOT_SHARE) -> DataFrame:
    """Entries holding at least ``share`` of the rows: (entry, freq, salts), at most
    ``1 / share`` rows. Counting combines on the map side before it shuffles."""
    total = entries.select(F.count(F.lit(1))).scalar()
    counted = entries.groupBy("entry").agg(F.count(F.lit(1)).alias("freq"))
    hot = counted.filter(F.col("freq") >= total * share).select(
        "entry", "freq", F.ceil(F.col("freq") / (total * share)).cast("int").alias("salts")
    )
    # At most 1000 rows; an exchange of its own, so that the count above stays spread.
    return materialize(hot.repartition(1), "hot-entries")


def _rare_first(entries: DataFrame, hot: DataFrame, keep: list[str]) -> DataFrame:
    """Per name its entries as one array, rare first. A name has few, so it is short."""
    ranked = entries.join(F.broadcast(hot.select("entry", "freq")), "entry", "left")
    return ranked.groupBy("norm", *keep).agg(
        F.transform(
            F.array_sort(
                F.collect_set(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "entry"))
            ),
            lambda s: s["entry"],
        ).alias("ordered")
    )


def _meet(left: DataFrame, right: DataFrame, hot: DataFrame, close: Column) -> DataFrame:
    """Pairs of names whose posting lists meet in ``entry`` and that are ``close``. The right
    list of a hot entry is spread over its salts and the left one repeated.

    Posting rows hold fixed-width signatures and the name only: the join runs over far more
    pairs than it returns. The lists are small next to that work, so the partition count is
    given rather than derived from their size.
    """
    small = F.broadcast(hot.select("entry", "salts"))
    every = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
    spread = F.pmod(F.xxhash64("right_norm"), F.coalesce("salts", F.lit(1)))
    left = left.join(small, "entry", "left").withColumn("salt", F.explode(every)).drop("salts")
    right = (
        right.join(small, "entry", "left")
        .withColumn("salt", spread.cast("int"))
        .drop("salts")
        .withColumnsRenamed({"entry": "_entry", "salt": "_salt"})
    )
    same = (F.col("entry") == F.col("_entry")) & (F.col("salt") == F.col("_salt"))
    width = shuffle_width(left)
    return (
        left.repartition(width, "entry", "salt")
        .join(right.repartition(width, "_entry", "_salt"), same & close)
        .select("left_norm", "right_norm")
    )


def _word_candidates(queries: DataFrame, names: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose shared words could be enough, searched from either side."""

    def entries(side: DataFrame) -> DataFrame:
        return side.select("norm", *SIGNATURES, F.explode("words").alias("entry"))

    words = {"left": entries(queries), "right": entries(names)}
    hot = hot_entries(words["left"].select("entry").unionByName(words["right"].select("entry")))
    # A missing word costs its length and the blank before it.
    spare = F.col("len") * (1 - threshold / (200.0 - threshold)) + _SLACK

    def cost(array: Column) -> Column:
        return F.aggregate(array, F.lit(0), lambda acc, w: acc + F.length(w) + 1)

    def lookups(side: DataFrame) -> DataFrame:
        ordered = _rare_first(side, hot, SIGNATURES)
        certain = F.filter("ordered", lambda w: F.length(w) + 1 > spare)
        run = F.filter("ordered", lambda w, i: cost(F.slice("ordered", 1, i)) <= spare)
        lead = F.when(F.size(certain) > 0, F.slice(certain, 1, 1)).otherwise(run)
        cheapest = F.array_sort(F.transform("ordered", lambda w: F.length(w) + 1))
        may_miss = F.size(
            F.filter(
                cheapest,
                lambda c, i: F.aggregate(F.slice(cheapest, 1, i + 1), F.lit(0), lambda a, x: a + x)
                <= spare,
            )
        )
        return ordered.select(
            "norm", "bits", may_miss.alias("may_miss"), F.explode(lead).alias("entry")
        )

    found = []
    for asking, answering in (("left", "right"), ("right", "left")):
        sides = {
            asking: _side(lookups(words[asking]), asking, "bits", "may_miss"),
            answering: _side(words[answering], answering, "bits"),
        }
        lacking = F.col(f"{asking}_bits").bitwiseAND(F.bitwise_not(F.col(f"{answering}_bits")))
        close = F.bit_count(lacking) <= F.col(f"{asking}_may_miss")
        found.append(_meet(sides["left"], sides["right"], hot, close))
    return found[0].unionByName(found[1])


def _edit_candidates(queries: DataFrame, names: DataFrame, threshold: float) -> DataFrame:
    """Pairs with equal counts of the characters of a group, whose bigram bits allow the threshold."""
    sigs = [f"sig{i}" for i in range(LANES)]
    # Each side's share of the allowed edits, so that a pair needs one addition.
    part = F.col("len") * (1 - threshold / 100.0) + _SLACK

    def postings(df: DataFrame, name: str, length: Column) -> DataFrame:
        """``length``: that of the known name of the pair, which is part of the entry."""
        numbers = F.sequence(F.lit(0), F.col("m") - 1)
        entry = F.transform(
            numbers, lambda i: F.xxhash64("m", i, length, F.filter("letters", lambda k: F.pmod(k, F.col("m")) == i))
        )
        rows = df.select("norm", part.alias("edits"), *sigs, F.explode(entry).alias("entry"))
        return _side(rows, name, "edits", *sigs)

    allowed = F.abs(F.col("len") - F.col("other")) <= max_edits(F.col("len") + F.col("other"), threshold)
    reached = {}
    for name, df in (("left", queries), ("right", names)):
        partners = df.where("len > 0").withColumn("other", F.explode(partner_lengths(F.col("len"), threshold))).where(allowed)
        reached[name] = partners.withColumn("m", groups_needed(F.col("len"), F.col("other"), threshold))
    left = postings(reached["left"], "left", F.col("other"))
    # All partners of a known name that take the same groups share its entries.
    shared = reached["right"].groupBy("norm", "len", "letters", *sigs, "m").agg(F.count(F.lit(1)).alias("_partners"))
    right = postings(shared, "right", F.col("len"))
    hot = hot_entries(left.select("entry").unionByName(right.select("entry")))

    edits = F.floor(F.col("left_edits") + F.col("right_edits"))
    flipped, close = F.lit(0), F.lit(True)
    for sig in sigs:
        flipped = flipped + F.bit_count(F.col(f"left_{sig}").bitwiseXOR(F.col(f"right_{sig}")))
        close = close & (flipped <= 3 * edits)
    return _meet(left, right, hot, close)


def fuzzy_pairs(
    queries: DataFrame, names: DataFrame, threshold: float = C.FUZZY_THRESHOLD
) -> DataFrame:
    """Every (left_norm, right_norm, score) with score at or above the threshold.

    Both inputs have one column ``norm`` with distinct, non-blank normalized names.
    """
    if not 0 < threshold <= 100:
        raise ValueError("the threshold must be above 0 and at most 100")
    # Both name tables are read several times below, by both indexes and for the counts.
    queries = materialize(with_signatures(queries), "query-names")
    names = materialize(with_signatures(names), "known-names")
    candidates = _word_candidates(queries, names, threshold).unionByName(
        _edit_candidates(queries, names, threshold)
    )
    return candidates.distinct().withColumn(
        "score", token_set_ratio_batch(F.col("left_norm"), F.col("right_norm"))
    ).filter(F.col("score") >= threshold)


def best_fuzzy(
    queries: DataFrame,
    registry: DataFrame,
    threshold: float = C.FUZZY_THRESHOLD,
) -> DataFrame:
    """The best-scoring entity of each query name: (norm, entity_id, score).

    ``queries`` has ``norm``, ``registry`` has entity_id and ``norm``. Entities that share
    a name are one candidate, represented by the lowest id, which is also how ties between
    names are settled. Queries with nothing at the threshold are absent.
    """
    asked = queries.filter("norm <> ''").select("norm").distinct()
    known = registry.filter("norm <> ''").groupBy("norm").agg(F.min("entity_id").alias("entity_id"))
    scored = fuzzy_pairs(asked, known.select("norm"), threshold)
    best = F.max_by(F.struct("entity_id", "score"), F.struct("score", (-F.col("entity_id")).alias("o")))
    return (
        scored.join(known.withColumnRenamed("norm", "right_norm"), "right_norm")
        .groupBy(F.col("left_norm").alias("norm"))
        .agg(best.alias("_best"))
        .select("norm", "_best.entity_id", "_best.score")
    )


def nearest_names(queries: DataFrame, names: DataFrame) -> DataFrame:
    """(left_norm, score): the best score of each query over all names, however low.

    Both inputs have one column ``norm`` with distinct, non-blank normalized names. Blocks of
    queries meet blocks of names; each block of names answers with one row a query. Few bytes
    bring much work here, so the number of tasks is given.
    """

    def blocked(df: DataFrame, name: str) -> tuple[DataFrame, int]:
        kept = materialize(df.select("norm"), f"{name}-names")
        blocks = 1 + kept.count() // BLOCK_NAMES
        return kept.withColumn(f"{name}_block", F.pmod(F.xxhash64("norm"), F.lit(blocks)).cast("int")), blocks

    (asked, asked_blocks), (known, known_blocks) = blocked(queries, "asked"), blocked(names, "known")
    keys = ["asked_block", "known_block"]
    left = asked.withColumn("known_block", F.explode(F.sequence(F.lit(0), F.lit(known_blocks - 1))))
    right = known.withColumn("asked_block", F.explode(F.sequence(F.lit(0), F.lit(asked_blocks - 1))))

    def best(own: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        scores = best_scores(own["norm"].tolist(), other["norm"].tolist())
        return pd.DataFrame({"left_norm": own["norm"], "score": scores})

    width = min(max(shuffle_width(left), LEAST_TASKS), asked_blocks * known_blocks)
    left, right = (df.repartition(width, *keys).groupBy(*keys) for df in (left, right))
    made = left.cogroup(right).applyInPandas(best, "left_norm string, score double")
    return made.groupBy("left_norm").agg(F.max("score").alias("score"))


def best_below(
    queries: DataFrame, names: DataFrame, threshold: float = C.FUZZY_THRESHOLD, falling: Sequence[float] = FALLING
) -> DataFrame:
    """(left_norm, score): the best score of queries that have none at ``threshold``.

    Lower thresholds are tried first, as their indexes rule most pairs out unseen: a query with a
    score at one of them has its best one there.
    """
    open_, found = materialize(queries.select("norm"), "open-names"), []
    known = names.count()
    for lower in falling:
        # Few pairs are searched sooner than indexed; the scores are the same.
        if lower >= threshold or open_.count() * known <= SEARCHED_PAIRS:
            continue
        scored = fuzzy_pairs(open_, names, lower).groupBy("left_norm").agg(F.max("score").alias("score"))
        scored = materialize(scored, "scored-names")
        found.append(scored)
        open_ = materialize(open_.join(scored, F.col("norm") == F.col("left_norm"), "left_anti"), "open-names")
    # The search is not to be made again by each reader of its result.
    found.append(materialize(nearest_names(open_, names), "nearest-scores"))
    made = found[0]
    for part in found[1:]:
        made = made.unionByName(part)
    return made
