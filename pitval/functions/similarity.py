"""Token-set similarity of two normalized names, on a 0-100 scale.

Words are compared as sets. With ``S`` the shared words and ``A``, ``B`` the words only
one side has (each sorted and joined by single blanks), the score is the best of

* 100 when a word is shared and one side has nothing else,
* the insert/delete similarity of ``"S A"`` and ``"S B"``,
* when ``S`` is not empty, the similarity of ``S`` alone to ``"S A"`` and to ``"S B"``.

The longest common subsequence is a bit-vector recurrence. ``token_set_ratio`` is a Column
expression, in lanes of 62 bits with a carry, so that a plan needs no Python. The fuzzy join
scores its many pairs in Arrow batches (``token_set_ratio_batch``), where one whole number holds
a name of any length; that takes a fraction of the time.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

# Ship the helpers with the task, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def lcs_length(left: str, right: str) -> int:
    """Longest common subsequence by the bit-vector recurrence over whole integers."""
    if not left or not right:
        return 0
    where: dict[str, int] = {}
    for index, char in enumerate(left):
        where[char] = where.get(char, 0) | (1 << index)
    full = (1 << len(left)) - 1
    state = full
    for char in right:
        hits = state & where.get(char, 0)
        state = ((state + hits) | (state - hits)) & full
    return len(left) - state.bit_count()


def _ratio(distance: int, total: int) -> float:
    return 100.0 - 100.0 * distance / total


def token_set_score(left: str | None, right: str | None) -> float:
    """The score of one pair. A blank or missing name scores 0 against anything."""
    words_l, words_r = set((left or "").split()), set((right or "").split())
    if not words_l or not words_r:
        return 0.0
    shared = len(" ".join(words_l & words_r))
    only_l = " ".join(sorted(words_l - words_r))
    only_r = " ".join(sorted(words_r - words_l))
    if shared and (not only_l or not only_r):
        return 100.0
    a, b = len(only_l), len(only_r)
    gap = 1 if shared else 0
    edits = a + b - 2 * lcs_length(only_l, only_r)
    best = _ratio(edits, 2 * (shared + gap) + a + b)
    if shared:
        best = max(best, _ratio(1 + a, 2 * shared + 1 + a), _ratio(1 + b, 2 * shared + 1 + b))
    return best


@pandas_udf(T.DoubleType())
def token_set_ratio_batch(left: pd.Series, right: pd.Series) -> pd.Series:
    """``token_set_score`` over Arrow batches."""
    return pd.Series([token_set_score(a, b) for a, b in zip(left, right, strict=True)], dtype="float64")


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row, not for each element of an array."""
    return F.transform(F.array(value), use)[0]


def _upto(last: Column) -> Column:
    """0..last, empty if last is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


LANE_BITS = 62


def lcs_length_column(left: Column, right: Column) -> Column:
    """Longest common subsequence of two texts.

    The state has a bit for each character of ``left``, in lanes of ``LANE_BITS``; a character of
    ``right`` adds the places where it stands, from the lowest lane up, with the carry of each
    lane going into the next one.
    """

    def characters(text: Column) -> Column:
        return F.filter(F.split(text, ""), lambda c: c != "")

    def bit(place: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))

    def over(lanes: Column) -> Column:
        numbers = _upto(F.size(lanes) - 1)
        full = F.transform(lanes, lambda lane: bit(F.size(lane)) - 1)

        def hits(lane: Column, char: Column) -> Column:
            marked = F.transform(lane, lambda c, i: F.when(c == char, bit(i)).otherwise(F.lit(0).cast("long")))
            return F.aggregate(marked, F.lit(0).cast("long"), lambda sum_, one: sum_.bitwiseOR(one))

        def step(state: Column, char: Column) -> Column:
            def lane(done: Column, k: Column) -> Column:
                def moved(own: Column) -> Column:
                    total = state[k] + own + done["carry"]
                    value = total.bitwiseOR(state[k] - own).bitwiseAND(full[k])
                    return F.struct(F.concat(done["lanes"], F.array(value)).alias("lanes"), F.shiftright(total, LANE_BITS).alias("carry"))

                return _bound(state[k].bitwiseAND(hits(lanes[k], char)), moved)

            start = F.struct(F.array().cast("array<bigint>").alias("lanes"), F.lit(0).cast("long").alias("carry"))
            return F.aggregate(numbers, start, lane)["lanes"]

        last = F.aggregate(characters(right), full, step)
        left_over = F.aggregate(last, F.lit(0), lambda sum_, lane: sum_ + F.bit_count(lane))
        return F.length(left) - left_over

    def lanes_of(chars: Column) -> Column:
        lanes = F.floor((F.size(chars) - 1) / LANE_BITS).cast("int")
        return F.transform(_upto(lanes), lambda k: F.slice(chars, k * LANE_BITS + 1, F.lit(LANE_BITS)))

    return _bound(characters(left), lambda chars: _bound(lanes_of(chars), over))


def token_set_ratio(left: Column, right: Column) -> Column:
    """``token_set_score`` as a Column expression."""

    def words(text: Column) -> Column:
        return F.array_distinct(F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != ""))

    def joined(array: Column) -> Column:
        return F.array_join(F.array_sort(array), " ")

    def ratio(edits: Column, total: Column) -> Column:
        return F.lit(100.0) - F.lit(100.0) * edits / total

    def scored(both: Column) -> Column:
        own, other = both["own"], both["other"]
        parts = F.struct(
            F.length(joined(F.array_intersect(own, other))).alias("shared"),
            joined(F.array_except(own, other)).alias("a"), joined(F.array_except(other, own)).alias("b"),
        )

        def best(p: Column) -> Column:
            shared, a, b = p["shared"], F.length(p["a"]), F.length(p["b"])
            gap = F.when(shared > 0, 1).otherwise(0)
            whole = ratio(a + b - 2 * lcs_length_column(p["a"], p["b"]), 2 * (shared + gap) + a + b)
            with_shared = F.greatest(whole, ratio(1 + a, 2 * shared + 1 + a), ratio(1 + b, 2 * shared + 1 + b))
            nothing_else = (shared > 0) & ((a == 0) | (b == 0))
            return F.when(nothing_else, F.lit(100.0)).when(shared > 0, with_shared).otherwise(whole)

        blank = (F.size(own) == 0) | (F.size(other) == 0)
        return F.when(blank, F.lit(0.0)).otherwise(_bound(parts, best))

    return _bound(F.struct(words(left).alias("own"), words(right).alias("other")), scored)


#: Pairs whose bounds stand in memory at once, and bits of the state of a comparison.
_BOUNDED_PAIRS = 1 << 18
_STATE_BITS = 64
_TRIED = 8


def _at_least(matrix: np.ndarray) -> np.ndarray:
    """A column for each count ``c`` and number ``k`` up to its greatest: is ``c`` at least ``k``?"""
    most = matrix.max(axis=0, initial=0)
    columns = np.repeat(np.arange(matrix.shape[1]), most)
    numbers = np.concatenate([np.arange(1, m + 1) for m in most.tolist()] or [np.zeros(0, int)])
    return (matrix[:, columns] >= numbers).astype(np.float32)


def _joined_subsequences(state: np.ndarray, masks: np.ndarray, chars: np.ndarray, lengths: np.ndarray, i: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Longest common subsequence of each pair (left i, right k): ``lcs_length``, all pairs a step at a time."""
    full = state[i]
    now = full
    # Right texts are as wide as the widest of these; what is behind a text's end hits nothing.
    for column in chars[k, : int(lengths[k].max(initial=0))].T:
        hits = now & masks[i, column]
        now = ((now + hits) | (now - hits)) & full
    return np.bitwise_count(full).astype(np.int64) - np.bitwise_count(now)


def best_scores(left: Sequence[str], right: Sequence[str]) -> list[float]:
    """The best score of each left name over all right ones (0 without any), exact.

    Only the comparison of the words that one side has needs the pair itself, and its edits are
    at least the differences of the character counts, which shared words don't change. All
    else follows from the lengths. The bounds of many pairs come from one product of matrices (the
    characters two names have in common, by their counts); a few pairs with the greatest bounds
    are scored first, then those whose bound is above the best of these.
    """
    sets_l, sets_r = ([set(n.split()) for n in names] for names in (left, right))
    if not right:
        return [0.0] * len(left)
    holders: dict[str, list[int]] = {}
    for k, own in enumerate(sets_r):
        for word in own:
            holders.setdefault(word, []).append(k)
    number = {c: i for i, c in enumerate(sorted({" ", *(c for n in [*left, *right] for c in n)}))}
    texts_l, texts_r = ([" ".join(sorted(own)) for own in sets] for sets in (sets_l, sets_r))

    def counts(texts: list[str]) -> np.ndarray:
        made = np.zeros((len(texts), len(number)), np.int32)
        for row, text in enumerate(texts):
            for char in text:
                made[row, number[char]] += 1
        return made

    counts_l, counts_r = counts(texts_l), counts(texts_r)
    length_l, length_r = counts_l.sum(axis=1).astype(np.int64), counts_r.sum(axis=1).astype(np.int64)
    # Both sides have the same columns: a count is compared up to the lesser of the greatest ones.
    upto = np.minimum(counts_l.max(axis=0, initial=0), counts_r.max(axis=0, initial=0))
    steps_l, steps_r = (_at_least(np.vstack([np.minimum(c, upto), upto]))[:-1] for c in (counts_l, counts_r))

    masks = np.zeros((len(left), len(number) + 1), np.uint64)
    short = length_l <= _STATE_BITS
    for row in np.flatnonzero(short).tolist():
        for place, char in enumerate(texts_l[row]):
            masks[row, number[char]] |= np.uint64(1 << place)
    state = np.array([(1 << min(n, _STATE_BITS)) - 1 for n in length_l.tolist()], np.uint64)
    chars = np.full((len(right), int(length_r.max(initial=0))), len(number), np.int32)
    for row, text in enumerate(texts_r):
        chars[row, : len(text)] = [number[c] for c in text]

    best = np.zeros(len(left))
    size = max(1, _BOUNDED_PAIRS // len(right))
    for start in range(0, len(left), size):
        rows = np.arange(start, min(start + size, len(left)))
        total = np.maximum(length_l[rows, None] + length_r, 1)
        common = (steps_l[rows] @ steps_r.T).astype(np.int64)
        bounds = 100.0 - 100.0 * (length_l[rows, None] + length_r - 2 * common) / total
        sharing = np.zeros(bounds.shape, bool)
        for at, row in enumerate(rows.tolist()):
            found = [(word, holders[word]) for word in sets_l[row] if word in holders]
            if not found:
                continue
            shared = np.zeros(len(right), np.int64)  # with a blank after each word
            for word, places in found:
                shared[places] += len(word) + 1
            some = sharing[at] = shared > 0
            for whole in (np.full(len(right), length_l[row]), length_r):
                rest = whole - shared  # -1 if a side has nothing else
                part = np.where(rest < 0, 100.0, 100.0 - 100.0 * (1 + rest) / np.maximum(2 * shared - 1 + rest, 1))
                bounds[at] = np.where(some, np.maximum(bounds[at], part), bounds[at])
        bounds[[not sets_l[row] for row in rows.tolist()]] = 0.0

        def score(at: np.ndarray, k: np.ndarray) -> None:
            """Raises the best scores by those of pairs, which leave the search."""
            plain = ~sharing[at, k] & short[rows[at]] & (length_r[k] > 0)
            i, other = rows[at[plain]], k[plain]
            both = length_l[i] + length_r[other]
            edits = both - 2 * _joined_subsequences(state, masks, chars, length_r, i, other)
            np.maximum.at(best, i, 100.0 - 100.0 * edits / both)
            bounds[at, k] = 0.0

        def score_rest(at: np.ndarray, k: np.ndarray) -> None:
            """Pairs with a word in common, or with long names: one by one, while a bound is above the best."""
            for a, b in zip(at.tolist(), k.tolist(), strict=True):
                if bounds[a, b] > best[rows[a]]:
                    best[rows[a]] = max(best[rows[a]], token_set_score(left[rows[a]], right[b]))

        first = min(_TRIED, len(right))
        top = np.argpartition(-bounds, first - 1, axis=1)[:, :first]
        at, k = np.repeat(np.arange(len(rows)), first), top.reshape(-1)
        apart = ~sharing[at, k] & short[rows[at]]
        score(at[apart], k[apart])
        open_ = bounds > best[rows, None]
        apart = ~sharing & short[rows, None]
        at, k = np.nonzero(open_ & ~apart)
        # The greatest bounds come first.
        order = np.argsort(-bounds[at, k], kind="stable")
        score_rest(at[order], k[order])
        score(*np.nonzero(apart & (bounds > best[rows, None])))
    return best.tolist()
