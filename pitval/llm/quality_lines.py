"""Quality by line labels: a linear-chain conditional random field tells content from boilerplate.

A text is a sequence of lines. The field has two labels, one weight per label and line
feature, and weights for a first label and for each pair of neighbouring labels. Viterbi
decoding labels the lines together; the share of words on content lines decides.

Training. ``labels`` judges documents, not lines. Lines of good documents are content.
Lines of bad ones start as boilerplate; a first fit then shows which of them look like
content, and the second fit uses those labels. At most ``SAMPLE`` documents of either
judgement are taken, in the order of a hash of their ids. Where their pieces of
``TRAIN_LINES`` lines are more than ``TRAIN_PIECES``, long texts give every so many of their
pieces only; each text gives one at least.

Base figures (whole texts, words are runs without space and \\t to \\r): see ``figures``.

Defined cases: a null or empty text has no words and fails the base rule; a text whose
lines hold no word has no content; without judgements of both kinds every line is
content, so that only the base rule rejects. Repeated rows are judged alike. Other columns
are not read, or pass through ``keep_good`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitval.llm.common import hash_order, in_pieces, read, share_for, utf8

SAMPLE = 500
CONTENT_SHARE = 0.5
LEAST_WORDS = 10
MOST_REPEATED = 20  # per cent of the words
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
#: A training sequence is cut after so many lines; decoding takes whole texts.
TRAIN_LINES = 24
#: Above so many sequences each text is thinned, so that a few texts of thousands of lines don't outweigh the rest.
TRAIN_PIECES = 8 * SAMPLE
STEPS = 80

FEATURES = ("bias", "symbols", "marks", "capitals", "digits", "separators", "short", "few_words", "repeated", "long_words")


def _table(members: bytes) -> np.ndarray:
    made = np.zeros(256, bool)
    made[list(members)] = True
    return made


_SPACE = _table(b" \t\n\v\f\r")
_SYMBOL = _table(SYMBOLS)
_MARK = _table(b"!?")
_BAR = _table(b"|<>{}=_/\\")
_DIGIT = _table(b"0123456789")
_UPPER = _table(bytes(range(65, 91)))
_LOWER = _table(bytes(range(97, 123)))
_REST = _table(bytes(range(0x80, 0xC0)))  # a UTF-8 byte that begins no character


@dataclass
class Figures:
    """Per text: words, word characters, symbols, repeated lines, words in repeated windows; and its lines."""

    per_text: np.ndarray
    line_of: np.ndarray
    line_words: np.ndarray
    features: np.ndarray


def repeated_words(tokens: list[list[bytes]]) -> np.ndarray:
    """Words of each text that lie in a window of five words found twice or more in that text."""
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    n = int(sizes.sum())
    found = np.zeros(len(tokens), np.int64)
    if n < WINDOW:
        return found
    ids = np.fromiter((hash(w) for own in tokens for w in own), np.int64, n).view(np.uint64)
    owner = np.repeat(np.arange(len(tokens)), sizes)
    ids = (ids ^ (ids >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    key = owner[: n - WINDOW + 1].astype(np.uint64)
    for k in range(WINDOW):
        key = (key ^ ids[k : n - WINDOW + 1 + k]) * np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(32)
    inside = np.flatnonzero(owner[: n - WINDOW + 1] == owner[WINDOW - 1 :])
    order = inside[np.argsort(key[inside], kind="stable")]
    same = key[order[1:]] == key[order[:-1]]
    again = np.unique(np.concatenate((order[1:][same], order[:-1][same])))
    marks = np.zeros(n + 1, np.int32)
    marks[again] += 1
    marks[again + WINDOW] -= 1
    np.add.at(found, owner[np.cumsum(marks[:-1]) > 0], 1)
    return found


def figures(texts: pa.Array) -> Figures:
    data, starts = utf8(texts)
    raw = [data[a:b].tobytes() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
    tokens = [t.split() for t in raw]
    # Lines: from a text's start or the byte after \n up to the next of these.
    newlines = np.flatnonzero(data == 10)
    heads = np.sort(np.concatenate((starts[:-1], newlines + 1)), kind="stable")
    line_of = np.concatenate([np.full(t.count(b"\n") + 1, i) for i, t in enumerate(raw)]) if raw else np.zeros(0, np.int64)
    # A text's start sorts before the place after its own newline, and an empty text before the next one's start.
    tails = np.concatenate((heads[1:], starts[-1:]))

    def sums(flags: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[end] - total[begin]

    space = _SPACE[data]
    letter_start = ~space & ~_REST[data]
    begins = np.zeros(len(data) + 1, bool)
    begins[starts] = True
    word_start = ~space
    word_start[1:] &= space[:-1] | begins[1:-1]
    symbol = _SYMBOL[data]
    line = {
        name: sums(flags, heads, tails)
        for name, flags in (
            ("words", word_start), ("chars", letter_start), ("symbols", symbol), ("marks", _MARK[data]),
            ("upper", _UPPER[data]), ("lower", _LOWER[data]), ("digits", _DIGIT[data]), ("bars", _BAR[data]),
        )
    }
    repeat = np.zeros(len(heads), bool)
    at = 0
    for text in raw:
        lines = text.split(b"\n")
        if len(lines) > 1:
            seen: set[bytes] = set()
            for k, own in enumerate(lines):
                if own in seen:
                    repeat[at + k] = line["words"][at + k] > 0
                seen.add(own)
        at += len(lines)
    words, chars = line["words"], np.maximum(line["chars"], 1)
    features = np.stack(
        [
            np.ones(len(heads)),
            np.minimum(4 * line["symbols"] / np.maximum(words, 1), 4),
            np.minimum(2 * line["marks"] / np.maximum(words, 1), 4),
            4 * line["upper"] / np.maximum(line["upper"] + line["lower"], 1),
            4 * line["digits"] / chars,
            np.minimum(4 * line["bars"] / np.maximum(words, 1), 4),
            (line["chars"] < 20).astype(float),
            (words < 4).astype(float),
            repeat.astype(float),
            np.minimum(chars / np.maximum(words, 1) / 8, 3),
        ],
        axis=1,
    )
    per_text = np.zeros((len(raw), 5), np.int64)
    for column, own in enumerate((words, line["chars"], line["symbols"], repeat)):
        np.add.at(per_text[:, column], line_of, own.astype(np.int64))
    per_text[:, 4] = repeated_words(tokens)
    return Figures(per_text, line_of, words, features)


@dataclass
class Field:
    """Weights of the chain. Labels: 0 boilerplate, 1 content."""

    emission: np.ndarray  # features x labels
    start: np.ndarray
    step: np.ndarray  # previous x next

    def decode(self, features: np.ndarray, counts: list[int]) -> np.ndarray:
        """The best labels of consecutive sequences, ``counts`` lines long each."""
        scores = features @ self.emission
        zero, one = scores[:, 0].tolist(), scores[:, 1].tolist()
        (s0, s1), ((t00, t01), (t10, t11)) = self.start.tolist(), self.step.tolist()
        labels = bytearray(len(zero))
        begin = 0
        for size in counts:
            a, b = s0 + zero[begin], s1 + one[begin]
            back = []
            for k in range(begin + 1, begin + size):
                from0, from1 = a + t00 >= b + t10, a + t01 > b + t11
                back.append((from0, from1))
                a, b = (a + t00 if from0 else b + t10) + zero[k], (a + t01 if from1 else b + t11) + one[k]
            label = int(b >= a)
            for k in range(begin + size - 1, begin, -1):
                labels[k] = label
                label = int(not back[k - begin - 1][label])
            labels[begin] = label
            begin += size
        return np.frombuffer(labels, np.uint8).astype(bool)


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    most = values.max(axis=axis, keepdims=True)
    return np.squeeze(most, axis) + np.log(np.exp(values - most).sum(axis=axis))


def fit(features: np.ndarray, present: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> Field:
    """Maximum likelihood with a Gaussian prior, by full-batch Adam steps.

    ``features``: sequences x lines x features, ``present``: which lines exist (leading
    ones), ``labels``: 0 or 1, ``weight``: of each sequence.
    """
    n, lines, width = features.shape
    size = width * 2 + 2 + 4
    theta, first, second = np.zeros(size), np.zeros(size), np.zeros(size)
    rows = np.arange(n)
    scale = weight.sum()
    for number in range(1, STEPS + 1):
        field = Field(theta[: 2 * width].reshape(width, 2), theta[2 * width : 2 * width + 2], theta[2 * width + 2 :].reshape(2, 2))
        score = features @ field.emission
        forward, backward = np.zeros((lines, n, 2)), np.zeros((lines, n, 2))
        forward[0] = score[:, 0] + field.start
        for k in range(1, lines):
            moved = _log_sum(forward[k - 1][:, :, None] + field.step, 1) + score[:, k]
            forward[k] = np.where(present[:, k, None], moved, forward[k - 1])
        for k in range(lines - 2, -1, -1):
            moved = _log_sum(field.step[None] + (score[:, k + 1] + backward[k + 1])[:, None, :], 2)
            backward[k] = np.where(present[:, k + 1, None], moved, 0)
        total = _log_sum(forward[-1], 1)
        alone = np.exp(forward + backward - total[None, :, None]) * present.T[:, :, None]
        truth = np.stack((1 - labels, labels), axis=2).transpose(1, 0, 2) * present.T[:, :, None]
        gap = (truth - alone) * weight[None, :, None]
        grad = [np.einsum("nlf,lnc->fc", features, gap).ravel(), gap[0].sum(axis=0)]
        step = np.zeros((2, 2))
        for k in range(1, lines):
            both = present[:, k]
            pair = np.exp(forward[k - 1][:, :, None] + field.step + (score[:, k] + backward[k])[:, None, :] - total[:, None, None])
            step -= (pair * (both * weight)[:, None, None]).sum(axis=0)
            np.add.at(step, (labels[rows, k - 1][both], labels[rows, k][both]), weight[both])
        grad.append(step.ravel())
        slope = np.concatenate(grad) / scale - 0.01 * theta
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        theta = theta + 0.1 * (first / (1 - 0.9**number)) / (np.sqrt(second / (1 - 0.999**number)) + 1e-8)
    return Field(theta[: 2 * width].reshape(width, 2), theta[2 * width : 2 * width + 2], theta[2 * width + 2 :].reshape(2, 2))


def _thinned(lines: list[bytes], most: int | None = None) -> list[list[np.ndarray]]:
    """Of each text its pieces of TRAIN_LINES lines; where all are more than ``most``, every so many
    of each text, its first one always."""
    cut = []
    for own in lines:
        own = np.frombuffer(own, "<f4").reshape(-1, len(FEATURES)).astype(float)
        cut.append([own[k : k + TRAIN_LINES] for k in range(0, len(own), TRAIN_LINES)])
    every = max(1, -(-sum(map(len, cut)) // (most or TRAIN_PIECES)))
    return [own[::every] for own in cut]


def train(docs: DataFrame, labels: DataFrame) -> Field | None:
    """The field fitted on a sample of judged documents; None without both judgements."""
    judged = labels.where("doc_id is not null and quality in (0, 1)").select(F.col("doc_id").alias("judged_id"), "quality").distinct()
    chosen = None
    for value in (0, 1):
        own = judged.where(F.col("quality") == value)
        own = own.where(hash_order("judged_id") < share_for(SAMPLE, own.count()))
        part = own.orderBy(hash_order("judged_id"), "judged_id").limit(SAMPLE)
        chosen = part if chosen is None else chosen.union(part)
    # At most 2 x SAMPLE short rows.
    texts = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("judged_id"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "text"):
            made = figures(batch.column("text"))
            counts = np.bincount(made.line_of, minlength=batch.num_rows)
            ends = np.cumsum(counts)
            values = [made.features[e - c : e].astype("<f4").tobytes() for c, e in zip(counts, ends, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("quality").cast(pa.int32()), pa.array(values, pa.binary())], ["doc_id", "quality", "lines"])

    rows = texts.select("doc_id", "text", "quality").mapInArrow(work, "doc_id bigint, quality int, lines binary").toPandas()
    rows = rows.sort_values(["doc_id", "quality", "lines"])  # whatever order the tasks ended in
    if rows.quality.nunique() < 2:
        return None
    pieces, judged_good = [], []
    for own, quality in zip(_thinned(list(rows.lines)), rows.quality, strict=True):
        pieces += own
        judged_good += [quality] * len(own)
    good = np.array(judged_good)
    longest = max(map(len, pieces))
    features, present = np.zeros((len(pieces), longest, len(FEATURES))), np.zeros((len(pieces), longest), bool)
    for i, own in enumerate(pieces):
        features[i, : len(own)], present[i, : len(own)] = own, True
    labels_ = np.repeat(good[:, None], longest, axis=1)
    weight = np.where(good == 1, 1.0, (good == 1).sum() / max(1, (good == 0).sum()))
    field = fit(features, present, labels_, weight)
    for i in np.flatnonzero(good == 0):
        own = field.decode(features[i, : int(present[i].sum())], [int(present[i].sum())])
        if not own.all():
            labels_[i, : len(own)] = own
    return fit(features, present, labels_, weight)


def judge(docs: DataFrame, field: Field | None, share: float = CONTENT_SHARE) -> DataFrame:
    """doc_id, the base figures, ``content_words``, ``base_failed`` and ``kept`` of every row."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_words")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "text"):
            made = figures(batch.column("text"))
            content = np.ones(len(made.line_of), bool)
            if field is not None:
                content = field.decode(made.features, np.bincount(made.line_of, minlength=batch.num_rows).tolist())
            on_content = np.zeros(batch.num_rows, np.int64)
            np.add.at(on_content, made.line_of[content], made.line_words[content])
            columns = [*made.per_text.T, on_content]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, columns)], ["doc_id", *names])

    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = T.StructType([chosen.schema["doc_id"], *(T.StructField(n, T.LongType()) for n in names)])
    words = F.col("n_words")
    failed = (words < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * words)
    return (
        chosen.mapInArrow(work, schema)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("content_words") >= share * words))
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept."""
    field = train(docs, labels)
    schema = docs.schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "text"):
            made = figures(batch.column(batch.schema.get_field_index("text")))
            words, repeats = made.per_text[:, 0], made.per_text[:, 4]
            good = (words >= LEAST_WORDS) & (100 * repeats <= MOST_REPEATED * words)
            if field is not None:
                content = field.decode(made.features, np.bincount(made.line_of, minlength=batch.num_rows).tolist())
                on_content = np.zeros(batch.num_rows, np.int64)
                np.add.at(on_content, made.line_of[content], made.line_words[content])
                good &= on_content >= CONTENT_SHARE * words
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(work, schema)


def op3(spark, folder):
    docs = read(spark, folder, "documents")
    return judge(docs, train(docs, read(spark, folder, "labels")))
