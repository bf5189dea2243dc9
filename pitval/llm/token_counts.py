"""Token counts without token ids: pieces are counted once per distinct pre-token.

1. A text becomes the pre-tokens that the tokenizer's own normalizer and split pattern give.
   Texts of one task are taken in chunks of some CHUNK_BYTES; a chunk is written as one row with
   its distinct pre-tokens and the frequencies of each of its documents, packed.
2. Each chunk sends its distinct pre-tokens to buckets by their hash. A bucket counts the pieces
   of each distinct pre-token once, for all documents there are, and answers every chunk.
3. A chunk joins the answers to its documents' frequencies and sums. No ids are kept.

A joined table of (document, pre-token, frequency) rows would be several times the input; by
chunks, what moves is a fraction of it. A pre-token is sent at most once by a chunk, however
frequent it is, so no bucket is hot by more than the number of chunks.

The library takes special strings out of the raw text first, as one token each, and so
does this. Without begin, end, truncation or padding.

Defined cases: a null text counts as empty, with no tokens. Repeated rows get equal
counts, one row each; other columns are not read.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitval.llm.common import PIECE_BYTES, in_pieces, read, utf8
from pitval.llm.pieces import tokenizer_path
from pitval.session import materialize

LIMIT = 2048
#: Text in a chunk, and distinct pre-tokens of all chunks in a bucket.
CHUNK_BYTES = 32 << 20
BUCKET_BYTES = 8 << 20
#: From here on the library's own splitter decides: Unicode tables of two libraries may differ in rare letters.
PLAIN_UPTO = "ɏ"


class Counter:
    """Counts the pieces of texts for a tokenizer whose pre-tokens come from one split pattern."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to other tasks
        from tokenizers import Regex, Tokenizer, normalizers, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        first, second = spec["pre_tokenizer"]["pretokenizers"]
        if (first["type"], first["behavior"], first["invert"], second["type"], second["use_regex"]) != ("Split", "Removed", True, "ByteLevel", False):
            raise ValueError("the tokenizer must split by one pattern")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens must match as they are")
        pattern = first["pattern"]["Regex"]
        self.normalize = Tokenizer.from_file(path).normalizer.normalize_str
        self.split, self.find = regex.compile(pattern).findall, regex.compile(pattern).finditer
        self.exact = pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str
        self.beyond = regex.compile(f"[^\\x00-{PLAIN_UPTO}]").search
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        #: A text without it has no special string.
        self.sign = "<" if all("<" in content for content in special) else ""
        self.library = Tokenizer.from_file(path)
        # A pre-token is normal already; only its bytes are spelled.
        self.library.normalizer = normalizers.Sequence([])
        self.library.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def pretokens(self, text: str) -> Iterable[str]:
        text = self.normalize(text)
        if self.beyond(text):
            return [w for w, _ in self.exact(text)]
        return self.split(text) if len(text) <= PIECE_BYTES else (m[0] for m in self.find(text))

    def parts(self, text: str) -> list[str]:
        """The text between special strings."""
        return self.special.split(text) if self.special and self.sign in text else [text]

    def pieces(self, words: list[str]) -> Iterator[int]:
        """The number of pieces of each pre-token."""
        for first in range(0, len(words), 10_000):
            yield from map(len, self.library.encode_batch_fast(words[first : first + 10_000], add_special_tokens=False))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def pack(values: np.ndarray) -> bytes:
    return zstandard.compress(values.astype(np.int32).tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(packed), np.int32)


def pack_words(words: list[str]) -> bytes:
    lengths = np.fromiter(map(len, words), np.int32, len(words))
    return zstandard.compress(np.int32(len(words)).tobytes() + lengths.tobytes() + "".join(words).encode(), 1)


def unpack_words(packed: bytes) -> list[str]:
    data = zstandard.decompress(packed)
    n = int(np.frombuffer(data, np.int32, 1)[0])
    ends = np.cumsum(np.frombuffer(data, np.int32, n, 4), dtype=np.int64).tolist()
    text = data[4 + 4 * n :].decode()
    return [text[a:b] for a, b in zip([0, *ends], ends)]


class Places(dict):
    """The place of each word, in the order of first use."""

    def __missing__(self, word: str) -> int:
        place = self[word] = len(self)
        return place


class Chunk:
    """The frequencies of some documents' pre-tokens."""

    def __init__(self):
        self.ids: list[pa.Array] = []
        self.sizes: list[np.ndarray] = []
        self.specials: list[int] = []
        self.distinct: list[int] = []
        self.places, self.used, self.often = Places(), [], []
        self.bytes = 0

    def add(self, ids: pa.Array, text: pa.Array, own: Counter) -> None:
        self.ids.append(ids)
        self.sizes.append(np.diff(utf8(text)[1]))
        self.bytes += int(self.sizes[-1].sum())
        place = self.places.__getitem__
        for value in text:
            parts = own.parts(value.as_py() or "")
            found = [np.fromiter(map(place, own.pretokens(part)), np.int32) for part in parts]
            used, often = np.unique(np.concatenate(found), return_counts=True)
            self.specials.append(len(parts) - 1)
            self.distinct.append(len(used))
            self.used.append(used)
            self.often.append(often.astype(np.int32))

    def row(self, number: int, names: list[str]) -> pa.RecordBatch:
        """The chunk with its words in the order of use, so that common ones have small places."""
        ids = pa.concat_arrays(self.ids)
        used, often = np.concatenate(self.used), np.concatenate(self.often)
        words = list(self.places)
        order = np.argsort(-np.bincount(used, minlength=len(words)), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        document = np.repeat(np.arange(len(ids), dtype=np.int64), self.distinct)
        key = (document << 32) | rank[used]
        sort = np.argsort(key)
        place = key[sort] & 0xFFFFFFFF
        words = [words[i] for i in order]
        values = {
            "chunk": pa.array([number], pa.int64()),
            "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            "sizes": pa.array([np.concatenate(self.sizes)], pa.list_(pa.int64())),
            "specials": pa.array([pack(np.array(self.specials))], pa.binary()),
            "distinct": pa.array([pack(np.array(self.distinct))], pa.binary()),
            "places": pa.array([pack(np.diff(place, prepend=0))], pa.binary()),
            "often": pa.array([pack(often[sort])], pa.binary()),
            "words": pa.array([pack_words(words)], pa.binary()),
            "word_bytes": pa.array([sum(map(len, map(str.encode, words)))], pa.int64()),
        }
        return pa.RecordBatch.from_arrays([values[name] for name in names], names)


class TokenCounts:
    """The three steps for the texts of ``docs`` (doc_id, text, ...)."""

    def __init__(self, docs: DataFrame, path: str):
        self.path = path
        self.docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
        self.id_type = self.docs.schema["doc_id"].dataType
        self.chunks = materialize(self.frequencies(), "pre-token-frequencies")
        self.buckets = max(1, (self.chunks.agg(F.sum("word_bytes")).first()[0] or 0) // BUCKET_BYTES)

    def frequencies(self) -> DataFrame:
        """One row for each chunk."""
        path = self.path
        binary = ["specials", "distinct", "places", "often", "words"]
        schema = T.StructType(
            [T.StructField("chunk", T.LongType()), T.StructField("ids", T.ArrayType(self.id_type)), T.StructField("sizes", T.ArrayType(T.LongType()))]
            + [T.StructField(name, T.BinaryType()) for name in binary]
            + [T.StructField("word_bytes", T.LongType())]
        )
        names = schema.names

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, made = counter(path), Chunk()
            number = TaskContext.get().partitionId() << 32
            for batch in in_pieces(batches, "text"):
                made.add(batch.column("doc_id"), batch.column("text"), own)
                if made.bytes >= CHUNK_BYTES:
                    yield made.row(number, names)
                    made, number = Chunk(), number + 1
            if made.ids:
                yield made.row(number, names)

        return self.docs.mapInArrow(work, schema)

    def sent(self) -> DataFrame:
        """(bucket, chunk, places, words): a chunk's words of one bucket, and their places."""
        buckets = self.buckets

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for chunk, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    words = unpack_words(packed.as_py())
                    bucket = np.fromiter((xxhash.xxh64_intdigest(w) % buckets for w in words), np.int64, len(words))
                    order = np.argsort(bucket, kind="stable")
                    groups = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(words) else []
                    # Sorted, neighbours share their first letters and pack better.
                    groups = [np.array(sorted(own.tolist(), key=words.__getitem__)) for own in groups]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "bucket": pa.array([int(bucket[own[0]]) for own in groups], pa.int64()),
                            "chunk": pa.array([chunk] * len(groups), pa.int64()),
                            "places": pa.array([pack(own) for own in groups], pa.binary()),
                            "words": pa.array([pack_words([words[i] for i in own]) for own in groups], pa.binary()),
                        }
                    )

        return self.chunks.select("chunk", "words").mapInArrow(work, "bucket bigint, chunk bigint, places binary, words binary")

    def answers(self) -> DataFrame:
        """(chunk, places, pieces): each distinct word of a bucket is counted once."""
        path = self.path

        def work(table: pa.Table) -> pa.Table:
            lists = [unpack_words(packed.as_py()) for packed in table.column("words")]
            words = list({word: None for own in lists for word in own})
            pieces = dict(zip(words, counter(path).pieces(words), strict=True))
            found = [pack(np.fromiter(map(pieces.__getitem__, own), np.int32, len(own))) for own in lists]
            return pa.table({"chunk": table.column("chunk"), "places": table.column("places"), "pieces": pa.array(found, pa.binary())})

        return self.sent().groupBy("bucket").applyInArrow(work, "chunk bigint, places binary, pieces binary")

    def totals(self) -> DataFrame:
        """doc_id, n_bytes and n_tokens of every row."""
        schema = T.StructType(
            [T.StructField("doc_id", self.id_type), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
        )

        def work(chunk: pa.Table, answers: pa.Table) -> pa.Table:
            row = chunk.slice(0, 1)
            ids = row.column("ids").combine_chunks().flatten()
            sizes = row.column("sizes").combine_chunks().flatten().cast(pa.int64())
            one = {name: unpack(row.column(name)[0].as_py()).astype(np.int64) for name in ("specials", "distinct", "places", "often")}
            at = [unpack(p.as_py()) for p in answers.column("places")]
            pieces = np.zeros(sum(map(len, at)), np.int64)
            for places, found in zip(at, answers.column("pieces"), strict=True):
                pieces[places] = unpack(found.as_py())
            sums = np.concatenate(([0], np.cumsum(pieces[np.cumsum(one["places"])] * one["often"])))
            ends = np.cumsum(one["distinct"])
            tokens = sums[ends] - sums[ends - one["distinct"]] + one["specials"]
            return pa.table({"doc_id": ids, "n_bytes": sizes, "n_tokens": pa.array(tokens, pa.int64())})

        chunks = self.chunks.drop("words", "word_bytes").groupBy("chunk")
        return chunks.cogroup(self.answers().groupBy("chunk")).applyInArrow(work, schema)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of ``docs`` (doc_id, text, ...)."""
    return TokenCounts(docs, path).totals().withColumn("over_limit", F.col("n_tokens") > limit)


def op10(spark, folder):
    return count_tokens(read(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"))
