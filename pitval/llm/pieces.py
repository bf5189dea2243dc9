"""SentencePiece encoding and decoding with forward states shared between words of one prefix.

Spaces are marked (U+2581) and the text gets one mark in front. No piece has a mark after
another character, so a text falls apart before each run of marks without changing its
encoding; ``PieceModel`` verifies that. The distinct marked words of a task's texts are
sorted and walked depth-first like a trie: a word reuses the forward states of the
prefix it shares with the word before, and only the rest is scanned.

A forward state says how the best path to that place ends. For a unigram model, the best
path has the greatest sum of scores. The given model merges pairs instead, and the path
of the greatest sum is not its encoding; there, a path is right if and only if each two
neighbours are what merging their text alone gives, and exactly one path is right, so the
state is its last piece. Either way a place needs only the states before it.

Words are encoded once per worker while they stay in a bounded memory; a text's ids are
its words' ids in order. Work stays with the rows: nothing is shuffled.

Defined cases: a null text has null ids, an empty one none. A character without a piece
becomes its UTF-8 bytes. A U+2581 in a text is taken for a space, as the model does, so
decoding gives a space for it; every other text comes back exactly. Other columns pass
through.
"""

from __future__ import annotations

import gc
import re
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitval.llm.common import in_pieces, read

MARK = "▁"
#: Words, pairs of pieces that are kept from one batch to the next, and the longest such word.
KEPT_WORDS = 500_000
KEPT_PAIRS = 1_000_000
KEPT_LENGTH = 64
#: A prefix without a state, and the first id of characters that have no piece.
UNSET, UNKNOWN_FROM = -1, 1 << 20
UNIGRAM, PAIRS = "unigram", "pairs"
_SPACED = re.compile(r" *[^ ]+| +")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceModel:
    """Pieces with ids and scores, the ids of single bytes, and how they are chosen."""

    def __init__(self, scores: dict[str, float], ids: dict[str, int], byte_ids: list[int], kind: str):
        if any(MARK in p.lstrip(MARK) for p in scores):
            raise ValueError("a piece has a mark after another character: words can't be cut")
        self.scores, self.ids, self.byte_ids, self.kind = scores, ids, byte_ids, kind
        self.longest = max(map(len, scores), default=1)
        #: For each piece and each beginning of one: twice its id (-2 if it has none), plus one if a longer piece begins so.
        self.codes = {p: 2 * i for p, i in ids.items()}
        for p in scores:
            for k in range(1, len(p)):
                self.codes[p[:k]] = self.codes.get(p[:k], -2) | 1
        self.least = min(scores.values(), default=0.0) - 10.0
        of = {i: p.replace(MARK, " ").encode() for p, i in ids.items()} | {i: bytes([b]) for b, i in enumerate(byte_ids)}
        spelled = [of.get(i, b"") for i in range(max(of, default=-1) + 1)]
        #: Bytes of all ids end to end, and where each begins.
        self.spelling = np.frombuffer(b"".join(spelled), np.uint8)
        self.begins = np.concatenate(([0], np.cumsum(list(map(len, spelled))))).astype(np.int64)
        #: Ids of words as bytes of 32-bit numbers.
        self.words: dict[str, bytes] = {}
        #: May the piece with one id follow the piece with another?
        self.pairs: dict[int, bool] = {}

    @staticmethod
    def load(path: str) -> PieceModel:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        given = SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(given.serialized_model_proto())
        spec = proto.normalizer_spec
        if spec.name != "identity" or not spec.add_dummy_prefix or spec.remove_extra_whitespaces:
            raise ValueError("only models that leave texts as they are can be used")
        normal = [i for i in range(given.vocab_size()) if not (given.is_control(i) or given.is_unknown(i) or given.is_byte(i))]
        scores = {given.id_to_piece(i): given.get_score(i) for i in normal}
        ids = {given.id_to_piece(i): i for i in normal}
        byte_ids = [given.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        kind = UNIGRAM if proto.trainer_spec.model_type == 1 else PAIRS
        return PieceModel(scores, ids, byte_ids, kind)

    def merged(self, text: str) -> list[str]:
        """Characters of a short text merged pair by pair: the best score first, then the leftmost."""
        parts = list(text)
        scores = self.scores
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                own = scores.get(parts[k] + parts[k + 1])
                if own is not None and (best is None or own > best):
                    best, at = own, k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stands(self, key: int, before: str, piece: str) -> bool:
        """May ``piece`` follow ``before`` (nothing, if empty)? Kept under ``key``."""
        if len(self.pairs) >= KEPT_PAIRS:
            self.pairs.clear()
        found = self.pairs[key] = self.merged(before + piece) == ([before, piece] if before else [piece])
        return found

    def extend(self, word: str, last: list[int], sizes: list[int], best: list[float], begin: int) -> None:
        """Forward states of the prefixes of ``word`` longer than ``begin``: the id and length
        of the last piece on the best path, and that path's sum."""
        code_of, known, pairs = self.codes.get, self.pairs.get, self.kind == PAIRS
        size = len(word)
        last += [UNSET] * (size - begin)
        sizes += [0] * (size - begin)
        best += [-float("inf")] * (size - begin)
        for start in range(max(0, begin + 1 - self.longest), size):
            before = last[start]
            for end in range((start if start > begin else begin) + 1, size + 1):
                piece = word[start:end]
                code = code_of(piece)
                if code is None or (code < 0 and end == start + 1):
                    if end == start + 1 and (last[end] == UNSET or best[start] + self.least > best[end]):
                        # A character without a piece stands alone.
                        last[end], sizes[end], best[end] = UNKNOWN_FROM + ord(piece), 1, best[start] + self.least
                    if code is None:
                        break
                elif code >= 0:
                    own = code >> 1
                    if not pairs:
                        total = best[start] + self.scores[piece]
                        if total > best[end]:
                            last[end], sizes[end], best[end] = own, end - start, total
                    elif last[end] == UNSET:
                        key = (before << 22) | own
                        fits = known(key)
                        if fits is None:
                            fits = self.stands(key, word[start - sizes[start] : start], piece)
                        if fits:
                            last[end], sizes[end] = own, end - start
                if not code & 1:
                    break

    def path(self, end: int, last: list[int], sizes: list[int]) -> tuple[int, ...]:
        made: list[int] = []
        while end:
            own = last[end]
            if own < UNKNOWN_FROM:
                made.append(own)
            else:
                made += [self.byte_ids[b] for b in reversed(chr(own - UNKNOWN_FROM).encode())]
            end -= sizes[end]
        made.reverse()
        return tuple(made)

    def encode_words(self, words: set[str]) -> dict[str, tuple[int, ...]]:
        """The ids of marked words, each given without its first mark."""
        made: dict[str, tuple[int, ...]] = {}
        before = ""
        last, sizes, best = [UNSET], [0], [0.0]
        for key in sorted(words):
            word = MARK + key.replace(" ", MARK)
            common = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                common += 1
            del last[common + 1 :], sizes[common + 1 :], best[common + 1 :]
            self.extend(word, last, sizes, best, common)
            made[key] = self.path(len(word), last, sizes)
            before = word
        return made

    def encode(self, texts: list[str | None]) -> list[bytes | None]:
        """The ids of each text as bytes of 32-bit numbers."""
        cut: list[list[str] | None] = []
        for text in texts:
            if not text:
                cut.append(None if text is None else [])
                continue
            text = text.replace(MARK, " ")
            if "  " in text or text[0] == " " or text[-1] == " ":
                cut.append([w[1:] for w in _SPACED.findall(" " + text)])
            else:
                cut.append(text.split(" "))
        known = self.words
        if len(known) > KEPT_WORDS:
            for old in list(islice(known, len(known) // 2)):
                del known[old]
        fresh = self.encode_words(set(chain.from_iterable(c for c in cut if c)).difference(known))
        known.update((w, array("i", ids).tobytes()) for w, ids in fresh.items())
        made = [None if c is None else b"".join(map(known.__getitem__, c)) for c in cut]
        for word in [w for w in fresh if len(w) > KEPT_LENGTH]:
            del known[word]
        return made

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> list[bytes]:
        """The UTF-8 bytes of rows of ids laid end to end; the first space is the added mark.

        Ids that mean nothing give nothing.
        """
        ids = np.where((ids >= 0) & (ids < len(self.begins) - 1), ids, 0)
        sizes = self.begins[ids + 1] - self.begins[ids]
        ends = np.cumsum(sizes)
        data = self.spelling[np.repeat(self.begins[ids] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        at = np.concatenate(([0], ends))[starts].tolist()
        return [data[a + (data[a : a + 1] == b" " and a < b) : b] for a, b in zip(at, at[1:], strict=False)]


@contextmanager
def no_collection() -> Iterator[None]:
    """Without the collector of reference cycles: it would walk the kept words again and again, and here are no cycles."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


@lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    """One model a worker, so that its words are kept from task to task."""
    return PieceModel.load(path)


def encode(docs: DataFrame, path: str, into: str = "ids", text: str = "text") -> DataFrame:
    """``docs`` with the column ``into`` (array of int) added or replaced."""
    columns = [c for c in docs.columns if c.lower() != into.lower()]
    schema = T.StructType([*docs.select(columns).schema.fields, T.StructField(into, T.ArrayType(T.IntegerType(), True))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in in_pieces(batches, text):
            with no_collection():
                made = own.encode(batch.column(batch.schema.get_field_index(text)).to_pylist())
            sizes = [0 if m is None else len(m) // 4 for m in made]
            flat = np.frombuffer(b"".join(m for m in made if m), np.int32)
            offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            missing = pa.array([m is None for m in made])
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), mask=missing)
            kept = [batch.column(batch.schema.get_field_index(c)) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, ids], [*columns, into])

    return docs.mapInArrow(work, schema)


def decode(rows: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``rows`` with the column ``into`` (string) in place of ``ids``."""
    columns = [c for c in rows.columns if c not in (ids, into)]
    schema = T.StructType([*rows.select(columns).schema.fields, T.StructField(into, T.StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                lists = part.column(part.schema.get_field_index(ids))
                missing = lists.is_null().to_pylist()
                starts = np.concatenate(([0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))))
                flat = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
                made = [None if x else m.decode("utf-8", "replace") for m, x in zip(own.decode(flat, starts), missing, strict=True)]
                kept = [part.column(part.schema.get_field_index(c)) for c in columns]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(made, pa.string())], [*columns, into])

    return rows.mapInArrow(work, schema)


def op9(spark, folder):
    """Ids as a count and a hash, and whether decoding gives the text again."""
    path = tokenizer_path("piece_bpe_32k.model")
    docs = read(spark, folder, "documents").select("doc_id", "text")
    rows = encode(docs, path).withColumns(
        {
            "n_pieces": F.coalesce(F.size("ids"), F.lit(0)).cast("long"),
            "ids_hash": F.xxhash64("ids"),
            "text_sha256": F.sha2("text", 256),
        }
    )
    back = decode(rows.select("doc_id", "n_pieces", "ids_hash", "text_sha256", "ids"), path)
    decoded = F.sha2("decoded", 256)
    return back.select(
        "doc_id", "n_pieces", "ids_hash", decoded.alias("decoded_sha256"), decoded.eqNullSafe(F.col("text_sha256")).alias("round_trip")
    )
