"""Repeated passages by a sparse, range-partitioned suffix array.

A string of ``length`` bytes (100) is removed wherever it also starts earlier. Sorting the
suffixes of all positions would move a hundred times the input, so only some suffixes
are sorted: of each 100-byte string the place of its least 32-byte hash is its anchor, a
choice that depends on the string alone. Neighbouring strings share anchors; a run of
them with its bytes is a context, about one for every 32 bytes of text.

1. Chunks of documents send the hashes of their anchors' leading 32 bytes to hash ranges
   and get back those that some other chunk has too. Nearly all unique text ends here.
   (A collision of hashes only lets a context through; it decides nothing.)
2. What is left goes to buckets by the leading bytes of the anchor's suffix, between
   splitters taken from a sample. Of equal contexts in one chunk only the first is sent.
3. A bucket sorts the suffixes to the right of the anchors and the reversed prefixes to
   their left by multikey quicksort, eight bytes at a time. Cutting both orders where
   neighbours share too few bytes gives, for each offset of a string around its anchor,
   the classes of equal strings; all but the first of a class are repeats. Strings are
   compared byte by byte, so the result is exact.
4. The spans return to their chunk, where overlapping ones are joined.

The number of buckets follows the bytes of the texts, however small the sample is: where the
ranges that it can tell apart are fewer, each range is cut further by the hash of the anchor's
leading 32 bytes. Strings with equal leading bytes share a bucket, so none has an equal beyond its
boundary. Leading bytes that the sample shows to be frequent would make one bucket
large; their contexts are cut into single strings and dealt by the hash of the whole
string, where a very frequent one counts at most once a chunk.

Order is by doc_id, then text hash for rows that share an id. Defined cases: a null text
is empty; a null doc_id is the smallest; of rows equal in doc_id and text the first is
treated as above and each other one repeats it whole; texts under 100 bytes keep all.
Other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitval.llm.common import free_name, read, text_bytes, utf8

LENGTH = 100
LEAD = 32
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 2 << 20
#: Texts and anchors that the splitters are taken from; they steer the balance, not the result.
SAMPLE_TEXTS = 2000
SAMPLE_LEADS = 100_000
#: Ranges between splitters; so many that the sample has some 50 leads for each.
MOST_RANGES = SAMPLE_LEADS // 50
BLOCK = 1 << 17
SMALL_RANGE = 4096
LEAST_ID = -(2**63)

_MIX = np.uint64(0x9E3779B97F4A7C15)


def unaligned_words(data: np.ndarray) -> np.ndarray:
    """Little-endian 64-bit words at every byte of ``data``; the last seven bytes have none."""
    return np.ndarray((max(0, len(data) - 7),), "<u8", data, strides=(1,))


def lead_hashes(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """64-bit hashes of the LEAD bytes at each place."""
    words = unaligned_words(data)
    made = np.zeros(len(places), np.uint64)
    for k in range(0, LEAD, 8):
        made = (made ^ words[places + k]) * _MIX
        made ^= made >> np.uint64(32)
    return made


@dataclass
class Contexts:
    """Runs of strings with one anchor: string starts ``first``..``last``, and the anchor."""

    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """A 32-bit hash of the LEAD bytes from each place, by doubling."""
    made = data.astype(np.uint32) * np.uint32(0x9E3779B1) + np.uint32(0x85EBCA77)
    span, factor = 1, 0x01000193
    while span < LEAD:
        made = made[:-span] * np.uint32(factor) + made[span:]
        factor = factor * factor % 2**32
        span *= 2
    made ^= made >> np.uint32(15)
    made *= np.uint32(0x2C1B3C6D)
    made ^= made >> np.uint32(13)
    return made


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def contexts(data: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> Contexts:
    """The contexts of texts laid end to end; none crosses a text."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    inside = np.zeros(len(data) + 1, np.int8)
    long = np.flatnonzero(np.diff(starts) >= length)
    inside[starts[long]] = 1
    # A text's last start is closed one further; where the next text begins right there, both cancel.
    ends = starts[long + 1] - length + 1
    np.subtract.at(inside, ends, 1)
    is_start = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    for begin in range(0, len(data) - length + 1, BLOCK):
        piece = data[begin : begin + BLOCK + length - 1]
        keyed = rolling_hash(piece).astype(np.uint64) << np.uint64(32)
        keyed |= np.arange(len(keyed), dtype=np.uint64)
        least = sliding_minimum(keyed, length - LEAD + 1)
        own = np.flatnonzero(is_start[begin : begin + len(least)])
        if not len(own):
            continue
        anchor = (least[own] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        change = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(own) != 1)) + 1
        heads = np.concatenate(([0], change))
        tails = np.concatenate((change - 1, [len(own) - 1]))
        found.append((own[heads] + begin, own[tails] + begin, anchor[heads] + begin))
    if not found:
        none = np.zeros(0, np.int64)
        return Contexts(none, none, none)
    return Contexts(*(np.concatenate(part) for part in zip(*found, strict=True)))


def multikey_quicksort(words: np.ndarray) -> np.ndarray:
    """The order of the rows of a matrix of words, compared from the left.

    Splits a range at a pivot of one word into less, equal and more; only the equal
    rows go on to the next word. Short ranges are sorted directly.
    """
    order = np.arange(len(words))
    todo = [(0, len(words), 0)]
    while todo:
        low, high, depth = todo.pop()
        if high - low < 2 or depth == words.shape[1]:
            continue
        rows = order[low:high]
        if high - low <= SMALL_RANGE:
            order[low:high] = rows[np.lexsort(words[rows, depth:].T[::-1])]
            continue
        column = words[rows, depth]
        pivot = np.sort(column[:: max(1, len(column) // 63)])[31]
        less, same, more = column < pivot, column == pivot, column > pivot
        cut, cut2 = low + int(less.sum()), high - int(more.sum())
        order[low:high] = np.concatenate((rows[less], rows[same], rows[more]))
        todo += [(low, cut, depth), (cut, cut2, depth + 1), (cut2, high, depth)]
    return order


def padded(data: np.ndarray, begin: np.ndarray, sizes: np.ndarray, width: int, step: int) -> np.ndarray:
    """Bytes from ``begin`` on, forwards (step 1) or backwards (-1), as rows of zero-padded width."""
    width = -(-width // 8) * 8
    reach = np.arange(width)
    places = begin[:, None] + step * reach
    return np.where(reach < sizes[:, None], data[np.clip(places, 0, len(data) - 1)], 0).astype(np.uint8)


def shared_prefixes(rows: np.ndarray) -> np.ndarray:
    """How many leading bytes each row shares with the one before it."""
    differ = rows[1:] != rows[:-1]
    return np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])


def repeated_strings(
    data: np.ndarray, begin: np.ndarray, left: np.ndarray, size: np.ndarray, rank: np.ndarray, length: int
) -> np.ndarray:
    """For each context and offset of a string before its anchor: does the string repeat one of lower rank?

    A context is ``data[begin : begin + size]`` with the anchor ``left`` bytes in. The
    result has a column per offset 0..length - LEAD.
    """
    n = len(begin)
    right_rows = padded(data, begin + left, size - left, length, 1)
    left_rows = padded(data, begin + left - 1, left, length - LEAD, -1)
    classes = []
    for rows in (right_rows, left_rows):
        order = multikey_quicksort(rows.view(">u8").astype(np.uint64))
        classes.append((order, shared_prefixes(rows[order])))
    repeated = np.zeros((n, length - LEAD + 1), bool)
    ids = [np.empty(n, np.int64), np.empty(n, np.int64)]
    for offset in range(length - LEAD + 1):
        has = np.flatnonzero((left >= offset) & (left - (size - length) <= offset))
        if len(has) < 2:
            continue
        for own, (order, shared), need in zip(ids, classes, (length - offset, offset), strict=True):
            own[order] = np.concatenate(([0], np.cumsum(shared < need)))
        key = ids[0][has] * n + ids[1][has]
        order = np.lexsort((rank[has], key))
        same = key[order[1:]] == key[order[:-1]]
        repeated[has[order[1:][same]], offset] = True
    return repeated


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of 64-bit numbers of one length."""
    return zstandard.compress(b"".join(a.astype("<i8").tobytes() for a in arrays), 1)


def unpack(packed: bytes, columns: int) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(packed), "<i8").reshape(columns, -1)


@dataclass
class Chunk:
    """Distinct rows of a chunk in order, end to end."""

    ids: np.ndarray
    hashes: np.ndarray
    data: np.ndarray
    starts: np.ndarray

    def places(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """doc_id, text hash and place within the text."""
        doc = np.searchsorted(self.starts, at, side="right") - 1
        return self.ids[doc], self.hashes[doc], at - self.starts[doc]


def row_keys(table: pa.Table, id_col: str, hash_col: str) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column(id_col).cast(pa.int64()).fill_null(LEAST_ID).to_numpy()
    return ids, table.column(hash_col).to_numpy()


def chunk_of(table: pa.Table, id_col: str, text_col: str, hash_col: str) -> Chunk:
    ids, hashes = row_keys(table, id_col, hash_col)
    order = np.lexsort((hashes, ids))
    again = np.concatenate(([False], (np.diff(ids[order]) == 0) & (np.diff(hashes[order]) == 0)))
    order = order[~again]
    data, starts = utf8(table.column(text_col).take(pa.array(order)))
    return Chunk(ids[order], hashes[order], data, starts)


class RepeatFinder:
    """Finds and removes the repeats of the texts of ``docs``."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH):
        if length < LEAD + 8:
            raise ValueError(f"strings must have at least {LEAD + 8} bytes")
        self.id_col, self.text_col, self.length = id_col, text_col, length
        self.columns = docs.columns
        self.chunk_col = free_name("chunk", docs.columns)
        self.hash_col = free_name("text_hash", docs.columns)
        total = docs.agg(F.count("*").alias("rows"), F.sum(text_bytes(F.col(text_col))).alias("bytes")).first()
        self.rows, self.bytes = total["rows"], total["bytes"] or 0
        self.chunks = max(1, self.bytes // CHUNK_BYTES)
        wanted = max(1, self.bytes // BUCKET_BYTES)
        self.ranges = min(wanted, MOST_RANGES)
        self.cuts = -(-wanted // self.ranges)
        self.buckets = self.ranges * self.cuts
        self.docs = docs.withColumn(self.hash_col, F.xxhash64(text_col)).withColumn(
            self.chunk_col, F.pmod(F.xxhash64(id_col, self.hash_col), F.lit(self.chunks)).cast("int")
        )

    def splitters(self) -> tuple[np.ndarray, np.ndarray]:
        """Leading words that part the buckets, and those too frequent for one bucket."""
        length, share = self.length, min(1.0, SAMPLE_TEXTS / max(1, self.rows))
        step = max(1, int(self.bytes * share / LEAD / SAMPLE_LEADS))

        def leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, starts = utf8(batch.column(0))
                found = contexts(data, starts, length).anchor[::step]
                yield pa.RecordBatch.from_arrays([pa.array(unaligned_words(data)[found].view(np.int64))], ["lead"])

        sample = self.docs.select(F.col(self.text_col).cast("string")).sample(share, seed=1)
        got = sample.mapInArrow(leads, "lead bigint").toArrow().column("lead").to_numpy()
        if not len(got):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        values, counts = np.unique(got.view(np.uint64).byteswap(), return_counts=True)
        hot = values[counts >= max(4, len(got) / (4 * self.buckets))]
        at = np.searchsorted(np.cumsum(counts), np.arange(1, self.ranges) * len(got) / self.ranges)
        return np.unique(values[at]), hot

    def shared_leads(self) -> DataFrame:
        """(chunk, packed): hashes of leading bytes that at least two chunks have."""
        id_col, text_col, hash_col, chunk_col = self.id_col, self.text_col, self.hash_col, self.chunk_col
        length, buckets = self.length, self.buckets

        def hashes(table: pa.Table) -> pa.Table:
            chunk = chunk_of(table, id_col, text_col, hash_col)
            made = np.unique(lead_hashes(chunk.data, contexts(chunk.data, chunk.starts, length).anchor))
            bucket = ((made >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(made)]))[: len(made) + 1]
            own = table.column(chunk_col)[0].as_py()
            heads = cuts[:-1]
            return pa.table(
                {
                    "bucket": pa.array(bucket[heads], pa.int64()),
                    "chunk": pa.array(np.full(len(heads), own), pa.int32()),
                    "packed": pa.array([made[a:b].tobytes() for a, b in zip(heads, cuts[1:], strict=True)], pa.binary()),
                }
            )

        def shared(table: pa.Table) -> pa.Table:
            parts = [np.frombuffer(p, np.uint64) for p in table.column("packed").to_pylist()]
            everything = np.sort(np.concatenate(parts))
            twice = np.unique(everything[1:][everything[1:] == everything[:-1]])
            hit = [part[np.isin(part, twice, assume_unique=True)].tobytes() for part in parts]
            some = [i for i, h in enumerate(hit) if h]
            return pa.table(
                {
                    "chunk": table.column("chunk").take(pa.array(some, pa.int64())).cast(pa.int32()),
                    "packed": pa.array([hit[i] for i in some], pa.binary()),
                }
            )

        sent = self.docs.groupBy(chunk_col).applyInArrow(hashes, "bucket bigint, chunk int, packed binary")
        return sent.groupBy("bucket").applyInArrow(shared, "chunk int, packed binary")

    def bucketed(self) -> DataFrame:
        """(bucket, chunk, packed, strings): contexts by bucket. A bucket past the last holds
        the spans of one chunk that repeat within it."""
        id_col, text_col, hash_col, chunk_col = self.id_col, self.text_col, self.hash_col, self.chunk_col
        length, buckets, cuts_in_range = self.length, self.buckets, self.cuts
        parts, hot = self.splitters()

        def work(table: pa.Table, flags: pa.Table) -> pa.Table:
            out: dict[str, list] = {"bucket": [], "chunk": [], "packed": [], "strings": []}
            if not table.num_rows:
                return pa.table(out, pa_schema)
            own = table.column(chunk_col)[0].as_py()
            chunk = chunk_of(table, id_col, text_col, hash_col)
            found = contexts(chunk.data, chunk.starts, length)
            hashes = lead_hashes(chunk.data, found.anchor)
            known = [np.frombuffer(p, np.uint64) for p in flags.column("packed").to_pylist()]
            in_order = np.sort(hashes)
            known.append(in_order[1:][in_order[1:] == in_order[:-1]])
            some = np.isin(hashes, np.concatenate(known))
            first, last, anchor = found.first[some], found.last[some], found.anchor[some]
            cut = (hashes[some] >> np.uint64(32)).astype(np.int64) * cuts_in_range >> 32
            lead = unaligned_words(chunk.data)[anchor].byteswap() if len(anchor) else np.zeros(0, np.uint64)
            raw = chunk.data.tobytes()
            # Of contexts with equal bytes and anchor, all but the first of the chunk are repeats.
            seen: dict[tuple[bytes, int], int] = {}
            repeat = np.zeros(len(first), bool)
            ends = (last + length).tolist()
            for i, (a, b, c) in enumerate(zip(first.tolist(), ends, anchor.tolist(), strict=True)):
                if seen.setdefault((raw[a:b], c - a), i) != i:
                    repeat[i] = True
            certain = [(first[repeat], last[repeat] + length)]
            rest = ~repeat
            is_hot = np.isin(lead, hot)
            plain = np.flatnonzero(rest & ~is_hot)
            whole = [(first[plain], last[plain] + length, anchor[plain], np.searchsorted(parts, lead[plain], side="right") * cuts_in_range + cut[plain])]
            single = np.flatnonzero(rest & is_hot)
            if len(single):
                sizes = last[single] - first[single] + 1
                at = np.repeat(first[single] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
                mid = np.repeat(anchor[single], sizes)
                strings: dict[bytes, int] = {}
                fresh = np.zeros(len(at), bool)
                deal = np.zeros(len(at), np.int64)
                for i, a in enumerate(at.tolist()):
                    string = raw[a : a + length]
                    if strings.setdefault(string, i) == i:
                        fresh[i] = True
                        deal[i] = xxhash.xxh3_64_intdigest(string) % buckets
                certain.append((at[~fresh], at[~fresh] + length))
                whole.append((at[fresh], at[fresh] + length, mid[fresh], deal[fresh]))
            begin, end, mid, bucket = (np.concatenate(x) for x in zip(*whole, strict=True))
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            for rows in np.split(order, cuts) if len(order) else []:
                ids, texts, at = chunk.places(begin[rows])
                spans = zip(begin[rows].tolist(), end[rows].tolist(), strict=True)
                out["bucket"].append(int(bucket[rows[0]]))
                out["chunk"].append(own)
                out["packed"].append(pack(ids, texts, at, mid[rows] - begin[rows], end[rows] - begin[rows]))
                out["strings"].append(zstandard.compress(b"".join(raw[a:b] for a, b in spans), 1))
            begin, end = (np.concatenate(x) for x in zip(*certain, strict=True))
            if len(begin):
                ids, texts, at = chunk.places(begin)
                out["bucket"].append(buckets + own)
                out["chunk"].append(own)
                out["packed"].append(pack(ids, texts, at, at + end - begin))
                out["strings"].append(None)
            return pa.table(out, pa_schema)

        pa_schema = pa.schema(
            [("bucket", pa.int64()), ("chunk", pa.int32()), ("packed", pa.binary()), ("strings", pa.binary())]
        )
        flags = self.shared_leads()
        left = self.docs.groupBy(chunk_col)
        return left.cogroup(flags.groupBy("chunk")).applyInArrow(
            work, "bucket bigint, chunk int, packed binary, strings binary"
        )

    def spans(self) -> DataFrame:
        """(chunk, packed): doc_id, text hash, begin and end of the bytes that repeat earlier ones."""
        length, buckets = self.length, self.buckets
        schema = pa.schema([("chunk", pa.int32()), ("packed", pa.binary())])

        def work(table: pa.Table) -> pa.Table:
            if table.column("bucket")[0].as_py() >= buckets:
                return table.select(["chunk", "packed"]).cast(schema)
            parts = [unpack(p, 5) for p in table.column("packed").to_pylist()]
            chunk = np.repeat(table.column("chunk").to_numpy(), [p.shape[1] for p in parts])
            ids, texts, at, left, size = np.concatenate(parts, axis=1)
            raw = b"".join(zstandard.decompress(s) for s in table.column("strings").to_pylist())
            begin = np.cumsum(size) - size
            rank = np.empty(len(ids), np.int64)
            rank[np.lexsort((at, texts, ids))] = np.arange(len(ids))
            # Contexts with equal bytes and anchor: all but the first are repeats as a whole.
            order = np.argsort(rank)
            seen: dict[tuple[bytes, int], int] = {}
            whole = np.zeros(len(ids), bool)
            for i, a, s, u in zip(order.tolist(), begin[order].tolist(), size[order].tolist(), left[order].tolist(), strict=True):
                if seen.setdefault((raw[a : a + s], u), i) != i:
                    whole[i] = True
            found = [(np.flatnonzero(whole), at[whole], (at + size)[whole])]
            data = np.frombuffer(raw + bytes(8), np.uint8)
            rest = np.flatnonzero(~whole)
            _, group, counts = np.unique(lead_hashes(data, (begin + left)[rest]), return_inverse=True, return_counts=True)
            rest = rest[counts[group] > 1]
            if len(rest):
                repeated = repeated_strings(data, begin[rest], left[rest], size[rest], rank[rest], length)
                # Runs of offsets; a larger offset starts earlier.
                edge = np.diff(np.pad(repeated, ((0, 0), (1, 1))).astype(np.int8), axis=1)
                row, low = np.nonzero(edge == 1)
                high = np.nonzero(edge == -1)[1] - 1
                context = rest[row]
                anchor = at[context] + left[context]
                found.append((context, anchor - high, anchor - low + length))
            context, start, end = (np.concatenate(x) for x in zip(*found, strict=True))
            out: dict[str, list] = {"chunk": [], "packed": []}
            order = np.argsort(chunk[context], kind="stable")
            cuts = np.flatnonzero(np.diff(chunk[context[order]])) + 1
            for rows in np.split(order, cuts) if len(order) else []:
                c = context[rows]
                out["chunk"].append(int(chunk[c[0]]))
                out["packed"].append(pack(ids[c], texts[c], start[rows], end[rows]))
            return pa.table(out, schema)

        return self.bucketed().groupBy("bucket").applyInArrow(work, "chunk int, packed binary")

    def kept(self) -> tuple[DataFrame, list[str]]:
        """All columns, then bytes, bytes removed, removed runs, and the bytes that stay; and these four names."""
        names = []
        for wanted in ("n_bytes", "n_removed", "n_spans", "kept"):
            names.append(free_name(wanted, self.columns + names))
        schema = T.StructType([*self.docs.select(self.columns).schema.fields, *(T.StructField(n, T.LongType()) for n in names[:3]), T.StructField(names[3], T.BinaryType())])
        id_col, text_col, hash_col, columns, length = self.id_col, self.text_col, self.hash_col, self.columns, self.length

        def work(table: pa.Table, spans: pa.Table) -> pa.Table:
            ids, hashes = row_keys(table, id_col, hash_col)
            data, starts = utf8(table.column(text_col))
            parts = [unpack(p, 4) for p in spans.column("packed").to_pylist()] or [np.zeros((4, 0), np.int64)]
            s_ids, s_hashes, begin, end = np.concatenate(parts, axis=1)
            order = np.lexsort((hashes, ids))
            again = np.zeros(len(ids), bool)
            again[order[1:]] = (np.diff(ids[order]) == 0) & (np.diff(hashes[order]) == 0)
            row_of = {(i, h): r for r, i, h, x in zip(range(len(ids)), ids.tolist(), hashes.tolist(), again.tolist(), strict=True) if not x}
            rows = np.fromiter((row_of[x] for x in zip(s_ids.tolist(), s_hashes.tolist(), strict=True)), np.int64, len(s_ids))
            marks = np.zeros(len(data) + 1, np.int32)
            np.add.at(marks, starts[rows] + begin, 1)
            np.subtract.at(marks, starts[rows] + end, 1)
            gone = np.cumsum(marks[:-1]) > 0
            figures: list[list] = [[], [], [], []]
            for a, b, x in zip(starts[:-1].tolist(), starts[1:].tolist(), again.tolist(), strict=True):
                away = gone[a:b] if not x or b - a < length else np.ones(b - a, bool)
                removed = int(away.sum())
                runs = int(away[0]) + int(np.count_nonzero(away[1:] & ~away[:-1])) if removed else 0
                own = data[a:b]
                for to, value in zip(figures, (b - a, removed, runs, (own[~away] if removed else own).tobytes()), strict=True):
                    to.append(value)
            made = table.select(columns)
            for name, values, kind in zip(names, figures, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True):
                made = made.append_column(name, pa.array(values, kind))
            return made

        return self.docs.groupBy(self.chunk_col).cogroup(self.spans().groupBy("chunk")).applyInArrow(work, schema), names


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeats cut out of ``text``. Bytes of a character that was cut through are left out."""
    kept, names = RepeatFinder(docs, length=length).kept()
    # Cutting inside a character leaves bytes that are no character; they are dropped, not replaced.
    left = F.col(names[3]).cast("string")
    whole = F.regexp_replace(F.make_valid_utf8(left), "\ufffd", "")
    exact = F.try_validate_utf8(left)
    text = F.when(F.col(names[1]) == 0, F.col("text")).otherwise(F.coalesce(exact, whole))
    return kept.withColumn("text", text).select(docs.columns)


def op4(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    kept, _ = RepeatFinder(docs).kept()
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
