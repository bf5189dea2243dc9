"""Helpers that several text operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task handles at a time, so that memory does not follow the batch size.
PIECE_BYTES = 4 << 20


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


HASH_RANGE = 1 << 40


def hash_order(*keys: str) -> Column:
    """A place in 0..HASH_RANGE - 1 that only the keys decide."""
    return F.pmod(F.xxhash64(*keys), F.lit(HASH_RANGE))


def share_for(wanted: int, rows: int) -> int:
    """Places below this hold some four times ``wanted`` of ``rows`` rows, or all rows if there are few.

    Cutting here first leaves a bounded number of rows to rank, however many tasks there are.
    """
    return HASH_RANGE if rows <= 4 * wanted else int(HASH_RANGE * 4 * wanted / rows)


def free_name(wanted: str, taken: list[str]) -> str:
    """``wanted``, with underscores before it until no column of ``taken`` has that name."""
    while wanted.lower() in {t.lower() for t in taken}:
        wanted = f"_{wanted}"
    return wanted


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column end to end, and where each row starts (one more than rows).

    A null counts as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def in_pieces(batches: Iterator[pa.RecordBatch], text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text; a longer text comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, starts = utf8(batch.column(batch.schema.get_field_index(text)))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(starts, starts[first] + limit, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last
