"""Keep a dated table up to date from files as they land.

Each micro-batch owns the partitions ``(as_of_date, batch_id)``: replaying a batch after a
failure replaces exactly what it wrote before, and a late row for an old date adds a small
partition instead of rewriting that date. Readers take the newest batch per key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pitval.operators.dedupe import first_per_key
from pitval.sources.store import replace_partitions


def stream_snapshots(
    source: DataFrame,
    path: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    date: str = "as_of_date",
) -> StreamingQuery:
    """Write every available row of a streaming ``source`` and stop.

    ``prepare`` maps a micro-batch to table rows and must produce the ``date`` column.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch).withColumn("batch_id", F.lit(batch_id).cast("long"))
        replace_partitions(rows, path, [date, "batch_id"])

    return (
        source.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_snapshots(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]
) -> DataFrame:
    """The table as written so far; for a key sent again the newest batch wins.

    Rows of one key in one batch are ordered by all their values, the greatest wins, so
    that the answer does not depend on how the batch was read.
    """
    fields = [f for f in schema.fields if f.name != "batch_id"]
    stored = spark.read.schema(T.StructType([*fields, T.StructField("batch_id", T.LongType())])).parquet(path)
    rest = [F.col(f.name).desc_nulls_last() for f in fields if f.name not in keys]
    return first_per_key(stored, keys, [F.col("batch_id").desc(), *rest]).drop("batch_id")


def compact_snapshots(
    spark: SparkSession, path: str, target: str, schema: T.StructType, keys: Sequence[str], date: str = "as_of_date"
) -> None:
    """Write the table as readers see it to ``target``, one partition per date.

    The batches become batch -1 there, older than any that follows, so a stream that goes
    on into ``target`` wins over them. ``path`` is left as it is; run between two runs of the stream.
    """
    rows = read_snapshots(spark, path, schema, keys).withColumn("batch_id", F.lit(-1).cast("long"))
    replace_partitions(rows, target, [date, "batch_id"])
