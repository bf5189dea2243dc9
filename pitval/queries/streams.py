"""The streaming query: dated snapshots from files as they land."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitval.queries.catalogue import query
from pitval.queries.views import Views
from pitval.session import scratch_path
from pitval.streaming.snapshots import read_snapshots, stream_snapshots


@query(
    "stream_snapshot_replace",
    """
    SELECT user_id AS entity_id, CAST(ts AS DATE) AS as_of_date,
           round(sum(value), 4) AS surplus_value, count(*) AS n
    FROM events GROUP BY ALL
    """,
)
def stream_snapshot_replace(v: Views) -> DataFrame:
    """Stream the events into a dated table, then sum the table per entity and date."""
    schema = v.table("events").schema
    source = (
        v.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(v.folder)
    )
    target = scratch_path(v.spark, "stream")
    stream_snapshots(
        source,
        target,
        scratch_path(v.spark, "progress"),
        lambda batch: batch.select(
            "event_id", "user_id", "value", F.col("ts").cast("date").alias("as_of_date")
        ),
    ).awaitTermination()
    stored = v.table("events").select(
        "event_id", "user_id", "value", F.col("ts").cast("date").alias("as_of_date")
    )
    rows = read_snapshots(v.spark, target, stored.schema, ["event_id"])
    return rows.groupBy(F.col("user_id").alias("entity_id"), "as_of_date").agg(
        F.round(F.sum("value"), 4).alias("surplus_value"), F.count(F.lit(1)).alias("n")
    )
