"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "pitval", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is written for.

    Adaptive execution does the runtime work: it coalesces small shuffle
    partitions, splits skewed ones in sort-merge joins and picks broadcast joins
    from measured sizes. Any keyword (dots written as ``__``) overrides a setting.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({key.replace("__", "."): str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder for written intermediate tables.

    ``spark.checkpoint.dir``, or the session's warehouse where that is not set: both are
    read by the driver and by every executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch folder; nothing has been written to it yet."""
    return f"{scratch_root(spark)}/pitval/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage on durable storage, so a lost executor costs a re-read and not
    a recompute, and pins values that depend on where rows were placed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
