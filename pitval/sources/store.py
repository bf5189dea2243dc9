"""Dated tables on shared storage: idempotent writes, schema-on-read.

A fact table is partitioned by ``as_of_date``; its partition for a date is that date's
snapshot. Writing a date again replaces that partition and no other. An empty frame
writes nothing and leaves the old rows in place.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitval import schemas
from pitval.operators.dedupe import best_prediction
from pitval.sources.feeds import fit_schema

_DATE = re.compile(r"as_of_date=(\d{4}-\d\d-\d\d)")

TABLES: dict[str, tuple[T.StructType, list[str]]] = {
    "registry": (schemas.REGISTRY, ["as_of_date"]),
    "outcomes": (schemas.OUTCOMES, ["as_of_date"]),
    "features": (schemas.FEATURES, ["as_of_date"]),
    "feed": (schemas.FEED, ["as_of_date"]),
    "resolutions": (schemas.RESOLUTIONS, ["as_of_date"]),
    "predictions": (schemas.PREDICTIONS, ["period", "system"]),
    "valuations": (schemas.VALUATIONS, ["as_of_date"]),
}


def replace_partitions(df: DataFrame, path: str, by: list[str], spread: bool = True) -> None:
    """Overwrite exactly the partitions present in ``df``.

    ``spread`` rebalances rows by partition value first: adaptive execution then merges
    small partitions into one file and splits a large one over several tasks.
    """
    rows = df.hint("rebalance", *by) if spread else df
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table as ``schema``: files written before a column existed read as null there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path`` on any file system that Spark reads; none if it is not there."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not system.exists(folder):
        return []
    return [status.getPath().getName() for status in system.listStatus(folder) if status.isDirectory()]


class Store:
    """The tables of one warehouse folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str) -> DataFrame:
        schema, _ = TABLES[table]
        return read_table(self.spark, self.path(table), schema)

    def replace_for_date(self, table: str, df: DataFrame, as_of: dt.date) -> None:
        """Make ``df`` the snapshot of ``as_of``. All rows go to one partition, so tasks
        write their own files and no shuffle is needed."""
        schema, by = TABLES[table]
        if by != ["as_of_date"]:
            raise ValueError(f"{table} is not partitioned by as_of_date")
        stamped = df.withColumn("as_of_date", F.lit(as_of).cast("date"))
        replace_partitions(fit_schema(stamped, schema, fill=True), self.path(table), by, spread=False)

    def dates(self, table: str) -> list[dt.date]:
        """The dates a table has snapshots of: one listing of the table's own folder, whatever
        the number of files below it."""
        found = (_DATE.fullmatch(name) for name in folder_names(self.spark, self.path(table)))
        return sorted(dt.date.fromisoformat(m[1]) for m in found if m)

    def snapshot(self, table: str, cutoff: dt.date | str | None = None) -> DataFrame:
        """The newest snapshot not after the cutoff. Only the folder of its date is read; the
        folders of other dates are not even listed."""
        if isinstance(cutoff, str):
            cutoff = dt.date.fromisoformat(cutoff)
        schema, _ = TABLES[table]
        known = [d for d in self.dates(table) if cutoff is None or d <= cutoff]
        if not known:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self.path(table))
        rows = reader.parquet(f"{self.path(table)}/as_of_date={known[-1]}")
        return rows.filter(F.col("as_of_date") == F.lit(known[-1]))

    def replace_predictions(self, df: DataFrame) -> None:
        """Replace the (period, system) partitions in ``df``; of several predictions for
        one entity the highest is kept."""
        schema, by = TABLES["predictions"]
        best = best_prediction(
            df, ["entity_id", "period", "system", "as_of_date"], "projected_outcome"
        )
        replace_partitions(fit_schema(best, schema, fill=True), self.path("predictions"), by)
