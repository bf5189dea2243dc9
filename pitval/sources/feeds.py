"""Readers and cleaners for landed feed files.

CSV columns are taken by header name and cast to declared types, so a feed may carry
extra columns or another column order. Nothing is inferred from the data.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitval import constants as C
from pitval import schemas
from pitval.functions.numeric import clean_nonfinite, finite, to_id, to_number
from pitval.operators.dedupe import first_per_key, highest_volume

log = logging.getLogger("pitval.feeds")


def typed(column: Column, kind: T.DataType, source: T.DataType | None = None) -> Column:
    """The column as ``kind``; bad text becomes null. Whole numbers in text or floating
    point may carry a decimal point; whole-number columns are never passed through a
    double, which would round large ids."""
    if source == kind:
        return column
    whole = (T.IntegerType, T.LongType)
    if isinstance(kind, whole) and not isinstance(source, (*whole, T.ShortType, T.ByteType)):
        rounded_off = finite(to_number(column)).try_cast(kind)
        if isinstance(source, (T.DoubleType, T.FloatType)):
            return rounded_off
        return F.coalesce(column.try_cast(kind), rounded_off)
    return column.try_cast(kind)


def fit_schema(df: DataFrame, schema: T.StructType, fill: bool = False) -> DataFrame:
    """Only declared columns, in declared order and type; absent ones dropped or null."""
    have = {field.name: field.dataType for field in df.schema.fields}
    out = []
    for field in schema.fields:
        if field.name in have:
            column = typed(F.col(field.name), field.dataType, have[field.name])
            out.append(column.alias(field.name))
        elif fill:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*out)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name; a column one side lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header, every column as text (quotes doubled inside quotes)."""
    return spark.read.option("header", True).option("escape", '"').csv(path)


def read_csv_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV file as ``schema``; an empty frame with that schema if the file is missing.

    ``seq`` numbers the lines in file order, for rules where a later line wins.
    """
    try:
        raw = read_csv(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("missing %s", path)
        return spark.createDataFrame([], schema).withColumn("seq", F.lit(0).cast("long"))
    numbered = raw.withColumn("_seq", F.monotonically_increasing_id())
    known = [f.name for f in schema.fields if f.name in raw.columns]
    return numbered.select(
        *[typed(F.col(n), schema[n].dataType).alias(n) for n in known], F.col("_seq").alias("seq")
    )


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    """Manual name overrides; the file calls the id and group by their feed names."""
    wanted = T.StructType(
        [
            T.StructField("player_name", T.StringType()),
            T.StructField("team", T.StringType()),
            T.StructField("primary_pos", T.StringType()),
            T.StructField("mlbam_id", T.LongType()),
            T.StructField("note", T.StringType()),
        ]
    )
    return read_csv_or_empty(spark, path, wanted).withColumnsRenamed(
        {"team": "group_code", "mlbam_id": "entity_id"}
    )


def read_manual_costs(spark: SparkSession, path: str) -> DataFrame:
    """Manual cost entries (entity_id, period, cost); an empty cost stays null."""
    wanted = T.StructType(
        [
            T.StructField("mlbam_id", T.LongType()),
            T.StructField("season", T.IntegerType()),
            T.StructField("salary_usd", T.DoubleType()),
            T.StructField("note", T.StringType()),
        ]
    )
    return read_csv_or_empty(spark, path, wanted).withColumnsRenamed(
        {"mlbam_id": "entity_id", "season": "period", "salary_usd": "cost"}
    )


# ---- forecast feeds -------------------------------------------------------------


def scan_feed(raw: DataFrame, columns: Mapping[str, str], role: str) -> DataFrame:
    """One feed with mapped columns only, renamed, and its role."""
    return raw.select(
        *[F.col(f"`{source}`").alias(name) for source, name in columns.items()],
        F.lit(role).alias("role"),
    )


def union_feeds(
    feeds: Sequence[DataFrame], source: str, period: int, as_of: dt.date
) -> DataFrame:
    """Role feeds as one table, stamped and cut to the declared columns (no feed_id)."""
    stamped = union_all(feeds).withColumns(
        {
            "source": F.lit(source),
            "period": F.lit(period),
            "as_of_date": F.lit(as_of).cast("date"),
        }
    )
    without_id = T.StructType([f for f in schemas.FEED.fields if f.name != "feed_id"])
    return fit_schema(stamped, without_id, fill=True)


FEED_IDENTITY = ["source", "as_of_date", "period", "role", "player_name", "group_code", "primary_pos", "other_pos"]


def with_feed_ids(feed: DataFrame) -> DataFrame:
    """Adds ``feed_id``: a 63-bit hash of what a row is about, and of its number among equal ones.

    Loading the same rows again gives the same ids, and no id ever passes to another name.
    """
    rest = [F.col(c) for c in feed.columns if c not in FEED_IDENTITY]
    number = F.row_number().over(Window.partitionBy(*FEED_IDENTITY).orderBy(*rest))
    made = F.xxhash64(*FEED_IDENTITY, number).bitwiseAND(F.lit((1 << 63) - 1))
    return feed.withColumn("feed_id", made).select(*[f.name for f in schemas.FEED.fields])


def load_feeds(
    spark: SparkSession,
    hitters: str,
    pitchers: str,
    period: int,
    as_of: dt.date,
    source: str = "feed",
) -> DataFrame | None:
    """Both CSV feeds; a missing one is skipped with a warning, None if neither exists."""
    found = []
    for path, columns, role in (
        (hitters, C.HITTER_COLUMNS, C.ROLE_BAT),
        (pitchers, C.PITCHER_COLUMNS, C.ROLE_PITCH),
    ):
        try:
            raw = read_csv(spark, path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            log.warning("missing %s", path)
            continue
        found.append(scan_feed(raw, columns, role))
    return union_feeds(found, source, period, as_of) if found else None


# ---- registry -------------------------------------------------------------------


def clean_registry(raw: DataFrame) -> DataFrame:
    """Registry rows with an id above zero and both names, one per id.

    Ids at or below zero are the register's mark for "none". Of several rows for one id
    the first by name is kept.
    """
    named = raw.withColumnsRenamed(C.REGISTRY_COLUMNS)
    kept = named.select(
        to_id(F.col("entity_id").cast("string")).alias("entity_id"), "first_name", "last_name"
    ).filter("entity_id > 0 and first_name is not null and last_name is not null")
    return first_per_key(kept, ["entity_id"], [F.col("first_name"), F.col("last_name")])


# ---- outcomes -------------------------------------------------------------------


def union_outcomes(bat: DataFrame, pitch: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Outcomes of both roles; fielding runs exist for one role only. A missing stint is 1."""

    def role_rows(raw: DataFrame, role: str, columns: Mapping[str, str]) -> DataFrame:
        named = raw.withColumnsRenamed(dict(columns))
        return named.select(*columns.values()).withColumn("role", F.lit(role))

    without_fielding = {k: v for k, v in C.OUTCOME_COLUMNS.items() if v != "def_runs"}
    both = union_all(
        [
            role_rows(bat, C.ROLE_BAT, C.OUTCOME_COLUMNS),
            role_rows(pitch, C.ROLE_PITCH, without_fielding),
        ]
    )
    typed_rows = fit_schema(both.filter("entity_id is not null"), schemas.OUTCOMES)
    out = clean_nonfinite(typed_rows).withColumn("stint", F.coalesce("stint", F.lit(1)))
    return out.withColumn("as_of_date", F.lit(as_of).cast("date")) if as_of else out


# ---- season features ------------------------------------------------------------

#: Columns without which a season file says nothing.
SEASON_NEEDS = ("Lev", "mlbID")


def read_whole_csv(spark: SparkSession, path: str, needed: Sequence[str]) -> DataFrame:
    """``read_csv``, but judged at once: raises ValueError if a needed column is not there or a
    record has more or fewer fields than the header."""
    found = read_csv(spark, path)
    missing = [c for c in needed if c not in found.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    broken = "_broken_record"
    schema = T.StructType([*found.schema.fields, T.StructField(broken, T.StringType())])
    reader = spark.read.schema(schema).option("header", True).option("escape", '"').option("enforceSchema", False)
    rows = reader.option("columnNameOfCorruptRecord", broken).csv(path)
    bad = rows.filter(F.col(broken).isNotNull()).select(*found.columns, broken).first()
    if bad is not None:
        raise ValueError(f"{path} has a broken record: {bad[broken][:200]}")
    return found


def clean_season(raw: DataFrame, columns: Mapping[str, str], volume: str, role: str) -> DataFrame:
    """Top-level rows of one role, one per entity and ``period``.

    An entity that changed groups has several rows; the one with the most volume stays,
    ties settled by the remaining columns. ``raw`` may hold any number of periods.
    """
    top = raw.filter(F.coalesce("Lev", F.lit("")).startswith(C.MAJOR_LEAGUE_PREFIX))
    named = top.withColumnsRenamed(dict(columns)).withColumns(
        {"entity_id": to_id(F.col("entity_id").cast("string")), "role": F.lit(role)}
    )
    kept = fit_schema(named.filter("entity_id is not null"), schemas.FEATURES)
    keys = ["entity_id", "period"]
    ties = [F.col(c) for c in kept.columns if c not in (*keys, volume, "role")]
    if volume not in kept.columns:
        return first_per_key(kept, keys, ties)
    return highest_volume(kept, keys, volume, ties)


def union_seasons(frames: Sequence[DataFrame], as_of: dt.date) -> DataFrame:
    """Season frames as one dated feature table."""
    stamped = union_all(frames).withColumn("as_of_date", F.lit(as_of).cast("date"))
    return clean_nonfinite(fit_schema(stamped, schemas.FEATURES, fill=True))


def load_seasons(
    spark: SparkSession, paths: Mapping[tuple[int, str], str], as_of: dt.date
) -> DataFrame | None:
    """CSV files per (period, role). A file that is missing, lacks a column that rows are chosen by,
    or holds a record that can't be parsed is logged and left out, and the pitch half of a period
    is read only if its bat half was good. Files of one role are cleaned together."""
    raw: dict[str, list[DataFrame]] = {C.ROLE_BAT: [], C.ROLE_PITCH: []}
    for period in sorted({p for p, _ in paths}):
        for role in raw:
            try:
                found = read_whole_csv(spark, paths[period, role], SEASON_NEEDS)
            except (PySparkException, KeyError, ValueError) as error:
                log.error("giving up on %s %s: %s", period, role, error)
                break
            raw[role].append(found.withColumn("period", F.lit(period)))
    cleaned = [
        clean_season(union_all(raw[role]), columns, volume, role)
        for role, columns, volume in (
            (C.ROLE_BAT, C.SEASON_BAT_COLUMNS, "pa"),
            (C.ROLE_PITCH, C.SEASON_PITCH_COLUMNS, "ip"),
        )
        if raw[role]
    ]
    return union_seasons(cleaned, as_of) if cleaned else None
