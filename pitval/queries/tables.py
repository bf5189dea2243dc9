"""Queries over reading, cleaning and writing tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitval import constants as C
from pitval.functions import numeric
from pitval.operators import dedupe
from pitval.operators import features as ft
from pitval.plans import evaluate as ev
from pitval.queries.catalogue import query
from pitval.queries.views import LAST_FULL_PERIOD, Views
from pitval.session import scratch_path
from pitval.sources import feeds
from pitval.sources.store import Store, read_table, replace_partitions


@query(
    "feed_scan",
    """
    SELECT p_name AS player_name, CAST(p_size AS INTEGER) AS age, p_brand AS group_code,
           p_type AS primary_pos, replace(p_name, ' ', ',') AS other_pos, 'pitch' AS role,
           round(p_retailprice, 1) AS ip, CAST(p_size % 3 AS INTEGER) AS w,
           CAST(NULL AS INTEGER) AS pa, 'test' AS source, CAST(2026 AS INTEGER) AS period,
           DATE '2024-01-20' AS as_of_date
    FROM part
    UNION ALL
    SELECT p_name, CAST(p_size AS INTEGER), p_brand, p_type, replace(p_name, ' ', ','), 'bat',
           NULL, NULL, CAST(p_size * 2 AS INTEGER), 'test', CAST(2026 AS INTEGER), DATE '2024-01-20'
    FROM part
    """,
)
def feed_scan(v: Views) -> DataFrame:
    part = v.table("part")
    common = [
        F.col("p_name").alias("PLAYER"),
        F.col("p_size").alias("AGE"),
        F.col("p_brand").alias("TM"),
        F.col("p_type").alias("MAIN POS"),
        F.translate("p_name", " ", ",").alias("OTHER POS"),
    ]

    def landed(columns, values, name):
        blank = [
            F.lit(None).cast("string").alias(c)
            for c in columns
            if c not in values and c not in ("PLAYER", "AGE", "TM", "MAIN POS", "OTHER POS")
        ]
        path = scratch_path(v.spark, name)
        part.select(
            F.lit("x").alias("IGNORED"), *blank, *common, *[x.alias(n) for n, x in values.items()]
        ).write.option("header", True).csv(path)
        return path

    hitters = landed(C.HITTER_COLUMNS, {"PA": F.col("p_size") * 2}, "hitters")
    pitchers = landed(
        C.PITCHER_COLUMNS,
        {"IP": F.round("p_retailprice", 1), "W": F.col("p_size") % 3},
        "pitchers",
    )
    loaded = feeds.load_feeds(v.spark, hitters, pitchers, 2026, dt.date(2024, 1, 20), "test")
    return loaded.select(
        "player_name", "age", "group_code", "primary_pos", "other_pos", "role", "ip", "w", "pa",
        "source", "period", "as_of_date",
    )


@query(
    "registry_clean",
    """
    WITH raw AS (
      SELECT CASE WHEN l_quantity < 3 THEN -1 WHEN l_quantity < 5 THEN NULL ELSE l_partkey END AS k,
             CASE WHEN l_discount = 0.05 THEN NULL ELSE l_returnflag || l_linestatus END AS f,
             'n' || l_linenumber AS l
      FROM lineitem)
    SELECT k AS entity_id, f AS first_name, l AS last_name FROM raw
    WHERE k > 0 AND f IS NOT NULL AND l IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY k ORDER BY f, l) = 1
    """,
)
def registry_clean(v: Views) -> DataFrame:
    raw = v.table("lineitem").select(
        F.when(F.col("l_quantity") < 3, F.lit(-1).cast("long"))
        .when(F.col("l_quantity") >= 5, F.col("l_partkey"))
        .alias("key_mlbam"),
        F.when(F.col("l_discount") != 0.05, F.concat("l_returnflag", "l_linestatus")).alias("name_first"),
        F.concat(F.lit("n"), F.col("l_linenumber").cast("string")).alias("name_last"),
    )
    return feeds.clean_registry(raw)


def _raw_outcomes(v: Views, status: str) -> DataFrame:
    rows = v.table("lineitem").filter(F.col("l_linestatus") == status)
    columns = {
        "mlb_ID": F.when(F.col("l_quantity") > 1, F.col("l_partkey")),
        "year_ID": F.year("l_shipdate"),
        "stint_ID": F.when(F.col("l_linenumber") < 7, F.col("l_linenumber")),
        "player_ID": F.lit("p"),
        "team_ID": F.lit("t"),
        "lg_ID": F.lit("l"),
        "G": F.col("l_quantity"),
        "salary": F.when(F.col("l_returnflag") != "N", F.col("l_extendedprice")),
        "WAR": F.col("l_discount"),
        "WAR_rep": F.col("l_tax"),
        "WAA": F.col("l_tax"),
    }
    if status == "F":
        columns["runs_above_avg_def"] = F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(
            F.col("l_tax")
        )
    return rows.select(*[c.alias(n) for n, c in columns.items()])


@query(
    "outcomes_union",
    """
    SELECT l_partkey AS entity_id, CAST(year(l_shipdate) AS INTEGER) AS period,
           CAST(CASE WHEN l_linenumber < 7 THEN l_linenumber ELSE 1 END AS INTEGER) AS stint,
           CASE WHEN l_linestatus = 'F' THEN 'bat' ELSE 'pitch' END AS role,
           CASE WHEN l_returnflag <> 'N' THEN l_extendedprice END AS cost,
           l_discount AS outcome,
           CASE WHEN l_linestatus = 'F' AND l_tax <> 0 THEN l_tax END AS def_runs,
           CAST(l_quantity AS INTEGER) AS games, DATE '2024-01-20' AS as_of_date
    FROM lineitem WHERE l_quantity > 1
    """,
)
def outcomes_union(v: Views) -> DataFrame:
    both = feeds.union_outcomes(_raw_outcomes(v, "F"), _raw_outcomes(v, "O"), dt.date(2024, 1, 20))
    return both.select(
        "entity_id", "period", "stint", "role", "cost", "outcome", "def_runs", "games", "as_of_date"
    )


def _raw_season(v: Views, status: str, columns: dict[str, str]) -> DataFrame:
    """All seasons of one role under feed headers, ids as text, some of them unusable."""
    rows = v.table("lineitem").filter(F.col("l_linestatus") == status)
    values = {
        "Lev": F.when(F.col("l_returnflag") == "N", "Min-AAA").when(
            F.col("l_returnflag") == "A", F.concat(F.lit("Maj-"), F.col("l_returnflag"))
        ).when(F.col("l_discount") > 0, "Maj"),
        "mlbID": F.when(F.col("l_tax") == 0, "unknown").otherwise(
            F.concat(F.col("l_partkey").cast("string"), F.lit(".0"))
        ),
        "Tm": F.concat(F.lit("S"), F.col("l_suppkey").cast("string")),
        "PA" if status == "F" else "IP": F.col("l_quantity"),
        "G": F.col("l_linenumber"),
        "ERA" if status == "O" else "BA": F.col("l_extendedprice"),
    }
    names = [*columns, "Lev"]
    return rows.select(
        *[values.get(n, F.lit(None).cast("string")).alias(n) for n in names],
        F.year("l_shipdate").alias("period"),
    )


SEASON_SQL = """
    WITH raw AS (
      SELECT CASE WHEN l_linestatus = 'F' THEN 'bat' ELSE 'pitch' END AS role,
             CAST(year(l_shipdate) AS INTEGER) AS period, l_partkey AS entity_id,
             'S' || l_suppkey AS group_code, l_quantity AS volume, l_linenumber AS games,
             l_extendedprice AS rate
      FROM lineitem
      WHERE l_tax <> 0 AND (l_returnflag = 'A' OR (l_returnflag = 'R' AND l_discount > 0))),
    best AS (
      SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY entity_id, period, role
        ORDER BY volume DESC NULLS LAST, group_code, games, rate) = 1)
"""


@query(
    "features_union",
    SEASON_SQL
    + """
    SELECT entity_id, period, role, group_code, CAST(games AS INTEGER) AS games,
           CASE WHEN role = 'bat' THEN CAST(volume AS INTEGER) END AS pa,
           CASE WHEN role = 'pitch' THEN volume END AS ip, DATE '2024-01-20' AS as_of_date
    FROM best
    """,
)
def features_union(v: Views) -> DataFrame:
    frames = []
    for status, role, columns, volume in (
        ("F", "bat", C.SEASON_BAT_COLUMNS, "pa"),
        ("O", "pitch", C.SEASON_PITCH_COLUMNS, "ip"),
    ):
        raw = _raw_season(v, status, columns)
        frames.append(feeds.clean_season(raw, columns, volume, role))
    return feeds.union_seasons(frames, dt.date(2024, 1, 20)).select(
        "entity_id", "period", "role", "group_code", "games", "pa", "ip", "as_of_date"
    )


@query(
    "dedupe_max_volume",
    "SELECT entity_id, period, role, group_code, pa, h, hr, bb, obp, ip, age FROM features",
)
def dedupe_max_volume(v: Views) -> DataFrame:
    return v.features().select(
        "entity_id", "period", "role", "group_code", "pa", "h", "hr", "bb", "obp", "ip", "age"
    )


@query(
    "coerce_numeric",
    """
    WITH t AS (SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN 'n/a' WHEN p_size % 2 = 0
                 THEN p_size || '.0' ELSE CAST(p_size AS VARCHAR) END AS txt FROM part)
    SELECT p_partkey AS entity_id, try_cast(txt AS DOUBLE) AS number,
           CAST(try_cast(txt AS DOUBLE) AS BIGINT) AS id FROM t
    """,
)
def coerce_numeric(v: Views) -> DataFrame:
    text = (
        F.when(F.col("p_type") == "SMALL", "n/a")
        .when(F.col("p_size") % 2 == 0, F.concat(F.col("p_size").cast("string"), F.lit(".0")))
        .otherwise(F.col("p_size").cast("string"))
    )
    return v.table("part").select(
        F.col("p_partkey").alias("entity_id"),
        numeric.to_number(text).alias("number"),
        numeric.to_id(text).alias("id"),
    )


@query(
    "clean_nonfinite",
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN l_tax = 0 OR l_discount = 0 THEN NULL ELSE l_quantity / l_discount END AS ratio
    FROM lineitem
    """,
)
def clean_nonfinite(v: Views) -> DataFrame:
    ratio = (
        F.when(F.col("l_tax") == 0, F.lit(float("nan")))
        .when(F.col("l_discount") == 0, F.lit(float("-inf")))
        .otherwise(F.col("l_quantity") / F.col("l_discount"))
    )
    return numeric.clean_nonfinite(
        v.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", ratio.alias("ratio"))
    )


@query(
    "rate_stats",
    """
    SELECT entity_id, period, role, bb / nullif(ip, 0) * 9 AS bb9, hr / nullif(ip, 0) * 9 AS hr9
    FROM features
    """,
)
def rate_stats(v: Views) -> DataFrame:
    return numeric.add_rate_stats(v.features()).select("entity_id", "period", "role", "bb9", "hr9")


@query(
    "best_role_row",
    """
    SELECT entity_id, period, role, outcome FROM (
      SELECT entity_id, period, role, round(sum(outcome), 4) AS outcome FROM outcomes GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY entity_id, period ORDER BY outcome DESC, role) = 1
    """,
)
def best_role_row(v: Views) -> DataFrame:
    totals = rounded_totals(v)
    return dedupe.best_prediction(totals, ["entity_id", "period"], "outcome")


def rounded_totals(v: Views) -> DataFrame:
    return ft.outcome_by_period(v.outcomes()).withColumn("outcome", F.round("outcome", 4))


@query(
    "entity_dim_for_period",
    """
    SELECT entity_id, first_name || ' ' || last_name AS name, g AS group_code
    FROM (SELECT entity_id, min(group_code) AS g FROM features WHERE period = 2000 GROUP BY 1)
    JOIN registry USING (entity_id)
    """,
)
def entity_dim_for_period(v: Views) -> DataFrame:
    return ev.entity_dim_for_period(v.features(), v.registry(), LAST_FULL_PERIOD)


# ---- writes: written to the scratch folder, then read back ----------------------


@query(
    "snapshot_replace",
    """
    SELECT entity_id, as_of_date, age, outcome_year1,
           surplus_value + CASE WHEN as_of_date = DATE '2024-01-10' THEN 1000 ELSE 0 END AS surplus_value,
           cost_estimated
    FROM dated_values
    """,
)
def snapshot_replace(v: Views) -> DataFrame:
    """Load all dates, load one date again with other values, then an empty frame."""
    store = Store(v.spark, scratch_path(v.spark, "store"))
    values = v.dated_values()
    replace_partitions(values, store.path("valuations"), ["as_of_date"])
    day = dt.date(2024, 1, 10)
    again = values.filter(F.col("as_of_date") == F.lit(day)).withColumn(
        "surplus_value", F.col("surplus_value") + 1000
    )
    store.replace_for_date("valuations", again, day)
    store.replace_for_date("valuations", values.filter("false"), dt.date(2024, 1, 11))
    return store.read("valuations")


@query(
    "full_refresh",
    "SELECT entity_id, first_name, last_name FROM registry",
)
def full_refresh(v: Views) -> DataFrame:
    store = Store(v.spark, scratch_path(v.spark, "store"))
    day = dt.date(2024, 1, 20)
    store.replace_for_date("registry", v.registry().withColumn("first_name", F.lit("older")), dt.date(2024, 1, 19))
    store.replace_for_date("registry", v.registry().withColumn("first_name", F.lit("old")), day)
    store.replace_for_date("registry", v.registry(), day)
    return store.snapshot("registry").select("entity_id", "first_name", "last_name")


@query(
    "predictions_replace",
    """
    WITH t AS (
      SELECT entity_id, period, role, round(sum(outcome), 4) AS outcome FROM outcomes GROUP BY ALL)
    SELECT entity_id, period, 'model' AS system, DATE '2024-01-20' AS as_of_date,
           max(outcome) AS projected_outcome
    FROM t GROUP BY entity_id, period
    """,
)
def predictions_replace(v: Views) -> DataFrame:
    """Two writes of the same (period, system) keep only the second, one row per entity."""
    store = Store(v.spark, scratch_path(v.spark, "store"))
    totals = rounded_totals(v).select(
        "entity_id",
        "period",
        "role",
        F.lit("model").alias("system"),
        F.lit("2024-01-20").cast("date").alias("as_of_date"),
        F.col("outcome").alias("projected_outcome"),
    )
    store.replace_predictions(totals.withColumn("projected_outcome", F.lit(0.0)))
    store.replace_predictions(totals)
    return store.read("predictions").select(
        "entity_id", "period", "system", "as_of_date", "projected_outcome"
    )


@query(
    "schema_evolve",
    """
    SELECT entity_id, as_of_date, age, surplus_value,
           CASE WHEN as_of_date >= DATE '2024-01-15' THEN outcome_year1 END AS outcome_year1
    FROM dated_values
    """,
)
def schema_evolve(v: Views) -> DataFrame:
    """Files written before a column existed read as null there."""
    path = scratch_path(v.spark, "evolve")
    values = v.dated_values().drop("cost_estimated")
    split = F.lit("2024-01-15").cast("date")
    replace_partitions(
        values.filter(F.col("as_of_date") < split).drop("outcome_year1"), path, ["as_of_date"]
    )
    replace_partitions(values.filter(F.col("as_of_date") >= split), path, ["as_of_date"])
    return read_table(v.spark, path, values.schema)
