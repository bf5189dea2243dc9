"""The library's tables built from the star-schema test tables.

Each view exists twice: as a DataFrame here, and as a CTE of the same name in
``PRELUDE`` for the SQL that checks it.

A part is an entity, a line item is an outcome of the year it shipped in, the line status
is the role, a supplier's nation is the group it appeared with, and events are dated
valuations of the entity with the user's id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LAST_FULL_PERIOD = 2000
CURRENT_PERIOD = 2001
#: Appearances go by month (year x 12 + month), so that the lookback leaves some entities out.
CURRENT_MONTH = 2001 * 12 + 11
FEED_DATES = ("2024-01-01", "2024-01-15")
MODEL_COLUMNS = ["pa", "h", "hr", "bb", "obp", "age"]
#: The remaining model features: a remainder of a key each.
MORE_COLUMNS = {
    "so": ("l_orderkey", 97), "sb": ("l_suppkey", 13), "slg": ("l_orderkey", 11), "r": ("l_partkey", 31),
    "rbi": ("l_suppkey", 37), "doubles": ("l_orderkey", 19), "triples": ("l_partkey", 7), "cs": ("l_suppkey", 5),
    "era": ("l_orderkey", 23), "whip": ("l_partkey", 3), "gs": ("l_suppkey", 29), "w": ("l_orderkey", 17),
    "l": ("l_partkey", 13), "sv": ("l_suppkey", 7), "so9": ("l_orderkey", 14),
}
RATE_COLUMNS = ["ip", "bb", "hr"]


class Views:
    """Views over the parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def registry(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("entity_id"),
            F.col("p_name").alias("first_name"),
            F.concat(F.lower("p_type"), F.lit(" "), F.col("p_size").cast("string")).alias("last_name"),
            F.col("p_brand").alias("group_code"),
            F.col("p_type").alias("primary_pos"),
            F.translate("p_name", " ", ",").alias("other_pos"),
            (18 + F.col("p_size") % 25).cast("int").alias("age"),
        )

    def outcomes(self) -> DataFrame:
        role = _role()
        return self.table("lineitem").select(
            F.col("l_partkey").alias("entity_id"),
            F.year("l_shipdate").cast("int").alias("period"),
            F.col("l_linenumber").cast("int").alias("stint"),
            role.alias("role"),
            F.when(F.col("l_returnflag") != "N", F.col("l_extendedprice") * 10).alias("cost"),
            (F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount"))) / 10000.0).alias("outcome"),
            F.when(
                F.col("l_linestatus") == "F", (F.round(F.col("l_tax") * 100) - 4).cast("double")
            ).alias("def_runs"),
        )

    def raw_features(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_partkey").alias("entity_id"),
            F.year("l_shipdate").cast("int").alias("period"),
            _role().alias("role"),
            F.concat(F.lit("S"), (F.col("l_suppkey") % 30).cast("string")).alias("group_code"),
            F.col("l_quantity").alias("pa"),
            F.when(F.col("l_linenumber") != 7, F.col("l_linenumber").cast("double")).alias("h"),
            F.round(F.col("l_discount") * 100).alias("hr"),
            F.round(F.col("l_tax") * 100).alias("bb"),
            (F.col("l_extendedprice") / 100000.0).alias("obp"),
            (F.col("l_quantity") % 10).alias("ip"),
            (18 + F.col("l_partkey") % 25).cast("int").alias("age"),
            *[(F.col(source) % size).cast("double").alias(name) for name, (source, size) in MORE_COLUMNS.items()],
            F.col("l_orderkey"),
            F.col("l_suppkey"),
        )

    def features(self) -> DataFrame:
        from pitval.operators.dedupe import highest_volume

        return highest_volume(
            self.raw_features(),
            ["entity_id", "period", "role"],
            "pa",
            [F.col(c).asc_nulls_last() for c in ("obp", "l_orderkey", "l_suppkey", "h", "hr", "bb")],
        )

    def appearances(self) -> DataFrame:
        """Where an entity was seen: the nation of the supplier, by month."""
        lines = self.table("lineitem").select("l_partkey", "l_suppkey", "l_shipdate")
        places = self.table("supplier").join(
            self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")
        )
        return lines.join(places, F.col("l_suppkey") == F.col("s_suppkey")).select(
            F.col("l_partkey").alias("entity_id"),
            (F.year("l_shipdate") * 12 + F.month("l_shipdate")).cast("int").alias("period"),
            F.col("n_name").alias("group_code"),
        )

    def mentions(self) -> DataFrame:
        """Registry names as a feed might write them."""
        part = self.table("part")
        first = F.col("p_name")
        last = F.concat(F.lower("p_type"), F.lit(" "), F.col("p_size").cast("string"))
        name = F.concat(first, F.lit(" "), last)
        kind = F.col("p_partkey") % 16
        written = (
            F.when(kind == 0, F.upper(name))
            .when(kind == 1, F.translate(name, "eo", "éö"))
            .when(kind == 2, F.concat(name, F.lit(" Jr.")))
            .when(kind == 3, F.concat(name, F.lit(" ("), F.col("p_brand"), F.lit(")")))
            .when(kind == 4, F.regexp_replace(name, "i", "i'"))
            .when(kind == 5, F.concat(F.substring(name, 1, 2), F.substring(name, 4, 200)))
            .when(kind == 6, F.lit("  "))
            .when(kind == 7, F.lit(None).cast("string"))
            .when(kind == 8, F.concat(last, F.lit(" "), first, F.lit("x")))
            .when(kind == 9, F.concat(name, F.lit(" extra")))
            .when(kind == 10, F.regexp_replace(name, " ", "  "))
            .when(kind == 11, F.concat(F.substring(name, 1, 3), F.lit("q"), F.substring(name, 4, 200)))
            .when(kind == 12, F.concat(F.lit("zzz "), F.col("p_partkey").cast("string")))
            .otherwise(name)
        )
        return part.select(
            F.col("p_partkey").alias("feed_id"),
            written.alias("player_name"),
            F.when(
                F.col("p_partkey") % 5 != 0,
                F.concat(F.lit("nation_"), (F.col("p_partkey") % 25).cast("string")),
            ).alias("group_code"),
            F.col("p_type").alias("primary_pos"),
        )

    def overrides(self) -> DataFrame:
        name = F.concat_ws(
            " ", "p_name", F.lower("p_type"), F.col("p_size").cast("string")
        )
        return (
            self.table("part")
            .filter("p_size in (13, 27)")
            .select(
                name.alias("player_name"),
                F.concat(F.lit("nation_"), (F.col("p_partkey") % 25).cast("string")).alias("group_code"),
                F.when(F.col("p_type") != "SMALL", F.col("p_partkey") + 1).alias("entity_id"),
                F.col("p_partkey").alias("seq"),
            )
        )

    def dated_values(self) -> DataFrame:
        """Valuation snapshots: one row per user and day."""
        return (
            self.table("events")
            .groupBy(F.col("user_id").alias("entity_id"), F.col("ts").cast("date").alias("as_of_date"))
            .agg(F.round(F.sum("value"), 4).alias("surplus_value"), F.count(F.lit(1)).alias("n_events"))
            .select(
                "entity_id",
                "as_of_date",
                (F.lit(20) + F.col("entity_id") % 20).cast("int").alias("age"),
                F.col("n_events").cast("double").alias("outcome_year1"),
                "surplus_value",
                (F.col("n_events") == 1).alias("cost_estimated"),
            )
        )

    def feed(self) -> DataFrame:
        """Two dated feeds; the later one moves every entity to another group."""
        variants = F.array(
            *[
                F.struct(F.lit(i).alias("i"), F.lit(day).cast("date").alias("d"), F.lit(role).alias("r"))
                for i, (day, role) in enumerate(
                    (day, role) for day in FEED_DATES for role in ("bat", "pitch")
                )
            ]
        )
        return (
            self.table("part")
            .withColumn("v", F.explode(variants))
            .filter((F.col("v.r") == "bat") | (F.col("p_size") > 43))
            .select(
                (F.col("p_partkey") * 4 + F.col("v.i")).alias("feed_id"),
                F.col("v.d").alias("as_of_date"),
                F.col("v.r").alias("role"),
                F.when(F.col("v.i") < 2, F.col("p_brand"))
                .otherwise(F.concat(F.lit("Brand#"), (F.col("p_size") % 25 + 1).cast("string")))
                .alias("group_code"),
                F.when(F.col("v.r") == "bat", F.col("p_type")).otherwise(F.lit("PITCH")).alias("primary_pos"),
                F.translate("p_name", " ", ",").alias("other_pos"),
                (18 + (F.col("p_size") + F.col("v.i")) % 25).cast("int").alias("age"),
                F.col("p_retailprice").alias("k_per_9"),
            )
        )

    def feed_resolutions(self) -> DataFrame:
        return self.feed().select(
            "feed_id",
            "as_of_date",
            F.when(F.col("age") != 30, F.floor(F.col("feed_id") / 4)).alias("entity_id"),
        )

    def predictions(self) -> DataFrame:
        """A prediction per entity: its outcome in the last full period."""
        return (
            self.outcomes()
            .filter(F.col("period") == LAST_FULL_PERIOD)
            .groupBy("entity_id")
            .agg(F.round(F.sum("outcome"), 4).alias("projected_outcome"))
        )

    def pair_values(self) -> DataFrame:
        """Entities with the value they are matched on."""
        values = self.predictions().withColumnRenamed("projected_outcome", "surplus_value")
        return self.registry().join(values, "entity_id").select(
            "entity_id",
            "group_code",
            F.concat_ws(" ", "first_name", "last_name").alias("name"),
            "primary_pos",
            "other_pos",
            "surplus_value",
        )


def _role() -> Column:
    return F.when(F.col("l_linestatus") == "F", "bat").otherwise("pitch")


PRELUDE = """
WITH RECURSIVE registry AS (
  SELECT p_partkey AS entity_id, p_name AS first_name,
         lower(p_type) || ' ' || p_size AS last_name, p_brand AS group_code,
         p_type AS primary_pos, replace(p_name, ' ', ',') AS other_pos,
         CAST(18 + p_size % 25 AS INTEGER) AS age
  FROM part),
outcomes AS (
  SELECT l_partkey AS entity_id, CAST(year(l_shipdate) AS INTEGER) AS period,
         CAST(l_linenumber AS INTEGER) AS stint,
         CASE WHEN l_linestatus = 'F' THEN 'bat' ELSE 'pitch' END AS role,
         CASE WHEN l_returnflag <> 'N' THEN l_extendedprice * 10 END AS cost,
         floor(l_extendedprice * (1 - l_discount)) / 10000.0 AS outcome,
         CASE WHEN l_linestatus = 'F' THEN CAST(round(l_tax * 100) - 4 AS DOUBLE) END AS def_runs
  FROM lineitem),
raw_features AS (
  SELECT l_partkey AS entity_id, CAST(year(l_shipdate) AS INTEGER) AS period,
         CASE WHEN l_linestatus = 'F' THEN 'bat' ELSE 'pitch' END AS role,
         'S' || (l_suppkey % 30) AS group_code, l_quantity AS pa,
         CASE WHEN l_linenumber <> 7 THEN CAST(l_linenumber AS DOUBLE) END AS h,
         round(l_discount * 100) AS hr, round(l_tax * 100) AS bb,
         l_extendedprice / 100000.0 AS obp, l_quantity % 10 AS ip,
         CAST(18 + l_partkey % 25 AS INTEGER) AS age,
         CAST(l_orderkey % 97 AS DOUBLE) AS so, CAST(l_suppkey % 13 AS DOUBLE) AS sb, CAST(l_orderkey % 11 AS DOUBLE) AS slg,
         CAST(l_partkey % 31 AS DOUBLE) AS r, CAST(l_suppkey % 37 AS DOUBLE) AS rbi, CAST(l_orderkey % 19 AS DOUBLE) AS doubles,
         CAST(l_partkey % 7 AS DOUBLE) AS triples, CAST(l_suppkey % 5 AS DOUBLE) AS cs, CAST(l_orderkey % 23 AS DOUBLE) AS era,
         CAST(l_partkey % 3 AS DOUBLE) AS whip, CAST(l_suppkey % 29 AS DOUBLE) AS gs, CAST(l_orderkey % 17 AS DOUBLE) AS w,
         CAST(l_partkey % 13 AS DOUBLE) AS l, CAST(l_suppkey % 7 AS DOUBLE) AS sv, CAST(l_orderkey % 14 AS DOUBLE) AS so9,
         l_orderkey, l_suppkey
  FROM lineitem),
features AS (
  SELECT * FROM raw_features
  QUALIFY row_number() OVER (PARTITION BY entity_id, period, role
    ORDER BY pa DESC NULLS LAST, obp NULLS LAST, l_orderkey NULLS LAST, l_suppkey NULLS LAST,
             h NULLS LAST, hr NULLS LAST, bb NULLS LAST) = 1),
appearances AS (
  SELECT l_partkey AS entity_id, CAST(year(l_shipdate) * 12 + month(l_shipdate) AS INTEGER) AS period,
         n_name AS group_code
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
written AS (
  SELECT p_partkey, p_brand, p_type, p_size, p_name, lower(p_type) || ' ' || p_size AS last,
         p_name || ' ' || lower(p_type) || ' ' || p_size AS name
  FROM part),
mentions AS (
  SELECT p_partkey AS feed_id,
    CASE p_partkey % 16
      WHEN 0 THEN upper(name)
      WHEN 1 THEN replace(replace(name, 'e', 'é'), 'o', 'ö')
      WHEN 2 THEN name || ' Jr.'
      WHEN 3 THEN name || ' (' || p_brand || ')'
      WHEN 4 THEN replace(name, 'i', 'i''')
      WHEN 5 THEN substr(name, 1, 2) || substr(name, 4)
      WHEN 6 THEN '  '
      WHEN 7 THEN NULL
      WHEN 8 THEN last || ' ' || p_name || 'x'
      WHEN 9 THEN name || ' extra'
      WHEN 10 THEN replace(name, ' ', '  ')
      WHEN 11 THEN substr(name, 1, 3) || 'q' || substr(name, 4)
      WHEN 12 THEN 'zzz ' || p_partkey
      ELSE name END AS player_name,
    CASE WHEN p_partkey % 5 <> 0 THEN 'nation_' || (p_partkey % 25) END AS group_code,
    p_type AS primary_pos
  FROM written),
overrides AS (
  SELECT name AS player_name, 'nation_' || (p_partkey % 25) AS group_code,
         CASE WHEN p_type <> 'SMALL' THEN p_partkey + 1 END AS entity_id, p_partkey AS seq
  FROM written WHERE p_size IN (13, 27)),
dated_values AS (
  SELECT user_id AS entity_id, CAST(ts AS DATE) AS as_of_date,
         CAST(20 + user_id % 20 AS INTEGER) AS age, CAST(count(*) AS DOUBLE) AS outcome_year1,
         round(sum(value), 4) AS surplus_value, count(*) = 1 AS cost_estimated
  FROM events GROUP BY ALL),
feed AS (
  SELECT p_partkey * 4 + i AS feed_id, d AS as_of_date, r AS role,
         CASE WHEN i < 2 THEN p_brand ELSE 'Brand#' || (p_size % 25 + 1) END AS group_code,
         CASE WHEN r = 'bat' THEN p_type ELSE 'PITCH' END AS primary_pos,
         replace(p_name, ' ', ',') AS other_pos,
         CAST(18 + (p_size + i) % 25 AS INTEGER) AS age, p_retailprice AS k_per_9
  FROM part CROSS JOIN (VALUES (0, DATE '2024-01-01', 'bat'), (1, DATE '2024-01-01', 'pitch'),
    (2, DATE '2024-01-15', 'bat'), (3, DATE '2024-01-15', 'pitch')) AS v(i, d, r)
  WHERE r = 'bat' OR p_size > 43),
feed_resolutions AS (
  SELECT feed_id, as_of_date, CASE WHEN age <> 30 THEN feed_id // 4 END AS entity_id
  FROM feed),
predictions AS (
  SELECT entity_id, round(sum(outcome), 4) AS projected_outcome
  FROM outcomes WHERE period = 2000 GROUP BY entity_id),
pair_values AS (
  SELECT entity_id, group_code, first_name || ' ' || last_name AS name, primary_pos, other_pos,
         projected_outcome AS surplus_value
  FROM registry JOIN predictions USING (entity_id))
"""
