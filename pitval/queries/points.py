"""Queries over joins in time: training rows, as-of reads, valuations and pairs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitval.functions.text import eligible_set
from pitval.functions.value import decline_rate, value_path
from pitval.operators import asof, quantiles
from pitval.operators import features as ft
from pitval.operators.costs import cost_precedence, with_surplus
from pitval.operators.pairs import closest_pairs
from pitval.plans import forecast, recommend, valuation
from pitval.queries.catalogue import query, rounded
from pitval.queries.views import LAST_FULL_PERIOD, MODEL_COLUMNS, Views
from pitval.sources.feeds import union_all

TOTALS_SQL = """
    WITH totals AS (
      SELECT entity_id, period, role, sum(outcome) AS outcome FROM outcomes
      GROUP BY entity_id, period, role HAVING count(outcome) > 0),
    hist AS (
      SELECT entity_id, period, sum(def_runs) AS def_runs FROM outcomes
      GROUP BY entity_id, period, role HAVING role = 'bat' AND count(def_runs) > 0)
"""


@query(
    "outcome_by_period",
    TOTALS_SQL + "SELECT entity_id, period, role, round(outcome, 4) AS outcome FROM totals",
)
def outcome_by_period(v: Views) -> DataFrame:
    return rounded(ft.outcome_by_period(v.outcomes()), 4, "outcome")


@query(
    "cost_by_entity",
    """
    SELECT entity_id, max(cost) AS cost FROM outcomes
    WHERE period = 2000 AND cost IS NOT NULL GROUP BY entity_id
    """,
)
def cost_by_entity(v: Views) -> DataFrame:
    return ft.cost_by_entity(v.outcomes(), LAST_FULL_PERIOD)


@query(
    "training_join",
    TOTALS_SQL
    + """
    SELECT entity_id, period, role, pa, h, hr, bb, obp, age, round(outcome, 4) AS outcome
    FROM features JOIN totals USING (entity_id, period, role)
    """,
)
def training_join(v: Views) -> DataFrame:
    return rounded(ft.training_rows(v.features(), v.outcomes(), MODEL_COLUMNS), 4, "outcome")


LAG1_SQL = (
    TOTALS_SQL
    + """,
    lag1 AS (
      SELECT entity_id, period, role, pa, h, hr, bb, obp, age, outcome_this_period, outcome,
             CAST(period + 1 AS INTEGER) AS target_period
      FROM features JOIN (
        SELECT entity_id, period - back AS period, role,
               sum(outcome) FILTER (WHERE back = 0) AS outcome_this_period,
               sum(outcome) FILTER (WHERE back = 1) AS outcome
        FROM totals, (VALUES (0), (1)) AS shifts(back)
        GROUP BY entity_id, period - back, role
        HAVING count(*) = 2) USING (entity_id, period, role))
"""
)


@query(
    "lag1_pairs",
    LAG1_SQL
    + """SELECT entity_id, period, role, pa, h, hr, bb, obp, age, target_period,
           round(outcome_this_period, 4) AS outcome_this_period, round(outcome, 4) AS outcome FROM lag1""",
)
def lag1_pairs(v: Views) -> DataFrame:
    rows = ft.lag1_rows(v.features(), v.outcomes(), MODEL_COLUMNS)
    return rounded(rows, 4, "outcome", "outcome_this_period")


@query(
    "asof_prior",
    TOTALS_SQL
    + """
    SELECT l.entity_id, l.period, l.role, l.pa, r.def_runs AS prior_def_runs
    FROM features l ASOF LEFT JOIN hist r ON l.entity_id = r.entity_id AND l.period > r.period
    """,
)
def asof_prior(v: Views) -> DataFrame:
    left = v.features().select("entity_id", "period", "role", "pa")
    history = ft.fielding_history(v.outcomes())
    return asof.asof_prior(
        left, history, "entity_id", "period", "period", "def_runs", "prior_def_runs"
    )


@query(
    "prepared_features",
    LAG1_SQL
    + """
    SELECT l.entity_id, l.period, l.role, l.target_period, l.pa, l.h,
           CASE WHEN l.role = 'bat' THEN r.def_runs END AS prior_def_runs
    FROM lag1 l ASOF LEFT JOIN hist r
      ON l.entity_id = r.entity_id AND l.target_period > r.period
    """,
)
def prepared_features(v: Views) -> DataFrame:
    return lag1_prepared(v).select(
        "entity_id", "period", "role", "target_period", "pa", "h", "prior_def_runs"
    )


def lag1_prepared(v: Views) -> DataFrame:
    outcomes = v.outcomes()
    return ft.with_prior_fielding(
        ft.lag1_rows(v.features(), outcomes, MODEL_COLUMNS), ft.fielding_history(outcomes), "target_period"
    )


@query(
    "temporal_split",
    """
    SELECT role, CASE WHEN period IN (2000, 2001) THEN 'test' ELSE 'train' END AS side,
           'holdout' AS rule, count(*) AS n
    FROM features GROUP BY ALL
    UNION ALL
    SELECT role, CASE WHEN period = 2000 THEN 'test' ELSE 'train' END, 'target', count(*)
    FROM features WHERE period <= 2000 GROUP BY ALL
    """,
)
def temporal_split(v: Views) -> DataFrame:
    rows = v.features()
    parts = []
    for rule, (train, test) in (
        ("holdout", ft.temporal_split(rows, "period", [2000, 2001])),
        ("target", ft.split_at_target(rows, 2000, "period")),
    ):
        for side, part in (("train", train), ("test", test)):
            parts.append(part.select("role", F.lit(side).alias("side"), F.lit(rule).alias("rule")))
    return union_all(parts).groupBy("role", "side", "rule").agg(F.count(F.lit(1)).alias("n"))


# ---- point-in-time reads --------------------------------------------------------

CUTOFFS = ("2023-12-31", "2024-01-10", "2024-06-01")


@query(
    "snapshot_as_of",
    " UNION ALL ".join(
        f"""SELECT DATE '{c}' AS cutoff, entity_id, as_of_date, surplus_value FROM dated_values
        WHERE as_of_date = (SELECT max(as_of_date) FROM dated_values WHERE as_of_date <= DATE '{c}')"""
        for c in CUTOFFS
    ),
)
def snapshot_as_of(v: Views) -> DataFrame:
    """Before any snapshot, between snapshots, and after the last one."""
    values = v.dated_values()
    return union_all(
        [
            asof.snapshot_as_of(values, c).select(
                F.lit(c).cast("date").alias("cutoff"), "entity_id", "as_of_date", "surplus_value"
            )
            for c in CUTOFFS
        ]
    )


@query(
    "latest_per_key_as_of",
    """
    SELECT entity_id, as_of_date, surplus_value FROM dated_values
    WHERE as_of_date <= DATE '2024-01-10'
    QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY as_of_date DESC) = 1
    """,
)
def latest_per_key_as_of(v: Views) -> DataFrame:
    return asof.latest_per_key_as_of(v.dated_values(), ["entity_id"], "2024-01-10").select(
        "entity_id", "as_of_date", "surplus_value"
    )


def _as_of_cte(cutoff: str, name: str = "pit") -> str:
    """Each dated input cut to its newest date by the cutoff, then one feed row per entity."""

    def pinned(table: str) -> str:
        return f"""(SELECT * FROM {table} WHERE as_of_date <= DATE '{cutoff}'
        QUALIFY as_of_date = max(as_of_date) OVER ())"""

    return f"""described AS (
      SELECT entity_id, group_code, primary_pos, other_pos FROM {pinned('feed_resolutions')} AS ids
      JOIN {pinned('feed')} AS rows USING (feed_id) WHERE entity_id IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY role, feed_id) = 1),
    {name} AS (
      SELECT entity_id, as_of_date, concat(first_name, ' ', last_name) AS name, described.group_code,
             described.primary_pos, described.other_pos, vals.age, outcome_year1, surplus_value, cost_estimated
      FROM {pinned('dated_values')} AS vals JOIN described USING (entity_id) JOIN registry USING (entity_id))"""


def pit_values(v: Views, cutoff: str | dt.date | None, entity_id: int | None = None) -> DataFrame:
    return recommend.valuations_as_of(
        v.dated_values(), v.registry(), v.feed_resolutions(), v.feed(), cutoff, entity_id
    )


@query("valuations_as_of", f"WITH {_as_of_cte('2024-01-10')} SELECT * FROM pit")
def valuations_as_of(v: Views) -> DataFrame:
    return pit_values(v, "2024-01-10")


@query("entity_lookup_as_of", f"WITH {_as_of_cte('9999-12-31')} SELECT * FROM pit WHERE entity_id = 42")
def entity_lookup_as_of(v: Views) -> DataFrame:
    return pit_values(v, None, 42)


@query(
    "valuations_summary",
    f"""WITH {_as_of_cte('2024-01-20')}
    SELECT count(*) AS entities, count(DISTINCT group_code) AS groups FROM pit""",
)
def valuations_summary(v: Views) -> DataFrame:
    return recommend.group_count(pit_values(v, "2024-01-20"))


@query(
    "resolved_feed",
    """
    SELECT feed_id, f.as_of_date, role, group_code, s.entity_id, age, k_per_9 AS so9
    FROM feed f JOIN feed_resolutions s USING (feed_id) WHERE s.entity_id IS NOT NULL
    """,
)
def resolved_feed(v: Views) -> DataFrame:
    return forecast.resolved_feed(v.feed(), v.feed_resolutions()).select(
        "feed_id", "as_of_date", "role", "group_code", "entity_id", "age", "so9"
    )


INPUTS_SQL = """inputs AS (
      SELECT p.entity_id, p.projected_outcome AS outcome_year1, max(f.age) AS age
      FROM predictions p JOIN feed_resolutions s USING (entity_id) JOIN feed f USING (feed_id)
      GROUP BY p.entity_id, p.projected_outcome)"""


def valuation_rows(v: Views) -> DataFrame:
    return valuation.valuation_inputs(v.predictions(), v.feed_resolutions(), v.feed())


@query("valuation_inputs", f"WITH {INPUTS_SQL} SELECT entity_id, outcome_year1, age FROM inputs")
def valuation_inputs(v: Views) -> DataFrame:
    return valuation_rows(v).select("entity_id", "outcome_year1", "age")


# ---- value over the horizon -----------------------------------------------------

RATE_SQL = (
    "CASE WHEN {a} <= 27 THEN 0.0::DOUBLE "
    "ELSE least(0.03::DOUBLE * ({a} - 27) - 0.02::DOUBLE, 0.40::DOUBLE) END"
)


@query(
    "aging_curve",
    f"SELECT p_partkey AS entity_id, round({RATE_SQL.format(a='p_size')}, 6) AS rate FROM part",
)
def aging_curve(v: Views) -> DataFrame:
    return v.table("part").select(
        F.col("p_partkey").alias("entity_id"), F.round(decline_rate(F.col("p_size")), 6).alias("rate")
    )


PATH_SQL = f"""path AS (
      SELECT *, outcome_year1 AS y0,
             outcome_year1 * (1 - {RATE_SQL.format(a='(age + 1)')}) AS y1,
             outcome_year1 * (1 - {RATE_SQL.format(a='(age + 1)')})
                           * (1 - {RATE_SQL.format(a='(age + 2)')}) AS y2
      FROM inputs)"""


@query(
    "value_path",
    f"""WITH {INPUTS_SQL}, {PATH_SQL}
    SELECT entity_id, round(y0, 6) AS y0, round(y1, 6) AS y1, round(y2, 6) AS y2 FROM path""",
)
def value_path_query(v: Views) -> DataFrame:
    path = value_path(F.col("outcome_year1"), F.col("age"))
    return valuation_rows(v).select(
        "entity_id", *[F.round(p, 6).alias(f"y{i}") for i, p in enumerate(path)]
    )


COSTS_SQL = """manual AS (
      SELECT l_partkey AS entity_id, CAST(2000 + l_linenumber % 3 AS INTEGER) AS period,
             CASE WHEN l_returnflag <> 'A' THEN l_extendedprice * 20 END AS cost,
             l_orderkey * 10 + l_linenumber AS seq
      FROM lineitem WHERE l_discount = 0.03 AND l_quantity > 40),
    automatic AS (
      SELECT entity_id, CAST(2000 AS INTEGER) AS period, max(cost) AS cost FROM outcomes
      WHERE period = 2000 AND cost IS NOT NULL GROUP BY entity_id),
    costs AS (
      SELECT entity_id, period, cost, rank = 1 AS is_manual FROM (
        SELECT entity_id, period, cost, 0 AS rank, 0 AS seq FROM automatic
        UNION ALL SELECT entity_id, period, cost, 1, seq FROM manual)
      QUALIFY row_number() OVER (PARTITION BY entity_id, period
        ORDER BY rank DESC, seq DESC, cost DESC NULLS LAST) = 1)"""


def all_costs(v: Views) -> DataFrame:
    manual = (
        v.table("lineitem")
        .filter("l_discount = 0.03 and l_quantity > 40")
        .select(
            F.col("l_partkey").alias("entity_id"),
            (2000 + F.col("l_linenumber") % 3).cast("int").alias("period"),
            F.when(F.col("l_returnflag") != "A", F.col("l_extendedprice") * 20).alias("cost"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        )
    )
    automatic = ft.cost_by_entity(v.outcomes(), LAST_FULL_PERIOD).withColumn(
        "period", F.lit(LAST_FULL_PERIOD)
    )
    return cost_precedence(automatic, manual)


@query("cost_precedence", f"WITH {COSTS_SQL} SELECT entity_id, period, cost, is_manual FROM costs")
def cost_precedence_query(v: Views) -> DataFrame:
    return all_costs(v)


SURPLUS_SQL = f"""{INPUTS_SQL}, {PATH_SQL}, {COSTS_SQL},
    surplus AS (
      SELECT entity_id, age, outcome_year1,
             round(sum(value * 8000000 / power(1.08, y) - coalesce(cost, 760000)), 2) AS surplus_value,
             bool_or(cost IS NULL) AS cost_estimated
      FROM (SELECT entity_id, age, outcome_year1, unnest([y0, y1, y2]) AS value,
                   unnest([0, 1, 2]) AS y FROM path) h
      LEFT JOIN (SELECT entity_id, period - 2000 AS y, cost FROM costs) c USING (entity_id, y)
      GROUP BY entity_id, age, outcome_year1)"""


def surplus_rows(v: Views) -> DataFrame:
    valued = with_surplus(valuation_rows(v), all_costs(v), LAST_FULL_PERIOD)
    return valued.select(
        "entity_id",
        "age",
        "outcome_year1",
        F.round("surplus_value", 2).alias("surplus_value"),
        "cost_estimated",
    )


@query("surplus_value", f"WITH {SURPLUS_SQL} SELECT * FROM surplus")
def surplus_value(v: Views) -> DataFrame:
    return surplus_rows(v)


@query(
    "top_surplus",
    f"WITH {SURPLUS_SQL} SELECT * FROM surplus ORDER BY surplus_value DESC, entity_id LIMIT 15",
)
def top_surplus(v: Views) -> DataFrame:
    return valuation.top_valued(surplus_rows(v))


# ---- pairs ----------------------------------------------------------------------

SET_SQL = "list_distinct(list_filter([primary_pos] || coalesce(string_split(other_pos, ','), []), lambda x: x IS NOT NULL AND x <> ''))"


@query(
    "eligible_set",
    f"SELECT entity_id, array_to_string(list_sort({SET_SQL}), '|') AS eligible FROM registry",
)
def eligible_set_query(v: Views) -> DataFrame:
    sets = eligible_set(F.col("primary_pos"), F.col("other_pos"))
    return v.registry().select("entity_id", F.array_join(F.array_sort(sets), "|").alias("eligible"))


def _pairs_sql(
    source: str, n: int, fit: bool = True, group: str | None = None, before: str = ""
) -> str:
    overlap = "AND list_has_any(l.elig, u.elig)" if fit else ""
    one_side = f"AND (l.group_code = '{group}') <> (u.group_code = '{group}')" if group else ""
    lower_is_a = f"l.group_code = '{group}'" if group else "l.entity_id < u.entity_id"

    def pick(column: str, side: str) -> str:
        first, second = ("l", "u") if side == "a" else ("u", "l")
        return f"CASE WHEN {lower_is_a} THEN {first}.{column} ELSE {second}.{column} END AS {column}_{side}"

    columns = ("entity_id", "group_code", "name", "primary_pos", "surplus_value")
    picked = ", ".join(pick(c, s) for s in "ab" for c in columns)
    return f"""WITH {before} rated AS (SELECT *, {SET_SQL} AS elig FROM {source})
    SELECT {picked}, u.surplus_value - l.surplus_value AS surplus_gap
    FROM rated l JOIN rated u ON (l.surplus_value, l.entity_id) < (u.surplus_value, u.entity_id)
    WHERE coalesce(l.group_code <> u.group_code, true) {overlap} {one_side}
    ORDER BY u.surplus_value - l.surplus_value, l.surplus_value DESC, l.entity_id DESC,
             u.surplus_value, u.entity_id
    LIMIT {n}"""


@query("fair_pairs", _pairs_sql("pair_values", 20))
def fair_pairs(v: Views) -> DataFrame:
    return closest_pairs(v.pair_values(), 20)


@query("fair_pairs_any_position", _pairs_sql("pair_values", 20, fit=False))
def fair_pairs_any_position(v: Views) -> DataFrame:
    return closest_pairs(v.pair_values(), 20, require_fit=False)


@query("fair_pairs_for_group", _pairs_sql("pair_values", 15, group="Brand#7"))
def fair_pairs_for_group(v: Views) -> DataFrame:
    return closest_pairs(v.pair_values(), 15, group="Brand#7")


@query("backtest_pairs", _pairs_sql("pit", 15, before=_as_of_cte("2024-01-10") + ","))
def backtest_pairs(v: Views) -> DataFrame:
    return closest_pairs(pit_values(v, "2024-01-10"), 15)


@query(
    "fact_median",
    """
    SELECT 'price' AS fact, role, round(median(outcome), 6) AS median FROM outcomes GROUP BY role
    UNION ALL SELECT 'cost', role, round(median(cost), 6) FROM outcomes WHERE cost IS NOT NULL GROUP BY role
    UNION ALL SELECT 'all costs', NULL, round(median(cost), 6) FROM outcomes""",
)
def fact_median(v: Views) -> DataFrame:
    """Medians over whole fact columns, which no task holds."""
    outcomes = v.outcomes()
    parts = [
        quantiles.exact_median(outcomes, "outcome", ["role"]).select(F.lit("price").alias("fact"), "role", "median"),
        quantiles.exact_median(outcomes, "cost", ["role"]).select(F.lit("cost").alias("fact"), "role", "median"),
        quantiles.exact_median(outcomes, "cost").select(F.lit("all costs").alias("fact"), F.lit(None).cast("string").alias("role"), "median"),
    ]
    return rounded(union_all(parts), 6, "median")
