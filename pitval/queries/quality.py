"""Queries over models, baselines and quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitval import constants as C
from pitval.operators import features as ft
from pitval.operators import metrics as mt
from pitval.operators import models as md
from pitval.operators import trees
from pitval.plans import evaluate as ev
from pitval.plans import forecast
from pitval.queries.catalogue import query, rounded
from pitval.queries.points import LAG1_SQL, TOTALS_SQL, lag1_prepared
from pitval.queries.views import MODEL_COLUMNS, MORE_COLUMNS, Views
from pitval.session import materialize

HOLDOUT = [2000, 2001]
BAT = [*MODEL_COLUMNS, C.PRIOR_FIELDING]
PITCH = MODEL_COLUMNS
ROLE_COLUMNS = {C.ROLE_BAT: BAT, C.ROLE_PITCH: PITCH}

SAME_SQL = (
    TOTALS_SQL
    + """,
    rows AS (
      SELECT entity_id, period, role, pa, h, hr, bb, obp, age, outcome
      FROM features JOIN totals USING (entity_id, period, role)),
    train AS (SELECT * FROM rows WHERE period NOT IN (2000, 2001)),
    test AS (SELECT * FROM rows WHERE period IN (2000, 2001)),
    means AS (SELECT role, avg(outcome) AS m FROM train GROUP BY role),
    last_seen AS (
      SELECT t.*, coalesce(p.outcome, 0) AS prior FROM test t
      LEFT JOIN totals p ON p.entity_id = t.entity_id AND p.role = t.role AND p.period = t.period - 1)
"""
)


def same_period_rows(v: Views) -> DataFrame:
    return ft.training_rows(v.features(), v.outcomes(), MODEL_COLUMNS)


def metric_columns(y: str, p: str) -> str:
    return f"""count(*) AS n, round(avg(abs({y} - {p})), 6) AS mae,
           round(sqrt(avg(({y} - {p}) * ({y} - {p}))), 6) AS rmse,
           round(1 - sum(({y} - {p}) * ({y} - {p})) / (var_pop({y}) * count({y})), 6) AS r2"""


@query(
    "naive_mean",
    SAME_SQL
    + """SELECT entity_id, period, t.role, round(m, 6) AS prediction
    FROM test t JOIN means USING (role)""",
)
def naive_mean(v: Views) -> DataFrame:
    parts = []
    both = materialize(same_period_rows(v), "rows")
    for role in (C.ROLE_BAT, C.ROLE_PITCH):
        rows = both.filter(F.col("role") == role)
        parts.append(ev.naive_mean(*ft.temporal_split(rows, "period", HOLDOUT)))
    return rounded(
        ev.union_all(parts).select("entity_id", "period", "role", "prediction"), 6, "prediction"
    )


@query(
    "naive_last_period",
    SAME_SQL + "SELECT entity_id, period, role, round(prior, 4) AS prediction FROM last_seen",
)
def naive_last_period(v: Views) -> DataFrame:
    parts = []
    both = materialize(same_period_rows(v), "rows")
    for role in (C.ROLE_BAT, C.ROLE_PITCH):
        rows = both.filter(F.col("role") == role)
        _, test = ft.temporal_split(rows, "period", HOLDOUT)
        parts.append(ev.naive_last_period(rows, test))
    return rounded(
        ev.union_all(parts).select("entity_id", "period", "role", "prediction"), 4, "prediction"
    )


@query(
    "regression_metrics",
    LAG1_SQL
    + f"SELECT role, {metric_columns('outcome', 'outcome_this_period')} FROM lag1 GROUP BY role",
)
def regression_metrics(v: Views) -> DataFrame:
    rows = ft.lag1_rows(v.features(), v.outcomes(), MODEL_COLUMNS)
    scores = mt.regression_metrics(rows, "outcome", "outcome_this_period", ["role"])
    return rounded(scores, 6, "mae", "rmse", "r2")


@query(
    "evaluate_baselines",
    SAME_SQL
    + f""",
    guesses AS (
      SELECT role || ': naive_mean' AS model, outcome AS y, m AS p FROM test JOIN means USING (role)
      UNION ALL SELECT role || ': naive_last', outcome, prior FROM last_seen)
    SELECT model, {metric_columns('y', 'p')} FROM guesses GROUP BY model""",
)
def evaluate_baselines(v: Views) -> DataFrame:
    rows = materialize(same_period_rows(v), "rows")
    scores = ev.union_all(
        [ev.evaluate_role(rows, role, [], HOLDOUT, fit=None) for role in (C.ROLE_BAT, C.ROLE_PITCH)]
    )
    return rounded(scores, 6, "mae", "rmse", "r2")


@query(
    "impute_scale",
    SAME_SQL
    + " UNION ALL ".join(
        f"""{'' if i else ''}SELECT '{c}' AS feature, round(avg({c}), 6) AS mean,
        round(sqrt(var_pop({c}) * count({c}) / count(*)), 6) AS std FROM train"""
        for i, c in enumerate(("pa", "h", "hr", "bb", "obp", "age"))
    ),
)
def impute_scale(v: Views) -> DataFrame:
    train, _ = ft.temporal_split(same_period_rows(v), "period", HOLDOUT)
    return rounded(md.impute_scale_statistics(train, MODEL_COLUMNS), 6, "mean", "std")


@query(
    "ridge_2f",
    SAME_SQL
    + """,
    fill AS (SELECT avg(pa) AS mx, avg(h) AS mz, avg(outcome) AS my FROM train),
    filled AS (
      SELECT coalesce(pa, mx) - mx AS x, coalesce(h, mz) - mz AS z, outcome - my AS y FROM train, fill),
    spread AS (SELECT stddev_pop(x) AS sx, stddev_pop(z) AS sz FROM filled),
    gram AS (
      SELECT sum(x * x) / (sx * sx) + 1 AS xx, sum(z * z) / (sz * sz) + 1 AS zz,
             sum(x * z) / (sx * sz) AS xz, sum(x * y) / sx AS xy, sum(z * y) / sz AS zy, sx, sz
      FROM filled, spread GROUP BY sx, sz),
    solved AS (
      SELECT (xy * zz - zy * xz) / (xx * zz - xz * xz) / sx AS bx,
             (zy * xx - xy * xz) / (xx * zz - xz * xz) / sz AS bz FROM gram)
    SELECT entity_id, period, role,
           round(my + bx * (coalesce(pa, mx) - mx) + bz * (coalesce(h, mz) - mz), 6) AS prediction
    FROM test, fill, solved""",
)
def ridge_2f(v: Views) -> DataFrame:
    """Ridge on two features, checked against its closed form."""
    train, test = ft.temporal_split(same_period_rows(v), "period", HOLDOUT)
    made = md.fit_predict(materialize(train, "train"), test, ["pa", "h"], md.fit_ridge)
    return rounded(made.select("entity_id", "period", "role", "prediction"), 6, "prediction")


# ---- fitted models; trees and cross-validation have no SQL form ---------------------


def prepared(v: Views) -> DataFrame:
    """Lag-1 rows with the fielding feature, written once for repeated fits."""
    return materialize(lag1_prepared(v), "prepared")


def _predicted(v: Views, fit: md.Fit) -> DataFrame:
    """Held-out predictions of both roles."""
    train, test = ft.temporal_split(prepared(v), "target_period", HOLDOUT)
    fitted = md.fit_models(train, {role: (columns, fit) for role, columns in ROLE_COLUMNS.items()})
    parts = [
        fitted[role].predict(test.filter(F.col("role") == role)).select("entity_id", "period", "role", "prediction")
        for role in ROLE_COLUMNS
    ]
    return rounded(ev.union_all(parts), 6, "prediction")


def ridge_sql(name: str, train: str, columns: list[str], alpha: float = C.RIDGE_ALPHA) -> str:
    """CTEs that solve a ridge regression on ``train``: the normal equations of imputed,
    standardized features, eliminated column by column. ``{name}_fit`` has one row: means
    ``centre``, deviations ``spread``, weights ``weight`` of the standardized features, and ``mean_outcome``."""
    k = len(columns)
    means = ", ".join(f"avg({c})" for c in columns)
    centred = ", ".join(f"coalesce({c}, centre[{i}]) - centre[{i}]" for i, c in enumerate(columns, 1))
    spread = ", ".join(f"stddev_pop(z[{i}])" for i in range(1, k + 1))
    lines = []
    for i in range(1, k + 1):
        cells = [f"sum(z[{i}] * z[{j}] / spread[{i}] / spread[{j}])" + (f" + {alpha}" if i == j else "") for j in range(1, k + 1)]
        lines.append(f"[{', '.join([*cells, f'sum(z[{i}] * d / spread[{i}])'])}]")
    at = "p[1][1]::INTEGER"
    return f"""{name}_mean AS (SELECT [{means}] AS centre, avg(outcome) AS mean_outcome FROM {train}),
    {name}_row AS (SELECT [{centred}] AS z, outcome - mean_outcome AS d FROM {train}, {name}_mean),
    {name}_spread AS (SELECT [{spread}] AS spread FROM {name}_row),
    {name}_system AS (SELECT [{', '.join(lines)}] AS a FROM {name}_row, {name}_spread),
    {name}_fit AS (
      SELECT centre, spread, mean_outcome, list_transform(
        list_reduce(list_transform(range(1, {k + 1}), lambda i: [[i::DOUBLE]]),
          lambda q, p: list_transform(q, lambda r, i: CASE WHEN i = {at}
            THEN list_transform(r, lambda x: x / r[i])
            ELSE list_transform(r, lambda x, j: x - r[{at}] * q[{at}][j] / q[{at}][{at}]) END),
          a), lambda r: r[{k + 1}]) AS weight
      FROM {name}_system, {name}_mean, {name}_spread)"""


def ridge_value(columns: list[str]) -> str:
    """The prediction of a row next to ``{name}_fit``."""
    return "mean_outcome + " + " + ".join(f"weight[{i}] * (coalesce({c}, centre[{i}]) - centre[{i}]) / spread[{i}]" for i, c in enumerate(columns, 1))


PREPARED_SQL = (
    LAG1_SQL
    + """,
    prepared AS (
      SELECT l.*, CASE WHEN l.role = 'bat' THEN r.def_runs END AS prior_def_runs
      FROM lag1 l ASOF LEFT JOIN hist r ON l.entity_id = r.entity_id AND l.target_period > r.period)"""
)


def side_sql(source: str, period: str) -> str:
    """CTEs of the training and the held-out rows of either role."""
    return ", ".join(
        f"{role}_{side} AS (SELECT * FROM {source} WHERE role = '{role}' AND {period} {test} (2000, 2001))"
        for role in ROLE_COLUMNS
        for side, test in (("train", "NOT IN"), ("test", "IN"))
    )


@query(
    "ridge_by_role",
    SAME_SQL
    + f""",
    joined AS (
      SELECT r.*, CASE WHEN r.role = 'bat' THEN h.def_runs END AS prior_def_runs
      FROM rows r ASOF LEFT JOIN hist h ON r.entity_id = h.entity_id AND r.period > h.period),
    {side_sql('joined', 'period')},
    {', '.join(ridge_sql(role, f'{role}_train', columns) for role, columns in ROLE_COLUMNS.items())}
    """
    + " UNION ALL ".join(
        f"SELECT entity_id, period, role, round({ridge_value(columns)}, 6) AS projected_outcome FROM {role}_test, {role}_fit"
        for role, columns in ROLE_COLUMNS.items()
    ),
)
def ridge_by_role(v: Views) -> DataFrame:
    outcomes = v.outcomes()
    rows = ft.training_rows(v.features(), outcomes, MODEL_COLUMNS)
    train, test = ft.temporal_split(rows, "period", HOLDOUT)
    made = forecast.train_and_predict(
        train,
        test.drop("outcome"),
        ft.fielding_history(outcomes),
        {C.ROLE_BAT: (BAT, md.fit_ridge), C.ROLE_PITCH: (PITCH, md.fit_ridge)},
    )
    return rounded(
        made.select("entity_id", "period", "role", "projected_outcome"), 6, "projected_outcome"
    )


def binned_sql(train: str, test: str, role_columns: dict[str, list[str]], bins: int) -> str:
    """CTEs that cut the features at quantiles of ``train``: ``boost_bins`` has a row's numbers of bins,
    its label as a whole number and its place in its role, ``boost_base`` the mean label of a role."""

    def per_role(make) -> str:
        return "CASE role " + " ".join(f"WHEN '{role}' THEN {make(columns)}" for role, columns in role_columns.items()) + " END"

    listed = per_role(lambda columns: "[" + ", ".join(f"{c}::DOUBLE" for c in columns) + "]")
    means = per_role(lambda columns: "[" + ", ".join(f"avg({c})" for c in columns) + "]")

    return f"""boost_means AS (SELECT role, {means} AS m FROM {train} WHERE outcome IS NOT NULL GROUP BY role),
    boost_rows AS (
      SELECT row_number() OVER (ORDER BY NOT train, role, entity_id, period) AS id, role, train, outcome, entity_id, period,
             list_transform(x, lambda v, i: coalesce(v, m[i])) AS x
      FROM (SELECT true AS train, role, outcome, entity_id, period, {listed} AS x FROM {train} WHERE outcome IS NOT NULL
            UNION ALL SELECT false, role, NULL, entity_id, period, {listed} FROM {test}) JOIN boost_means USING (role)),
    boost_values AS (
      SELECT role, f, list(v ORDER BY v) AS ordered FROM (
        SELECT role, unnest(range(1, len(x) + 1)) AS f, unnest(x) AS v FROM boost_rows WHERE train) GROUP BY role, f),
    boost_cuts AS (
      SELECT role, list(list_sort(list_distinct(list_transform(range(1, {bins}), lambda j: ordered[(j * len(ordered) + {bins - 1}) // {bins}]))) ORDER BY f) AS cuts
      FROM boost_values GROUP BY role),
    boost_scale AS (SELECT role, power(2.0, 28 - ceil(log2(max(abs(outcome))))) AS scale FROM boost_rows WHERE train GROUP BY role),
    boost_bins AS MATERIALIZED (
      SELECT id, role, train, entity_id, period, CAST(floor(outcome * scale + 0.5) AS BIGINT) AS y,
             list_transform(x, lambda v, i: len(list_filter(cuts[i], lambda c: c < v))) AS bins
      FROM boost_rows JOIN boost_cuts USING (role) JOIN boost_scale USING (role)),
    boost_base AS MATERIALIZED (
      SELECT role, scale, CAST(floor(sum(y)::DOUBLE / count(*) + 0.5) AS BIGINT) AS base FROM boost_bins JOIN boost_scale USING (role) WHERE train GROUP BY role, scale)"""


def boosted_sql(train: str, test: str, role_columns: dict[str, list[str]], settings: dict = C.BOOSTED_TREES) -> str:
    """CTEs, the whole of boosting with one tree a step: ``boosted`` has every row of ``test`` (role,
    features, ...) with ``boosted`` predicted. The WITH must be recursive."""
    bins, penalty, rate, depth = (settings[k] for k in ("bins", "penalty", "rate", "depth"))

    def level(k: int) -> str:
        # A node that can't be split any further goes on as its negative.
        return f"""cell{k} AS (
        SELECT role, node, f, bin, sum(g) AS g, count(*) AS n
        FROM (SELECT role, node, g, unnest(range(1, len(bins) + 1)) AS f, unnest(bins) AS bin FROM level{k} WHERE train AND node > 0)
        GROUP BY role, node, f, bin),
      side{k} AS (
        SELECT role, node, f, bin, sum(g) OVER upto AS lg, sum(n) OVER upto AS ln, sum(g) OVER every AS wg, sum(n) OVER every AS wn
        FROM cell{k} WINDOW upto AS (PARTITION BY role, node, f ORDER BY bin), every AS (PARTITION BY role, node, f)),
      gain{k} AS (
        SELECT role, node, f, bin, wg::DOUBLE * wg::DOUBLE / (wn + {penalty}::DOUBLE) AS whole,
          lg::DOUBLE * lg::DOUBLE / (ln + {penalty}::DOUBLE) + (wg - lg)::DOUBLE * (wg - lg)::DOUBLE / ((wn - ln) + {penalty}::DOUBLE) AS score
        FROM side{k} WHERE wn > ln),
      split{k} AS (
        SELECT role, node, f, bin FROM gain{k} JOIN boost_base USING (role) WHERE score - whole > 0.000001::DOUBLE * scale * scale
        QUALIFY row_number() OVER (PARTITION BY role, node ORDER BY score DESC, f, bin) = 1),
      level{k + 1} AS (
        SELECT l.id, l.role, l.train, l.bins, l.margin, l.g,
               CASE WHEN l.node < 0 THEN l.node WHEN s.f IS NULL THEN -l.node WHEN l.bins[s.f] <= s.bin THEN 2 * l.node ELSE 2 * l.node + 1 END AS node
        FROM level{k} l LEFT JOIN split{k} s USING (role, node))"""

    return f"""{binned_sql(train, test, role_columns, bins)},
    boost(step, id, margin) AS (
      SELECT 0, id, base FROM boost_bins JOIN boost_base USING (role)
      UNION ALL
      (WITH level0 AS (
        SELECT id, role, train, bins, margin, margin - y AS g, 1 AS node FROM boost JOIN boost_bins USING (id) WHERE step < {settings['trees']}),
      {', '.join(level(k) for k in range(depth))},
      leaf AS (
        SELECT role, node, CAST(floor(-sum(g)::DOUBLE / (count(*) + {penalty}::DOUBLE) * {rate}::DOUBLE + 0.5) AS BIGINT) AS leaf
        FROM level{depth} WHERE train GROUP BY role, node)
      SELECT (SELECT max(step) + 1 FROM boost), id, margin + leaf FROM level{depth} JOIN leaf USING (role, node))),
    boosted AS (
      SELECT entity_id, period, role, margin / scale AS boosted
      FROM boost JOIN boost_bins USING (id) JOIN boost_base USING (role) WHERE step = {settings['trees']} AND NOT train)"""


BOOSTED_SQL = f"""{PREPARED_SQL},
    held_train AS (SELECT * FROM prepared WHERE target_period NOT IN (2000, 2001)),
    held_test AS (SELECT * FROM prepared WHERE target_period IN (2000, 2001)),
    {boosted_sql('held_train', 'held_test', ROLE_COLUMNS)}"""


@query("gbt_predict", f"{BOOSTED_SQL} SELECT entity_id, period, role, round(boosted, 6) AS prediction FROM boosted")
def gbt_predict(v: Views) -> DataFrame:
    return _predicted(v, md.fit_boosted_trees)


def forest_sql(train: str, test: str, role_columns: dict[str, list[str]], settings: dict = C.FOREST, binned: bool = True) -> str:
    """CTEs, all trees a level at a time: ``forest`` has every row of ``test`` with ``forest`` predicted.
    Without ``binned`` those of ``binned_sql`` must be there already, with as many bins."""
    bins, depth, count = (settings[k] for k in ("bins", "depth", "trees"))
    prime = 2**31 - 1
    steps = " + ".join(f"CASE WHEN u >= {limit} THEN 1 ELSE 0 END" for limit in trees.DRAWS)

    def level(k: int) -> str:
        return f"""wood_cell{k} AS (
      SELECT role, t, node, f, bin, sum(w * g) AS g, sum(w) AS n
      FROM (SELECT l.role, t, node, w, y - base AS g, unnest(range(1, len(bins) + 1)) AS f, unnest(bins) AS bin
            FROM wood{k} l JOIN boost_bins USING (id) JOIN boost_base b ON b.role = l.role WHERE train AND node > 0)
      GROUP BY role, t, node, f, bin),
    wood_side{k} AS (
      SELECT role, t, node, f, bin, sum(g) OVER upto AS lg, sum(n) OVER upto AS ln, sum(g) OVER every AS wg, sum(n) OVER every AS wn
      FROM wood_cell{k} WINDOW upto AS (PARTITION BY role, t, node, f ORDER BY bin), every AS (PARTITION BY role, t, node, f)),
    wood_gain{k} AS (
      SELECT role, t, node, f, bin, wg::DOUBLE * wg::DOUBLE / wn AS whole,
        lg::DOUBLE * lg::DOUBLE / ln + (wg - lg)::DOUBLE * (wg - lg)::DOUBLE / (wn - ln) AS score
      FROM wood_side{k} WHERE wn > ln),
    wood_split{k} AS (
      SELECT role, t, node, f, bin FROM wood_gain{k} JOIN boost_base USING (role) WHERE score - whole > 0.000001::DOUBLE * scale * scale
      QUALIFY row_number() OVER (PARTITION BY role, t, node ORDER BY score DESC, f, bin) = 1),
    wood{k + 1} AS MATERIALIZED (
      SELECT id, l.role, l.t, w, CASE WHEN l.node < 0 THEN l.node WHEN s.f IS NULL THEN -l.node WHEN bins[s.f] <= s.bin THEN 2 * l.node ELSE 2 * l.node + 1 END AS node
      FROM wood{k} l JOIN boost_bins USING (id) LEFT JOIN wood_split{k} s ON s.role = l.role AND s.t = l.t AND s.node = l.node)"""

    before = f"{binned_sql(train, test, role_columns, bins)}," if binned else ""
    return f"""{before}
    wood_drawn AS (
      SELECT id, role, t, train, place, (x2 * 48271) % {prime} AS u FROM (
        SELECT *, (x1 * x1) % {prime} AS x2 FROM (
          SELECT *, ((x0 * x0) % {prime} + place + 7 * t + 1) % {prime} AS x1 FROM (
            SELECT id, role, train, t, (id - 1)::BIGINT AS place, (id * 40692::BIGINT + (t + 1) * 69621::BIGINT) % {prime} AS x0
            FROM boost_bins, (SELECT unnest(range({count})) AS t))))),
    wood0 AS MATERIALIZED (
      SELECT id, role, t, CASE WHEN train THEN {steps} ELSE 0 END AS w, 1 AS node FROM wood_drawn WHERE NOT train OR u >= {trees.DRAWS[0]}),
    {', '.join(level(k) for k in range(depth))},
    wood_leaf AS (
      SELECT l.role, t, node, CAST(any_value(base) + floor(sum(w * (y - base))::DOUBLE / sum(w) + 0.5) AS BIGINT) AS leaf
      FROM wood{depth} l JOIN boost_bins USING (id) JOIN boost_base b ON b.role = l.role WHERE train GROUP BY l.role, t, node),
    forest AS (
      SELECT entity_id, period, l.role, sum(leaf)::DOUBLE / ({count} * any_value(scale)) AS forest
      FROM wood{depth} l JOIN boost_bins USING (id) JOIN wood_leaf f ON f.role = l.role AND f.t = l.t AND f.node = l.node
      JOIN boost_base b ON b.role = l.role WHERE NOT train GROUP BY id, entity_id, period, l.role)"""


FOREST_SQL = f"""{PREPARED_SQL},
    held_train AS (SELECT * FROM prepared WHERE target_period NOT IN (2000, 2001)),
    held_test AS (SELECT * FROM prepared WHERE target_period IN (2000, 2001)),
    {forest_sql('held_train', 'held_test', ROLE_COLUMNS)}"""


@query("rf_predict", f"{FOREST_SQL} SELECT entity_id, period, role, round(forest, 6) AS prediction FROM forest")
def rf_predict(v: Views) -> DataFrame:
    return _predicted(v, md.fit_forest)


def elastic_sql(train: str, test: str, role_columns: dict[str, list[str]], folds: int = C.ELASTIC_FOLDS, strengths: int = C.ELASTIC_STRENGTHS, mix: float = C.ELASTIC_MIX) -> str:
    """CTEs, cross-validated elastic nets by coordinate descent, a cycle a step for all folds and
    roles at once: ``elastic`` has every row of ``test`` with ``elastic`` predicted. The WITH must be recursive."""

    def per_role(make) -> str:
        return "CASE role " + " ".join(f"WHEN '{role}' THEN {make(columns)}" for role, columns in role_columns.items()) + " END"

    listed = per_role(lambda columns: "[" + ", ".join(f"{c}::DOUBLE" for c in columns) + "]")
    means = per_role(lambda columns: "[" + ", ".join(f"avg({c})" for c in columns) + "]")
    spreads = per_role(lambda columns: "[" + ", ".join(f"stddev_pop(f[{i}])" for i in range(1, len(columns) + 1)) + "]")
    pull = "t[j[1]::INTEGER] - list_dot_product(g[j[1]::INTEGER], q) + g[j[1]::INTEGER][j[1]::INTEGER] * q[j[1]::INTEGER]"
    curve = "g[j[1]::INTEGER][j[1]::INTEGER]"
    cell = f"""CASE WHEN i <> j[1] OR {curve} <= 0 THEN v
        ELSE sign({pull}) * greatest(abs({pull}) - strength * {mix}, 0) / ({curve} + strength * (1 - {mix})) END"""
    return f"""net_mean AS (SELECT role, {means} AS m, avg(outcome) AS my FROM {train} GROUP BY role),
    net_filled AS (
      SELECT role, outcome - my AS y, m, my, list_transform({listed}, lambda v, i: coalesce(v, m[i])) AS f,
             row_number() OVER (PARTITION BY role ORDER BY entity_id, period) - 1 AS place, count(*) OVER (PARTITION BY role) AS n
      FROM {train} JOIN net_mean USING (role)),
    net_scale AS (SELECT role, m, my, list_transform({spreads}, lambda v: CASE WHEN v = 0 THEN 1 ELSE v END) AS s FROM net_filled GROUP BY role, m, my),
    net_rows AS (
      SELECT role, list_append(list_transform(f, lambda v, i: (v - f1.m[i]) / s[i]), y) AS z,
             CASE WHEN place < (n % {folds}) * (n // {folds} + 1) THEN place // (n // {folds} + 1)
                  ELSE n % {folds} + (place - (n % {folds}) * (n // {folds} + 1)) // (n // {folds}) END AS fold
      FROM net_filled f1 JOIN net_scale USING (role)),
    net_cells AS (
      SELECT role, fold, i, j, sum(z[i] * z[j]) AS p, sum(z[i]) AS a, count(*) AS n
      FROM (SELECT role, fold, z, i, unnest(range(1, len(z) + 1)) AS j FROM (SELECT role, fold, z, unnest(range(1, len(z) + 1)) AS i FROM net_rows))
      GROUP BY role, fold, i, j),
    net_part AS (  -- held: the fold left out of it, -1 for none; own: the held fold itself
      SELECT role, held, own, i, j, sum(p) AS p, sum(a) AS a, sum(n) AS n
      FROM net_cells, (SELECT unnest(range(-1, {folds})) AS held), (VALUES (true), (false)) AS o(own)
      WHERE CASE WHEN own THEN fold = held ELSE fold <> held END GROUP BY role, held, own, i, j),
    net_line AS (
      SELECT role, held, own, i, any_value(a) AS a, any_value(n) AS n, list(p ORDER BY j) AS p FROM net_part GROUP BY role, held, own, i),
    net_moment AS MATERIALIZED (
      SELECT role, held, own, any_value(n) AS n, list(a ORDER BY i) AS a, list(p ORDER BY i) AS p, count(*) - 1 AS k FROM net_line GROUP BY role, held, own),
    net_problem AS MATERIALIZED (
      SELECT role, held, k, list_transform(a, lambda v: v / n) AS mean,
             list_transform(range(1, k + 1), lambda i: list_transform(range(1, k + 1), lambda j: p[i][j] / n - a[i] / n * (a[j] / n))) AS g,
             list_transform(range(1, k + 1), lambda i: p[i][k + 1] / n - a[i] / n * (a[k + 1] / n)) AS t
      FROM net_moment WHERE NOT own),
    net_top AS (SELECT role, greatest(list_max(list_transform(t, lambda v: abs(v))), 1e-9) / {mix} AS top FROM net_problem WHERE held = -1),
    net(role, held, stage, w, cycles, solved) AS (
      SELECT role, held, 0, list_transform(range(k), lambda i: 0.0::DOUBLE), 0, -1 FROM net_problem
      UNION ALL
      SELECT role, held, CASE WHEN ended THEN stage + 1 ELSE stage END, next, CASE WHEN ended THEN 0 ELSE cycles + 1 END, CASE WHEN ended THEN stage ELSE -1 END
      FROM (
        SELECT *, list_max(list_transform(next, lambda v, i: abs(v - w[i]))) <= {md.SOLVED} * greatest(1, list_max(list_transform(next, lambda v: abs(v)))) OR cycles >= 999 AS ended
        FROM (
          SELECT role, held, stage, w, cycles,
                 list_reduce(list_transform(range(1, k + 1), lambda i: [i::DOUBLE]), lambda q, j: list_transform(q, lambda v, i: {cell}), w) AS next
          FROM (SELECT *, top * power(10.0, -3.0 * stage / {strengths - 1}) AS strength FROM net JOIN net_problem USING (role, held) JOIN net_top USING (role) WHERE stage < {strengths})))),
    net_solved AS (SELECT role, held, solved, w, mean[k + 1] - list_dot_product(mean[1:k], w) AS base, k FROM net JOIN net_problem USING (role, held) WHERE solved >= 0),
    net_error AS (
      SELECT role, solved, sum((list_dot_product(v, list_transform(p, lambda r: list_dot_product(r, v))) - 2 * base * list_dot_product(v, a) + n * base * base) / n) AS error
      FROM (SELECT s.*, list_append(list_transform(w, lambda x: -x), 1.0::DOUBLE) AS v, a, p, n FROM net_solved s JOIN net_moment m ON m.role = s.role AND m.held = s.held AND m.own)
      GROUP BY role, solved),
    net_best AS (SELECT role, solved FROM net_error QUALIFY row_number() OVER (PARTITION BY role ORDER BY error, solved) = 1),
    elastic AS (
      SELECT entity_id, period, role, my + base + list_sum(list_transform({listed}, lambda v, i: w[i] / s[i] * (coalesce(v, m[i]) - m[i]))) AS elastic
      FROM {test} JOIN net_scale USING (role) JOIN net_solved USING (role) JOIN net_best USING (role, solved) WHERE held = -1)"""


ELASTIC_SQL = f"""{PREPARED_SQL},
    held_train AS (SELECT * FROM prepared WHERE target_period NOT IN (2000, 2001)),
    held_test AS (SELECT * FROM prepared WHERE target_period IN (2000, 2001)),
    {elastic_sql('held_train', 'held_test', ROLE_COLUMNS)}"""


@query("elasticnet_cv", f"{ELASTIC_SQL} SELECT entity_id, period, role, round(elastic, 6) AS prediction FROM elastic")
def elasticnet_cv(v: Views) -> DataFrame:
    return _predicted(v, md.fit_elastic_net)


@query(
    "model_blend",
    f"""{BOOSTED_SQL}, {side_sql('prepared', 'target_period')},
    {', '.join(ridge_sql(role, f'{role}_train', columns) for role, columns in ROLE_COLUMNS.items())},
    linear AS ({' UNION ALL '.join(
        f"SELECT entity_id, period, role, {ridge_value(columns)} AS linear FROM {role}_test, {role}_fit" for role, columns in ROLE_COLUMNS.items()
    )})
    SELECT entity_id, period, role, round((linear + boosted) / 2, 6) AS prediction FROM linear JOIN boosted USING (entity_id, period, role)""",
)
def model_blend(v: Views) -> DataFrame:
    return _predicted(v, md.fit_blend)


@query(
    "evaluate_models",
    PREPARED_SQL
    + f""",
    {side_sql('prepared', 'target_period')},
    {', '.join(ridge_sql(role, f'{role}_train', columns) for role, columns in ROLE_COLUMNS.items())},
    guesses AS ("""
    + " UNION ALL ".join(
        f"""SELECT '{role}: naive_mean' AS model, outcome AS actual, mean_outcome AS predicted FROM {role}_test, {role}_fit
      UNION ALL SELECT '{role}: naive_last', outcome, outcome_this_period FROM {role}_test
      UNION ALL SELECT '{role}: model', outcome, {ridge_value(columns)} FROM {role}_test, {role}_fit"""
        for role, columns in ROLE_COLUMNS.items()
    )
    + f") SELECT model, {metric_columns('actual', 'predicted')} FROM guesses GROUP BY model",
)
def evaluate_models(v: Views) -> DataFrame:
    rows = prepared(v)
    scores = ev.union_all(
        [
            ev.evaluate_role(rows, role, columns, HOLDOUT, "target_period")
            for role, columns in ((C.ROLE_BAT, BAT), (C.ROLE_PITCH, PITCH))
        ]
    )
    return rounded(scores, 6, "mae", "rmse", "r2")


def feature_sets(columns: list[str]) -> dict[str, list[str]]:
    """All columns, and all but one."""
    return {"all": columns} | {f"without {c}": [x for x in columns if x != c] for c in columns}


SETS = [
    (role, name, f"{role}_{number}", chosen)
    for role, columns in ROLE_COLUMNS.items()
    for number, (name, chosen) in enumerate(feature_sets(columns).items())
]


@query(
    "feature_ablation",
    PREPARED_SQL
    + f""",
    {side_sql('prepared', 'target_period')},
    {', '.join(ridge_sql(key, f'{role}_train', chosen) for role, _, key, chosen in SETS)},
    guesses AS ("""
    + " UNION ALL ".join(
        f"SELECT '{role}' AS role, '{name}' AS model, outcome AS actual, {ridge_value(chosen)} AS predicted FROM {role}_test, {key}_fit"
        for role, name, key, chosen in SETS
    )
    + f") SELECT role, model, {metric_columns('actual', 'predicted')} FROM guesses GROUP BY role, model",
)
def feature_ablation(v: Views) -> DataFrame:
    sets = {role: feature_sets(columns) for role, columns in ROLE_COLUMNS.items()}
    return rounded(ev.ablate_by_role(prepared(v), sets, HOLDOUT, "target_period"), 6, "mae", "rmse", "r2")


COMPARED_SQL = f"""{BOOSTED_SQL},
    {forest_sql('held_train', 'held_test', ROLE_COLUMNS, binned=False)},
    {elastic_sql('held_train', 'held_test', ROLE_COLUMNS)},
    {side_sql('prepared', 'target_period')},
    {', '.join(ridge_sql(role, f'{role}_train', columns) for role, columns in ROLE_COLUMNS.items())},
    linear AS ({' UNION ALL '.join(
        f"SELECT entity_id, period, role, {ridge_value(columns)} AS linear FROM {role}_test, {role}_fit" for role, columns in ROLE_COLUMNS.items()
    )}),
    every AS (
      SELECT * FROM held_test JOIN linear USING (entity_id, period, role) JOIN boosted USING (entity_id, period, role)
      JOIN forest USING (entity_id, period, role) JOIN elastic USING (entity_id, period, role)),
    guesses AS ({' UNION ALL '.join(
        f"SELECT role, '{name}' AS model, outcome AS actual, {value} AS predicted FROM every"
        for name, value in (("ridge", "linear"), ("elastic_net", "elastic"), ("forest", "forest"), ("boosted", "boosted"), ("blend", "(linear + boosted) / 2"))
    )})"""


@query("model_comparison", f"{COMPARED_SQL} SELECT role, model, {metric_columns('actual', 'predicted')} FROM guesses GROUP BY role, model")
def model_comparison(v: Views) -> DataFrame:
    return rounded(ev.compare_models_by_role(prepared(v), ROLE_COLUMNS, None, HOLDOUT, "target_period"), 6, "mae", "rmse", "r2")


# ---- reports on the full feature sets ---------------------------------------------

FULL_COLUMNS = [*dict.fromkeys([*MODEL_COLUMNS, "ip", *MORE_COLUMNS])]
FULL_SQL = (
    LAG1_SQL
    + """,
    full_rows AS (
      SELECT f.*, outcome_this_period, outcome, target_period,
             CASE WHEN f.ip <> 0 THEN 9 * f.bb / f.ip END AS bb9, CASE WHEN f.ip <> 0 THEN 9 * f.hr / f.ip END AS hr9
      FROM features f JOIN lag1 USING (entity_id, period, role)),
    full_prepared AS (
      SELECT l.*, CASE WHEN l.role = 'bat' THEN r.def_runs END AS prior_def_runs
      FROM full_rows l ASOF LEFT JOIN hist r ON l.entity_id = r.entity_id AND l.target_period > r.period)"""
)


def full_prepared(v: Views) -> DataFrame:
    outcomes = v.outcomes()
    return materialize(
        ft.with_prior_fielding(
            ft.lag1_rows(v.features(), outcomes, FULL_COLUMNS), ft.fielding_history(outcomes), "target_period"
        ),
        "full-prepared",
    )


def sets_sql(role: str, sets: dict[str, list[str]]) -> str:
    """Scores of a ridge regression on each set of features."""
    fits = ", ".join(ridge_sql(f"set{i}", f"{role}_train", columns) for i, columns in enumerate(sets.values()))
    guesses = " UNION ALL ".join(
        f"SELECT '{name}' AS model, outcome AS actual, {ridge_value(columns)} AS predicted FROM {role}_test, set{i}_fit"
        for i, (name, columns) in enumerate(sets.items())
    )
    return f"""{FULL_SQL}, {side_sql('full_prepared', 'target_period')}, {fits}, guesses AS ({guesses})
    SELECT model, {metric_columns('actual', 'predicted')} FROM guesses GROUP BY model"""


@query(
    "fielding_ablation",
    sets_sql(
        C.ROLE_BAT,
        {
            "without prior_def_runs": [c for c in C.BAT_FEATURES if c != C.PRIOR_FIELDING],
            "with prior_def_runs": C.BAT_FEATURES,
        },
    ),
)
def fielding_ablation(v: Views) -> DataFrame:
    scores = ev.fielding_ablation(full_prepared(v), holdout=HOLDOUT, period="target_period")
    return rounded(scores, 6, "mae", "rmse", "r2")


@query(
    "extra_features_ablation",
    sets_sql(
        C.ROLE_BAT,
        {
            "without extra": [c for c in C.BAT_FEATURES if c not in C.EXTRA_BAT_FEATURES],
            "with extra": C.BAT_FEATURES,
        },
    ),
)
def extra_features_ablation(v: Views) -> DataFrame:
    scores = ev.extra_features_ablation(full_prepared(v), holdout=HOLDOUT, period="target_period")
    return rounded(scores, 6, "mae", "rmse", "r2")


@query("pitch_feature_swap", sets_sql(C.ROLE_PITCH, {"current": C.PITCH_FEATURES, "skill": C.SKILL_PITCH_FEATURES}))
def pitch_feature_swap(v: Views) -> DataFrame:
    scores = ev.pitch_feature_swap(full_prepared(v), holdout=HOLDOUT, period="target_period")
    return rounded(scores, 6, "mae", "rmse", "r2")


@query(
    "evaluate_same_period",
    SAME_SQL
    + f""",
    joined AS (
      SELECT r.*, CASE WHEN r.role = 'bat' THEN h.def_runs END AS prior_def_runs
      FROM rows r ASOF LEFT JOIN hist h ON r.entity_id = h.entity_id AND r.period > h.period),
    {side_sql('joined', 'period')},
    {', '.join(ridge_sql(role, f'{role}_train', columns) for role, columns in ROLE_COLUMNS.items())},
    guesses AS ("""
    + " UNION ALL ".join(
        f"""SELECT '{role}: naive_mean' AS model, outcome AS actual, mean_outcome AS predicted FROM {role}_test, {role}_fit
      UNION ALL SELECT '{role}: naive_last', outcome, prior FROM last_seen WHERE role = '{role}'
      UNION ALL SELECT '{role}: model', outcome, {ridge_value(columns)} FROM {role}_test, {role}_fit"""
        for role, columns in ROLE_COLUMNS.items()
    )
    + f") SELECT model, {metric_columns('actual', 'predicted')} FROM guesses GROUP BY model",
)
def evaluate_same_period(v: Views) -> DataFrame:
    """Model and baselines on features and outcomes of one period."""
    rows = materialize(
        ft.with_prior_fielding(same_period_rows(v), ft.fielding_history(v.outcomes())), "same-period"
    )
    scores = ev.union_all(
        [ev.evaluate_role(rows, role, columns, HOLDOUT) for role, columns in ROLE_COLUMNS.items()]
    )
    return rounded(scores, 6, "mae", "rmse", "r2")


# ---- value and pair quality ------------------------------------------------------

FRAME_SQL = (
    LAG1_SQL
    + """,
    period_costs AS (
      SELECT entity_id, period, max(cost) AS cost FROM outcomes WHERE cost IS NOT NULL GROUP BY ALL),
    dims AS (
      SELECT entity_id, first_name || ' ' || last_name AS name, g AS group_code
      FROM (SELECT entity_id, min(group_code) AS g FROM features WHERE period = 2000 GROUP BY 1)
      JOIN registry USING (entity_id)),
    aged AS (
      SELECT *, age + 1 AS a,
        outcome_this_period AS y0,
        outcome_this_period * (1 - CASE WHEN age + 2 <= 27 THEN 0.0 ELSE least(0.03 * (age + 2 - 27) - 0.02, 0.40) END) AS y1
      FROM lag1 WHERE target_period = 2000),
    pathed AS (
      SELECT *, y1 * (1 - CASE WHEN age + 3 <= 27 THEN 0.0 ELSE least(0.03 * (age + 3 - 27) - 0.02, 0.40) END) AS y2
      FROM aged),
    priced AS (
      SELECT p.*, coalesce(c0.cost, 760000) AS c0, coalesce(c1.cost, 760000) AS c1, coalesce(c2.cost, 760000) AS c2
      FROM pathed p
      LEFT JOIN period_costs c0 ON c0.entity_id = p.entity_id AND c0.period = 2000
      LEFT JOIN period_costs c1 ON c1.entity_id = p.entity_id AND c1.period = 2001
      LEFT JOIN period_costs c2 ON c2.entity_id = p.entity_id AND c2.period = 2002),
    frame AS (
      SELECT entity_id, role, name, group_code,
        round(outcome_this_period, 4) AS score,
        round(y0 * 8000000 - c0 + y1 * 8000000 / 1.08 - c1 + y2 * 8000000 / power(1.08, 2) - c2, 2) AS naive_surplus,
        round(outcome * 8000000 - c0, 2) AS realized_value
      FROM priced JOIN dims USING (entity_id)
      QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY round(outcome_this_period, 4) DESC, role) = 1)
"""
)


def naive_frame(v: Views) -> DataFrame:
    """The evaluation frame of the repeat-last baseline, with rounded money columns."""
    outcomes = v.outcomes()
    _, test = ft.split_at_target(ft.lag1_rows(v.features(), outcomes, MODEL_COLUMNS), 2000)
    test = test.withColumn("score", F.round("outcome_this_period", 4))
    frame = ev.value_frame(
        test,
        outcomes,
        ev.entity_dim_for_period(v.features(), v.registry(), 2000),
        2000,
        {"naive_surplus": "outcome_this_period"},
        "score",
    )
    return rounded(frame, 2, "naive_surplus", "realized_value")


@query(
    "realized_value",
    TOTALS_SQL
    + """,
    spent AS (SELECT entity_id, max(cost) AS cost FROM outcomes WHERE period = 2000 AND cost IS NOT NULL GROUP BY 1)
    SELECT entity_id, role, round(outcome * 8000000 - coalesce(cost, 760000), 2) AS realized_value
    FROM totals LEFT JOIN spent USING (entity_id) WHERE period = 2000""",
)
def realized_value(v: Views) -> DataFrame:
    outcomes = v.outcomes()
    totals = ft.outcome_by_period(outcomes.filter(F.col("period") == 2000))
    return rounded(ev.with_realized_value(totals, outcomes, 2000), 2, "realized_value").select(
        "entity_id", "role", "realized_value"
    )


@query(
    "evaluation_frame",
    FRAME_SQL + "SELECT entity_id, role, name, group_code, score, naive_surplus, realized_value FROM frame",
)
def evaluation_frame(v: Views) -> DataFrame:
    return naive_frame(v).select(
        "entity_id", "role", "name", "group_code", "score", "naive_surplus", "realized_value"
    )


SCORES = ["predicted_surplus", "naive_surplus"]


def surplus_sql(value: str) -> str:
    """Surplus over three periods from a value, next to ``kept``, ``a`` and costs ``c0`` to ``c2``."""
    declines = [f"(1 - CASE WHEN a + {n} <= 27 THEN 0.0 ELSE least(0.03 * (a + {n} - 27) - 0.02, 0.40) END)" for n in (1, 2)]
    return f"""round({value} * 8000000 - c0 + {value} * {declines[0]} * 8000000 / 1.08 - c1
          + {value} * {declines[0]} * {declines[1]} * 8000000 / power(1.08, 2) - c2, 2)"""


def model_frame_sql(roles: list[str], more: str = "") -> str:
    """The evaluation frame with ridge predictions for ``roles``; ``more`` adds those of others."""
    linear = {role: ROLE_COLUMNS[role] for role in roles}
    return f"""{PREPARED_SQL},
    {', '.join(f"{role}_train AS (SELECT * FROM prepared WHERE role = '{role}' AND target_period < 2000)" for role in ROLE_COLUMNS)},
    {', '.join(ridge_sql(role, f'{role}_train', columns) for role, columns in linear.items())},
    predicted AS (
      {' UNION ALL '.join(
        f'''SELECT entity_id, role, age + 1 AS a, outcome, outcome_this_period AS naive, {ridge_value(columns)} AS predicted
      FROM prepared, {role}_fit WHERE role = '{role}' AND target_period = 2000''' for role, columns in linear.items()
      )}{more}),
    period_costs AS (
      SELECT entity_id, period, max(cost) AS cost FROM outcomes WHERE cost IS NOT NULL GROUP BY ALL),
    dims AS (
      SELECT entity_id, first_name || ' ' || last_name AS name, g AS group_code
      FROM (SELECT entity_id, min(group_code) AS g FROM features WHERE period = 2000 GROUP BY 1)
      JOIN registry USING (entity_id)),
    kept AS (
      SELECT p.*, name, group_code,
             coalesce(c0.cost, 760000) AS c0, coalesce(c1.cost, 760000) AS c1, coalesce(c2.cost, 760000) AS c2
      FROM predicted p JOIN dims USING (entity_id)
      LEFT JOIN period_costs c0 ON c0.entity_id = p.entity_id AND c0.period = 2000
      LEFT JOIN period_costs c1 ON c1.entity_id = p.entity_id AND c1.period = 2001
      LEFT JOIN period_costs c2 ON c2.entity_id = p.entity_id AND c2.period = 2002
      WHERE a IS NOT NULL AND name IS NOT NULL AND group_code IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY p.entity_id ORDER BY predicted DESC, role) = 1),
    frame AS (
      SELECT entity_id, role, name, group_code, {surplus_sql('predicted')} AS predicted_surplus,
             {surplus_sql('naive')} AS naive_surplus, round(outcome * 8000000 - c0, 2) AS realized_value
      FROM kept)"""

MODEL_FRAME_SQL = model_frame_sql(list(ROLE_COLUMNS))


BOOSTED_FRAME_SQL = model_frame_sql(
    [C.ROLE_BAT],
    """ UNION ALL SELECT entity_id, role, age + 1, outcome, outcome_this_period, boosted
      FROM boosted JOIN pitch_test USING (entity_id, period, role)""",
).replace(
    "predicted AS (",
    f"""pitch_test AS (SELECT * FROM prepared WHERE role = 'pitch' AND target_period = 2000),
    {boosted_sql('pitch_train', 'pitch_test', {C.ROLE_PITCH: PITCH})},
    predicted AS (""",
    1,
)


@query(
    "evaluation_frame_model",
    BOOSTED_FRAME_SQL + " SELECT entity_id, role, name, predicted_surplus, naive_surplus, realized_value FROM frame",
)
def evaluation_frame_model(v: Views) -> DataFrame:
    """The frame with model predictions: ridge for one role, boosted trees for the other."""
    frame = ev.build_evaluation_frame(
        v.features(), v.outcomes(), v.registry(), 2000, MODEL_COLUMNS + ["group_code"],
        {C.ROLE_BAT: (BAT, md.fit_ridge), C.ROLE_PITCH: (PITCH, md.fit_boosted_trees)},
    )
    return rounded(frame, 2, "predicted_surplus", "naive_surplus", "realized_value").select(
        "entity_id", "role", "name", "predicted_surplus", "naive_surplus", "realized_value"
    )


@query(
    "spearman",
    FRAME_SQL
    + """,
    ranked AS (
      SELECT rank() OVER (ORDER BY naive_surplus) + (count(*) OVER (PARTITION BY naive_surplus) - 1) / 2.0 AS a,
             rank() OVER (ORDER BY realized_value) + (count(*) OVER (PARTITION BY realized_value) - 1) / 2.0 AS b
      FROM frame),
    tied AS (
      SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS a,
             rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS b
      FROM lineitem)
    SELECT 'frame' AS source, round(corr(a, b), 6) AS rho FROM ranked
    UNION ALL SELECT 'tied', round(corr(a, b), 6) FROM tied""",
)
def spearman(v: Views) -> DataFrame:
    """Over the evaluation frame, and over a table whose values repeat heavily."""
    parts = [
        mt.spearman(materialize(naive_frame(v).select("naive_surplus", "realized_value"), "frame"), "naive_surplus", "realized_value")
        .withColumn("source", F.lit("frame")),
        mt.spearman(v.table("lineitem"), "l_quantity", "l_extendedprice").withColumn("source", F.lit("tied")),
    ]
    return rounded(ev.union_all(parts), 6, "rho").select("source", "rho")


@query(
    "precision_at_k",
    FRAME_SQL
    + """
    SELECT 'top' AS kind, count(*) AS n, round(avg(CASE WHEN realized_value > 0 THEN 1.0 ELSE 0.0 END), 6) AS rate
    FROM (SELECT * FROM frame ORDER BY naive_surplus DESC, entity_id LIMIT 20)
    UNION ALL
    SELECT 'base', count(*), round(avg(CASE WHEN realized_value > 0 THEN 1.0 ELSE 0.0 END), 6) FROM frame""",
)
def precision_at_k(v: Views) -> DataFrame:
    frame = materialize(naive_frame(v).select("entity_id", "naive_surplus", "realized_value"), "frame")
    top = mt.precision_at_k(frame, "naive_surplus", "realized_value", C.TOP_K)
    base = mt.hit_rate(frame, "realized_value")
    both = top.withColumn("kind", F.lit("top")).unionByName(base.withColumn("kind", F.lit("base")))
    return rounded(both, 6, "rate").select("kind", "n", "rate")


@query(
    "surplus_accuracy",
    FRAME_SQL
    + """,
    ranked AS (
      SELECT rank() OVER (ORDER BY naive_surplus) + (count(*) OVER (PARTITION BY naive_surplus) - 1) / 2.0 AS a,
             rank() OVER (ORDER BY realized_value) + (count(*) OVER (PARTITION BY realized_value) - 1) / 2.0 AS b,
             realized_value, row_number() OVER (ORDER BY naive_surplus DESC, entity_id) AS place
      FROM frame)
    SELECT 'naive_surplus' AS score, round(corr(a, b), 6) AS rho,
           round(avg(CASE WHEN realized_value > 0 THEN 1.0 ELSE 0.0 END) FILTER (WHERE place <= 20), 6) AS precision,
           round(avg(CASE WHEN realized_value > 0 THEN 1.0 ELSE 0.0 END), 6) AS base_rate
    FROM ranked""",
)
def surplus_accuracy(v: Views) -> DataFrame:
    frame = materialize(naive_frame(v).select("entity_id", "naive_surplus", "realized_value"), "frame")
    return rounded(ev.surplus_accuracy(frame, ["naive_surplus"]), 6, "rho", "precision", "base_rate").select(
        "score", "rho", "precision", "base_rate"
    )


PAIR_SQL = (
    FRAME_SQL
    + """,
    closest AS (
      SELECT least(l.entity_id, u.entity_id) AS entity_id_a, greatest(l.entity_id, u.entity_id) AS entity_id_b,
             'closest' AS kind
      FROM frame l JOIN frame u
        ON (l.naive_surplus, l.entity_id) < (u.naive_surplus, u.entity_id)
      WHERE l.group_code <> u.group_code
      ORDER BY u.naive_surplus - l.naive_surplus, l.naive_surplus DESC, l.entity_id DESC,
               u.naive_surplus, u.entity_id
      LIMIT 20),
    hashed AS (
      SELECT entity_id, row_number() OVER (ORDER BY md5('0:' || entity_id), entity_id) AS i FROM frame),
    random AS (
      SELECT least(a.entity_id, b.entity_id), greatest(a.entity_id, b.entity_id), 'random'
      FROM hashed a JOIN hashed b ON a.i <= 501 AND b.i <= 501 AND b.i > a.i
      ORDER BY b.i - a.i, a.i LIMIT 500),
    gaps AS (
      SELECT p.*, abs(x.realized_value - y.realized_value) AS realized_gap
      FROM (SELECT * FROM closest UNION ALL SELECT * FROM random) p
      JOIN frame x ON x.entity_id = entity_id_a JOIN frame y ON y.entity_id = entity_id_b)
"""
)


@query(
    "pair_realized_gap",
    PAIR_SQL
    + """SELECT entity_id_a, entity_id_b, round(realized_gap, 2) AS realized_gap
    FROM gaps WHERE kind = 'closest'""",
)
def pair_realized_gap(v: Views) -> DataFrame:
    frame = materialize(naive_frame(v), "frame")
    pairs = ev.closest_pairs(
        frame.select(
            "entity_id", "group_code", "name", F.col("naive_surplus").alias("surplus_value"),
            F.lit(None).cast("string").alias("primary_pos"), F.lit(None).cast("string").alias("other_pos"),
        ),
        C.TOP_PAIRS,
        require_fit=False,
    )
    return rounded(mt.pair_gaps(pairs, frame), 2, "realized_gap").select(
        "entity_id_a", "entity_id_b", "realized_gap"
    )


@query(
    "pair_gap_median",
    PAIR_SQL
    + "SELECT kind, count(*) AS pairs, round(median(realized_gap), 2) AS median_gap FROM gaps GROUP BY kind",
)
def pair_gap_median(v: Views) -> DataFrame:
    frame = materialize(naive_frame(v), "frame")
    return rounded(ev.pairing_quality(frame, "naive_surplus"), 2, "median_gap")


def ridge_frame(v: Views) -> DataFrame:
    """The evaluation frame with ridge predictions for both roles, with rounded money columns."""
    frame = ev.build_evaluation_frame(
        v.features(), v.outcomes(), v.registry(), 2000, MODEL_COLUMNS,
        {C.ROLE_BAT: (BAT, md.fit_ridge), C.ROLE_PITCH: (PITCH, md.fit_ridge)},
    )
    return materialize(
        rounded(frame, 2, *SCORES, "realized_value").select("entity_id", "group_code", "name", *SCORES, "realized_value"), "frame"
    )


@query(
    "surplus_accuracy_model",
    MODEL_FRAME_SQL
    + ", "
    + ", ".join(
        f"""ranked_{score} AS (
      SELECT rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2.0 AS a,
             rank() OVER (ORDER BY realized_value) + (count(*) OVER (PARTITION BY realized_value) - 1) / 2.0 AS b,
             realized_value, row_number() OVER (ORDER BY {score} DESC, entity_id) AS place
      FROM frame)"""
        for score in SCORES
    )
    + " UNION ALL ".join(
        f""" SELECT '{score}' AS score, round(corr(a, b), 6) AS rho,
           round(avg(CASE WHEN realized_value > 0 THEN 1.0 ELSE 0.0 END) FILTER (WHERE place <= 20), 6) AS precision,
           round(avg(CASE WHEN realized_value > 0 THEN 1.0 ELSE 0.0 END), 6) AS base_rate
    FROM ranked_{score}"""
        for score in SCORES
    ),
)
def surplus_accuracy_model(v: Views) -> DataFrame:
    """Rank quality of the model beside the repeat-last baseline."""
    return rounded(ev.surplus_accuracy(ridge_frame(v), SCORES), 6, "rho", "precision", "base_rate").select(
        "score", "rho", "precision", "base_rate"
    )


@query(
    "pair_gap_median_model",
    MODEL_FRAME_SQL
    + """,
    hashed AS (
      SELECT entity_id, row_number() OVER (ORDER BY md5('0:' || entity_id), entity_id) AS i FROM frame),
    random AS (
      SELECT a.entity_id AS x, b.entity_id AS y FROM hashed a JOIN hashed b ON a.i <= 501 AND b.i <= 501 AND b.i > a.i
      ORDER BY b.i - a.i, a.i LIMIT 500),
    chosen AS ("""
    + " UNION ALL ".join(
        f"""SELECT '{score}' AS score, 'random' AS kind, x, y FROM random
      UNION ALL (
      SELECT '{score}', 'closest', l.entity_id, u.entity_id
      FROM frame l JOIN frame u ON (l.{score}, l.entity_id) < (u.{score}, u.entity_id)
      WHERE l.group_code <> u.group_code
      ORDER BY u.{score} - l.{score}, l.{score} DESC, l.entity_id DESC, u.{score}, u.entity_id LIMIT 20)"""
        for score in SCORES
    )
    + """)
    SELECT score, kind, count(*) AS pairs, round(median(abs(p.realized_value - q.realized_value)), 2) AS median_gap
    FROM chosen JOIN frame p ON p.entity_id = x JOIN frame q ON q.entity_id = y GROUP BY score, kind""",
)
def pair_gap_median_model(v: Views) -> DataFrame:
    """Pair quality of the model beside the repeat-last baseline."""
    frame = ridge_frame(v)
    parts = [ev.pairing_quality(frame, score).withColumn("score", F.lit(score)) for score in SCORES]
    return rounded(ev.union_all(parts), 2, "median_gap").select("score", "kind", "pairs", "median_gap")
