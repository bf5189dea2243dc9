"""Queries over names: normalization, similarity and the resolution ladder."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitval.functions import text as tx
from pitval.functions.similarity import token_set_ratio
from pitval.operators import fuzzy, resolve
from pitval.plans import resolution
from pitval.queries.catalogue import query
from pitval.queries.views import CURRENT_MONTH, Views
from pitval.session import materialize, scratch_path
from pitval.sources.store import Store

RESOLVED_ON = dt.date(2024, 1, 20)


def norm_sql(expression: str) -> str:
    """The normalization steps in SQL."""
    bracket = rf"regexp_replace(lower(strip_accents(coalesce({expression}, ''))), '\s*\([^)]*\)\s*', ' ', 'g')"
    bare = f"regexp_replace({bracket}, '[.,''`\"’]', '', 'g')"
    spaced = rf"trim(regexp_replace({bare}, '\s+', ' ', 'g'))"
    return rf"trim(regexp_replace({spaced}, '\s+(jr|sr|ii|iii|iv|v)$', ''))"


NAMES_SQL = f"""keyed AS (
      SELECT feed_id, {norm_sql('player_name')} AS norm, trim(coalesce(group_code, '')) AS grp
      FROM mentions),
    names AS (
      SELECT entity_id, {norm_sql("first_name || ' ' || last_name")} AS norm FROM registry),
    recent AS (
      SELECT DISTINCT entity_id, group_code FROM appearances WHERE period >= {CURRENT_MONTH} - 3 + 1),
    active AS (SELECT DISTINCT entity_id FROM recent)"""


@query("normalize_text", f"WITH {NAMES_SQL} SELECT feed_id, norm, grp FROM keyed")
def normalize_text(v: Views) -> DataFrame:
    return resolve.mention_keys(v.mentions()).select("feed_id", "norm", "grp")


CODES = [
    "SD", "sdp ", "SF", "TB", "TBD", "TBR", "KC", "WSN", "was", "CWS", "AZ", "ARI", "NYM", "", " bos",
]
#: Written out, so that the SQL does not depend on the table under test.
ALIAS_VALUES = """
      ('SD', 'SD|SDP'), ('SDP', 'SD|SDP'), ('SF', 'SF|SFG'), ('SFG', 'SF|SFG'),
      ('TB', 'TB|TBD|TBR'), ('TBR', 'TB|TBD|TBR'), ('KC', 'KC|KCR'), ('KCR', 'KC|KCR'),
      ('WSN', 'WAS|WSN'), ('WAS', 'WAS|WSN'), ('CWS', 'CHW|CWS'), ('CHW', 'CHW|CWS'),
      ('AZ', 'ARI|AZ'), ('ARI', 'ARI|AZ')"""


@query(
    "alias_expand",
    f"""
    WITH codes AS (
      SELECT p_partkey AS entity_id, [{', '.join(f"'{c}'" for c in CODES)}][1 + p_size % 15] AS code
      FROM part),
    alias(code, accepted) AS (VALUES {ALIAS_VALUES})
    SELECT entity_id, codes.code AS code, coalesce(accepted, upper(trim(codes.code))) AS accepted
    FROM codes LEFT JOIN alias ON alias.code = upper(trim(codes.code))
    """,
)
def alias_expand(v: Views) -> DataFrame:
    code = F.element_at(F.array(*[F.lit(c) for c in CODES]), (1 + F.col("p_size") % 15).cast("int"))
    coded = v.table("part").select(F.col("p_partkey").alias("entity_id"), code.alias("code"))
    accepted = F.array_join(F.array_sort(tx.alias_set(F.col("code"))), "|")
    return coded.withColumn("accepted", accepted)


@query(
    "active_pool",
    f"WITH {NAMES_SQL} SELECT entity_id FROM active",
)
def active_pool(v: Views) -> DataFrame:
    return resolve.active_pool(resolve.recent_appearances(v.appearances(), CURRENT_MONTH))


@query(
    "recent_groups",
    f"""WITH {NAMES_SQL}
    SELECT entity_id, string_agg(group_code, '|' ORDER BY group_code) AS groups, count(*) AS n
    FROM recent GROUP BY entity_id""",
)
def recent_groups(v: Views) -> DataFrame:
    recent = resolve.recent_appearances(v.appearances(), CURRENT_MONTH)
    return recent.groupBy("entity_id").agg(
        F.array_join(F.array_sort(F.collect_set("group_code")), "|").alias("groups"),
        F.count(F.lit(1)).alias("n"),
    )


OVERRIDES_SQL = f"""listed AS (
      SELECT {norm_sql('player_name')} AS norm, trim(coalesce(group_code, '')) AS grp,
             entity_id AS override_id
      FROM overrides
      QUALIFY row_number() OVER (PARTITION BY norm, grp ORDER BY seq DESC) = 1)"""


@query(
    "resolve_override",
    f"""WITH {NAMES_SQL}, {OVERRIDES_SQL}
    SELECT feed_id, override_id,
           CASE WHEN override_id IS NULL THEN 'rookie_pending' ELSE 'manual_override' END AS method
    FROM keyed JOIN listed USING (norm, grp)""",
)
def resolve_override(v: Views) -> DataFrame:
    keyed = resolve.mention_keys(v.mentions()).select("feed_id", "norm", "grp")
    listed = resolve.override_table(v.overrides())
    return keyed.join(listed, ["norm", "grp"]).select(
        "feed_id",
        "override_id",
        F.when(F.col("override_id").isNull(), "rookie_pending").otherwise("manual_override").alias("method"),
    )


PROFILE_SQL = """profile AS (
      SELECT norm, count(*) AS n_all, min(n.entity_id) AS any_id,
             count(a.entity_id) AS n_active, min(a.entity_id) AS active_id
      FROM names n LEFT JOIN active a USING (entity_id) GROUP BY norm),
    wanted AS (
      SELECT DISTINCT entity_id, upper(group_code) AS wanted FROM recent WHERE group_code IS NOT NULL),
    by_group AS (
      SELECT norm, wanted, count(*) AS n_group, min(entity_id) AS group_id
      FROM names JOIN wanted USING (entity_id) GROUP BY norm, wanted)"""


@query(
    "resolve_exact",
    f"""WITH {NAMES_SQL}, {PROFILE_SQL}
    SELECT norm, n_all, any_id, n_active, active_id FROM profile""",
)
def resolve_exact(v: Views) -> DataFrame:
    pool = resolve.active_pool(resolve.recent_appearances(v.appearances(), CURRENT_MONTH))
    return resolve.name_profile(resolve.registry_names(v.registry()), pool)


@query(
    "resolve_group",
    f"""WITH {NAMES_SQL}, {PROFILE_SQL}
    SELECT norm, wanted, n_group, group_id FROM by_group""",
)
def resolve_group(v: Views) -> DataFrame:
    accepted = resolve.accepted_requests(resolve.recent_appearances(v.appearances(), CURRENT_MONTH))
    return resolve.name_group_profile(resolve.registry_names(v.registry()), accepted)


LADDER_SQL = f"""{NAMES_SQL}, {OVERRIDES_SQL}, {PROFILE_SQL},
    looked AS (
      SELECT k.*, nullif(upper(k.grp), '') AS wanted, l.norm IS NOT NULL AS is_listed, override_id,
             coalesce(n_all, 0) AS n, any_id, n_active, active_id, coalesce(n_group, 0) AS n_group, group_id
      FROM keyed k LEFT JOIN listed l USING (norm, grp) LEFT JOIN profile USING (norm)
      LEFT JOIN by_group b ON b.norm = k.norm AND b.wanted = upper(k.grp)),
    ladder AS (
      SELECT *, CASE WHEN norm = '' THEN 'empty_name'
             WHEN is_listed AND override_id IS NOT NULL THEN 'manual_override'
             WHEN is_listed THEN 'rookie_pending'
             WHEN n = 1 THEN 'exact'
             WHEN n > 1 AND n_active = 1 THEN 'active_narrow'
             WHEN n > 1 AND n_active > 1 AND n_group = 1 THEN 'team_narrow'
             WHEN n > 1 THEN 'ambiguous' ELSE 'needs_fuzzy' END AS method
      FROM looked),
    verdicts AS (
      SELECT feed_id, norm, wanted, method,
        CASE method WHEN 'manual_override' THEN override_id WHEN 'exact' THEN any_id
                    WHEN 'active_narrow' THEN active_id WHEN 'team_narrow' THEN group_id END AS entity_id,
        CASE method WHEN 'manual_override' THEN 100.0 WHEN 'exact' THEN 100.0
                    WHEN 'active_narrow' THEN 95.0 WHEN 'team_narrow' THEN 92.0 ELSE 0.0 END AS score,
        CASE WHEN method IN ('manual_override', 'exact') THEN 1
             WHEN method IN ('active_narrow', 'team_narrow', 'ambiguous') THEN n ELSE 0 END AS candidate_count
      FROM ladder)"""


def ladder_rows(v: Views, with_fuzzy: bool) -> DataFrame:
    return resolve.resolve_mentions(
        v.mentions(), v.registry(), v.appearances(), v.overrides(), CURRENT_MONTH,
        fuzzy=with_fuzzy, resolved_at=RESOLVED_ON,
    )


@query(
    "resolve_ladder",
    f"""WITH {LADDER_SQL}
    SELECT feed_id, entity_id, method, CAST(score AS DOUBLE) AS score,
           CAST(candidate_count AS BIGINT) AS candidate_count, DATE '2024-01-20' AS resolved_at
    FROM verdicts""",
)
def resolve_ladder(v: Views) -> DataFrame:
    """Every rule but the fuzzy one."""
    return ladder_rows(v, with_fuzzy=False)


# ---- similarity -----------------------------------------------------------------


def lcs_sql(a: str, b: str) -> str:
    """Longest common subsequence as a fold over table rows."""
    cell = (
        f"CASE WHEN ord({b}[j[1]]) = ch[1] THEN state[j[1]] + 1 "
        "ELSE greatest(state[j[1] + 1], acc[j[1]]) END"
    )
    row = (
        f"list_reduce(list_transform(range(1, len({b}) + 1), lambda j: [j]), "
        f"lambda acc, j: list_append(acc, {cell}), [0::BIGINT])"
    )
    return (
        f"list_reduce(list_transform(range(len({a})), lambda i: [ord({a}[i + 1])::BIGINT]), "
        f"lambda state, ch: {row}, list_transform(range(len({b}) + 1), lambda x: 0::BIGINT))[len({b}) + 1]"
    )


def score_sql(pairs: str, floor: float | None = None, name: str = "") -> str:
    """CTEs that score ``pairs`` (left_norm, right_norm, ...) in ``{name}rated``. With ``floor`` the character
    comparison is skipped where the edit distance already rules the floor out."""
    guard = (
        f"WHEN levenshtein(a, b) > {1 - floor / 100.0} * total + 0.000001 THEN 0.0" if floor else ""
    )
    return f"""{name}worded AS (
      SELECT *, list_sort(list_distinct(list_filter(string_split(left_norm, ' '), lambda w: w <> ''))) AS lw,
             list_sort(list_distinct(list_filter(string_split(right_norm, ' '), lambda w: w <> ''))) AS rw
      FROM {pairs}),
    {name}parts AS (
      SELECT *, array_to_string(list_filter(lw, lambda w: list_contains(rw, w)), ' ') AS s,
             array_to_string(list_filter(lw, lambda w: NOT list_contains(rw, w)), ' ') AS a,
             array_to_string(list_filter(rw, lambda w: NOT list_contains(lw, w)), ' ') AS b
      FROM {name}worded),
    {name}sized AS (
      SELECT *, 2 * len(s) + len(a) + len(b) + CASE WHEN s <> '' THEN 2 ELSE 0 END AS total FROM {name}parts),
    {name}rated AS (
      SELECT *, CASE WHEN left_norm = '' OR right_norm = '' THEN 0.0
        WHEN s <> '' AND (a = '' OR b = '') THEN 100.0
        ELSE greatest(
          CASE {guard} WHEN total > 0
               THEN 100.0::DOUBLE - 100.0::DOUBLE * (len(a) + len(b) - 2 * {lcs_sql('a', 'b')}) / total
               ELSE 0.0 END,
          CASE WHEN s <> '' THEN 100.0::DOUBLE - 100.0::DOUBLE * (len(a) + 1) / (2 * len(s) + 1 + len(a)) ELSE 0.0 END,
          CASE WHEN s <> '' THEN 100.0::DOUBLE - 100.0::DOUBLE * (len(b) + 1) / (2 * len(s) + 1 + len(b)) ELSE 0.0 END)
        END AS score
      FROM {name}sized)"""


@query(
    "token_set_ratio",
    f"""WITH {NAMES_SQL},
    both_names AS (
      SELECT feed_id, keyed.norm AS left_norm, names.norm AS right_norm
      FROM keyed JOIN names ON feed_id = entity_id),
    {score_sql('both_names')}
    SELECT feed_id, round(score, 6) AS score FROM rated""",
)
def token_set_ratio_query(v: Views) -> DataFrame:
    """Each mention against the registry name it was made from."""
    keyed = resolve.mention_keys(v.mentions()).select("feed_id", F.col("norm").alias("left_norm"))
    names = resolve.registry_names(v.registry()).select(
        F.col("entity_id").alias("feed_id"), F.col("norm").alias("right_norm")
    )
    score = token_set_ratio(F.col("left_norm"), F.col("right_norm"))
    return keyed.join(names, "feed_id").select("feed_id", F.round(score, 6).alias("score"))


FUZZY_SQL = f"""{LADDER_SQL},
    asked AS (SELECT DISTINCT norm AS left_norm FROM ladder WHERE method = 'needs_fuzzy'),
    known AS (
      SELECT norm AS right_norm, min(entity_id) AS fuzzy_id FROM names JOIN active USING (entity_id)
      WHERE norm <> '' GROUP BY norm),
    crossed AS (SELECT * FROM asked CROSS JOIN known),
    {score_sql('crossed', 88)},
    hits AS (SELECT left_norm, right_norm, fuzzy_id, score FROM rated WHERE score >= 88),
    best AS (
      SELECT left_norm AS norm, fuzzy_id, score AS fuzzy_score FROM hits
      QUALIFY row_number() OVER (PARTITION BY left_norm ORDER BY score DESC, fuzzy_id) = 1)"""


def open_names(v: Views) -> tuple[DataFrame, DataFrame]:
    """Names that need the fuzzy rule, and the active registry names."""
    ladder = resolve.exact_ladder(
        resolve.mention_keys(v.mentions()).select("norm", "grp").distinct(),
        v.registry(), v.appearances(), v.overrides(), CURRENT_MONTH,
    )
    asked = ladder.filter(F.col("method") == resolve.NEEDS_FUZZY).select("norm").distinct()
    pool = resolve.active_pool(resolve.recent_appearances(v.appearances(), CURRENT_MONTH))
    return asked, resolve.registry_names(v.registry()).join(pool, "entity_id", "left_semi")


@query(
    "fuzzy_candidates",
    f"""WITH {FUZZY_SQL}
    SELECT left_norm, right_norm, round(score, 6) AS score FROM hits""",
)
def fuzzy_candidates(v: Views) -> DataFrame:
    """Every pair of names at or above the threshold."""
    asked, active = open_names(v)
    names = active.filter("norm <> ''").select("norm").distinct()
    return fuzzy.fuzzy_pairs(asked, names).withColumn("score", F.round("score", 6))


@query(
    "resolve_fuzzy",
    f"""WITH {FUZZY_SQL}
    SELECT norm, fuzzy_id AS entity_id, round(fuzzy_score, 6) AS score FROM best""",
)
def resolve_fuzzy(v: Views) -> DataFrame:
    asked, active = open_names(v)
    return fuzzy.best_fuzzy(asked, active).withColumn("score", F.round("score", 6))


WATERFALL_SQL = f"""{FUZZY_SQL},
    lonely AS (SELECT left_norm, right_norm FROM asked CROSS JOIN known WHERE left_norm NOT IN (SELECT norm FROM best)),
    {score_sql('lonely', name='lonely_')},
    low AS (SELECT left_norm AS norm, max(score) AS low_score FROM lonely_rated GROUP BY left_norm),
    checked AS (
      SELECT v.*, b.fuzzy_id, coalesce(b.fuzzy_score, low_score, 0) AS fuzzy_score,
             b.fuzzy_id IS NOT NULL AND (v.wanted IS NULL
               OR b.fuzzy_id NOT IN (SELECT entity_id FROM recent WHERE group_code IS NOT NULL)
               OR EXISTS (SELECT 1 FROM wanted w WHERE w.entity_id = b.fuzzy_id AND w.wanted = v.wanted)
             ) AS taken
      FROM verdicts v LEFT JOIN best b ON v.method = 'needs_fuzzy' AND b.norm = v.norm
      LEFT JOIN low ON v.method = 'needs_fuzzy' AND low.norm = v.norm),
    waterfall AS (
    SELECT feed_id,
           CASE WHEN method <> 'needs_fuzzy' THEN entity_id WHEN taken THEN fuzzy_id END AS entity_id,
           CASE WHEN method <> 'needs_fuzzy' THEN method WHEN taken THEN 'fuzzy' ELSE 'unresolved' END AS method,
           CASE WHEN method <> 'needs_fuzzy' THEN CAST(score AS DOUBLE) ELSE round(fuzzy_score, 6) END AS score,
           CAST(CASE WHEN method <> 'needs_fuzzy' THEN candidate_count WHEN taken THEN 1 ELSE 0 END AS BIGINT)
             AS candidate_count,
           DATE '2024-01-20' AS resolved_at
    FROM checked)"""


@query("resolve_waterfall", f"WITH {WATERFALL_SQL} SELECT * FROM waterfall")
def resolve_waterfall(v: Views) -> DataFrame:
    return ladder_rows(v, with_fuzzy=True).withColumn("score", F.round("score", 6))


@query(
    "resolution_audit",
    f"""WITH {WATERFALL_SQL}
    SELECT method, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM waterfall), 6) AS percent
    FROM waterfall GROUP BY method
    UNION ALL
    SELECT 'resolved', count(entity_id), round(count(entity_id) * 100.0 / count(*), 6) FROM waterfall""",
)
def resolution_audit(v: Views) -> DataFrame:
    rows = materialize(ladder_rows(v, with_fuzzy=True), "resolved")
    summary = resolution.method_summary(rows)
    rate = resolution.resolved_rate(rows).select(
        F.lit("resolved").alias("method"), F.col("resolved").alias("n"), "percent"
    )
    return summary.unionByName(rate).withColumn("percent", F.round("percent", 6))


@query(
    "unresolved_sample",
    f"""WITH {WATERFALL_SQL}
    SELECT feed_id, method, score, entity_id, player_name, group_code, primary_pos
    FROM waterfall JOIN mentions USING (feed_id) WHERE method IN ('unresolved', 'ambiguous')
    ORDER BY feed_id LIMIT 10""",
)
def unresolved_sample(v: Views) -> DataFrame:
    return resolution.unresolved_sample(resolve_waterfall(v), v.mentions())


@query(
    "weakest_fuzzy",
    f"""WITH {WATERFALL_SQL}
    SELECT feed_id, method, score, entity_id, player_name, group_code, primary_pos
    FROM waterfall JOIN mentions USING (feed_id) WHERE method = 'fuzzy'
    ORDER BY score, feed_id LIMIT 5""",
)
def weakest_fuzzy(v: Views) -> DataFrame:
    return resolution.weakest_fuzzy(resolve_waterfall(v), v.mentions())


@query(
    "resolve_again",
    f"""WITH {WATERFALL_SQL}
    SELECT feed_id, entity_id, method, score, candidate_count,
           CASE WHEN feed_id % 3 <> 0 THEN DATE '2024-01-20' ELSE DATE '2024-01-25' END AS resolved_at
    FROM waterfall WHERE feed_id % 4 <> 0""",
)
def resolve_again(v: Views) -> DataFrame:
    """A date that is ingested and resolved twice: verdicts that stand are kept, those of rows that
    left go, and rows that came are resolved."""
    store = Store(v.spark, scratch_path(v.spark, "store"))
    store.replace_for_date("registry", v.registry(), RESOLVED_ON)
    store.replace_for_date("outcomes", v.appearances(), RESOLVED_ON)
    for rule, today in (("feed_id % 3 <> 0", RESOLVED_ON), ("feed_id % 4 <> 0", RESOLVED_ON + dt.timedelta(5))):
        store.replace_for_date("feed", v.mentions().filter(rule), RESOLVED_ON)
        resolution.resolve_all(store, v.overrides(), CURRENT_MONTH, today=today)
    made = store.snapshot("resolutions").withColumn("score", F.round("score", 6))
    return made.select("feed_id", "entity_id", "method", "score", "candidate_count", "resolved_at")
