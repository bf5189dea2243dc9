"""Names to entity ids through an ordered ladder of rules.

First rule that applies wins:

    empty_name        the normalized name is blank
    manual_override   (name, group) is listed with an id             score 100
    rookie_pending    (name, group) is listed without an id
    exact             one registry entity has the name               score 100
    active_narrow     several have it, one of them is active         score 95
    team_narrow       several are active, one was seen with a code
                      accepted for the group                         score 92
    ambiguous         any other name that several entities share
    fuzzy             best active name at or above the threshold whose
                      known groups, if any, include the group        its score
    unresolved        nothing above

Every rule depends on the (name, group) pair alone, so the ladder runs once per distinct
pair and the mentions pick up its verdict in one skew-safe join. Candidates are never
listed: counts and the lowest id per name say all that the ladder needs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitval import constants as C
from pitval.functions.text import full_name, group_key, normalize_name, requested_by
from pitval.operators.dedupe import first_per_key
from pitval.operators.fuzzy import best_below, best_fuzzy
from pitval.operators.skew import salted_join, shuffle_width
from pitval.session import materialize

NEEDS_FUZZY = "needs_fuzzy"


def registry_names(registry: DataFrame) -> DataFrame:
    """entity_id with its normalized full name."""
    return registry.select(
        "entity_id",
        normalize_name(full_name(F.col("first_name"), F.col("last_name"))).alias("norm"),
    )


def recent_appearances(
    outcomes: DataFrame, current_period: int, lookback: int = C.ACTIVE_LOOKBACK_PERIODS
) -> DataFrame:
    """Distinct (entity_id, group_code) of the last ``lookback`` periods."""
    return (
        outcomes.filter(F.col("period") >= current_period - lookback + 1)
        .select("entity_id", "group_code")
        .distinct()
    )


def active_pool(recent: DataFrame) -> DataFrame:
    return recent.select("entity_id").distinct()


def accepted_requests(recent: DataFrame) -> DataFrame:
    """Distinct (entity_id, wanted): requested codes each entity's recorded codes satisfy."""
    return (
        recent.filter("group_code is not null")
        .select("entity_id", F.explode(requested_by(F.col("group_code"))).alias("wanted"))
        .distinct()
    )


def name_profile(names: DataFrame, pool: DataFrame) -> DataFrame:
    """Per normalized name: how many entities share it, how many are active, lowest ids."""
    flagged = names.join(pool.withColumn("_active", F.lit(True)), "entity_id", "left")
    active_id = F.when(F.col("_active"), F.col("entity_id"))
    return flagged.groupBy("norm").agg(
        F.count(F.lit(1)).alias("n_all"),
        F.min("entity_id").alias("any_id"),
        F.count(active_id).alias("n_active"),
        F.min(active_id).alias("active_id"),
    )


def name_group_profile(names: DataFrame, accepted: DataFrame) -> DataFrame:
    """Per (name, wanted code): how many active entities were seen with an accepted code."""
    return (
        names.join(accepted, "entity_id")
        .groupBy("norm", "wanted")
        .agg(F.count(F.lit(1)).alias("n_group"), F.min("entity_id").alias("group_id"))
    )


def override_table(overrides: DataFrame) -> DataFrame:
    """(norm, group) -> id or null for pending. A later line for the same key wins; the
    line number is ``seq`` where given."""
    if "seq" not in overrides.columns:
        overrides = overrides.withColumn("seq", F.monotonically_increasing_id())
    keyed = overrides.select(
        normalize_name(F.col("player_name")).alias("norm"),
        F.trim(F.coalesce("group_code", F.lit(""))).alias("grp"),
        F.col("entity_id").cast("long").alias("override_id"),
        "seq",
    )
    return first_per_key(keyed, ["norm", "grp"], [F.col("seq").desc()]).select(
        "norm", "grp", "override_id", F.lit(True).alias("listed")
    )


def mention_keys(mentions: DataFrame) -> DataFrame:
    """Mentions with ``norm`` (normalized name) and ``grp`` (trimmed raw group, blank if none)."""
    return mentions.withColumns(
        {
            "norm": normalize_name(F.col("player_name")),
            "grp": F.trim(F.coalesce("group_code", F.lit(""))),
        }
    )


def exact_ladder(
    keys: DataFrame,
    registry: DataFrame,
    outcomes: DataFrame,
    overrides: DataFrame,
    current_period: int,
    lookback: int = C.ACTIVE_LOOKBACK_PERIODS,
) -> DataFrame:
    """All rules but the fuzzy one for distinct (norm, grp) keys.

    A name that no registry entity has is labelled ``needs_fuzzy``.
    """
    return _exact_rules(keys, registry_names(registry), recent_appearances(outcomes, current_period, lookback), overrides)


def _exact_rules(keys: DataFrame, names: DataFrame, recent: DataFrame, overrides: DataFrame) -> DataFrame:
    """``exact_ladder`` on the names and the recent appearances."""
    profile = name_profile(names, active_pool(recent))
    by_group = name_group_profile(names, accepted_requests(recent))
    joined = (
        keys.withColumn("wanted", group_key(F.col("grp")))
        .join(override_table(overrides), ["norm", "grp"], "left")
        .join(profile, "norm", "left")
        .join(by_group, ["norm", "wanted"], "left")
    )
    n = F.coalesce("n_all", F.lit(0))
    n_group = F.coalesce("n_group", F.lit(0))
    method = (
        F.when(F.col("norm") == "", "empty_name")
        .when(F.col("listed") & F.col("override_id").isNotNull(), "manual_override")
        .when(F.col("listed"), "rookie_pending")
        .when(n == 1, "exact")
        .when((n > 1) & (F.col("n_active") == 1), "active_narrow")
        .when((n > 1) & (F.col("n_active") > 1) & (n_group == 1), "team_narrow")
        .when(n > 1, "ambiguous")
        .otherwise(NEEDS_FUZZY)
    )
    verdict = joined.withColumn("method", method)
    m = F.col("method")
    return verdict.select(
        "norm",
        "grp",
        "wanted",
        "method",
        F.when(m == "manual_override", F.col("override_id"))
        .when(m == "exact", F.col("any_id"))
        .when(m == "active_narrow", F.col("active_id"))
        .when(m == "team_narrow", F.col("group_id"))
        .alias("entity_id"),
        F.when(m.isin("manual_override", "exact"), 100.0)
        .when(m == "active_narrow", 95.0)
        .when(m == "team_narrow", 92.0)
        .otherwise(0.0)
        .alias("score"),
        F.when(m.isin("manual_override", "exact"), F.lit(1).cast("long"))
        .when(m.isin("active_narrow", "team_narrow", "ambiguous"), n.cast("long"))
        .otherwise(F.lit(0).cast("long"))
        .alias("candidate_count"),
    )


def fuzzy_verdicts(
    keys: DataFrame,
    registry: DataFrame,
    outcomes: DataFrame,
    current_period: int,
    lookback: int = C.ACTIVE_LOOKBACK_PERIODS,
    threshold: float = C.FUZZY_THRESHOLD,
) -> DataFrame:
    """Fuzzy rule for keys (norm, grp, wanted): best active name, then the group check.

    The check looks at the single best entity: one with known groups, none of them
    accepted for the wanted group, is refused and no second-best is tried. A refused match
    keeps its score; a name with nothing at the threshold has the best score below it.
    """
    return _fuzzy_rule(keys, registry_names(registry), recent_appearances(outcomes, current_period, lookback), threshold)


def _fuzzy_rule(keys: DataFrame, names: DataFrame, recent: DataFrame, threshold: float) -> DataFrame:
    """``fuzzy_verdicts`` on the names and the recent appearances."""
    active = materialize(names.join(active_pool(recent), "entity_id", "left_semi"), "active-names")
    best = materialize(best_fuzzy(keys, active, threshold), "best-names")
    asked = keys.filter("norm <> ''").select("norm").distinct()
    known = active.filter("norm <> ''").select("norm").distinct()
    low = best_below(asked.join(best, "norm", "left_anti"), known, threshold)
    accepted = accepted_requests(recent).withColumn("_seen_with", F.lit(True))
    grouped = recent.filter("group_code is not null").select("entity_id").distinct()
    checked = (
        keys.join(best, "norm", "left")
        .join(low.select(F.col("left_norm").alias("norm"), F.col("score").alias("_low")), "norm", "left")
        .join(grouped.withColumn("_has_group", F.lit(True)), "entity_id", "left")
        .join(accepted, ["entity_id", "wanted"], "left")
    )
    refused = F.col("wanted").isNotNull() & F.col("_has_group") & F.col("_seen_with").isNull()
    taken = F.col("entity_id").isNotNull() & ~F.coalesce(refused, F.lit(False))
    return checked.select(
        "norm",
        "grp",
        F.when(taken, "fuzzy").otherwise("unresolved").alias("method"),
        F.when(taken, F.col("entity_id")).alias("entity_id"),
        F.coalesce("score", "_low", F.lit(0.0)).alias("score"),
        F.when(taken, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("candidate_count"),
    )


def _spread(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).repartition(shuffle_width(df), *columns)


def resolve_mentions(
    mentions: DataFrame,
    registry: DataFrame,
    outcomes: DataFrame,
    overrides: DataFrame,
    current_period: int,
    lookback: int = C.ACTIVE_LOOKBACK_PERIODS,
    threshold: float = C.FUZZY_THRESHOLD,
    fuzzy: bool = True,
    resolved_at: dt.date | None = None,
) -> DataFrame:
    """One verdict per mention: feed_id, entity_id, method, score, candidate_count, resolved_at.

    ``mentions`` has feed_id, player_name and group_code. With ``fuzzy`` off, names without
    a registry entry stay labelled ``needs_fuzzy``.
    """
    # Read several times below; names are few bytes and many expressions, so they are spread first.
    keyed = mention_keys(_spread(mentions, "feed_id", "player_name", "group_code")).select("feed_id", "norm", "grp")
    keyed = materialize(keyed, "keyed")
    names = materialize(registry_names(_spread(registry, "entity_id", "first_name", "last_name")), "names")
    recent = materialize(recent_appearances(outcomes, current_period, lookback), "recent")
    ladder = _exact_rules(keyed.select("norm", "grp").distinct(), names, recent, overrides)
    columns = ["norm", "grp", "method", "entity_id", "score", "candidate_count"]
    if fuzzy:
        ladder = materialize(ladder, "ladder")
        open_keys = ladder.filter(F.col("method") == NEEDS_FUZZY).select("norm", "grp", "wanted")
        verdicts = (
            ladder.filter(F.col("method") != NEEDS_FUZZY)
            .select(*columns)
            .unionByName(_fuzzy_rule(open_keys, names, recent, threshold).select(*columns))
        )
    else:
        verdicts = ladder.select(*columns)
    when = F.lit(resolved_at) if resolved_at else F.current_date()
    return salted_join(keyed, verdicts, ["norm", "grp"], "left").select(
        "feed_id", "entity_id", "method", "score", "candidate_count", when.cast("date").alias("resolved_at")
    )
