"""Declared schemas of the dated tables.

``entity_id`` is the subject, ``period`` the season, ``stint`` a part of a period,
``role`` the bat/pitch discriminator, ``group_code`` the team, ``outcome`` the
measured value of a period and ``cost`` what it cost. ``as_of_date`` is when a row was
known; of resolutions, the date of the feed they resolve.
"""

from __future__ import annotations

from pyspark.sql.types import StructType


def _schema(**kinds: str) -> StructType:
    """The columns of each kind in turn."""
    made = StructType()
    for kind, names in kinds.items():
        for name in names.split():
            made = made.add(name, kind)
    return made


REGISTRY = _schema(long="entity_id", string="first_name last_name", date="as_of_date")
RESOLUTIONS = _schema(long="feed_id entity_id candidate_count", string="method", double="score", date="resolved_at as_of_date")
PREDICTIONS = _schema(
    long="entity_id", integer="period", string="system", date="as_of_date",
    double="projected_outcome projected_pa projected_ip",
)
VALUATIONS = _schema(
    long="entity_id", date="as_of_date", integer="age", double="outcome_year1 surplus_value", boolean="cost_estimated"
)
OUTCOMES = _schema(
    long="entity_id", integer="period stint games", string="role group_code", date="as_of_date",
    double="cost outcome outcome_rep outcome_avg def_runs",
)

# The measures of the feeds. Counts are whole numbers, the rest are rates.
BAT_COUNTS = "pa ab h doubles triples hr r rbi bb so sb cs"
PITCH_COUNTS = "gs w l sv er"
BAT_RATES = "obp slg ops"
PITCH_RATES = "ip era whip"

FEED = _schema(
    long="feed_id", string="source role player_name group_code primary_pos other_pos", date="as_of_date",
    integer=f"period age {BAT_COUNTS} {PITCH_COUNTS}", double=f"avg {BAT_RATES} {PITCH_RATES} k_per_9",
)
FEATURES = _schema(
    long="entity_id", string="role group_code", date="as_of_date",
    integer=f"period age games hbp bf {BAT_COUNTS} {PITCH_COUNTS}", double=f"ba {BAT_RATES} {PITCH_RATES} so9 so_bb",
)
