"""Attribution: P6-P8.

Which event earned a user's conversion: the latest day wins, then the lowest weight, then
the latest time; sent/delivered (weight 4) counts only for users without anything better.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import DataFrame, Observation, functions as F

from ..constants import FALLBACK_WEIGHT, WINDOW_DAYS
from ..functions import surrogate_key, weight_label
from ..operators.matching import (
    day_touches,
    interactions,
    interactions_by_day,
    interactions_of_owners,
    known_weights_only,
    look_at_owners,
    Owners,
    owned_events,
)
from ..operators.ranking import RANKED_TOGETHER, rank_interactions, top_row
from ..session import stored

Mode = Literal["documented", "as_written"]
Grain = Literal["user", "conversion"]


def _last_touch() -> list:
    return [
        F.desc("interaction_date"),
        F.asc("interaction_weight"),
        F.desc("interaction_ts"),
        F.asc("channel"),
        F.asc("raw_log_id"),
        F.asc("conversion_date"),
    ]


def _group(grain: Grain) -> Sequence[str]:
    return ("user_id",) if grain == "user" else ("user_id", "conversion_date")


def unified_interactions(email: DataFrame, whatsapp: DataFrame, crm: DataFrame) -> DataFrame:
    """Every valid event of a converted user, one row per (event, user) match.

    Few users are broadcast.  Otherwise both sides are shuffled straight from their scans, so
    adaptive execution can split a skewed identity.
    """
    return interactions_of_owners(interactions(email, whatsapp), look_at_owners(crm))


def interactions_in_window(
    email: DataFrame, whatsapp: DataFrame, crm: DataFrame, days: int = WINDOW_DAYS
) -> DataFrame:
    """Interactions dated from ``days`` days before the conversion up to its day.

    The conversion date travels with the identity, so users are joined once, not twice;
    ``user_id`` must be unique in ``crm`` (see `duplicate_users`).
    """
    owners = look_at_owners(crm)
    return interactions_by_day(owned_events(interactions(email, whatsapp), owners), owners, days)


def ranked_interactions(
    email: DataFrame,
    whatsapp: DataFrame,
    crm: DataFrame,
    days: int = WINDOW_DAYS,
    grain: Grain = "user",
) -> DataFrame:
    """W1 over `interactions_in_window`.

    The rows inside the windows are few beside the logs, so they are stored once, which also tells how many
    the busiest user has (from a sketch of frequent items).  Only if those are too many for a task
    are users divided, which reads the rows twice.
    """
    group, seen = _group(grain), Observation()
    rows = interactions_in_window(email, whatsapp, crm, days)
    rows = stored(rows.observe(seen, F.call_function("approx_top_k", F.xxhash64(*group), F.lit(1)).alias("most")))
    most = seen.get["most"]
    return rank_interactions(rows, group, divided=bool(most) and most[0]["count"] > RANKED_TOGETHER)


def _touches(events: DataFrame, owners: Owners, days: int) -> DataFrame:
    """The strongest event per identity and day, joined to the users it counts for."""
    strongest = day_touches(owned_events(events, owners))
    return interactions_by_day(strongest, owners, days, split=owners.widely_shared(days))


def _stored_touches(touches: DataFrame, owners: Owners, days: int) -> DataFrame:
    """The same from a stored summary.  It comes straight from its scan, so the join can divide any key."""
    return interactions_by_day(owned_events(touches, owners), owners, days)


def touches_by_day(email: DataFrame, whatsapp: DataFrame) -> DataFrame:
    """The strongest event per channel, identity and day, whoever owns the identity.

    All that attribution needs to know of a day, in either mode: an event of unknown weight is the
    strongest only where there is no other.  Days do not affect each other, so the summary is kept
    up by replacing the days whose events changed.
    """
    return day_touches(interactions(email, whatsapp))


def premium_users(
    email: DataFrame, whatsapp: DataFrame, crm: DataFrame, days: int = WINDOW_DAYS
) -> DataFrame:
    """A1: users with anything better than sent/delivered in their window."""
    premium = interactions(email, whatsapp).where(F.col("interaction_weight") < FALLBACK_WEIGHT)
    return _touches(premium, look_at_owners(crm), days).select("user_id").distinct()


def _winners_documented(touches: DataFrame, group: Sequence[str]) -> DataFrame:
    premium_first = (F.col("interaction_weight") >= FALLBACK_WEIGHT).asc()
    return top_row(touches, group, [premium_first, *_last_touch()])


def _winners_as_written(touches: DataFrame, group: Sequence[str]) -> DataFrame:
    """Rank 1 and the lowest weight of a group in one aggregation, combined map-side.

    The struct compares field by field in the order of `_last_touch`; the columns after that
    ride along.
    """
    order = {
        "_recency": -F.unix_date("interaction_date"),
        "interaction_weight": F.col("interaction_weight"),
        "_lateness": -F.unix_micros(F.col("interaction_ts").cast("timestamp")),
        "channel": F.col("channel"),
        "raw_log_id": F.col("raw_log_id"),
        "conversion_date": F.col("conversion_date"),
    }
    ridden = {name: F.col(name) for name in touches.columns}
    fields = [column.alias(name) for name, column in {**order, **ridden}.items() if name not in group]
    first = F.min(F.struct(*fields)).alias("_first")
    weight = F.col("interaction_weight")
    return (
        touches.groupBy(*group)
        .agg(first, F.min("interaction_weight").alias("_best"))
        .select(*group, "_first.*", "_best")
        .where((weight < FALLBACK_WEIGHT) | ((weight == FALLBACK_WEIGHT) & (F.col("_best") == FALLBACK_WEIGHT)))
    )


def attribute(
    email: DataFrame,
    whatsapp: DataFrame,
    crm: DataFrame,
    mode: Mode = "documented",
    days: int = WINDOW_DAYS,
    grain: Grain = "user",
) -> DataFrame:
    """At most one winning interaction per user (or per conversion).

    ``documented`` follows the stated rule: sent/delivered stands back whenever the window
    holds anything better.  ``as_written`` ranks first and applies the rule to rank 1 only,
    so a user whose latest day holds just a sent/delivered or unknown event is dropped.

    Events are reduced to one per identity and day before they are joined.  A user then
    brings at most two channels x (days + 1) rows into the final window.
    """
    _check(mode)
    events, owners = interactions(email, whatsapp), look_at_owners(crm)
    if mode == "documented":
        events = known_weights_only(events)
    return _attributed(_touches(events, owners, days), mode, grain)


def attribute_touches(
    touches: DataFrame, crm: DataFrame, mode: Mode = "documented", days: int = WINDOW_DAYS, grain: Grain = "user"
) -> DataFrame:
    """P8 from a summary by day (`touches_by_day`): the same rows as `attribute` over its events."""
    _check(mode)
    if mode == "documented":
        touches = known_weights_only(touches)
    return _attributed(_stored_touches(touches, look_at_owners(crm), days), mode, grain)


def _check(mode: str) -> None:
    if mode not in ("documented", "as_written"):
        raise ValueError(f"unknown mode: {mode!r}")


def _attributed(touches: DataFrame, mode: Mode, grain: Grain) -> DataFrame:
    winners = (_winners_documented if mode == "documented" else _winners_as_written)(touches, _group(grain))
    return winners.select(
        surrogate_key("user_id", "conversion_date", "raw_log_id").alias("attribution_id"),
        "user_id",
        "conversion_date",
        F.col("campaign_code").alias("attributed_campaign"),
        F.col("channel").alias("attributed_channel"),
        F.col("event_type").alias("attributed_event_type"),
        F.col("interaction_weight").alias("attributed_weight"),
        F.col("interaction_date").alias("attributed_interaction_date"),
        F.col("interaction_ts").alias("attributed_interaction_ts"),
        "days_before_conversion",
        "raw_log_id",
        weight_label(F.col("interaction_weight")).alias("interaction_type_label"),
        F.current_timestamp().alias("_created_at"),
    )
