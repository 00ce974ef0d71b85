"""Matching interactions to converted users: J1-J3, X3, X5, U1.

Both channels are matched the same way: an event carries (channel, identity) where the
identity is the address for e-mail and the number for messages; a converted user owns one
identity per channel.  One union therefore needs one exchange and one join.

The seven-day window is a range condition.  Each user's window is unrolled into its days
instead, so the join is an equi-join on (channel, identity, day): the user side grows by
the window length, the event side (the large one) is neither copied nor compared pairwise,
and a popular identity is spread over its days.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, functions as F

from ..constants import EMAIL_CHANNEL, WEIGHT_LABELS, WHATSAPP_CHANNEL, WINDOW_DAYS
from ..session import stored
from .ranking import top_row

# Bounds of a broadcast: rows, and bytes of text in them.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
# Owners of one identity from which the join with day touches must be able to divide it.
SHARED_BY = 10_000

_OWNER_KEY = ["channel", "identity"]
_SPLIT = "_split"
_DAY_KEY = [*_OWNER_KEY, "interaction_date"]
_INTERACTION = [
    "user_id",
    "event_type",
    "interaction_date",
    "interaction_ts",
    "campaign_code",
    "interaction_weight",
    "channel",
    "raw_log_id",
]


def interactions(email: DataFrame, whatsapp: DataFrame) -> DataFrame:
    """Valid staged events of both channels, keyed by (channel, identity)."""

    def keyed(df: DataFrame, identity: str) -> DataFrame:
        return df.where("is_valid_json").select(
            "channel",
            F.col(identity).alias("identity"),
            "event_type",
            F.col("event_ts_brt").cast("date").alias("interaction_date"),
            F.col("event_ts_brt").alias("interaction_ts"),
            "campaign_code",
            "interaction_weight",
            F.col("source_id").alias("raw_log_id"),
        )

    return keyed(email, "user_email_normalized").unionByName(keyed(whatsapp, "user_phone_normalized"))


def known_weights_only(events: DataFrame) -> DataFrame:
    """Rows whose weight has a label; the others can never be attributed."""
    return events.where(F.col("interaction_weight") <= max(WEIGHT_LABELS))


def identities(crm: DataFrame) -> DataFrame:
    """(channel, identity, user_id, conversion_date) of converted users.

    No event has a blank identity, so users without an address or number are left out here.
    """
    pairs = F.array(
        F.struct(F.lit(EMAIL_CHANNEL).alias("channel"), F.col("user_email_normalized").alias("identity")),
        F.struct(F.lit(WHATSAPP_CHANNEL).alias("channel"), F.col("user_phone_normalized").alias("identity")),
    )
    return (
        crm.where("is_converted")
        .select("user_id", "conversion_date", F.inline(pairs))
        .where(F.col("identity") != "")
    )


def unrolled(owners: DataFrame, days: int) -> DataFrame:
    """One row per identity and day of the closed window before a conversion."""
    return owners.withColumn(
        "interaction_date",
        F.explode(F.sequence(F.date_sub("conversion_date", days), F.col("conversion_date"))),
    )


class Owners(NamedTuple):
    """Identities of converted users, stored, and what one look at them told."""

    rows: DataFrame
    size: tuple[int, int] | None
    shared: int

    def fit(self, copies: int = 1) -> bool:
        """TRUE when so many copies of them may be broadcast."""
        return _may_broadcast(self.size, copies)

    def widely_shared(self, days: int) -> bool:
        """TRUE when users too many to broadcast share one identity by the thousands."""
        return not self.fit(days + 1) and self.shared > SHARED_BY


def look_at_owners(crm: DataFrame) -> Owners:
    """X3 stored: rows, text bytes and how many users share one identity, all from the job that writes them.

    Users are derived once, however often a plan reads them.  Every broadcast of this module rests on
    the counts; planner estimates would miss that windows are unrolled.  The most shared identity comes
    from a sketch of frequent items, which may take it for more shared than it is but not for less.
    """
    seen = Observation()
    identity = F.xxhash64(*_OWNER_KEY)
    text = F.octet_length("identity") + F.octet_length("user_id")
    rows = identities(crm).observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(text), F.lit(0)).alias("bytes"),
        F.call_function("approx_top_k", identity, F.lit(1)).alias("most"),
    )
    kept = stored(rows)
    found = seen.get
    size = (found["rows"], found["bytes"])
    shared = found["most"][0]["count"] if found["most"] else 0
    return Owners(kept, size if _may_broadcast(size) else None, shared)


def _may_broadcast(size: tuple[int, int] | None, copies: int = 1) -> bool:
    return size is not None and size[0] * copies <= BROADCAST_ROWS and size[1] * copies <= BROADCAST_BYTES


def owned_events(events: DataFrame, owners: Owners) -> DataFrame:
    """Early drop of events whose identity no converted user owns, while those are few.

    The identities are broadcast and events filtered where they are read.  With many owners
    the events pass unfiltered and the later join does the same work, shuffled.
    """
    if not owners.fit():
        return events
    return events.join(F.broadcast(owners.rows.select(*_OWNER_KEY)), _OWNER_KEY, "left_semi")


def interactions_of_owners(events: DataFrame, owners: Owners) -> DataFrame:
    """Every event with each user who owns its identity, whatever the date.

    An identity that several users share gives each of them every event; that is the rule, so the
    result has events x owners of it.  The mart goes through `interactions_by_day` instead.
    """
    users = owners.rows.select(*_OWNER_KEY, "user_id")
    users = F.broadcast(users) if owners.fit() else users.hint("merge")
    return events.join(users, _OWNER_KEY).select(*_INTERACTION)


def day_touches(events: DataFrame) -> DataFrame:
    """The strongest event per identity and day: lowest weight, latest time.

    Window and day order treat all events of a day alike, so no other event of that day
    can win for any user.  Only these rows reach the join; the group limit runs before the
    exchange, and the exchange is the one the join needs.
    """
    order = [F.asc("interaction_weight"), F.desc("interaction_ts"), F.asc("raw_log_id")]
    return top_row(events, _DAY_KEY, order)


def interactions_by_day(
    events: DataFrame, owners: Owners, days: int = WINDOW_DAYS, split: bool = False
) -> DataFrame:
    """Events (or day touches) inside the window of the users they belong to.

    Day touches come grouped by the join's key, and Spark then cannot divide a key.  ``split`` adds
    a column to the key, so both sides are exchanged for the join itself and adaptive execution
    divides a number that very many users share.  The rows are the same.
    """
    windows, keys = unrolled(owners.rows, days), _DAY_KEY
    windows = F.broadcast(windows) if owners.fit(days + 1) else windows.hint("merge")
    if split:
        windows, events = (df.withColumn(_SPLIT, F.xxhash64(*_DAY_KEY)) for df in (windows, events))
        keys = [*_DAY_KEY, _SPLIT]
    return (
        events.join(windows, keys)
        .select(*_INTERACTION, "conversion_date")
        .withColumn("days_before_conversion", F.datediff("conversion_date", "interaction_date"))
    )
