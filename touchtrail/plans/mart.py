"""The attribution mart: P9, P10, A2, A3, A5, A6, J5, S8, S10, X7."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..constants import WINDOW_DAYS
from ..operators.matching import interactions
from ..sources.tables import STAGED_PARTITION, replace_dates
from .attribution import Grain, Mode, attribute, attribute_touches


def between(events: DataFrame, first: dt.date | None, last: dt.date | None) -> DataFrame:
    """Events of a range of local days: partitions of a table stored by day, else bounds on the stored
    time so that files are skipped."""
    if STAGED_PARTITION in events.columns:
        day = F.col(STAGED_PARTITION)
        if first is not None:
            events = events.where(day >= F.lit(first))
        return events.where(day <= F.lit(last)) if last is not None else events
    clock = F.col("event_ts_brt")
    if first is not None:
        events = events.where(clock >= F.lit(first).cast("timestamp_ntz"))
    if last is not None:
        events = events.where(clock < F.lit(last + dt.timedelta(days=1)).cast("timestamp_ntz"))
    return events


def build_mart(
    email: DataFrame,
    whatsapp: DataFrame,
    crm: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    mode: Mode = "documented",
    days: int = WINDOW_DAYS,
    grain: Grain = "user",
) -> DataFrame:
    """Attribution of the conversions in [start, end] (open ends: all).

    The range is applied to all three inputs before anything is shuffled.
    """
    if start is not None:
        crm = crm.where(F.col("conversion_date") >= F.lit(start))
    if end is not None:
        crm = crm.where(F.col("conversion_date") <= F.lit(end))
    first = start - dt.timedelta(days=days) if start is not None else None
    return attribute(
        between(email, first, end), between(whatsapp, first, end), crm, mode, days, grain
    )


def backfill(
    table: str,
    email: DataFrame,
    whatsapp: DataFrame,
    crm: DataFrame,
    start: dt.date,
    end: dt.date,
    mode: Mode = "documented",
    days: int = WINDOW_DAYS,
    grain: Grain = "user",
) -> None:
    """Recompute [start, end] of a stored mart; other days are not touched."""
    rows = build_mart(email, whatsapp, crm, start, end, mode, days, grain)
    replace_dates(rows, table, start, end)


def backfill_touches(
    table: str,
    touches: DataFrame,
    crm: DataFrame,
    start: dt.date,
    end: dt.date,
    mode: Mode = "documented",
    days: int = WINDOW_DAYS,
    grain: Grain = "user",
) -> None:
    """Recompute the conversions that events of [start, end] can change, from touches by day.

    Those are conversions from ``start`` up to a window behind ``end``; other days are not touched.
    """
    last = end + dt.timedelta(days=days)
    day, converted = F.col("interaction_date"), F.col("conversion_date")
    near = touches.where(day.between(F.lit(start - dt.timedelta(days=days)), F.lit(last)))
    people = crm.where(converted.between(F.lit(start), F.lit(last)))
    replace_dates(attribute_touches(near, people, mode, days, grain), table, start, last)


def duplicate_users(rows: DataFrame) -> DataFrame:
    """A2: user ids found more than once; empty for a sound mart or user base."""
    return rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1")


def attribution_distribution(mart: DataFrame) -> DataFrame:
    """A3, O1: attributed conversions per channel and kind, most frequent first."""
    return (
        mart.groupBy("attributed_channel", "interaction_type_label")
        .agg(F.count(F.lit(1)).alias("conversions"))
        .orderBy(F.desc("conversions"))
    )


def unattributed_converters(mart: DataFrame, crm: DataFrame) -> DataFrame:
    """Converted users the mart does not hold."""
    converted = crm.where("is_converted").select("user_id", "conversion_date")
    return converted.join(mart.select("user_id"), "user_id", "left_anti")


def validate_mart(mart: DataFrame, crm: DataFrame) -> dict[str, DataFrame]:
    """P10: the three checks to run after a load."""
    return {
        "duplicates": duplicate_users(mart),
        "distribution": attribution_distribution(mart),
        "unattributed": unattributed_converters(mart, crm),
    }


def campaign_daily(mart: DataFrame) -> DataFrame:
    """A5: conversions per day, campaign and channel."""
    return mart.groupBy("conversion_date", "attributed_campaign", "attributed_channel").agg(
        F.count(F.lit(1)).alias("conversions")
    )


def campaign_days(email: DataFrame, whatsapp: DataFrame) -> DataFrame:
    """A6 by day: events of each campaign and channel a day, the state `campaign_dimension` is merged from."""
    return interactions(email, whatsapp).groupBy("interaction_date", "campaign_code", "channel").agg(
        F.count(F.lit(1)).alias("events")
    )


def campaigns_of(rows: DataFrame) -> DataFrame:
    """One row per campaign from events or states by day, with its first and last day and its channels."""
    return rows.groupBy("campaign_code").agg(
        F.min("interaction_date").alias("first_interaction_date"),
        F.max("interaction_date").alias("last_interaction_date"),
        F.concat_ws(",", F.array_sort(F.collect_set("channel"))).alias("channels"),
    )


def campaign_dimension(email: DataFrame, whatsapp: DataFrame) -> DataFrame:
    """One row per campaign with its first and last day and the channels it used."""
    return campaigns_of(interactions(email, whatsapp))
