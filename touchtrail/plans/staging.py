"""Staging: P3-P5, S9.

Narrow plans: no shuffle, every column a built-in expression.  A consumer that reads a few
staged columns pays for those only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import EMAIL_CHANNEL, EMAIL_WEIGHTS, LOCAL_ZONE, TAG_PATTERN, WHATSAPP_CHANNEL, WHATSAPP_WEIGHTS
from ..functions import (
    digits,
    email_key,
    event_weight,
    instant,
    is_blank,
    local_date,
    parse_json_document,
    phone_from_digits,
    phone_key,
    surrogate_key,
    tag_code,
    wall_clock,
    with_values,
)
from ..session import require_configured

STAGED_COLUMNS = (
    "stg_id",
    "source_id",
    "user_email_normalized",
    "user_phone_normalized",
    "event_type",
    "event_ts_brt",
    "campaign_code",
    "interaction_weight",
    "channel",
    "is_valid_json",
    "_loaded_at",
)
_ENVELOPE = "_json_envelope"
_DIGITS = "_digits"


def _no_text():
    return F.lit(None).cast("string")


def _clocked(addressed: DataFrame, clock: Column, days: tuple[dt.date, dt.date] | None) -> tuple[DataFrame, Column]:
    """Rows of the local days asked for, told before their other values are worked out, and their local time."""
    if days is None:
        return addressed, clock
    timed = with_values(addressed, _clock=clock)
    return timed.where(F.col("_clock").cast("date").between(*map(F.lit, days))), F.col("_clock")


def stage_email(
    df: DataFrame,
    zone: str = LOCAL_ZONE,
    strict_time: bool = True,
    days: tuple[dt.date, dt.date] | None = None,
) -> DataFrame:
    """E-mail events with normalised key, local time, campaign and weight.

    ``days``, the first and the last, keeps only events of these local days.
    """
    require_configured(df.sparkSession)
    parsed = parse_json_document(F.col("message_details"))
    clock = wall_clock(instant(F.col("event_timestamp"), strict_time), zone)
    addressed, clock = _clocked(df.where(~is_blank(F.col("user_email"))), clock, days)
    return with_values(
        addressed.withColumn(_ENVELOPE, parsed.envelope),
        user_email_normalized=email_key(F.col("user_email")),
        event_ts_brt=clock,
        campaign_code=parsed.bound(_ENVELOPE).scalar("campaign_code"),
    ).select(
        surrogate_key().alias("stg_id"),
        F.col("event_id").alias("source_id"),
        "user_email_normalized",
        _no_text().alias("user_phone_normalized"),
        "event_type",
        "event_ts_brt",
        "campaign_code",
        event_weight(F.col("event_type"), EMAIL_WEIGHTS).alias("interaction_weight"),
        F.lit(EMAIL_CHANNEL).alias("channel"),
        F.col("campaign_code").isNotNull().alias("is_valid_json"),
        F.current_timestamp().alias("_loaded_at"),
    )


def stage_whatsapp(
    df: DataFrame,
    tag_pattern: str = TAG_PATTERN,
    zone: str = LOCAL_ZONE,
    source_zone: str = "UTC",
    days: tuple[dt.date, dt.date] | None = None,
) -> DataFrame:
    """Messages with normalised key, local time, campaign and weight.

    ``source_zone`` names the clock ``sent_at_brt`` was recorded in.  The default moves it
    from UTC to ``zone``; pass the local zone itself when the provider already sends
    local time.  ``days``, the first and the last, keeps only events of these local days.
    """
    require_configured(df.sparkSession)
    clock = wall_clock(F.col("sent_at_brt"), zone, source_zone)
    addressed, clock = _clocked(df.where(F.col("phone_clean").isNotNull()), clock, days)
    return with_values(
        addressed.withColumn(_DIGITS, digits(F.col("phone_clean"))),
        user_phone_normalized=phone_from_digits(F.col(_DIGITS)),
        event_ts_brt=clock,
        campaign_code=tag_code(F.col("campaign_tag"), tag_pattern),
    ).select(
        surrogate_key().alias("stg_id"),
        F.col("message_id").alias("source_id"),
        _no_text().alias("user_email_normalized"),
        "user_phone_normalized",
        F.col("status").alias("event_type"),
        "event_ts_brt",
        "campaign_code",
        event_weight(F.col("status"), WHATSAPP_WEIGHTS).alias("interaction_weight"),
        F.lit(WHATSAPP_CHANNEL).alias("channel"),
        F.col("campaign_code").isNotNull().alias("is_valid_json"),
        F.current_timestamp().alias("_loaded_at"),
    )


def stage_crm(df: DataFrame, conversion_zone: str = "UTC") -> DataFrame:
    """P5: users with both normalised keys and the conversion date; unconverted users stay."""
    require_configured(df.sparkSession)
    return df.select(
        "user_id",
        email_key(F.col("email")).alias("user_email_normalized"),
        phone_key(F.col("phone")).alias("user_phone_normalized"),
        local_date(F.col("conversion_at"), conversion_zone).alias("conversion_date"),
        F.col("conversion_at").isNotNull().alias("is_converted"),
        F.current_timestamp().alias("_loaded_at"),
    )


def valid_only(staged: DataFrame) -> DataFrame:
    """Rows whose campaign could be read."""
    return staged.where("is_valid_json")
