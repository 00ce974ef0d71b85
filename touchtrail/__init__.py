"""Weighted last-touch campaign attribution on Spark DataFrames."""

from .plans import (
    IngestReport,
    attribute,
    attribute_touches,
    attribution_distribution,
    backfill,
    build_mart,
    campaign_daily,
    campaign_dimension,
    duplicate_users,
    ingest_email_logs,
    interactions_in_window,
    merge_new_events,
    premium_users,
    ranked_interactions,
    refresh_crm,
    refresh_email,
    refresh_gold,
    refresh_mart,
    refresh_touches,
    refresh_whatsapp,
    stage_crm,
    stage_email,
    stage_whatsapp,
    staging_tables,
    touches_by_day,
    unattributed_converters,
    unified_interactions,
    update_mart,
    valid_only,
    validate_mart,
)
from .operators import quality_gate
from .session import configure

__all__ = [
    "IngestReport",
    "attribute",
    "attribute_touches",
    "attribution_distribution",
    "backfill",
    "build_mart",
    "campaign_daily",
    "campaign_dimension",
    "configure",
    "duplicate_users",
    "ingest_email_logs",
    "interactions_in_window",
    "merge_new_events",
    "premium_users",
    "quality_gate",
    "ranked_interactions",
    "refresh_crm",
    "refresh_email",
    "refresh_gold",
    "refresh_mart",
    "refresh_touches",
    "refresh_whatsapp",
    "stage_crm",
    "stage_email",
    "stage_whatsapp",
    "staging_tables",
    "touches_by_day",
    "unattributed_converters",
    "unified_interactions",
    "update_mart",
    "valid_only",
    "validate_mart",
]
