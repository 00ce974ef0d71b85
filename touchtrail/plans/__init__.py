"""Composite plans: staging, attribution, mart upkeep and ingest."""

from .attribution import (
    attribute,
    attribute_touches,
    interactions_in_window,
    premium_users,
    ranked_interactions,
    touches_by_day,
    unified_interactions,
)
from .ingest import IngestReport, ingest_email_logs, merge_new_events
from .layers import (
    refresh_crm,
    refresh_email,
    refresh_gold,
    refresh_mart,
    refresh_touches,
    refresh_whatsapp,
    staging_tables,
    update_mart,
)
from .mart import (
    attribution_distribution,
    backfill,
    build_mart,
    campaign_daily,
    campaign_dimension,
    duplicate_users,
    unattributed_converters,
    validate_mart,
)
from .staging import stage_crm, stage_email, stage_whatsapp, valid_only

__all__ = [
    "IngestReport",
    "attribute",
    "attribute_touches",
    "attribution_distribution",
    "backfill",
    "build_mart",
    "campaign_daily",
    "campaign_dimension",
    "duplicate_users",
    "ingest_email_logs",
    "interactions_in_window",
    "merge_new_events",
    "premium_users",
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
