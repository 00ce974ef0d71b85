"""Reusable DataFrame operators."""

from .gate import (
    GateResult,
    gate_stats,
    judge,
    quality_gate,
    quarantined,
    reject_summary,
    validated,
    with_parser_messages,
)
from .history import deduplicate, enrich, new_rows, retain
from .matching import (
    day_touches,
    identities,
    interactions,
    interactions_by_day,
    interactions_of_owners,
    look_at_owners,
    owned_events,
)
from .ranking import rank_interactions, top_row

__all__ = [
    "GateResult",
    "day_touches",
    "deduplicate",
    "enrich",
    "gate_stats",
    "identities",
    "interactions",
    "interactions_by_day",
    "interactions_of_owners",
    "look_at_owners",
    "judge",
    "new_rows",
    "owned_events",
    "quality_gate",
    "quarantined",
    "rank_interactions",
    "reject_summary",
    "retain",
    "top_row",
    "validated",
    "with_parser_messages",
]
