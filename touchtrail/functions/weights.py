"""Interaction weights and labels: F13, F14, F20."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, functions as F

from ..constants import UNKNOWN_LABEL, UNKNOWN_WEIGHT, WEIGHT_LABELS


def _lookup(value: Column, table: Mapping, default) -> Column:
    first, *rest = table.items()
    arms = reduce(lambda c, kv: c.when(value == kv[0], F.lit(kv[1])), rest, F.when(value == first[0], F.lit(first[1])))
    return arms.otherwise(F.lit(default))


def event_weight(event_type: Column, weights: Mapping[str, int], default: int = UNKNOWN_WEIGHT) -> Column:
    """Exact, case-sensitive match; NULL and unknown types get ``default``."""
    return _lookup(event_type, weights, default)


def weight_label(weight: Column) -> Column:
    """Readable name of a weight."""
    return _lookup(weight, WEIGHT_LABELS, UNKNOWN_LABEL)
