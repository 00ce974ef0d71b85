"""Evaluate costly expressions once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def with_values(df: DataFrame, **values: Column) -> DataFrame:
    """Add columns that are computed once per row, however many filters read them.

    Catalyst moves a filter below a projection by repeating the projected expression in the
    filter (also the null checks it infers for join keys), so a document would be parsed
    and a time converted again.  It does not move filters on generated columns; the values
    are therefore generated from a one-element array.
    """
    row = F.struct(*[value.alias(name) for name, value in values.items()])
    return df.select("*", F.inline(F.array(row)))
