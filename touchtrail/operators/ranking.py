"""Ranking: W1 and top-1 per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "_rank"
# Rows of one user that a task may sort together.
RANKED_TOGETHER = 1_000_000


def top_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key.

    Catalyst turns ``row_number = 1`` into a group limit that also runs before the
    exchange: every task sends at most one row per key, so a key holding a third of all
    rows costs one row per task on the reduce side.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def rank_interactions(
    df: DataFrame, partition: Sequence[str] = ("user_id",), divided: bool = True
) -> DataFrame:
    """Rank of every interaction of a user: latest day, lowest weight, latest time.

    Without ``divided`` a user is sorted in one task, which suits users of up to ``RANKED_TOGETHER`` rows.
    Else a user with very many interactions is not ranked in one task.  Rows are numbered within
    (user, day, weight, minute) and lifted by the size of the groups in front, which comes
    from a map-side count.  The second window sees one row per such group, however many
    interactions it holds.  ``df`` is read twice.
    """
    if not divided:
        days = [F.desc("interaction_date"), F.asc("interaction_weight"), F.desc("interaction_ts")]
        order = Window.partitionBy(*partition).orderBy(*days, F.asc("channel"), F.asc("raw_log_id"))
        return df.withColumn("attribution_rank", F.row_number().over(order).cast("bigint"))
    df = df.withColumn("_minute", F.hour("interaction_ts") * 60 + F.minute("interaction_ts"))
    groups = [*partition, "interaction_date", "interaction_weight", "_minute"]
    group_order = [F.desc("interaction_date"), F.asc("interaction_weight"), F.desc("_minute")]

    before = Window.partitionBy(*partition).orderBy(*group_order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        df.groupBy(*groups)
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_offset", F.coalesce(F.sum("_size").over(before), F.lit(0)))
        .drop("_size")
    )
    within = Window.partitionBy(*groups).orderBy(
        F.desc("interaction_ts"), F.asc("channel"), F.asc("raw_log_id")
    )
    same = F.lit(True)
    for name in groups:  # a user, day or time may be missing
        same = same & F.col(f"r.{name}").eqNullSafe(F.col(f"o.{name}"))
    numbered = df.withColumn("_local", F.row_number().over(within)).alias("r")
    return (
        numbered.join(offsets.alias("o"), same)
        .select("r.*", "o._offset")
        .withColumn("attribution_rank", F.col("_offset") + F.col("_local"))
        .drop("_minute", "_local", "_offset")
    )
