"""Row history: load metadata, retention, deduplication."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import RETENTION_DAYS
from ..functions.keys import is_blank
from .gate import ISO_UTC
from .ranking import top_row


def enrich(df: DataFrame, source_file: str | None = None) -> DataFrame:
    """M1: file each row came from and time of ingest.

    File-backed frames name the file per row, so one frame may span many files.
    """
    name = F.col("_metadata.file_name") if source_file is None else F.lit(source_file.rsplit("/", 1)[-1])
    return df.withColumns(
        {"_source_file": name, "_ingested_at": F.date_format(F.current_timestamp(), ISO_UTC)}
    )


def retain(df: DataFrame, date_col: str, as_of: dt.date, days: int = RETENTION_DAYS) -> DataFrame:
    """Rows of the last ``days`` days.  A range on the bare column, so partitions are pruned."""
    return df.where(F.col(date_col) >= F.lit(as_of - dt.timedelta(days=days)))


def deduplicate(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The newest row per key.  ``newest_first`` must order copies totally."""
    return top_row(df, keys, newest_first)


def has_key(keys: Sequence[str]) -> Column:
    """TRUE when every key column has a value other than blanks."""
    out = F.lit(True)
    for key in keys:
        out = out & ~is_blank(F.col(key).cast("string"))
    return out


def new_rows(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a deduplicated batch whose key the target does not hold yet.

    The target is first reduced to the batch's keys: a batch is small beside a history, so Spark
    can send its keys round and leave the history unshuffled.  Keys are compared as they are.
    """
    names = list(keys)
    held = target.select(*names).join(batch.select(*names).distinct(), names, "left_semi").distinct()
    return batch.join(held, names, "left_anti")


def new_copies(batch: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of a batch that have no key, as often as the target holds fewer copies of them.

    Rows are told by a digest of ``columns`` (with which are missing); counts are combined map-side.
    """
    told = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    mine = (
        batch.withColumn("_digest", told)
        .groupBy("_digest")
        .agg(F.first(F.struct(*batch.columns)).alias("_row"), F.count(F.lit(1)).alias("_n"))
    )
    held = target.select(told.alias("_digest")).groupBy("_digest").agg(F.count(F.lit(1)).alias("_held"))
    more = F.col("_n") - F.coalesce("_held", F.lit(0))
    lacking = mine.join(held, "_digest", "left").withColumn("_n", more).where("_n > 0")
    copies = F.explode(F.array_repeat(F.lit(0), F.col("_n").cast("int")))
    return lacking.select("_row", copies.alias("_copy")).select("_row.*")
