"""Parquet tables in the session catalog: S3-S5, S7, S8, S10-S12."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..constants import RETENTION_DAYS

MART_PARTITION = "conversion_date"
MART_CLUSTERING = ("attributed_campaign", "attributed_channel")
STAGED_PARTITION = "event_day"


def _split(table: str) -> tuple[str, str]:
    """Prefix with the dot (empty without a database) and bare name."""
    database, dot, name = table.rpartition(".")
    return f"{database}{dot}", name


def _left_over(spark: SparkSession, table: str, kind: str) -> list[str]:
    """Tables that an interrupted replacement left beside ``table``."""
    prefix, name = _split(table)
    where = f" IN {prefix[:-1]}" if prefix else ""
    found = spark.sql(f"SHOW TABLES{where}").where(F.col("tableName").startswith(f"{name}__{kind}_".lower()))
    return sorted(prefix + row.tableName for row in found.collect())


def recover_table(spark: SparkSession, table: str) -> None:
    """Undo or finish a replacement that was interrupted.

    The old rows stand under the backup name until the new ones have the table's name, so a
    missing table comes back from there.  Without a backup (a first load) complete new rows take
    the name: a table is listed only once its rows are written.  What is left then is dropped.
    """
    backups, fresh = (_left_over(spark, table, kind) for kind in ("old", "new"))
    if (backups or fresh) and not spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {(backups or fresh)[-1]} RENAME TO {table}")
    for name in (*backups, *fresh):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def replace_table(df: DataFrame, table: str) -> None:
    """Replace all rows; a rerun gives the same table.

    The new rows are written under a name of their own.  Then the old table steps aside under a
    backup name, the new one takes its place, and the backup goes: at every moment one complete
    copy is listed, and the next run puts it in place (`recover_table`).  ``df`` may read the table
    it replaces.  One run at a time may replace a table.
    """
    spark, run = df.sparkSession, uuid.uuid4().hex
    recover_table(spark, table)
    prefix, name = _split(table)
    fresh, backup = f"{prefix}{name}__new_{run}", f"{prefix}{name}__old_{run}"
    df.write.format("parquet").saveAsTable(fresh)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {backup}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {backup}")


def append_table(df: DataFrame, table: str) -> None:
    """Add rows, creating the table on first use; an existing one keeps its partitioning."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        df.select(*spark.table(table).columns).write.insertInto(table)
    else:
        df.write.format("parquet").saveAsTable(table)


def append_daily(df: DataFrame, table: str, day: str = "ingest_date") -> None:
    """Add rows to a table partitioned by day."""
    df.write.format("parquet").partitionBy(day).mode("append").saveAsTable(table)


def _by_day(df: DataFrame, column: str) -> DataFrame:
    """Rows of a day together in few files: adaptive execution divides busy days and joins quiet ones."""
    return df.hint("rebalance", column)


def _days_seen(df: DataFrame, column: str, seen: Observation | None) -> DataFrame:
    if seen is None:
        return df
    return df.observe(seen, F.collect_set(column).alias("days"), F.count_if(F.col(column).isNull()).alias("without"))


def _laid_out(df: DataFrame, days_seen: Observation | None = None) -> DataFrame:
    """Range partitions by day and clustering columns, sorted inside.

    The key column last makes range boundaries fall inside a busy day or campaign too, so no
    task writes a whole day alone; each file still covers a narrow range of campaigns.
    """
    keys = [MART_PARTITION, *MART_CLUSTERING]
    ranged = _days_seen(df.repartitionByRange(*keys, "user_id"), MART_PARTITION, days_seen)
    return ranged.sortWithinPartitions(*keys)


def replace_mart(df: DataFrame, table: str) -> None:
    """Rebuild the whole partitioned mart, creating it on first use."""
    if df.sparkSession.catalog.tableExists(table):
        replace_dates(df, table)
    else:
        _laid_out(df).write.format("parquet").partitionBy(MART_PARTITION).saveAsTable(table)


def partition_dates(
    spark: SparkSession,
    table: str,
    column: str = MART_PARTITION,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> list[dt.date]:
    """Dates the table holds partitions for: catalog metadata, one entry per day.

    Reads the day from a partition name such as ``conversion_date=2024-01-31``; partitions
    without a date (NULL) are left out.
    """
    day = F.to_date(F.regexp_extract("partition", rf"{column}=(\d{{4}}-\d{{2}}-\d{{2}})", 1))
    named = spark.sql(f"SHOW PARTITIONS {table}").where(F.col("partition").rlike(rf"{column}=\d{{4}}-"))
    days = named.select(day.alias("day"))
    if start is not None:
        days = days.where(F.col("day") >= F.lit(start))
    if end is not None:
        days = days.where(F.col("day") <= F.lit(end))
    return sorted(row.day for row in days.distinct().collect())


def _drop_dates(spark: SparkSession, table: str, column: str, days: list[dt.date]) -> None:
    if days:
        parts = ", ".join(f"PARTITION ({column}=DATE'{day.isoformat()}')" for day in days)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Let an overwrite touch only the partitions it writes.

    Inserting into a catalog table takes this from the session only; as a write option it
    is ignored, and the whole table would be replaced.
    """
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def is_partitioned_by(spark: SparkSession, table: str, column: str) -> bool:
    """TRUE when the table exists and its rows are stored by ``column``."""
    if not spark.catalog.tableExists(table):
        return False
    return any(c.name == column and c.isPartition for c in spark.catalog.listColumns(table))


def replace_dates(
    df: DataFrame,
    table: str,
    start: dt.date | None = None,
    end: dt.date | None = None,
    column: str = MART_PARTITION,
) -> None:
    """Make the table's days in [start, end] hold exactly ``df`` (open ends: all days).

    Days with rows are overwritten by a dynamic partition write.  Days that lost all their
    rows are not touched by that write, so they are dropped after it: the old rows stay
    whole until the new ones are in place, and a rerun ends in the same state.
    """
    spark, date = df.sparkSession, F.col(column)
    if start is not None:
        df = df.where(date >= F.lit(start))
    if end is not None:
        df = df.where(date <= F.lit(end))
    before = partition_dates(spark, table, column, start, end)
    seen = Observation()
    rows = df.select(*spark.table(table).columns)
    clustered = {MART_PARTITION, *MART_CLUSTERING, "user_id"} <= set(rows.columns)
    laid = _laid_out(rows, seen) if clustered else _days_seen(_by_day(rows, column), column, seen)
    with _dynamic_overwrite(spark):
        laid.write.mode("overwrite").insertInto(table)
    kept = set(seen.get["days"])
    _drop_dates(spark, table, column, [day for day in before if day not in kept])
    if start is None and end is None and not seen.get["without"]:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({column}=NULL)")


def replace_days(df: DataFrame, table: str, column: str) -> None:
    """Replace all rows of a table stored by ``column``, day by day as `replace_dates` does.

    A table of another layout steps aside under a backup name until the new one is listed; an interrupted
    run is put right by the next (`recover_table`).
    """
    spark = df.sparkSession
    recover_table(spark, table)
    same = is_partitioned_by(spark, table, column) and set(spark.table(table).columns) == set(df.columns)
    if same:
        replace_dates(df, table, column=column)
        return
    prefix, name = _split(table)
    backup = f"{prefix}{name}__old_{uuid.uuid4().hex}"
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {backup}")
    _by_day(df, column).write.format("parquet").partitionBy(column).saveAsTable(table)
    spark.sql(f"DROP TABLE IF EXISTS {backup}")


def drop_expired_partitions(
    spark: SparkSession, table: str, column: str, as_of: dt.date, days: int = RETENTION_DAYS
) -> list[dt.date]:
    """Drop whole days older than ``days`` days; returns the days dropped."""
    limit = as_of - dt.timedelta(days=days)
    expired = partition_dates(spark, table, column, end=limit - dt.timedelta(days=1))
    _drop_dates(spark, table, column, expired)
    return expired
