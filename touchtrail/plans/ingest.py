"""Quality-gated ingest: P2, S1-S6, M1, Q9-Q12, S13."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..constants import QUARANTINE_ALERT_PCT
from ..operators.gate import ISO_UTC, judge, quarantined, sample_rows, stats_columns, validated
from ..operators.history import deduplicate, has_key, new_copies, new_rows
from ..session import scratch_table
from ..sources.event_csv import read_event_csv
from ..sources.key_sketch import add_sketches, days_that_may_hold
from ..sources.tables import append_table, replace_table

VALID_TABLE = "raw_sfmc_email_logs"
QUARANTINE_TABLE = "raw_sfmc_email_logs_quarantine"
SAMPLE_ROWS = 5


@dataclass(frozen=True)
class IngestReport:
    """Q11: outcome of one run.

    After a dry run ``sample`` holds a few valid and rejected rows (Q12).  The other frames are lazy plans
    over the input.
    """

    total_rows: int
    valid_rows: int
    quarantined_rows: int
    quarantine_rate_pct: float
    high_quarantine_rate: bool
    has_rejects: bool
    source_file: str
    execution_time_s: float
    dry_run: bool
    status: str
    valid: DataFrame
    quarantine: DataFrame
    sample: DataFrame | None = None


def ingest_email_logs(
    spark: SparkSession,
    path: str,
    valid_table: str = VALID_TABLE,
    quarantine_table: str = QUARANTINE_TABLE,
    write: bool = True,
    alert_pct: float = QUARANTINE_ALERT_PCT,
    multi_line: bool | Literal["split"] = True,
    sample: int = SAMPLE_ROWS,
) -> IngestReport:
    """Read, judge, replace the valid table, append to the quarantine table.

    Texts are split and parsed once: the judged rows go to a scratch table in columnar form,
    are counted on the way and loaded from there.  An input without any valid row leaves the
    old valid table in place, one without rejects leaves the quarantine table alone.  Without ``write``
    rows are counted and ``sample`` of each kind picked in one pass (`sample_rows`).
    """
    started = time.monotonic()
    judged = judge(read_event_csv(spark, path, multi_line)).withColumn(
        "_ingested_at", F.date_format(F.current_timestamp(), ISO_UTC)
    )
    counts, picked = Observation(), None
    if write:
        with scratch_table(judged.observe(counts, *stats_columns())) as rows:
            total, passed = counts.get["total_rows"], counts.get["valid_rows"]
            if passed:
                replace_table(validated(rows), valid_table)
            if passed < total:
                append_table(quarantined(rows), quarantine_table)
    else:
        rows = sample_rows(judged.observe(counts, *stats_columns()), sample)
        picked = spark.createDataFrame(rows.collect(), rows.schema)  # at most two times ``sample`` rows
        total, passed = counts.get["total_rows"], counts.get["valid_rows"]
    rejected = total - passed

    rate = round(rejected / total * 100, 2) if total else 0
    return IngestReport(
        total_rows=total,
        valid_rows=passed,
        quarantined_rows=rejected,
        quarantine_rate_pct=rate,
        high_quarantine_rate=rate > alert_pct,
        has_rejects=rejected > 0,
        source_file=path,
        execution_time_s=round(time.monotonic() - started, 2),
        dry_run=not write,
        status="success",
        valid=validated(judged),
        quarantine=quarantined(judged),
        sample=picked,
    )


def merge_new_events(
    batch: DataFrame,
    table: str,
    newest_first: Sequence[Column],
    keys: Sequence[str] = ("event_id",),
    held_in: Column | None = None,
    sketches: str | None = None,
    day: str = "event_day",
) -> None:
    """Append the events a stored table does not hold yet, one row per key.

    Rows whose key is missing or blank are events of their own and never merged.  They are told
    by their content (all columns but those that begin with an underscore): of equal rows the
    table holds as many as the batch with the most of them.  A rerun finds its own rows and adds
    nothing.  ``held_in`` may narrow the stored rows to compare with, such as a range of days; the
    caller then vouches that no key of the batch is stored outside.

    With ``sketches`` (a prefix of table names) only days are read that may hold a key of the batch, told
    by sketches of each ``day``'s keys; a day that was never sketched is read.  All loads of such a table
    must come this way.  Rows without a key have no sketch, so for a batch with such rows all days are read.
    """
    spark = batch.sparkSession
    stored = spark.table(table)
    if held_in is not None:
        stored = stored.where(held_in)
    if sketches is not None and batch.where(~has_key(keys)).isEmpty():
        days = days_that_may_hold(spark, batch.where(has_key(keys)), table, sketches, keys, day)
        stored = stored.where(F.col(day).isin(days) if days else F.lit(False))
    columns = [c for c in stored.columns if not c.startswith("_")]
    keyed = new_rows(deduplicate(batch.where(has_key(keys)), keys, newest_first), stored, keys)
    keyless = new_copies(batch.where(~has_key(keys)), stored.where(~has_key(keys)), columns)
    fresh = keyed.unionByName(keyless)
    if sketches is None:
        append_table(fresh, table)
        return
    with scratch_table(fresh) as rows:  # sketched, then appended: the same rows
        add_sketches(rows.where(has_key(keys)), sketches, keys, day)
        append_table(rows, table)
