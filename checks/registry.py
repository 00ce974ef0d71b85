"""Every registered query: the engine run over tables derived from `events`."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import touchtrail as tt
from touchtrail import operators as ops
from touchtrail.constants import LEGACY_TAG_PATTERN, LOCAL_ZONE, WINDOW_DAYS
from touchtrail.functions import wall_clock_from_text
from touchtrail.operators import matching
from touchtrail.plans import layers
from touchtrail.session import scratch_path, stored
from touchtrail.sources import append_daily, drop_expired_partitions, read_event_csv, replace_dates, replace_table
from touchtrail.sources.tables import STAGED_PARTITION
from touchtrail.streaming import append_new_files

from . import derived

BACKFILL_START = dt.date(2024, 1, 20)
BACKFILL_END = dt.date(2024, 1, 28)
RETENTION_AS_OF = dt.date(2024, 4, 10)

Query = Callable[[SparkSession, str], DataFrame]

# Random keys and load times differ on every run, so they are left out of the results.
_UNSTABLE = ("stg_id", "_loaded_at", "_created_at", "_quarantined_at")


def _stable(df: DataFrame) -> DataFrame:
    return df.drop(*_UNSTABLE)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.load_events(tt.configure(spark), sf_dir)


def _staged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    events = _events(spark, sf_dir)
    return (
        tt.stage_email(derived.email_logs(events)),
        tt.stage_whatsapp(derived.whatsapp_logs(events)),
        tt.stage_crm(derived.crm_users(events)),
    )


def _over_staged(build: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, sf_dir: _stable(build(*_staged(spark, sf_dir), *args))


def _over_one(position: int, build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: _stable(build(_staged(spark, sf_dir)[position]))


def _over_mart(build: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        email, whatsapp, crm = _staged(spark, sf_dir)
        return _stable(build(tt.attribute(email, whatsapp, crm), crm))

    return run


def _over_judged(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: _stable(build(ops.judge(derived.email_logs(_events(spark, sf_dir)))))


def _with_day(logs: DataFrame) -> DataFrame:
    return logs.withColumn("event_day", F.to_date(F.substring("event_timestamp", 1, 10)))


def events_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row delivered twice, first with an outdated type; the later delivery stays."""
    logs = derived.email_logs(_events(spark, sf_dir))
    deliveries = logs.withColumn("event_type", F.lit("outdated")).withColumn("delivery", F.lit(1)).unionByName(
        logs.withColumn("delivery", F.lit(2))
    )
    return ops.deduplicate(deliveries, ["event_id"], [F.desc("delivery")]).drop("delivery")


def events_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows two full redeliveries add to a daily table that ends before the backfill start."""
    logs = _with_day(derived.email_logs(_events(spark, sf_dir)))
    table = f"{_scratch_database(spark)}.merged"
    append_daily(logs.where(F.col("event_day") < F.lit(BACKFILL_START)), table, day="event_day")
    for _ in range(2):
        tt.merge_new_events(logs, table, [F.desc("event_timestamp")])
    return spark.table(table).where(F.col("event_day") >= F.lit(BACKFILL_START)).select(*logs.columns).drop("event_day")


def events_merged_by_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge, which reads only days whose key sketches may hold an event of the batch."""
    logs = _with_day(derived.email_logs(_events(spark, sf_dir)))
    table = f"{_scratch_database(spark)}.merged"
    append_daily(logs.where("FALSE"), table, day="event_day")
    early = F.col("event_day") < F.lit(BACKFILL_START)
    for batch in (logs.where(early), logs, logs):
        tt.merge_new_events(batch, table, [F.desc("event_timestamp")], sketches=f"{table}_keys")
    return spark.table(table).where(~early).select(*logs.columns).drop("event_day")


def raw_retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = _with_day(derived.email_logs(_events(spark, sf_dir)))
    return ops.retain(logs, "event_day", RETENTION_AS_OF)


def _scratch_database(spark: SparkSession) -> str:
    """A database of its own below the shared folder; its files go when the driver ends."""
    path = scratch_path(spark)
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


def _write_csv(logs: DataFrame, folder: str) -> None:
    """CSV files with every blank kept, also at the ends of a field."""
    logs.write.csv(
        folder, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def _shuffled(build: Callable[..., DataFrame], *args) -> Query:
    """The same query with every user side taken for too large to broadcast."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        before, matching.BROADCAST_ROWS = matching.BROADCAST_ROWS, 0
        try:
            return _stable(build(*_staged(spark, sf_dir), *args))
        finally:
            matching.BROADCAST_ROWS = before

    return run


def _long_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-mail logs whose documents also hold what is beyond the parser's usual limits."""
    logs = derived.email_logs(_events(spark, sf_dir))
    number = F.substring("event_id", 2, 20).cast("bigint")
    extra = (
        F.when(number % 5 == 0, F.concat(F.repeat(F.lit("["), F.lit(1200)), F.repeat(F.lit("]"), F.lit(1200))))
        .when(number % 5 == 1, F.repeat(F.lit("7"), F.lit(1500)))
        .when(number % 5 == 2, F.concat(F.lit('{"'), F.repeat(F.lit("k"), F.lit(60_000)), F.lit('": 1}')))
        .otherwise(F.concat(F.repeat(F.lit("["), F.lit(1200)), F.repeat(F.lit("]"), F.lit(1199))))
    )
    opened = F.expr("left(message_details, length(message_details) - 1)")
    longer = F.concat(opened, F.lit(', "extra": '), extra, F.lit("}"))
    return logs.withColumn("message_details", F.when(F.col("message_details").endswith("}"), longer).otherwise(F.col("message_details")))


def gate_long_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons over documents with deep nesting, long numbers and long keys, of which some are broken."""
    return ops.judge(_long_details(spark, sf_dir)).select("event_id", "_error_reason")


def email_staged_long_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign codes of the same documents."""
    return tt.stage_email(_long_details(spark, sf_dir)).select("source_id", "campaign_code", "is_valid_json")


def duplicate_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 where there is something to find: users of the matched interactions, who come many times."""
    return tt.duplicate_users(tt.interactions_in_window(*_staged(spark, sf_dir)))


def mart_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store the documented mart, then recompute a range of days under the other mode."""
    database = _staged_layers(spark, sf_dir)
    tt.refresh_mart(spark, database, database)
    tt.refresh_mart(spark, database, database, BACKFILL_START, BACKFILL_END, mode="as_written")
    return _stable(spark.table(f"{database}.{layers.MART}"))


def ingest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the logs as CSV files, ingest them and count what was stored."""
    logs = derived.email_logs(_events(spark, sf_dir))
    database = _scratch_database(spark)
    folder = scratch_path(spark)
    _write_csv(logs, folder)
    valid, rejects = f"{database}.raw_sfmc_email_logs", f"{database}.raw_sfmc_email_logs_quarantine"
    report = tt.ingest_email_logs(spark, folder, valid, rejects, multi_line=False)
    loaded = spark.table(valid).select(F.lit(True).alias("passed")).unionByName(
        spark.table(rejects).select(F.lit(False).alias("passed"))
    )
    stored = loaded.agg(
        F.count_if("passed").alias("stored_valid_rows"),
        F.count_if(~F.col("passed")).alias("stored_quarantine_rows"),
    )
    return stored.select(
        "*",
        F.lit(report.total_rows).cast("bigint").alias("total_rows"),
        F.lit(report.valid_rows).cast("bigint").alias("valid_rows"),
        F.lit(report.quarantined_rows).cast("bigint").alias("quarantined_rows"),
        F.lit(report.quarantine_rate_pct).cast("double").alias("quarantine_rate_pct"),
        F.lit(report.high_quarantine_rate).alias("high_quarantine_rate"),
        F.lit(report.has_rejects).alias("has_rejects"),
        F.lit(report.dry_run).alias("dry_run"),
        F.lit(report.status).alias("status"),
    )


def csv_split_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logs, with line breaks in their documents, as one CSV file that is read in ranges of 64 KB."""
    logs = derived.email_logs(_events(spark, sf_dir))
    folder, size = scratch_path(spark), "spark.sql.files.maxPartitionBytes"
    _write_csv(logs.withColumn("message_details", F.replace("message_details", F.lit("{"), F.lit("{\n"))).coalesce(1), folder)
    before = spark.conf.get(size)
    spark.conf.set(size, "64k")
    try:
        return stored(read_event_csv(spark, folder, multi_line="split").select(*logs.columns))
    finally:
        spark.conf.set(size, before)


def dry_run_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dry run over the logs as CSV files: its sample of valid rows, and why others are rejected."""
    folder = scratch_path(spark)
    _write_csv(derived.email_logs(_events(spark, sf_dir)), folder)
    report = tt.ingest_email_logs(spark, folder, write=False, multi_line=False)
    shown = ["event_id", "user_email", "_error_reason"]
    valid = report.sample.where("_error_reason IS NULL").select(*shown)
    return valid.union(report.quarantine.select(*shown))


def whatsapp_staged_documented(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as the documents describe them: local times as text, campaigns in [CAMP:...] tags."""
    logs = derived.whatsapp_logs(_events(spark, sf_dir))
    clock = F.date_format("sent_at_brt", "yyyy-MM-dd HH:mm:ss")
    described = logs.withColumn("sent_at_brt", wall_clock_from_text(clock)).withColumn(
        "campaign_tag", F.regexp_replace("campaign_tag", r"^\[WA\] - (CAMP_[0-9]+) - ", "[CAMP:$1] ")
    )
    return _stable(tt.stage_whatsapp(described, tag_pattern=LEGACY_TAG_PATTERN, source_zone=LOCAL_ZONE))


def crm_staged_local_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with the conversion date in local time."""
    return _stable(tt.stage_crm(derived.crm_users(_events(spark, sf_dir)), conversion_zone=LOCAL_ZONE))


def events_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with the file it came from."""
    return ops.enrich(_events(spark, sf_dir)).drop("_ingested_at")


def raw_daily_retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs appended by day, then the days past retention dropped."""
    logs = _with_day(derived.email_logs(_events(spark, sf_dir)))
    table = f"{_scratch_database(spark)}.daily"
    append_daily(logs, table, day="event_day")
    drop_expired_partitions(spark, table, "event_day", RETENTION_AS_OF)
    return spark.table(table)


def _raw_events(events: DataFrame, database: str) -> None:
    replace_table(derived.email_logs(events), f"{database}.{layers.RAW_EMAIL}")
    replace_table(derived.whatsapp_logs(events), f"{database}.{layers.RAW_WHATSAPP}")


def _staged_layers(spark: SparkSession, sf_dir: str, early: Column | None = None) -> str:
    """Raw and staging tables, of all or only of early events, in a database of their own, whose name is returned."""
    events, database = _events(spark, sf_dir), _scratch_database(spark)
    _raw_events(events if early is None else events.where(early), database)
    replace_table(derived.crm_users(events), f"{database}.{layers.RAW_CRM}")
    tt.refresh_crm(spark, database, database)
    tt.refresh_email(spark, database, database)
    tt.refresh_whatsapp(spark, database, database)
    return database


def _layers(spark: SparkSession, sf_dir: str) -> str:
    """All layers in a database of their own, whose name is returned."""
    database = _staged_layers(spark, sf_dir)
    tt.refresh_mart(spark, database, database)
    tt.refresh_gold(spark, database, database)
    return database


def _kept_up(spark: SparkSession, sf_dir: str) -> str:
    """All layers built before a third of some days' events arrived, all of one day's among them, then kept up."""
    day = F.to_date("ts")
    late = day.between(F.lit(BACKFILL_START), F.lit(BACKFILL_END)) & (
        (F.col("event_id") % 3 == 0) | (day == F.lit(BACKFILL_START + dt.timedelta(days=3)))
    )
    database = _staged_layers(spark, sf_dir, ~late)
    tt.refresh_mart(spark, database, database)
    tt.refresh_touches(spark, database)
    tt.refresh_gold(spark, database, database)
    _raw_events(_events(spark, sf_dir), database)
    first = BACKFILL_START - dt.timedelta(days=1)  # the first hours of a day belong to the local day before
    tt.refresh_email(spark, database, database, start=first, end=BACKFILL_END)
    tt.refresh_whatsapp(spark, database, database, start=first, end=BACKFILL_END)
    tt.update_mart(spark, first, BACKFILL_END, database, database)
    tt.refresh_gold(spark, database, database, first, BACKFILL_END)
    return database


def _over_kept_up(table: str) -> Query:
    return lambda spark, sf_dir: _stable(spark.table(f"{_kept_up(spark, sf_dir)}.{table}"))


def email_staged_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged e-mails of which a range of days was lost and refreshed, and the day each is stored under."""
    database = _staged_layers(spark, sf_dir)
    table = f"{database}.{layers.STG_EMAIL}"
    replace_dates(spark.table(table).limit(0), table, BACKFILL_START, BACKFILL_END, STAGED_PARTITION)
    tt.refresh_email(spark, database, database, start=BACKFILL_START, end=BACKFILL_END)
    return _stable(spark.table(table))


def mart_from_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw tables to staging tables and views to the stored mart."""
    return _stable(spark.table(f"{_layers(spark, sf_dir)}.{layers.MART}"))


def dim_campaigns_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(f"{_layers(spark, sf_dir)}.{layers.CAMPAIGNS}")


def agg_campaign_daily_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(f"{_layers(spark, sf_dir)}.{layers.CAMPAIGN_DAILY}")


def daily_stream_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logs as files, picked up by the daily stream: rows that passed the gate."""
    logs = derived.email_logs(_events(spark, sf_dir))
    folder = scratch_path(spark)
    _write_csv(logs, f"{folder}/landing")
    append_new_files(
        spark,
        f"{folder}/landing",
        f"{folder}/valid",
        f"{folder}/quarantine",
        f"{folder}/state",
        logs.columns,
        multi_line=False,
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/valid").select(*logs.columns)


def queries() -> dict[str, Query]:
    return {
        "crm_staged": _over_one(2, lambda df: df),
        "email_staged": _over_one(0, lambda df: df),
        "email_valid": _over_one(0, tt.valid_only),
        "whatsapp_staged": _over_one(1, lambda df: df),
        "whatsapp_valid": _over_one(1, tt.valid_only),
        "gate_valid": _over_judged(ops.validated),
        "gate_quarantine": _over_judged(ops.quarantined),
        "gate_stats": _over_judged(ops.gate_stats),
        "gate_reject_summary": _over_judged(ops.reject_summary),
        "unified_interactions": _over_staged(tt.unified_interactions),
        "interactions_in_window": _over_staged(tt.interactions_in_window),
        "ranked_interactions": _over_staged(tt.ranked_interactions),
        "premium_users": _over_staged(tt.premium_users),
        "attribution_documented": _over_staged(tt.attribute, "documented"),
        "attribution_as_written": _over_staged(tt.attribute, "as_written"),
        "attribution_documented_shuffled": _shuffled(tt.attribute, "documented"),
        "attribution_as_written_shuffled": _shuffled(tt.attribute, "as_written"),
        "attribution_per_conversion": _over_staged(tt.attribute, "documented", WINDOW_DAYS, "conversion"),
        "interactions_in_window_shuffled": _shuffled(tt.interactions_in_window),
        "duplicate_contacts": duplicate_contacts,
        "gate_long_documents": gate_long_documents,
        "email_staged_long_documents": email_staged_long_documents,
        "attribution_distribution": _over_mart(lambda mart, _: tt.attribution_distribution(mart)),
        "attribution_duplicates": _over_mart(lambda mart, _: tt.duplicate_users(mart)),
        "unattributed_converters": _over_mart(tt.unattributed_converters),
        "agg_campaign_daily": _over_mart(lambda mart, _: tt.campaign_daily(mart)),
        "dim_campaigns": _over_staged(lambda email, whatsapp, _: tt.campaign_dimension(email, whatsapp)),
        "events_deduplicated": events_deduplicated,
        "events_merged": events_merged,
        "events_merged_by_sketch": events_merged_by_sketch,
        "raw_retained": raw_retained,
        "mart_backfill": mart_backfill,
        "ingest_report": ingest_report,
        "csv_split_records": csv_split_records,
        "dry_run_sample": dry_run_sample,
        "whatsapp_staged_documented": whatsapp_staged_documented,
        "crm_staged_local_date": crm_staged_local_date,
        "events_enriched": events_enriched,
        "raw_daily_retained": raw_daily_retained,
        "mart_from_layers": mart_from_layers,
        "email_staged_by_range": email_staged_by_range,
        "mart_kept_up": _over_kept_up(layers.MART),
        "dim_campaigns_kept_up": _over_kept_up(layers.CAMPAIGNS),
        "agg_campaign_daily_kept_up": _over_kept_up(layers.CAMPAIGN_DAILY),
        "dim_campaigns_stored": dim_campaigns_stored,
        "agg_campaign_daily_stored": agg_campaign_daily_stored,
        "daily_stream_valid": daily_stream_valid,
    }
