"""S11 as a file stream: pick up new event files, judge them, append by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.gate import CORRUPT, ISO_UTC, check_columns, judge, quarantined, validated
from ..session import require_configured, scratch_table
from ..sources.event_csv import CSV_OPTIONS, event_schema

_PARTITIONS = ("ingest_date", "run_id", "batch_id")
_QUERY_ID = "sql.streaming.queryId"


def append_new_files(
    spark: SparkSession,
    landing: str,
    valid_path: str,
    quarantine_path: str,
    checkpoint: str,
    columns: list[str],
    multi_line: bool = True,
) -> StreamingQuery:
    """Append all files not seen before, then stop.

    ``columns`` is the header order of the files.  ``ingest_date`` is the day a file
    arrived.  Each batch overwrites its own partitions only, so a batch repeated after a
    failure leaves no copies.  ``run_id`` is the identity Spark keeps in the checkpoint: other
    streams into the same target, and a stream whose checkpoint was lost, write elsewhere.  (A
    stream without its checkpoint reads all files again, beside the partitions of the lost run.)
    """
    require_configured(spark)
    check_columns(columns)
    raw = (
        spark.readStream.schema(event_schema(columns))
        .options(**CSV_OPTIONS, multiLine=str(multi_line).lower())
        .csv(landing)
    )
    texts = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns]
    events = raw.select(
        *texts,
        CORRUPT,
        F.col("_metadata.file_name").alias("_source_file"),
        F.col("_metadata.file_modification_time").cast("date").alias("ingest_date"),
    ).withColumn("_ingested_at", F.date_format(F.current_timestamp(), ISO_UTC))

    def load(batch: DataFrame, batch_id: int) -> None:
        run = F.lit(spark.sparkContext.getLocalProperty(_QUERY_ID))
        named = judge(batch).withColumns({"run_id": run, "batch_id": F.lit(batch_id)})
        with scratch_table(named) as rows:
            for part, path in ((validated(rows), valid_path), (quarantined(rows), quarantine_path)):
                (
                    part.write.mode("overwrite")
                    .option("partitionOverwriteMode", "dynamic")
                    .partitionBy(*_PARTITIONS)
                    .parquet(path)
                )

    return (
        events.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
