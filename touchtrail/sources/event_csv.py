"""CSV source: S1, S2, M1's file name.

All columns are read as text, in the order of the file's own header.  Missing fields come
back as empty texts, never NULL.  Lines that do not split into the header's fields keep
their original text in ``_corrupt_record`` for the quality gate.
"""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.gate import CORRUPT, check_columns
from .csv_records import split_records

# A quote inside a field is doubled; header names must match the schema in every file.
# Without pruning a record is checked for all its fields, whatever columns a query reads.
CSV_OPTIONS = {
    "columnPruning": "false",
    "header": "true",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "enforceSchema": "false",
}


def event_schema(columns: list[str]) -> T.StructType:
    fields = [T.StructField(name, T.StringType()) for name in [*columns, CORRUPT]]
    return T.StructType(fields)


def read_event_csv(spark: SparkSession, path: str, multi_line: bool | Literal["split"] = True) -> DataFrame:
    """Read one file, a folder or a glob.  A missing path raises Spark's own error.

    Fields may hold line breaks, so by default each file is read in one task, whatever it holds.
    ``multi_line=False`` says that no field of these files does, and lets Spark split them.
    ``"split"`` lets many tasks read a file all the same, if its quotes are balanced (`split_records`).
    """
    columns = spark.read.options(header="true", quote='"', escape='"').csv(path).columns
    check_columns(columns)
    if multi_line == "split":
        raw = _split_csv(spark, path, columns)
    else:
        raw = (
            spark.read.schema(event_schema(columns))
            .options(**CSV_OPTIONS, multiLine=str(multi_line).lower())
            .csv(path)
            .select("*", F.col("_metadata.file_name").alias("_source_file"))
        )
    texts = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns]
    return raw.select(*texts, CORRUPT, "_source_file")


def _split_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Columns as text, the line of a malformed record, and the file's name; every header must be the same."""
    records = split_records(spark, path)
    options = {k: v for k, v in CSV_OPTIONS.items() if k not in ("header", "enforceSchema", "columnPruning")}
    parsed = F.from_csv("record", event_schema(columns).toDDL(), options)
    header = F.concat_ws("\x1f", *(F.col(f"fields.{c}") for c in columns))
    odd_one = F.raise_error(F.concat(F.lit("CSV header does not conform to the schema: "), F.col("record")))
    sound = F.when(F.col("first") & (header != F.lit("\x1f".join(columns))), odd_one.cast("boolean"))
    rows = records.withColumn("fields", parsed).where(F.coalesce(sound, ~F.col("first")))
    return rows.select("fields.*", F.element_at(F.split("file", "/"), -1).alias("_source_file"))
