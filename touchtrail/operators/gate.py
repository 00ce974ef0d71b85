"""Quality gate: Q1-Q9, P1.

`judge` adds one nullable reason column; everything else filters or counts on it.  The
plan is narrow: no shuffle, one JSON parse per row, no Python in the row path.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..constants import (
    MISSING_COLUMNS_MESSAGE,
    QUARANTINE_ALERT_PCT,
    REASON_BAD_RECORD,
    REASON_EMPTY,
    REASON_MALFORMED,
    REASON_MALFORMED_PREFIX,
    REASON_MISSING_KEYS_PREFIX,
    REASON_NOT_OBJECT,
    REQUIRED_COLUMNS,
    REQUIRED_JSON_KEYS,
)
from ..functions.json_errors import message
from ..functions.keys import is_blank
from ..functions.once import with_values
from ..functions.payload import parse_json_document
from ..session import require_configured

REASON = "_error_reason"
CORRUPT = "_corrupt_record"
_ENVELOPE, _IS_JSON = "_json_envelope", "_is_json"
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


class GateResult(NamedTuple):
    valid: DataFrame
    quarantine: DataFrame
    stats: DataFrame


def check_columns(columns: Sequence[str], required: Sequence[str] = REQUIRED_COLUMNS) -> None:
    """Q1: fail at plan time when a required column is absent; extra columns pass."""
    missing = sorted(set(required) - set(columns))
    if missing:
        raise ValueError(f"input lacks required columns ({MISSING_COLUMNS_MESSAGE}): {missing}")


def judge(
    df: DataFrame,
    json_col: str = "message_details",
    required_keys: Sequence[str] = REQUIRED_JSON_KEYS,
    required_cols: Sequence[str] = REQUIRED_COLUMNS,
) -> DataFrame:
    """Q1-Q4: the input plus ``_error_reason``, NULL on rows that pass.

    Rows a CSV source could not split into fields arrive with ``_corrupt_record`` set and
    are rejected with their original line kept.
    """
    require_configured(df.sparkSession)
    check_columns(df.columns, required_cols)

    keys = sorted(required_keys)
    parsed = parse_json_document(F.col(json_col), allow_non_finite=True)
    document = parsed.bound(_ENVELOPE, _IS_JSON)

    has_all = F.lit(True)
    for key in keys:
        has_all = has_all & document.has_key(key)
    if not keys:
        has_all = document.is_object
    absent = F.concat_ws(
        ", ", *[F.when(~document.has_key(key), F.lit(f"'{key}'")) for key in keys]
    )
    missing_reason = F.concat(F.lit(REASON_MISSING_KEYS_PREFIX + "{"), absent, F.lit("}"))

    # Only an object can own a key, so the common case ends at the first arm.
    reason = (
        F.when(document.is_json & has_all, F.lit(None).cast("string"))
        .when(is_blank(F.col(json_col)), F.lit(REASON_EMPTY))
        .when(~document.is_json, F.lit(REASON_MALFORMED))
        .when(~document.is_object, F.lit(REASON_NOT_OBJECT))
        .otherwise(missing_reason)
    )
    if CORRUPT in df.columns:
        reason = F.when(F.col(CORRUPT).isNotNull(), F.lit(REASON_BAD_RECORD)).otherwise(reason)
    told = with_values(df.withColumn(_ENVELOPE, parsed.envelope), **{_IS_JSON: parsed.bound(_ENVELOPE).is_json})
    return with_values(told, **{REASON: reason}).drop(_ENVELOPE, _IS_JSON)


def validated(judged: DataFrame) -> DataFrame:
    """Q5: rows that passed, in their original columns."""
    return judged.where(F.col(REASON).isNull()).drop(REASON, CORRUPT)


def quarantined(judged: DataFrame) -> DataFrame:
    """Q5, Q6: rejected rows with reason and UTC time of rejection."""
    return judged.where(F.col(REASON).isNotNull()).withColumn(
        "_quarantined_at", F.date_format(F.current_timestamp(), ISO_UTC)
    )


def stats_columns() -> list:
    """The two counts behind every statistic; map-side sums, one row per task is shuffled."""
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(REASON).isNull()).alias("valid_rows"),
    ]


def sample_rows(judged: DataFrame, n: int) -> DataFrame:
    """Q12, L1: up to ``n`` valid rows and ``n`` rejected ones.

    Those whose content hashes lowest (all columns but those that begin with an underscore), so every
    rerun and every partitioning gives the same ones.  A task sends no more than ``n`` of each.
    """
    told = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in judged.columns if not c.startswith("_")]
    digest = F.sha2(F.concat_ws("\x1f", *told), 256)
    lowest = Window.partitionBy(F.col(REASON).isNull()).orderBy(digest, *told)
    return judged.withColumn("_place", F.row_number().over(lowest)).where(F.col("_place") <= n).drop("_place")


def reject_rate(rejected: Column, total: Column) -> Column:
    """Q7: percent of rejected rows at two places, 0 for an empty input; equal to Python's ``round``.

    Python rounds the exact binary value, half to even, while Spark rounds its shortest decimal
    text.  The fraction is therefore taken as a whole number of 2^-60 and divided exactly.  (Below
    2^-8 a double may be finer than that; such a rate rounds to 0 either way.)
    """
    pct = rejected / total * 100
    whole = F.floor(pct)
    unit = F.lit(1 << 60).cast("decimal(19,0)")
    hundredfold = ((pct - whole) * float(1 << 60)).cast("bigint").cast("decimal(19,0)") * 100
    rest = hundredfold % unit
    hundredths = ((hundredfold - rest) / unit).cast("bigint")
    up = (rest * 2 > unit) | ((rest * 2 == unit) & (hundredths % 2 == 1))
    rounded = (whole * 100 + hundredths + up.cast("int")) / F.lit(100.0)
    return F.when(total == 0, F.lit(0.0)).otherwise(rounded)


def gate_stats(judged: DataFrame, alert_pct: float = QUARANTINE_ALERT_PCT) -> DataFrame:
    """Q7, Q8, Q10: counts, reject rate in percent and flags."""
    total, valid = F.col("total_rows"), F.col("valid_rows")
    rejected = total - valid
    rate = reject_rate(rejected, total)
    return (
        judged.agg(*stats_columns())
        .select(total, valid, rejected.alias("quarantined_rows"), rate.alias("quarantine_rate_pct"))
        .withColumn("high_quarantine_rate", F.col("quarantine_rate_pct") > alert_pct)
        .withColumn("has_rejects", F.col("quarantined_rows") > 0)
    )


def reject_summary(judged: DataFrame) -> DataFrame:
    """Q9: rejected rows per reason."""
    return judged.where(F.col(REASON).isNotNull()).groupBy(REASON).agg(F.count(F.lit(1)).alias("rejected_rows"))


def quality_gate(
    df: DataFrame,
    required_cols: Sequence[str] = REQUIRED_COLUMNS,
    json_col: str = "message_details",
    required_keys: Sequence[str] = REQUIRED_JSON_KEYS,
    alert_pct: float = QUARANTINE_ALERT_PCT,
) -> GateResult:
    """Lazy valid, quarantine and statistics frames over one judged plan."""
    judged = judge(df, json_col, required_keys, required_cols)
    return GateResult(validated(judged), quarantined(judged), gate_stats(judged, alert_pct))


def with_parser_messages(quarantine: DataFrame, json_col: str = "message_details") -> DataFrame:
    """Q3, optional: put the strict parser's own position text into malformed-JSON reasons.

    Runs Python on quarantined rows only; all other texts are sent as NULL.
    """
    malformed = F.col(REASON) == REASON_MALFORMED

    def messages(texts: pd.Series) -> pd.Series:
        told = (None if t is None else message(t) for t in texts)
        return pd.Series([t and REASON_MALFORMED_PREFIX + t for t in told], dtype=object)

    told = F.pandas_udf(messages, "string")(F.when(malformed, F.col(json_col)))
    return quarantine.withColumn(REASON, F.coalesce(told, F.col(REASON)))
