"""CSV exports of the other two raw tables, under explicit schemas.

A value that does not fit its type fails the read: the schema is the contract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CRM_SCHEMA = "user_id string, email string, phone string, conversion_at timestamp"
WHATSAPP_SCHEMA = (
    "message_id string, phone_clean bigint, sent_at_brt timestamp, status string, campaign_tag string"
)
_OPTIONS = {"header": "true", "escape": '"', "mode": "FAILFAST", "enforceSchema": "false"}


def read_crm_csv(spark: SparkSession, path: str) -> DataFrame:
    """Users; an empty conversion time is NULL."""
    return spark.read.schema(CRM_SCHEMA).options(**_OPTIONS).csv(path)


def read_whatsapp_csv(spark: SparkSession, path: str) -> DataFrame:
    """Messages; the number is a whole number, as the provider sends it."""
    return spark.read.schema(WHATSAPP_SCHEMA).options(**_OPTIONS).csv(path)
