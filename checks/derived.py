"""The three source tables, derived by Spark from the whole `events` table.

Every event gives one e-mail row and one message row; every user gives one CRM row.  The
CASE arms plant the dirt the engine has to clean: blank and padded addresses, broken JSON,
numbers without country code, unreadable tags, shared phones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def email_logs(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "concat('E', event_id) AS event_id",
        """CASE WHEN event_id % 50 = 0 THEN NULL
                WHEN event_id % 50 = 2 THEN '  '
                WHEN event_id % 8 = 0 THEN concat('user', user_id, '@example.com')
                WHEN event_id % 8 = 2 THEN concat('USER', user_id, '@EXAMPLE.COM')
                WHEN event_id % 8 = 4 THEN concat('  User', user_id, '@example.com ')
                ELSE concat(chr(9), 'user', user_id, '@example.com') END AS user_email""",
        "date_format(ts, 'yyyy-MM-dd HH:mm:ss') AS event_timestamp",
        """CASE WHEN user_id % 7 = 0 THEN 'sent'
                WHEN event_type = 'click' THEN 'click'
                WHEN event_type = 'view' THEN 'open'
                WHEN event_type = 'signup' THEN 'sent'
                WHEN event_type = 'purchase' THEN 'delivered'
                ELSE 'bounce' END AS event_type""",
        """CASE event_id % 20
                WHEN 4 THEN NULL
                WHEN 6 THEN ''
                WHEN 8 THEN '{campaign_code: BROKEN'
                WHEN 10 THEN '{"template_id": "T1"}'
                WHEN 12 THEN '{"campaign_code": null}'
                ELSE concat('{"campaign_code": "CAMP_', regexp_extract(props, '[0-9]+', 0),
                            '", "template_id": "T1"}') END AS message_details""",
    )


def whatsapp_logs(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "concat('W', event_id) AS message_id",
        """CASE WHEN event_id % 49 = 0 THEN NULL
                WHEN event_id % 25 = 1 THEN 900000000 + user_id
                WHEN event_id % 6 = 3 THEN 11900000000 + user_id
                ELSE 5511900000000 + user_id END AS phone_clean""",
        "CAST(date_trunc('second', ts) AS timestamp_ntz) AS sent_at_brt",
        """CASE WHEN user_id % 7 = 0 THEN 'delivered'
                WHEN event_type = 'click' THEN 'read'
                WHEN event_type = 'purchase' THEN 'read'
                WHEN event_type = 'view' THEN 'delivered'
                WHEN event_type = 'signup' THEN 'sent'
                ELSE 'failed' END AS status""",
        """CASE event_id % 20
                WHEN 9 THEN 'no tag'
                WHEN 11 THEN '[WA] - A-B - Batch A'
                WHEN 13 THEN NULL
                ELSE concat('[WA] - CAMP_', regexp_extract(props, '[0-9]+', 0), ' - Batch A')
                END AS campaign_tag""",
    )


def crm_users(events: DataFrame) -> DataFrame:
    purchase = F.when(F.col("event_type") == "purchase", F.col("ts"))
    per_user = events.groupBy("user_id").agg(
        F.min(purchase).alias("first_purchase"), F.max(purchase).alias("last_purchase")
    )
    return per_user.selectExpr(
        "concat('u_', user_id) AS user_id",
        """CASE WHEN user_id % 11 = 5 THEN concat('other', user_id, '@example.com')
                WHEN user_id % 5 = 0 THEN concat('USER', user_id, '@EXAMPLE.COM')
                ELSE concat('user', user_id, '@example.com') END AS email""",
        """CASE WHEN user_id % 11 = 5 THEN '+55 (99) 90000-0000'
                ELSE concat('+55 (11) 90000-', lpad(CAST(CASE WHEN user_id % 17 = 16
                     THEN user_id - 1 ELSE user_id END AS STRING), 4, '0')) END AS phone""",
        """CASE WHEN user_id % 3 = 0 THEN NULL
                WHEN user_id % 10 = 1 THEN first_purchase
                ELSE last_purchase END AS conversion_at""",
    )
