import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import touchtrail as tt  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("scratch")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("touchtrail-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(scratch))
        .config("spark.sql.warehouse.dir", str(scratch / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tt.configure(session)
    session.stop()


EMAIL_SCHEMA = "event_id string, user_email string, event_type string, event_timestamp string, message_details string"
STAGED_SCHEMA = (
    "source_id string, user_email_normalized string, user_phone_normalized string, event_type string,"
    " event_ts_brt timestamp_ntz, campaign_code string, interaction_weight int, channel string,"
    " is_valid_json boolean"
)
CRM_SCHEMA = (
    "user_id string, user_email_normalized string, user_phone_normalized string,"
    " conversion_date date, is_converted boolean"
)


@pytest.fixture(scope="session")
def email_frame(spark):
    """Logs that differ in their documents only; ``fixed`` sets a column of all rows."""

    def make(details, **fixed):
        shared = {"user_email": "ana.lima@mail.test", "event_type": "open", "event_timestamp": "2023-11-05 21:14:09"}
        rows = [{"event_id": f"row-{k}", "message_details": text} | shared | fixed for k, text in enumerate(details, 1)]
        return spark.createDataFrame(rows, EMAIL_SCHEMA)

    return make


def touch(identity, when, weight, channel="email", source="S", kind="x", code="C", valid=True):
    """One staged event."""
    moment = dt.datetime.fromisoformat(when) if isinstance(when, str) else when
    email, phone = (identity, None) if channel == "email" else (None, identity)
    return (source, email, phone, kind, moment, code, weight, channel, valid)


@pytest.fixture(scope="session")
def staged(spark):
    """Split touches into staged e-mail and message frames."""

    def make(touches):
        frame = spark.createDataFrame(touches, STAGED_SCHEMA)
        return frame.where("channel = 'email'"), frame.where("channel = 'whatsapp'")

    return make


@pytest.fixture(scope="session")
def users(spark):
    def make(rows):
        """(user_id, email, phone, conversion date or None)"""
        full = [(u, e, p, dt.date.fromisoformat(d) if isinstance(d, str) else d, d is not None) for u, e, p, d in rows]
        return spark.createDataFrame(full, CRM_SCHEMA)

    return make
