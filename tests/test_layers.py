"""From files to the mart, through stored tables."""

import csv
import datetime as dt
import json
import uuid

import pytest

import touchtrail as tt
from touchtrail.sources import read_crm_csv, read_whatsapp_csv, replace_table

from .test_mart import content


@pytest.fixture
def databases(spark):
    names = [f"{layer}_{uuid.uuid4().hex[:8]}" for layer in ("raw", "silver", "gold")]
    for name in names:
        spark.sql(f"CREATE DATABASE {name}")
    yield names
    for name in names:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def write(path, rows):
    with open(path, "w", newline="", encoding="utf-8") as out:
        csv.writer(out).writerows(rows)
    return str(path)


def test_from_files_to_mart(spark, databases, tmp_path):
    raw, silver, gold = databases
    payload = json.dumps({"campaign_code": "MAIL"})
    mails = write(tmp_path / "mail.csv", [
        ["event_id", "user_email", "event_type", "event_timestamp", "message_details"],
        ["E1", " ANA@X.COM ", "open", "2024-01-10 23:00:00", payload],
        ["E2", "bia@x.com", "click", "2024-01-10 12:00:00", payload],
        ["E3", "bia@x.com", "click", "2024-01-11 12:00:00", "{broken"],
    ])
    messages = write(tmp_path / "wa.csv", [
        ["message_id", "phone_clean", "sent_at_brt", "status", "campaign_tag"],
        ["W1", "5511987654321", "2024-01-10 15:00:00", "read", "[WA] - CHAT - Batch A"],
        ["W2", "", "2024-01-10 15:00:00", "read", "[WA] - CHAT - Batch A"],
        ["W3", "11912345678", "2024-01-09 15:00:00", "sent", "no tag"],
    ])
    people = write(tmp_path / "crm.csv", [
        ["user_id", "email", "phone", "conversion_at"],
        ["u_1", "ana@x.com", "+55 (11) 98765-4321", "2024-01-12 16:00:00"],
        ["u_2", "BIA@X.COM", "+55 (11) 91234-5678", "2024-01-13 16:00:00"],
        ["u_3", "caio@x.com", "+55 (11) 90000-0000", ""],
    ])
    report = tt.ingest_email_logs(spark, mails, f"{raw}.raw_sfmc_email_logs", f"{raw}.raw_sfmc_email_logs_quarantine")
    assert (report.valid_rows, report.quarantined_rows) == (2, 1)
    replace_table(read_whatsapp_csv(spark, messages), f"{raw}.raw_whatsapp_provider")
    replace_table(read_crm_csv(spark, people), f"{raw}.crm_user_base")

    for _ in range(2):
        tt.refresh_crm(spark, raw, silver)
        tt.refresh_email(spark, raw, silver)
        tt.refresh_whatsapp(spark, raw, silver)
        tt.refresh_mart(spark, silver, gold)
    assert spark.table(f"{silver}.stg_crm_users").count() == 3
    assert spark.table(f"{silver}.stg_whatsapp_logs").count() == 2
    assert spark.table(f"{silver}.stg_whatsapp_logs_valid").count() == 1
    expected = [("u_1", "2024-01-12", "W1"), ("u_2", "2024-01-13", "E2")]
    assert content(spark.table(f"{gold}.fct_attribution")) == expected

    tt.refresh_mart(spark, silver, gold, dt.date(2024, 1, 12), dt.date(2024, 1, 12), days=1)
    assert content(spark.table(f"{gold}.fct_attribution")) == expected[1:]
    with pytest.raises(ValueError, match="both"):
        tt.refresh_mart(spark, silver, gold, start=dt.date(2024, 1, 12))


def test_values_must_fit_the_schema(spark, tmp_path):
    path = write(tmp_path / "crm.csv", [["user_id", "email", "phone", "conversion_at"], ["u", "e", "p", "soon"]])
    with pytest.raises(Exception, match="MALFORMED_RECORD|CAST_INVALID|FAILED_READ"):
        read_crm_csv(spark, path).collect()
