import datetime as dt

from touchtrail import stage_crm, stage_email, stage_whatsapp, valid_only
from touchtrail.constants import LEGACY_TAG_PATTERN, LOCAL_ZONE
from touchtrail.plans.staging import STAGED_COLUMNS

from .conftest import EMAIL_SCHEMA

WHATSAPP_SCHEMA = "message_id string, phone_clean bigint, sent_at_brt timestamp_ntz, status string, campaign_tag string"
CRM_SCHEMA = "user_id string, email string, phone string, conversion_at timestamp_ntz"


def test_email(spark):
    rows = [
        ("E1", " A@B.c\t", "click", "2024-01-15 02:00:00", '{"campaign_code": "X"}'),
        ("E2", None, "click", "2024-01-15 02:00:00", '{"campaign_code": "X"}'),
        ("E3", " \t", "click", "2024-01-15 02:00:00", '{"campaign_code": "X"}'),
        ("E4", "a@b.c", "bounce", "2024-01-15 02:00:00", '{"campaign_code": null}'),
        ("E5", "a@b.c", "open", "2024-01-15 02:00:00", None),
    ]
    frame = stage_email(spark.createDataFrame(rows, EMAIL_SCHEMA))
    assert tuple(frame.columns) == STAGED_COLUMNS
    assert dict(frame.dtypes)["event_ts_brt"] == "timestamp_ntz"
    assert dict(frame.dtypes)["user_phone_normalized"] == "string"
    got = {r.source_id: r for r in frame.collect()}
    assert sorted(got) == ["E1", "E4", "E5"]
    first = got["E1"]
    assert first.user_email_normalized == "a@b.c"
    assert first.event_ts_brt == dt.datetime(2024, 1, 14, 23)
    assert (first.campaign_code, first.interaction_weight, first.channel) == ("X", 2, "email")
    assert [got[k].is_valid_json for k in ("E1", "E4", "E5")] == [True, False, False]
    assert got["E4"].interaction_weight == 99
    assert len({r.stg_id for r in got.values()}) == 3
    assert [r.source_id for r in valid_only(frame).collect()] == ["E1"]


def test_whatsapp(spark):
    noon = dt.datetime(2024, 1, 15, 12)
    rows = [
        ("W1", 5511912345678, noon, "read", "[WA] - X_1 - Batch A"),
        ("W2", None, noon, "read", "[WA] - X_1 - Batch A"),
        ("W3", 11912345678, noon, "sent", "[WA] - A-B - Batch A"),
        ("W4", 912345678, noon, "failed", None),
    ]
    frame = spark.createDataFrame(rows, WHATSAPP_SCHEMA)
    got = {r.source_id: r for r in stage_whatsapp(frame).collect()}
    assert sorted(got) == ["W1", "W3", "W4"]
    assert got["W1"].user_phone_normalized == got["W3"].user_phone_normalized == "5511912345678"
    assert got["W4"].user_phone_normalized == "912345678"
    assert got["W1"].event_ts_brt == dt.datetime(2024, 1, 15, 9)
    assert [got[k].interaction_weight for k in ("W1", "W3", "W4")] == [1, 4, 99]
    assert [got[k].is_valid_json for k in ("W1", "W3", "W4")] == [True, False, False]
    assert got["W1"].user_email_normalized is None

    already_local = stage_whatsapp(frame, source_zone=LOCAL_ZONE)
    assert already_local.where("source_id = 'W1'").first().event_ts_brt == noon


def test_whatsapp_with_instants_and_legacy_tags(spark):
    frame = spark.createDataFrame(
        [("W1", 5511912345678, "2024-01-15 12:00:00", "read", "[CAMP:OLD-1] lida")],
        "message_id string, phone_clean bigint, sent string, status string, campaign_tag string",
    ).selectExpr("*", "CAST(sent AS timestamp) AS sent_at_brt")
    row = stage_whatsapp(frame, tag_pattern=LEGACY_TAG_PATTERN).first()
    assert (row.campaign_code, row.event_ts_brt) == ("OLD-1", dt.datetime(2024, 1, 15, 9))


def test_crm(spark):
    rows = [
        ("u_1", "ANA@X.com ", "+55 (11) 90123-4567", dt.datetime(2024, 1, 15, 1)),
        ("u_2", "b@x.com", "+55 (11) 90123-4568", None),
    ]
    frame = spark.createDataFrame(rows, CRM_SCHEMA)
    got = {r.user_id: r for r in stage_crm(frame).collect()}
    assert got["u_1"].user_email_normalized == "ana@x.com"
    assert got["u_1"].user_phone_normalized == "5511901234567"
    assert got["u_1"].conversion_date == dt.date(2024, 1, 15) and got["u_1"].is_converted
    assert got["u_2"].conversion_date is None and not got["u_2"].is_converted
    local = stage_crm(frame, conversion_zone=LOCAL_ZONE).where("user_id = 'u_1'").first()
    assert local.conversion_date == dt.date(2024, 1, 14)
