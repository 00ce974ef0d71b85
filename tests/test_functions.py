import datetime as dt
import sys

import pytest
from pyspark.sql import functions as F

from touchtrail import constants, functions as f


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x"))).first()[0]


def many(spark, values, expression, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in frame.orderBy("i").select(expression(F.col("x"))).collect()]


@pytest.mark.parametrize(
    "phone, key",
    [
        ("+55 (11) 98765-4321", "5511987654321"),
        ("55 21 99887-6543", "5521998876543"),
        ("5511912345678", "5511912345678"),
        ("(11) 98765-4321", "5511987654321"),
        ("11 8765-4321", "551187654321"),
        ("55 8765-4321", "555587654321"),
        ("5598765432", "555598765432"),
        ("551234567890", "551234567890"),
        ("441234567890", "441234567890"),
        ("98765-4321", "987654321"),
        ("n/a", ""),
        (None, None),
    ],
)
def test_phone_key(spark, phone, key):
    assert one(spark, phone, f.phone_key) == key


def test_phone_key_of_whole_number(spark):
    assert many(spark, [5511912345678, 11912345678, 912345678], f.phone_key, "bigint") == [
        "5511912345678",
        "5511912345678",
        "912345678",
    ]


def test_strip_agrees_with_python_on_every_white_space(spark):
    spaces = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]
    assert many(spark, [f"{c}a b{c}" for c in spaces], f.strip) == ["a b"] * len(spaces)
    assert many(spark, spaces, f.is_blank) == [True] * len(spaces)
    assert many(spark, [None, "", " x ", "\u200b"], f.is_blank) == [True, True, False, False]


def test_email_key(spark):
    assert one(spark, "\t Ana.Lima@Example.COM ", f.email_key) == "ana.lima@example.com"


def test_tag_code(spark):
    tags = [
        "[WA] - BLK_FRIDAY_23 - Batch A",
        "prefix [WA] -  PADDED  - x",
        "[WA] -   - x",
        "[WA] - A-B - Batch A",
        "no tag",
        None,
    ]
    got = many(spark, tags, lambda c: f.tag_code(c, constants.TAG_PATTERN))
    assert got == ["BLK_FRIDAY_23", "PADDED", "", None, None, None]
    legacy = many(
        spark, ["[CAMP:CAMP_CARTAO_JAN] Mensagem lida", "none"], lambda c: f.tag_code(c, constants.LEGACY_TAG_PATTERN)
    )
    assert legacy == ["CAMP_CARTAO_JAN", None]


def test_wall_clock_follows_daylight_saving(spark):
    got = many(
        spark,
        ["2018-01-15 12:00:00", "2023-01-15 12:00:00", "2024-01-15 12:00:00+02:00", "2024-01-15T01:30:00Z"],
        lambda c: f.wall_clock(f.instant(c)),
    )
    assert got == [
        dt.datetime(2018, 1, 15, 10),
        dt.datetime(2023, 1, 15, 9),
        dt.datetime(2024, 1, 15, 7),
        dt.datetime(2024, 1, 14, 22, 30),
    ]


def test_instant_of_garbage(spark):
    assert one(spark, "yesterday", lambda c: f.instant(c, strict=False)) is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        one(spark, "yesterday", f.instant)


def test_local_time_without_conversion(spark):
    when = dt.datetime(2024, 1, 15, 8, 30)
    assert one(spark, "2024-01-15 08:30:00", f.wall_clock_from_text) == when
    assert one(spark, when, lambda c: f.wall_clock(c, "America/Sao_Paulo", "America/Sao_Paulo"), "timestamp_ntz") == when


def test_dates(spark):
    late = dt.datetime(2024, 1, 15, 1)
    assert one(spark, late, f.local_date, "timestamp_ntz") == dt.date(2024, 1, 15)
    assert one(spark, late, lambda c: f.local_date(c, "America/Sao_Paulo"), "timestamp_ntz") == dt.date(2024, 1, 14)
    assert one(spark, "2024-01-31", lambda c: f.local_date(c, pattern="yyyy-MM-dd")) == dt.date(2024, 1, 31)
    assert one(spark, dt.date(2024, 3, 1), lambda c: f.days_between(c, F.lit(dt.date(2024, 2, 28))), "date") == 2


def test_weights_are_exact_matches(spark):
    email = many(
        spark,
        ["click", "open", "sent", "delivered", "Click", "bounce", None],
        lambda c: f.event_weight(c, constants.EMAIL_WEIGHTS),
    )
    assert email == [2, 3, 4, 4, 99, 99, 99]
    messages = many(
        spark, ["read", "delivered", "sent", "failed", None], lambda c: f.event_weight(c, constants.WHATSAPP_WEIGHTS)
    )
    assert messages == [1, 4, 4, 99, 99]


def test_labels(spark):
    assert many(spark, [1, 2, 3, 4, 99], f.weight_label, "int") == [
        "WhatsApp Read",
        "Email Click",
        "Email Open",
        "Sent/Delivered (fallback)",
        "Unknown",
    ]


@pytest.mark.parametrize(
    "text, code",
    [
        ('{"campaign_code": "A"}', "A"),
        ('{"campaign_code": ""}', ""),
        ('{"campaign_code": "{x}"}', "{x}"),
        ('{"campaign_code": "a<b"}', "a<b"),
        ('{"campaign_code": 12}', "12"),
        ('{"campaign_code": true}', "true"),
        ('{"campaign_code": null}', None),
        ('{"campaign_code": {"x": 1}}', None),
        ('{"campaign_code": [1]}', None),
        ('{"other": 1}', None),
        ('{"campaign_code": "A"} trailing', None),
        ('{"campaign_code": "A"}]', None),
        ('{"campaign_code": "A"},{"campaign_code": "B"}', None),
        ('{"campaign_code": "A", "campaign_code": "B"}', "B"),
        ('["campaign_code"]', None),
        ('{"campaign_code": NaN}', None),
        ("", None),
        (None, None),
    ],
)
def test_json_scalar(spark, text, code):
    assert one(spark, text, lambda c: f.json_scalar(c, "campaign_code")) == code


def test_surrogate_keys(spark):
    frame = spark.createDataFrame([("a", 1), ("b", 1)], "x string, y int")
    stable = [r[0] for r in frame.select(f.surrogate_key("x", "y")).collect()]
    assert stable == [r[0] for r in frame.select(f.surrogate_key("x", "y")).collect()]
    assert len({*stable, *(r[0] for r in frame.select(f.surrogate_key()).collect())}) == 4
