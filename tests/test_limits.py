"""Rates equal Python's, and documents beyond the parser's usual limits."""

import json

import pytest
from pyspark.sql import functions as F

import touchtrail as tt
from touchtrail import operators as ops
from touchtrail.functions import json_scalar
from touchtrail.operators.gate import reject_rate


def test_rates_equal_pythons_round(spark):
    pairs = [(q, n) for n in (1, 3, 7, 800, 4000, 8000, 40_000, 10**6) for q in range(0, min(n, 700) + 1)]
    pairs += [(0, 0), (1, 10**9), (10**9, 10**9), (10**12 - 1, 10**12)]
    df = spark.createDataFrame(pairs, "q bigint, n bigint")
    for r in df.withColumn("rate", reject_rate(F.col("q"), F.col("n"))).collect():
        assert r.rate == (round(r.q / r.n * 100, 2) if r.n else 0.0), (r.q, r.n)


@pytest.mark.parametrize("rejected, total", [(1, 4000), (3, 4000), (13, 4000), (1, 800), (0, 0)])
def test_both_reports_agree_at_ties(spark, email_frame, tmp_path, rejected, total):
    texts = ["{}"] * rejected + ['{"campaign_code": "A"}'] * (total - rejected)
    frame = email_frame(texts) if texts else email_frame(["x"]).limit(0)
    stats = ops.gate_stats(ops.judge(frame)).first()
    assert stats.quarantine_rate_pct == (round(rejected / total * 100, 2) if total else 0.0)
    if total:
        frame.coalesce(1).write.csv(str(tmp_path / "in"), header=True, escape='"')
        report = tt.ingest_email_logs(spark, str(tmp_path / "in"), write=False)
        assert report.quarantine_rate_pct == stats.quarantine_rate_pct


def nested(depth):
    return "[" * depth + "]" * depth


LONG = {
    "deep": '{"campaign_code": "A", "x": %s}' % nested(1_001),
    "deepest": '{"campaign_code": "A", "x": %s}' % nested(1_900),
    "digits": '{"campaign_code": "A", "x": %s}' % ("1" * 1_001),
    "fraction": '{"campaign_code": "A", "x": 0.%s}' % ("1" * 3_000),
    "key": '{"%s": 1, "campaign_code": "A"}' % ("k" * 60_000),
    "escaped key": '{"a\\"%s": 1, "campaign_code": "A"}' % ("k" * 60_000),
    "string": '{"campaign_code": "A", "x": "%s"}' % ("s" * 20_100_000),
}


@pytest.mark.parametrize("case", LONG)
def test_long_documents_pass_gate_and_staging(spark, email_frame, case):
    assert "campaign_code" in json.loads(LONG[case])
    frame = email_frame([LONG[case]])
    assert [r._error_reason for r in ops.judge(frame).select("_error_reason").collect()] == [None]
    assert [r.campaign_code for r in tt.stage_email(frame).select("campaign_code").collect()] == ["A"]


@pytest.mark.parametrize(
    "text",
    [
        LONG["deep"] + " x",
        LONG["deep"][:-2] + "}",
        LONG["deep"] + ",{}",
        LONG["key"].replace("k" * 60_000, "k" * 60_000 + "\n"),
        '{"campaign_code": A%s}' % ("b" * 5_000),
    ],
)
def test_long_broken_documents_are_rejected(spark, email_frame, text):
    with pytest.raises(ValueError):
        json.loads(text)
    (row,) = ops.judge(email_frame([text])).collect()
    assert row._error_reason.startswith("JSONDecodeError")
    assert spark.createDataFrame([(text,)], "t string").select(json_scalar(F.col("t"), "campaign_code")).first()[0] is None


def test_parser_messages_are_whole(spark, email_frame):
    judged = ops.quarantined(ops.judge(email_frame(["{a"])))
    with pytest.raises(json.JSONDecodeError) as error:
        json.loads("{a")
    assert ops.with_parser_messages(judged).first()._error_reason == f"JSONDecodeError: {error.value}"
