"""Shape of the physical plans."""

import contextlib
import re

import pytest
from pyspark.sql import functions as F

import touchtrail as tt
from checks import derived, registry
from touchtrail import operators as ops
from touchtrail.operators import matching

SF = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan as adaptive execution ended it."""
    df.write.format("noop").mode("overwrite").save()
    df._jdf.queryExecution().toRdd().count()
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def settings(spark, **values):
    values = {f"spark.sql.{k.replace('__', '.')}": v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Staged tables on disk, as a mart run finds them."""
    folder = tmp_path_factory.mktemp("staged")
    events = derived.load_events(spark, SF)
    frames = {
        "email": tt.stage_email(derived.email_logs(events)),
        "whatsapp": tt.stage_whatsapp(derived.whatsapp_logs(events)),
        "crm": tt.stage_crm(derived.crm_users(events)),
    }
    for name, frame in frames.items():
        frame.write.parquet(str(folder / name))
    return [spark.read.parquet(str(folder / name)) for name in frames]


STORED = (
    "ingest_report",
    "dry_run_sample",
    "events_merged_by_sketch",
    "mart_backfill",
    "raw_daily_retained",
    "mart_from_layers",
    "email_staged_by_range",
    "mart_kept_up",
    "dim_campaigns_kept_up",
    "agg_campaign_daily_kept_up",
    "daily_stream_valid",
)
NATIVE = [n for n in registry.queries() if n not in STORED]


@pytest.mark.parametrize("name", NATIVE)
def test_no_python_and_no_pairwise_joins(spark, name):
    text = plan(registry.queries()[name](spark, SF))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Scan ExistingRDD"):
        if (name, node) != ("ranked_interactions", "Scan ExistingRDD"):  # its checkpoint
            assert node not in text


@pytest.mark.parametrize("name", ["email_valid", "whatsapp_valid", "gate_valid", "gate_quarantine"])
def test_staging_and_gate_do_not_shuffle(spark, name):
    assert "Exchange" not in plan(registry.queries()[name](spark, SF))


@pytest.mark.parametrize("name", ["email_valid", "gate_valid", "gate_quarantine"])
def test_documents_are_parsed_once(spark, name):
    assert plan(registry.queries()[name](spark, SF)).count("parseJson") == 1


@pytest.mark.parametrize("mode, limits", [("documented", 4), ("as_written", 2)])
def test_events_are_reduced_before_their_only_exchange(spark, stored, mode, limits, monkeypatch):
    """With a user side too large to broadcast: one exchange for events, one for users, one per user."""
    monkeypatch.setattr(matching, "BROADCAST_ROWS", 0)
    text = plan(tt.attribute(*stored, mode=mode))
    exchanges = re.findall(r"Exchange hashpartitioning\((\w+)", text)
    assert sorted(exchanges) == ["channel", "channel", "user_id"]
    assert text.count("SortMergeJoin") == 1
    assert text.count("WindowGroupLimit") == limits
    # The join finds the events partitioned and sorted by the reduction above it.
    events_side = text[text.index("SortMergeJoin") :]
    assert events_side.index("WindowGroupLimit") < events_side.index("Exchange")
    assert events_side[: events_side.index("WindowGroupLimit")].count("Sort [") == 0


def test_nothing_is_broadcast_beyond_the_counted_limit(spark, stored, monkeypatch):
    monkeypatch.setattr(matching, "BROADCAST_ROWS", 10)
    for build in (tt.attribute, tt.unified_interactions, tt.interactions_in_window, tt.premium_users):
        assert "Broadcast" not in plan(build(*stored))


def test_small_user_side_is_broadcast_to_the_scan(spark, stored):
    text = plan(tt.attribute(*stored))
    assert text.count("LeftSemi") == 2
    assert text.index("WindowGroupLimit") < text.index("LeftSemi")


def test_columns_and_ranges_reach_the_scan(spark, stored):
    import datetime as dt

    text = plan(tt.build_mart(*stored, dt.date(2024, 1, 10), dt.date(2024, 1, 12)))
    scans = [line for line in text.splitlines() if "FileScan" in line]
    mail = [line for line in scans if "user_email_normalized" in line and "event_type" in line]
    assert len(mail) == 1 and "is_valid_json" in mail[0]
    assert "stg_id" not in mail[0] and "_loaded_at" not in mail[0] and "user_phone_normalized" not in mail[0]
    assert "event_ts_brt" in mail[0].split("PushedFilters")[1].split("ReadSchema")[0]
    assert all("conversion_date" in line.split("PushedFilters")[1] for line in scans if "is_converted" in line)


@pytest.mark.parametrize("build", [tt.unified_interactions, tt.interactions_in_window])
def test_skewed_identity_is_split(spark, monkeypatch, build):
    """A third of all events on one address: adaptive execution splits that partition."""
    events = (
        spark.range(0, 300000, 1, 8)
        .select(
            F.concat(F.lit("E"), "id").alias("source_id"),
            F.expr("IF(id % 3 = 0, 'hot@x', concat('u', id % 5000, '@x'))").alias("user_email_normalized"),
            F.lit(None).cast("string").alias("user_phone_normalized"),
            F.lit("open").alias("event_type"),
            F.expr("timestampadd(SECOND, CAST(id AS INT), TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("event_ts_brt"),
            F.sha2(F.col("id").cast("string"), 512).alias("campaign_code"),
            F.lit(3).alias("interaction_weight"),
            F.lit("email").alias("channel"),
            F.lit(True).alias("is_valid_json"),
        )
    )
    crm = spark.range(5000).selectExpr(
        "concat('p', id) AS user_id",
        "IF(id = 0, 'hot@x', concat('u', id, '@x')) AS user_email_normalized",
        "CAST(NULL AS STRING) AS user_phone_normalized",
        "DATE'2024-01-03' AS conversion_date",
        "TRUE AS is_converted",
    )
    monkeypatch.setattr(matching, "BROADCAST_ROWS", 0)
    with settings(
        spark,
        adaptive__skewJoin__skewedPartitionThresholdInBytes="1MB",
        adaptive__advisoryPartitionSizeInBytes="1MB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        shuffle__partitions="16",
    ):
        frame = build(events, events.where("FALSE"), crm)
        text = final_plan(frame)
    assert "skew=true" in text


def test_rank_splits_users_over_groups(spark, stored):
    text = plan(tt.ranked_interactions(*stored))
    windows = re.findall(r"Window \[row_number\(\) windowspecdefinition\(([^)]*?)specifiedwindowframe", text)
    assert windows and all("interaction_date" in w.split(" ASC")[0].split(" DESC")[0] for w in windows)


def shared_number(spark, users=30_000, days=1):
    """Messages to many numbers, and users of whom a third share one and a third have none."""
    messages = spark.range(0, 60_000, 1, 8).selectExpr(
        "concat('W', id) AS source_id",
        "CAST(NULL AS STRING) AS user_email_normalized",
        "IF(id % 3 = 0, '5511', concat('n', id % 5000)) AS user_phone_normalized",
        "'read' AS event_type",
        "timestampadd(SECOND, CAST(id AS INT), TIMESTAMP_NTZ'2024-01-02 00:00:00') AS event_ts_brt",
        "sha2(CAST(id AS STRING), 512) AS campaign_code",
        "1 AS interaction_weight",
        "'whatsapp' AS channel",
        "TRUE AS is_valid_json",
    )
    crm = spark.range(users).selectExpr(
        "sha2(CAST(id AS STRING), 512) AS user_id",
        "'' AS user_email_normalized",
        "CASE id % 3 WHEN 0 THEN '5511' WHEN 1 THEN '' ELSE concat('n', id % 5000) END AS user_phone_normalized",
        f"date_add(DATE'2024-01-03', CAST(id % {days} AS INT)) AS conversion_date",
        "TRUE AS is_converted",
    )
    return messages, crm


@pytest.mark.parametrize("mode", ["documented", "as_written"])
def test_attribute_splits_a_number_that_many_users_share(spark, monkeypatch, mode):
    """All conversions on one day: the same rows as by broadcast, from a join that is split."""
    messages, crm = shared_number(spark)
    columns = ["user_id", "conversion_date", "raw_log_id", "days_before_conversion"]
    want = tt.attribute(messages.where("FALSE"), messages, crm, mode).select(*columns)
    want = sorted(map(tuple, want.collect()))
    monkeypatch.setattr(matching, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(matching, "SHARED_BY", 5_000)
    with settings(
        spark,
        adaptive__skewJoin__skewedPartitionThresholdInBytes="1MB",
        adaptive__advisoryPartitionSizeInBytes="1MB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        shuffle__partitions="16",
    ):
        frame = tt.attribute(messages.where("FALSE"), messages, crm, mode).select(*columns)
        assert "skew=true" in final_plan(frame)
        assert sorted(map(tuple, frame.collect())) == want
    assert len(want) == 20_000


def test_blank_identities_are_not_counted_or_joined(spark):
    _, crm = shared_number(spark, 300)
    owners = matching.identities(crm)
    assert owners.where("identity = ''").isEmpty()
    assert matching.look_at_owners(crm).size[0] == 200


def test_rows_without_user_or_time_are_ranked_too(spark):
    rows = [(None, "E1", 1), (None, "E2", 2), ("u", "E3", 1)]
    df = spark.createDataFrame(rows, "user_id string, raw_log_id string, interaction_weight int").selectExpr(
        "*",
        "DATE'2024-01-01' AS interaction_date",
        "IF(raw_log_id = 'E2', NULL, TIMESTAMP_NTZ'2024-01-01 08:00:00') AS interaction_ts",
        "'email' AS channel",
    )
    got = {r.raw_log_id: r.attribution_rank for r in ops.ranking.rank_interactions(df).collect()}
    assert got == {"E1": 1, "E2": 2, "E3": 1}
