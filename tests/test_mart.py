import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

import touchtrail as tt
from touchtrail.sources import (
    append_daily,
    append_table,
    drop_expired_partitions,
    partition_dates,
    replace_mart,
    replace_table,
)

from .conftest import touch


@pytest.fixture
def database(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def content(frame):
    return sorted((r.user_id, r.conversion_date.isoformat(), r.raw_log_id) for r in frame.collect())


@pytest.fixture
def case(staged, users):
    """One conversion on each of four days; on two of them the latest day is a fallback only."""
    touches, people = [], []
    for day, user in enumerate("abcd", 10):
        touches.append(touch(f"{user}@x", f"2024-01-{day - 1}T08:00:00" if day > 10 else "2024-01-09T08:00:00", 2, source=f"click {user}"))
        if user in "bc":
            touches.append(touch(f"{user}@x", f"2024-01-{day}T08:00:00", 4, source=f"sent {user}"))
        people.append((user, f"{user}@x", None, f"2024-01-{day}"))
    return (*staged(touches), users(people))


def test_range_is_applied_before_the_joins(case):
    start, end = dt.date(2024, 1, 11), dt.date(2024, 1, 12)
    whole = tt.build_mart(*case).where(F.col("conversion_date").between(F.lit(start), F.lit(end)))
    assert content(tt.build_mart(*case, start, end)) == content(whole)
    assert len(content(whole)) == 2


def test_backfill_replaces_the_range_and_nothing_else(spark, database, case):
    table = f"{database}.fct"
    replace_mart(tt.build_mart(*case), table)
    assert [d.day for d in partition_dates(spark, table)] == [10, 11, 12, 13]

    # As written, the users of the 11th and 12th are lost: the days must become empty.
    start, end = dt.date(2024, 1, 10), dt.date(2024, 1, 12)
    for _ in range(2):
        tt.backfill(table, *case, start, end, mode="as_written")
        assert content(spark.table(table)) == [("a", "2024-01-10", "click a"), ("d", "2024-01-13", "click d")]
        assert [d.day for d in partition_dates(spark, table)] == [10, 13]

    tt.backfill(table, *case, start, end)
    assert content(spark.table(table)) == content(tt.build_mart(*case))
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_backfill_of_a_range_without_any_rows_left(spark, database, case):
    table = f"{database}.fct"
    replace_mart(tt.build_mart(*case), table)
    tt.backfill(table, *case, dt.date(2024, 1, 11), dt.date(2024, 1, 12), mode="as_written")
    assert [d.day for d in partition_dates(spark, table)] == [10, 13]


def test_rebuild_and_backfill_keep_attribution_ids(spark, database, case):
    table = f"{database}.fct"
    replace_mart(tt.build_mart(*case), table)
    before = {r.user_id: r.attribution_id for r in spark.table(table).collect()}
    tt.backfill(table, *case, dt.date(2024, 1, 10), dt.date(2024, 1, 13))
    assert {r.user_id: r.attribution_id for r in spark.table(table).collect()} == before


def test_a_busy_day_is_written_by_several_tasks(spark, database):
    rows = spark.range(20000).selectExpr(
        "CAST(id AS STRING) AS user_id",
        "IF(id % 3 = 0, DATE'2024-01-01', date_add(DATE'2024-01-02', CAST(id % 20 AS INT))) AS conversion_date",
        "concat('C', id % 50) AS attributed_campaign",
        "'email' AS attributed_channel",
    )
    table = f"{database}.wide"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        replace_mart(rows, table)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert spark.table(table).count() == 20000
    files = spark.table(table).select("conversion_date", F.input_file_name().alias("file"), "attributed_campaign")
    busy = files.where("conversion_date = DATE'2024-01-01'").groupBy("file").agg(
        F.min("attributed_campaign").alias("low"), F.max("attributed_campaign").alias("high")
    )
    ranges = sorted((r.low, r.high) for r in busy.collect())
    assert len(ranges) > 1
    assert all(first[1] <= second[0] for first, second in zip(ranges, ranges[1:]))
    # Few files in all: a range partition covers neighbouring days.
    assert files.select("file").distinct().count() <= 21 + 4


def test_partition_pruning(spark, database, case):
    table = f"{database}.fct"
    replace_mart(tt.build_mart(*case), table)
    one_day = spark.table(table).where("conversion_date = DATE'2024-01-13'")
    assert len(one_day.inputFiles()) >= 1
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(conversion_date" in plan


def test_reports(spark, case):
    mart, crm = tt.build_mart(*case), case[2]
    checks = tt.validate_mart(mart, crm)
    assert checks["duplicates"].count() == 0
    assert [tuple(r) for r in checks["distribution"].collect()] == [("email", "Email Click", 4)]
    assert checks["unattributed"].count() == 0
    lost = tt.validate_mart(tt.build_mart(*case, mode="as_written"), crm)["unattributed"]
    assert sorted(r.user_id for r in lost.collect()) == ["b", "c"]
    daily = tt.campaign_daily(mart).collect()
    assert len(daily) == 4 and {r.conversions for r in daily} == {1}
    (campaign,) = tt.campaign_dimension(*case[:2]).collect()
    assert tuple(campaign) == ("C", dt.date(2024, 1, 9), dt.date(2024, 1, 12), "email")


def test_table_modes(spark, database):
    table = f"{database}.raw"
    for _ in range(2):
        replace_table(spark.range(3), table)
    assert spark.table(table).count() == 3
    append_table(spark.range(2), table)
    assert spark.table(table).count() == 5
    append_table(spark.range(2), f"{database}.fresh")
    assert spark.table(f"{database}.fresh").count() == 2


def test_merge_adds_unknown_events_once(spark, database):
    table = f"{database}.events"
    schema = "event_id string, at int"
    replace_table(spark.createDataFrame([("E1", 1)], schema), table)
    batch = spark.createDataFrame([("E1", 5), ("E2", 1), ("E2", 3), ("E2", 2)], schema)
    for _ in range(2):
        tt.merge_new_events(batch, table, [F.desc("at")])
        assert sorted(tuple(r) for r in spark.table(table).collect()) == [("E1", 1), ("E2", 3)]


def test_a_failed_replacement_leaves_the_old_rows(spark, database):
    table = f"{database}.raw"
    replace_table(spark.range(3), table)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        replace_table(spark.range(5).selectExpr("id DIV (id - 4) AS id"), table)
    assert spark.table(table).count() == 3
    replace_table(spark.table(table).where("id > 0"), table)
    assert spark.table(table).count() == 2


def test_rebuild_of_a_stored_mart(spark, database, case):
    table = f"{database}.fct"
    replace_mart(tt.build_mart(*case), table)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        broken = tt.build_mart(*case).withColumn("attributed_weight", F.expr("attributed_weight DIV (attributed_weight - 2)"))
        replace_mart(broken, table)
    assert content(spark.table(table)) == content(tt.build_mart(*case))
    replace_mart(tt.build_mart(*case, mode="as_written"), table)
    assert content(spark.table(table)) == content(tt.build_mart(*case, mode="as_written"))
    assert [d.day for d in partition_dates(spark, table)] == [10, 13]


def test_retention_drops_whole_days(spark, database):
    table = f"{database}.daily"
    as_of = dt.date(2024, 4, 1)
    days = [as_of - dt.timedelta(days=n) for n in (0, 90, 91, 200)]
    append_daily(spark.createDataFrame([(1, d) for d in days], "x int, ingest_date date"), table)
    append_daily(spark.createDataFrame([(2, as_of)], "x int, ingest_date date"), table)
    assert drop_expired_partitions(spark, table, "ingest_date", as_of) == sorted(days[2:])
    assert spark.table(table).count() == 3
    assert drop_expired_partitions(spark, table, "ingest_date", as_of) == []
