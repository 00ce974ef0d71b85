"""Nothing stored is lost: interrupted replacements, merges of keyless events, streams into one target."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

import touchtrail as tt
from touchtrail.sources import append_daily, replace_table
from touchtrail.sources.tables import recover_table
from touchtrail.streaming import append_new_files


@pytest.fixture
def database(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def ids(spark, table):
    return sorted(r.id for r in spark.table(table).collect())


def names(spark, database):
    return sorted(r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect())


STATES = {
    "written, not swapped": ["t", "t__new_1"],
    "old stepped aside": ["t__old_1", "t__new_1"],
    "swapped, backup left": ["t", "t__old_1"],
    "first load, not named": ["t__new_1"],
}


@pytest.mark.parametrize("state", STATES)
def test_an_interrupted_replacement_loses_nothing(spark, database, state):
    """Each state a crash can leave, then a run that fails, then one that works."""
    content = {"t": 1, "t__old_1": 1, "t__new_1": 2}
    for name in STATES[state]:
        spark.range(content[name], content[name] + 1).write.saveAsTable(f"{database}.{name}")
    table = f"{database}.t"
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        replace_table(spark.range(3).selectExpr("id DIV 0 AS id"), table)
    assert ids(spark, table) == ([2] if state == "first load, not named" else [1])
    assert names(spark, database) == ["t"]
    replace_table(spark.range(7, 9), table)
    assert ids(spark, table) == [7, 8] and names(spark, database) == ["t"]


def test_recovery_touches_no_other_table(spark, database):
    for name in ("t", "t__new", "t2__old_x", "tt__new_1"):
        spark.range(1).write.saveAsTable(f"{database}.{name}")
    recover_table(spark, f"{database}.t")
    assert names(spark, database) == ["t", "t2__old_x", "t__new", "tt__new_1"]


SCHEMA = "event_id string, user_email string, day date, _ingested_at string"
DAY = dt.date(2024, 1, 2)


def stored(spark, table):
    return sorted(("-" if r.event_id is None else r.event_id, r.user_email) for r in spark.table(table).collect())


def test_events_without_a_key_are_not_merged(spark, database):
    table = f"{database}.logs"
    append_daily(spark.createDataFrame([("E1", "old", DAY, "x")], SCHEMA), table, day="day")
    batch = [
        ("E1", "again", DAY, "y"),
        ("E2", "new", DAY, "y"),
        ("E2", "newer", DAY, "z"),
        (None, "a", DAY, "y"),
        (None, "b", DAY, "y"),
        ("", "c", DAY, "y"),
        ("", "c", DAY, "z"),
        ("  ", "d", DAY, "y"),
    ]
    want = [("", "c"), ("", "c"), ("  ", "d"), ("-", "a"), ("-", "b"), ("E1", "old"), ("E2", "newer")]
    for _ in range(3):  # a rerun adds nothing
        tt.merge_new_events(spark.createDataFrame(batch, SCHEMA), table, [F.desc("_ingested_at")])
        assert stored(spark, table) == sorted(want)
    more = [(None, "a", DAY, "w")] * 2
    tt.merge_new_events(spark.createDataFrame(more, SCHEMA), table, [F.desc("_ingested_at")])
    assert stored(spark, table).count(("-", "a")) == 2
    assert spark.sql(f"SHOW PARTITIONS {table}").count() == 1


def test_a_range_narrows_what_a_merge_reads(spark, database):
    table = f"{database}.logs"
    append_daily(spark.createDataFrame([("E1", "a", DAY, "x"), ("E0", "z", DAY - dt.timedelta(9), "x")], SCHEMA), table, day="day")
    batch = spark.createDataFrame([("E1", "b", DAY, "y"), ("E3", "c", DAY, "y")], SCHEMA)
    tt.merge_new_events(batch, table, [F.desc("_ingested_at")], held_in=F.col("day") >= F.lit(DAY))
    assert [e for e, _ in stored(spark, table)] == ["E0", "E1", "E3"]


def test_two_streams_into_one_target_keep_all_rows(spark, tmp_path):
    """Each has its own checkpoint, and each counts its batches from zero; so does one begun anew."""
    header = "event_id,user_email,event_type,event_timestamp,message_details\n"
    good = 'E{},a@x,open,2024-01-15 08:30:00,"{{""campaign_code"": ""A""}}"\n'

    def run(landing, state):
        append_new_files(
            spark,
            str(tmp_path / landing),
            str(tmp_path / "valid"),
            str(tmp_path / "bad"),
            str(tmp_path / state),
            header.strip().split(","),
        ).awaitTermination()

    def found():
        return sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "valid")).collect())

    for k in (1, 2):
        (tmp_path / f"in{k}").mkdir()
        (tmp_path / f"in{k}" / "a.csv").write_text(header + good.format(k))
        run(f"in{k}", f"state{k}")
        run(f"in{k}", f"state{k}")
    assert found() == ["E1", "E2"]
    (tmp_path / "in1" / "b.csv").write_text(header + good.format(3))
    run("in1", "state1")
    assert found() == ["E1", "E2", "E3"]
    run("in1", "state_lost")
    assert set(found()) == {"E1", "E2", "E3"}
