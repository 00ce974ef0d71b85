"""Merging into a daily history: only days that may hold a key are read."""

import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import functions as F

import touchtrail as tt
from touchtrail.sources import append_daily, key_sketch
from touchtrail.sources.key_sketch import days_that_may_hold

SCHEMA = "event_id string, other string, event_day date"
DAYS = [dt.date(2024, 1, d) for d in range(1, 7)]


@pytest.fixture
def table(spark):
    name = f"keys_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    yield f"{name}.events"
    spark.sql(f"DROP DATABASE {name} CASCADE")


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def merge(spark, rows, table, **settings):
    tt.merge_new_events(batch(spark, rows), table, [F.desc("other")], sketches=f"{table}_keys", **settings)


def held(spark, table):
    return sorted((r.event_id, r.other, r.event_day) for r in spark.table(table).collect())


def history(spark, table, per_day=300):
    append_daily(batch(spark, []), table, day="event_day")
    merge(spark, [(f"{j * 7919 % 100_003:06d}-{k}", "x", day) for k, day in enumerate(DAYS) for j in range(per_day)], table)


def may_hold(spark, rows, table):
    return days_that_may_hold(spark, batch(spark, rows), table, f"{table}_keys", ["event_id"], "event_day")


def test_only_days_that_may_hold_a_key_are_read(spark, table):
    history(spark, table)
    old = spark.table(table).where(F.col("event_day") == F.lit(DAYS[2])).first()
    rows = [(old.event_id, "again", DAYS[5]), ("050000-new", "y", DAYS[5])]
    found = may_hold(spark, rows, table)
    assert DAYS[2] in found and len(found) <= 3
    before = held(spark, table)
    merge(spark, rows, table)
    assert held(spark, table) == sorted([*before, ("050000-new", "y", DAYS[5])])
    stored = spark.table(table).where(F.col("event_day").isin(found))
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*event_day", plan)


def test_every_stored_key_is_found(spark, table):
    history(spark, table, per_day=120)
    for day in DAYS[::2]:
        rows = [(r.event_id, r.other, r.event_day) for r in spark.table(table).where(F.col("event_day") == F.lit(day)).collect()]
        assert day in may_hold(spark, rows[:1], table) and day in may_hold(spark, rows, table)
        before = held(spark, table)
        merge(spark, [(i, "z", DAYS[0]) for i, *_ in rows], table)
        assert held(spark, table) == before


def test_keys_beyond_all_stored_ones_read_nothing(spark, table):
    history(spark, table, per_day=50)
    assert may_hold(spark, [("zzz", "n", DAYS[0])], table) == []


def test_a_day_never_sketched_is_read(spark, table):
    history(spark, table, per_day=20)
    late = dt.date(2024, 2, 1)
    append_daily(batch(spark, [("foreign", "x", late)]), table, day="event_day")
    assert late in may_hold(spark, [("zzz", "n", DAYS[0])], table)
    merge(spark, [("foreign", "y", late)], table)
    assert held(spark, table).count(("foreign", "x", late)) == 1 and ("foreign", "y", late) not in held(spark, table)


def test_rows_without_a_key_are_compared_with_all_days(spark, table):
    history(spark, table, per_day=5)
    for _ in range(2):
        merge(spark, [(None, "k", DAYS[1]), (" ", "k", DAYS[1]), ("new", "k", DAYS[1])], table)
    assert sum(o == "k" for _, o, _ in [(i or "", o, d) for i, o, d in map(tuple, spark.table(table).collect())]) == 3


def test_a_load_that_failed_after_sketching_is_repeated(spark, table, monkeypatch):
    from touchtrail.plans import ingest

    history(spark, table, per_day=5)
    kept = ingest.append_table
    monkeypatch.setattr(ingest, "append_table", lambda *args: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        merge(spark, [("new", "k", DAYS[1])], table)
    monkeypatch.setattr(ingest, "append_table", kept)
    for _ in range(2):
        merge(spark, [("new", "k", DAYS[1])], table)
    assert held(spark, table).count(("new", "k", DAYS[1])) == 1


def asked_keys(monkeypatch):
    """Numbers of keys and days of every look into the filters."""
    looks, look = [], key_sketch._days_hit

    def seen(told, near, pages):
        looks.append((told.count(), near.select("day").distinct().count()))
        return look(told, near, pages)

    monkeypatch.setattr(key_sketch, "_days_hit", seen)
    return looks


def test_a_redelivered_batch_is_settled_by_few_of_its_keys(spark, table, monkeypatch):
    monkeypatch.setattr(key_sketch, "FIRST_KEYS", 60)
    looks = asked_keys(monkeypatch)
    history(spark, table)
    rows = [(r.event_id, r.other, r.event_day) for r in spark.table(table).collect()]
    assert may_hold(spark, rows, table) == DAYS
    assert looks and all(keys < 300 for keys, _ in looks)


def test_one_old_key_among_many_new_ones_is_found(spark, table, monkeypatch):
    monkeypatch.setattr(key_sketch, "FIRST_KEYS", 2)
    monkeypatch.setattr(key_sketch, "MORE_KEYS", 8)
    looks = asked_keys(monkeypatch)
    history(spark, table)
    old = spark.table(table).where(F.col("event_day") == F.lit(DAYS[4])).first()
    rows = [(f"{k:06d}-new", "n", DAYS[0]) for k in range(0, 100_000, 500)] + [(old.event_id, "again", DAYS[0])]
    assert DAYS[4] in may_hold(spark, rows, table)
    assert looks[-1][0] == len(rows) and [d for _, d in looks] == sorted((d for _, d in looks), reverse=True)


def test_days_of_many_sizes_have_filters_of_few(spark, table):
    append_daily(batch(spark, []), table, day="event_day")
    day = F.expr("date_add(DATE'2024-01-01', CAST(sqrt(id) / 32 AS INT))")
    rows = spark.range(300_000).select(F.col("id").cast("string").alias("event_id"), F.lit("x").alias("other"), day.alias("event_day"))
    tt.merge_new_events(rows, table, [F.desc("other")], sketches=f"{table}_keys")
    heads = spark.table(f"{table}_keys_days").collect()
    assert len({r.n for r in heads}) > 15 and {r.pages for r in heads} <= {1, 2, 4, 8, 16, 32}
    assert all(r.pages * key_sketch.PAGE_BITS >= r.n * key_sketch.BITS_PER_KEY for r in heads)
