"""Touches, mart and gold tables kept up by day equal those built anew."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

import touchtrail as tt
from touchtrail.plans import layers
from touchtrail.plans.mart import campaign_days, campaigns_of
from touchtrail.sources.tables import replace_days, replace_table

from .conftest import touch

DAY = dt.date(2024, 1, 1)
KEPT = ("user_id", "conversion_date", "attributed_campaign", "attributed_channel", "raw_log_id", "interaction_type_label")


@pytest.fixture
def database(spark):
    name = f"kept_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def moment(rng, day):
    return dt.datetime.combine(DAY + dt.timedelta(days=day), dt.time(rng.randrange(24), rng.randrange(60)))


def events(seed, n=240, days=20, people=8):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        channel = rng.choice(["email", "whatsapp"])
        who = f"p{rng.randrange(people)}" + ("@x" if channel == "email" else "")
        weight = rng.choice([2, 3, 4, 4, 99] if channel == "email" else [1, 4, 4, 99])
        out.append(touch(who, moment(rng, rng.randrange(days)), weight, channel, f"s{k}", code=f"C{rng.randrange(5)}", valid=k % 17 > 0))
    return out


def people(seed, n=8, days=20):
    rng = random.Random(seed)
    return [(f"u{k}", f"p{k}@x", f"p{rng.randrange(n)}", (DAY + dt.timedelta(days=rng.randrange(days))).isoformat()) for k in range(n)]


def stage(staged, database, rows):
    email, whatsapp = staged(rows)
    for frame, name in ((email, layers.STG_EMAIL), (whatsapp, layers.STG_WHATSAPP)):
        table = f"{database}.{name}"
        replace_days(frame.withColumn("event_day", F.col("event_ts_brt").cast("date")), table, "event_day")
        layers._replace_valid_view(frame.sparkSession, table)


def rows(frame, columns=None):
    return sorted(map(tuple, frame.select(*(columns or sorted(frame.columns))).collect()), key=str)


@pytest.mark.parametrize("mode, grain", [("documented", "user"), ("as_written", "user"), ("documented", "conversion")])
def test_touches_attribute_as_events_do(staged, users, mode, grain):
    email, whatsapp = staged(events(1))
    crm = users(people(2))
    want = tt.attribute(email, whatsapp, crm, mode, grain=grain)
    found = tt.attribute_touches(tt.touches_by_day(email, whatsapp), crm, mode, grain=grain)
    assert rows(found, KEPT) == rows(want, KEPT) != []


def test_a_mode_must_be_known(staged, users):
    email, whatsapp = staged(events(1, 5))
    with pytest.raises(ValueError, match="unknown mode"):
        tt.attribute_touches(tt.touches_by_day(email, whatsapp), users(people(2)), "last")


@pytest.mark.parametrize("mode", ["documented", "as_written"])
def test_ten_random_days_kept_up_equal_a_rebuild(spark, staged, users, database, mode):
    rng = random.Random(f"{mode}")
    held = events(5)
    replace_table(users(people(6)), f"{database}.{layers.STG_CRM}")
    stage(staged, database, held)
    tt.refresh_mart(spark, database, database, mode=mode)
    tt.refresh_touches(spark, database)
    tt.refresh_gold(spark, database, database)
    for turn in range(10):
        day = rng.randrange(20)
        date = DAY + dt.timedelta(days=day)
        own = [r for r in held if r[4].date() == date]
        held = [r for r in held if r[4].date() != date]
        if turn % 3:  # else the day loses all its events
            late = [touch(f"p{rng.randrange(8)}", moment(rng, day), rng.choice([1, 4]), "whatsapp", f"late{turn}-{k}", code="L") for k in range(4)]
            held += [r for r in own if rng.random() < 0.6] + late
        stage(staged, database, held)
        tt.update_mart(spark, date, date, database, database, mode=mode)
        tt.refresh_gold(spark, database, database, date, date)
        if turn in (0, 4, 9):
            email, whatsapp = staged(held)
            mart = tt.attribute(email, whatsapp, users(people(6)), mode)
            assert rows(spark.table(f"{database}.{layers.MART}"), KEPT) == rows(mart, KEPT) != []
            assert rows(spark.table(f"{database}.{layers.CAMPAIGN_DAILY}")) == rows(tt.campaign_daily(mart))
            assert rows(spark.table(f"{database}.{layers.CAMPAIGNS}")) == rows(tt.campaign_dimension(email, whatsapp)) != []


def test_only_touched_days_are_read_and_written(spark, staged, users, database):
    replace_table(users(people(6)), f"{database}.{layers.STG_CRM}")
    stage(staged, database, events(5))
    tt.refresh_mart(spark, database, database)
    tt.refresh_touches(spark, database)
    made = lambda name, day: {r[0] for r in spark.table(f"{database}.{name}").where(day).select("_metadata.file_path").distinct().collect()}
    day, last = dt.date(2024, 1, 8), dt.date(2024, 1, 15)
    others = (F.col("conversion_date") < F.lit(day)) | (F.col("conversion_date") > F.lit(last))
    touched = F.col("interaction_date") != F.lit(day)
    before = made(layers.MART, others), made(layers.TOUCHES, touched)
    tt.update_mart(spark, day, day, database, database)
    assert before == (made(layers.MART, others), made(layers.TOUCHES, touched))


def test_states_by_day_merge_to_the_dimension(staged):
    email, whatsapp = staged(events(9))
    assert rows(campaigns_of(campaign_days(email, whatsapp))) == rows(tt.campaign_dimension(email, whatsapp))
