import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import touchtrail as tt
from checks import derived
from touchtrail.operators import (
    gate_stats,
    identities,
    interactions,
    look_at_owners,
    judge,
    matching,
    owned_events,
    rank_interactions,
    reject_summary,
)

from touchtrail.plans import attribution

from .conftest import touch


def winners(frame):
    return {r.user_id: (r.raw_log_id, r.attributed_weight) for r in frame.collect()}


def test_channel_conflict_on_one_day(staged, users):
    events = staged([
        touch("a@x", "2024-01-10T20:00:00", 3, source="open"),
        touch("551", "2024-01-10T09:00:00", 1, "whatsapp", source="read"),
    ])
    assert winners(tt.attribute(*events, users([("u", "a@x", "551", "2024-01-11")]))) == {"u": ("read", 1)}


def test_later_day_beats_lower_weight(staged, users):
    events = staged([
        touch("a@x", "2024-01-10T20:00:00", 3, source="open"),
        touch("551", "2024-01-09T09:00:00", 1, "whatsapp", source="read"),
    ])
    assert winners(tt.attribute(*events, users([("u", "a@x", "551", "2024-01-11")]))) == {"u": ("open", 3)}


@pytest.mark.parametrize("days_before, counted", [(-1, False), (0, True), (7, True), (8, False)])
def test_window_is_closed(staged, users, days_before, counted):
    day = dt.datetime(2024, 1, 20, 23, 59) - dt.timedelta(days=days_before)
    events = staged([touch("a@x", day, 2), touch("none", day, 1, "whatsapp")])
    crm = users([("u", "a@x", None, "2024-01-20")])
    rows = tt.interactions_in_window(*events, crm).collect()
    assert [r.days_before_conversion for r in rows] == ([days_before] if counted else [])
    assert len(winners(tt.attribute(*events, crm))) == counted


def test_fallback_modes(staged, users):
    """A fallback on the latest day hides an earlier premium event only as written."""
    events = staged([
        touch("a@x", "2024-01-10T08:00:00", 2, source="click"),
        touch("a@x", "2024-01-11T08:00:00", 4, source="sent"),
        touch("b@x", "2024-01-11T08:00:00", 4, source="only sent"),
        touch("c@x", "2024-01-11T08:00:00", 99, source="bounce"),
        touch("c@x", "2024-01-10T08:00:00", 3, source="open"),
        touch("d@x", "2024-01-11T08:00:00", 99, source="bounce"),
    ])
    crm = users([(u, f"{u}@x", None, "2024-01-12") for u in "abcd"])
    assert winners(tt.attribute(*events, crm)) == {"a": ("click", 2), "b": ("only sent", 4), "c": ("open", 3)}
    assert winners(tt.attribute(*events, crm, mode="as_written")) == {"b": ("only sent", 4)}
    assert [r.user_id for r in tt.premium_users(*events, crm).orderBy("user_id").collect()] == ["a", "c"]


def test_ties_are_settled(staged, users):
    when = "2024-01-10T08:00:00"
    events = staged([
        touch("551", when, 4, "whatsapp", source="A"),
        touch("a@x", when, 4, source="C"),
        touch("a@x", when, 4, source="B"),
    ])
    crm = users([("u", "a@x", "551", "2024-01-11")])
    for mode in ("documented", "as_written"):
        assert winners(tt.attribute(*events, crm, mode=mode)) == {"u": ("B", 4)}
    ranks = tt.ranked_interactions(*events, crm).orderBy("attribution_rank").collect()
    assert [(r.raw_log_id, r.attribution_rank) for r in ranks] == [("B", 1), ("C", 2), ("A", 3)]


def test_shared_identity_fans_out_and_unconverted_users_stay_out(staged, users):
    events = staged([touch("551", "2024-01-10T08:00:00", 1, "whatsapp")])
    crm = users([("u", None, "551", "2024-01-11"), ("v", None, "551", "2024-01-12"), ("w", None, "551", None)])
    assert sorted(winners(tt.attribute(*events, crm))) == ["u", "v"]
    assert tt.unified_interactions(*events, crm).count() == 2


def test_invalid_rows_do_not_count(staged, users):
    events = staged([touch("a@x", "2024-01-10T08:00:00", 2, valid=False)])
    crm = users([("u", "a@x", None, "2024-01-11")])
    assert winners(tt.attribute(*events, crm)) == {}


def test_several_conversions_per_user(staged, users):
    events = staged([touch("a@x", "2024-01-10T08:00:00", 2, source="1"), touch("a@x", "2024-01-25T08:00:00", 2, source="2")])
    crm = users([("u", "a@x", None, "2024-01-11"), ("u", "a@x", None, "2024-01-25")])
    per_conversion = tt.attribute(*events, crm, grain="conversion").orderBy("conversion_date").collect()
    assert [r.raw_log_id for r in per_conversion] == ["1", "2"]
    assert winners(tt.attribute(*events, crm)) == {"u": ("2", 2)}
    as_written = tt.attribute(*events, crm, mode="as_written", grain="conversion").orderBy("conversion_date")
    assert [(r.raw_log_id, r.conversion_date) for r in as_written.collect()] == [
        (r.raw_log_id, r.conversion_date) for r in per_conversion
    ]
    assert [r.user_id for r in tt.duplicate_users(crm).collect()] == ["u"]


def test_unknown_mode(staged, users):
    with pytest.raises(ValueError, match="unknown mode"):
        tt.attribute(*staged([touch("a", "2024-01-10T08:00:00", 2)]), users([("u", "a", None, None)]), mode="x")


def _random_case(seed):
    chance = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    touches = []
    for i in range(400):
        channel = chance.choice(["email", "whatsapp"])
        # A third of all events share one identity.
        number = 0 if chance.random() < 0.33 else chance.randrange(12)
        moment = start + dt.timedelta(days=chance.randrange(25), hours=chance.randrange(3), minutes=30 * chance.randrange(2))
        weight = chance.choice([2, 3, 4, 4, 99] if channel == "email" else [1, 4, 4, 99])
        touches.append(touch(f"{channel}{number}", moment, weight, channel, f"{channel[0]}{i:04d}", valid=chance.random() < 0.9))
    people = []
    for u in range(40):
        converted = (start + dt.timedelta(days=chance.randrange(28))).date() if chance.random() < 0.8 else None
        email = f"email{chance.randrange(14)}"
        phone = "whatsapp0" if chance.random() < 0.33 else chance.choice([None, f"whatsapp{chance.randrange(14)}"])
        people.append((f"u{u:02d}", email, phone, converted))
    return touches, people


def _brute_force(touches, people):
    """Ranked in-window interactions per user, straight from the stated rules."""
    result = {}
    for user, email, phone, converted in people:
        if converted is None:
            continue
        rows = []
        for source, e, p, kind, moment, code, weight, channel, valid in touches:
            mine = (channel == "email" and e == email) or (channel == "whatsapp" and p is not None and p == phone)
            if mine and valid and 0 <= (converted - moment.date()).days <= 7:
                rows.append((-moment.date().toordinal(), weight, -moment.timestamp(), channel, source))
        result[user] = sorted(rows)
    return result


@pytest.mark.parametrize("seed, broadcast_rows", [(1, 500_000), (2, 100), (3, 0)])
def test_against_brute_force(spark, staged, users, seed, broadcast_rows, monkeypatch):
    """With all, some and no broadcasts."""
    monkeypatch.setattr(matching, "BROADCAST_ROWS", broadcast_rows)
    touches, people = _random_case(seed)
    events, crm = staged(touches), users(people)
    expected = _brute_force(touches, people)

    matched = {(r.user_id, r.raw_log_id) for r in tt.unified_interactions(*events, crm).collect()}
    assert matched >= {(u, row[-1]) for u, rows in expected.items() for row in rows}

    ranked = {}
    for r in tt.ranked_interactions(*events, crm).collect():
        ranked.setdefault(r.user_id, {})[r.attribution_rank] = r.raw_log_id
    assert ranked == {u: {i: row[-1] for i, row in enumerate(rows, 1)} for u, rows in expected.items() if rows}

    as_written, documented = {}, {}
    for user, rows in expected.items():
        premium = any(row[1] < 4 for row in rows)
        if rows and (rows[0][1] < 4 or (rows[0][1] == 4 and not premium)):
            as_written[user] = (rows[0][-1], rows[0][1])
        eligible = [row for row in rows if row[1] < 4 or (row[1] == 4 and not premium)]
        if eligible:
            documented[user] = (eligible[0][-1], eligible[0][1])
    assert winners(tt.attribute(*events, crm)) == documented
    assert winners(tt.attribute(*events, crm, mode="as_written")) == as_written
    assert as_written.items() <= documented.items()

    unconverted = {u for u, *_, d in people if d is None}
    missing = {r.user_id for r in tt.unattributed_converters(tt.attribute(*events, crm), crm).collect()}
    assert missing == {u for u, *_ in people} - unconverted - set(documented)


def test_early_filter_drops_only_strangers(spark, staged, users, monkeypatch):
    touches, people = _random_case(4)
    crm = users(people)
    events, owners = interactions(*staged(touches)), identities(crm)
    known = {(r.channel, r.identity) for r in owners.collect()}
    kept = owned_events(events, look_at_owners(crm)).collect()
    assert sorted(r.raw_log_id for r in kept) == sorted(
        r.raw_log_id for r in events.collect() if (r.channel, r.identity) in known
    )
    monkeypatch.setattr(matching, "BROADCAST_ROWS", owners.count())
    rows, size = look_at_owners(crm).size
    assert (rows, size) == (owners.count(), sum(len(r.identity) + len(r.user_id) for r in owners.collect()))
    monkeypatch.setattr(matching, "BROADCAST_BYTES", size - 1)
    assert look_at_owners(crm).size is None
    monkeypatch.setattr(matching, "BROADCAST_BYTES", size)
    monkeypatch.setattr(matching, "BROADCAST_ROWS", owners.count() - 1)
    assert look_at_owners(crm).size is None


def test_owners_are_looked_at_in_one_job(spark, users, monkeypatch):
    crm = users([(f"u{k}", f"m{k}@x", "55119" if k % 3 else None, "2024-01-05") for k in range(60)])
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("look", "look")
    owners = look_at_owners(crm)
    for days in (7, 30):
        owners.fit(days), owners.widely_shared(days)
    assert len(jobs.getJobIdsForGroup("look")) == 1
    spark.sparkContext.setJobGroup("rest", "rest")
    assert owners.size[0] == 100 == owners.rows.count() and owners.shared == 40
    monkeypatch.setattr(matching, "SHARED_BY", 39)
    assert not owners.widely_shared(7)
    monkeypatch.setattr(matching, "BROADCAST_ROWS", 99)
    assert owners.widely_shared(7)


def test_both_ways_to_rank_agree(staged, users, monkeypatch):
    touches, people = _random_case(7)
    events, crm = staged(touches), users(people)
    together = tt.ranked_interactions(*events, crm).collect()
    monkeypatch.setattr(attribution, "RANKED_TOGETHER", 0)
    divided = tt.ranked_interactions(*events, crm).collect()
    assert sorted(map(str, together)) == sorted(map(str, divided)) != []


def test_rank_of_one_very_busy_user(spark):
    rows = spark.range(20000).selectExpr(
        "'u' AS user_id",
        "CAST(date_add(DATE'2024-01-01', CAST(id % 8 AS INT)) AS DATE) AS interaction_date",
        "CAST(1 + id % 4 AS INT) AS interaction_weight",
        "timestampadd(SECOND, id % 86400, CAST(date_add(DATE'2024-01-01', CAST(id % 8 AS INT)) AS timestamp_ntz)) AS interaction_ts",
        "'email' AS channel",
        "lpad(CAST(id AS STRING), 6, '0') AS raw_log_id",
    )
    ranked = rank_interactions(rows)
    assert ranked.columns == [*rows.columns, "attribution_rank"]
    got = [r.raw_log_id for r in ranked.orderBy("attribution_rank").collect()]
    want = sorted(
        rows.collect(),
        key=lambda r: (-r.interaction_date.toordinal(), r.interaction_weight, -r.interaction_ts.timestamp(), r.raw_log_id),
    )
    assert got == [r.raw_log_id for r in want]


@pytest.mark.parametrize("sf, total", [("0.001", 500), ("0.01", 5000)])
def test_baseline_gate_counts(spark, sf, total):
    events = derived.load_events(spark, f"/root/testdata/sf{sf}")
    judged = judge(derived.email_logs(events.where("event_id % 2 = 0")))
    row = gate_stats(judged).first()
    assert (row.total_rows, row.valid_rows, row.quarantine_rate_pct) == (total, total * 6 // 10, 40.0)
    reasons = {r["_error_reason"]: r.rejected_rows for r in reject_summary(judged).collect()}
    assert reasons == {
        "message_details is null or empty": total // 5,
        "JSONDecodeError: malformed JSON": total // 10,
        "Missing required JSON fields: {'campaign_code'}": total // 10,
    }


@pytest.mark.parametrize(
    "sf, counts", [("0.001", (460, 230, 490, 343, 15, 10, 350, 69, 9, 8)), ("0.01", (4600, 2300, 4898, 3429, 150, 100, 3402, 853, 87, 67))]
)
def test_baseline_counts(spark, sf, counts):
    events = derived.load_events(spark, f"/root/testdata/sf{sf}")
    email = tt.stage_email(derived.email_logs(events.where("event_id % 2 = 0")))
    whatsapp = tt.stage_whatsapp(derived.whatsapp_logs(events.where("event_id % 2 = 1")))
    crm = tt.stage_crm(derived.crm_users(events))
    frames = (
        email,
        tt.valid_only(email),
        whatsapp,
        tt.valid_only(whatsapp),
        crm,
        crm.where("is_converted"),
        tt.unified_interactions(email, whatsapp, crm),
        tt.interactions_in_window(email, whatsapp, crm),
        tt.attribute(email, whatsapp, crm),
        tt.attribute(email, whatsapp, crm, mode="as_written"),
    )
    assert tuple(frame.count() for frame in frames) == counts
    assert frames[-2].select(F.countDistinct("user_id")).first()[0] == counts[-2]
