import datetime as dt

from pyspark.sql import functions as F

from touchtrail.operators import deduplicate, enrich, new_rows, retain


def test_deduplicate_keeps_the_newest_row(spark):
    frame = spark.createDataFrame(
        [("E1", 1, "a"), ("E1", 3, "c"), ("E1", 2, "b"), ("E2", 1, "d")], "event_id string, at int, x string"
    )
    got = deduplicate(frame, ["event_id"], [F.desc("at")])
    assert got.columns == frame.columns
    assert sorted(tuple(r) for r in got.collect()) == [("E1", 3, "c"), ("E2", 1, "d")]


def test_new_rows(spark):
    batch = spark.createDataFrame([("E1", "new"), ("E2", "new")], "event_id string, x string")
    target = spark.createDataFrame([("E1", "old")], "event_id string, x string")
    assert [tuple(r) for r in new_rows(batch, target, ["event_id"]).collect()] == [("E2", "new")]


def test_retain_includes_the_limit(spark):
    as_of = dt.date(2024, 4, 1)
    days = [(as_of - dt.timedelta(days=n),) for n in (0, 89, 90, 91)]
    frame = spark.createDataFrame(days, "day date")
    assert retain(frame, "day", as_of).count() == 3


def test_enrich_without_files(spark):
    row = enrich(spark.range(1).toDF("x"), "folder/mail.csv").first()
    assert row["_source_file"] == "mail.csv"
    assert row["_ingested_at"].endswith("+00:00")


def test_enrich_names_each_rows_file(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text("1\n")
    got = enrich(spark.read.csv(str(tmp_path))).select("_source_file").collect()
    assert sorted(r[0] for r in got) == ["a.csv", "b.csv"]
