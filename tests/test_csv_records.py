"""One file with line breaks in its fields, read by many tasks."""

import csv
import random
import re

import pytest

import touchtrail as tt
from touchtrail.operators.gate import CORRUPT
from touchtrail.sources import read_event_csv
from touchtrail.sources.csv_records import TASKS_A_CORE, split_records

HEADER = ["event_id", "user_email", "event_type", "event_timestamp", "message_details"]
FIELDS = ["", "plain", "two\nlines", 'say "x"', '"', "a,b", "\n", "\n\n", "é\n漢字", 'q"\n"r', " padded ", "x" * 90, "end\r\nhere"]


def write(path, rows, newline="\n"):
    with open(path, "w", newline="", encoding="utf-8") as out:
        csv.writer(out, lineterminator=newline).writerows([HEADER, *rows])
    return str(path)


def some_rows(seed, n):
    rng = random.Random(seed)
    return [[f"E{k}", *(rng.choice(FIELDS) for _ in range(4))] for k in range(n)]


@pytest.fixture
def small_ranges(spark, request):
    size = getattr(request, "param", 64)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield size
    for key, value in before.items():
        spark.conf.set(key, value)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.mark.parametrize("small_ranges", [23, 64, 500, 4096], indirect=True)
@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_rows_equal_the_read_in_one_task(spark, tmp_path, small_ranges, newline):
    path = write(tmp_path / "mail.csv", some_rows(small_ranges, 120), newline)
    found = read_event_csv(spark, path, multi_line="split")
    assert split_records(spark, path).select("file").distinct().count() == 1
    assert rows(found) == rows(read_event_csv(spark, path)) and found.count() == 120
    if small_ranges < 4096:
        assert spark.read.text(path).rdd.getNumPartitions() > 8


def test_a_field_longer_than_several_ranges(spark, tmp_path, small_ranges):
    long = "\n".join(f"line {k} of a \"long\" field" for k in range(60))
    path = write(tmp_path / "mail.csv", [["E1", "a", "b", "c", long], ["E2", long, "b", "c", "d"], ["E3", *"abcd"]])
    assert rows(read_event_csv(spark, path, multi_line="split")) == rows(read_event_csv(spark, path))


def test_many_files_and_blank_lines(spark, tmp_path, small_ranges):
    for k in range(4):
        path = write(tmp_path / f"part {k}.csv", some_rows(k, 15 * k))
        with open(path, "a", newline="") as out:
            out.write("\n\n")
    found = read_event_csv(spark, str(tmp_path), multi_line="split")
    assert rows(found) == rows(read_event_csv(spark, str(tmp_path)))
    assert {r["_source_file"] for r in found.collect()} == {f"part%20{k}.csv" for k in range(1, 4)}


def test_records_that_do_not_split_into_the_header(spark, tmp_path, small_ranges):
    path = write(tmp_path / "mail.csv", [["E1", "a"], ["E2", "a", "b", "c", "d\ne", "f"], ["E3", *"abcd"]])
    found = {r.event_id: r[CORRUPT] for r in read_event_csv(spark, path, multi_line="split").collect()}
    assert found == {"E1": "E1,a", "E2": 'E2,a,b,c,"d\ne",f', "E3": None}


def test_headers_must_agree(spark, tmp_path):
    write(tmp_path / "a.csv", some_rows(1, 3))
    with open(tmp_path / "b.csv", "w") as out:
        out.write("event_id,user_email,event_type,message_details,event_timestamp\nE1,a,b,c,d\n")
    with pytest.raises(Exception, match="header"):
        read_event_csv(spark, str(tmp_path), multi_line="split").collect()


def test_ingest_of_split_files(spark, tmp_path, small_ranges):
    details = '{"campaign_code": "A",\n "note": "x"}'
    path = write(tmp_path / "mail.csv", [[f"E{k}", "a@b.c", "open", "2024-01-15 08:30:00", details if k % 4 else "{\n"] for k in range(40)])
    report = tt.ingest_email_logs(spark, path, write=False, multi_line="split")
    assert (report.total_rows, report.valid_rows) == (40, 30)


@pytest.mark.parametrize("small_ranges", [64, 1 << 20], indirect=True)
def test_records_that_lie_in_batches_of_few_lines(spark, tmp_path, small_ranges):
    path = write(tmp_path / "mail.csv", some_rows(7, 200), "\r\n")
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "3")
    try:
        assert rows(read_event_csv(spark, path, multi_line="split")) == rows(read_event_csv(spark, path))
    finally:
        spark.conf.set(size, before)


def test_bytes_that_are_no_text_are_read_as_in_one_task(spark, tmp_path, small_ranges):
    path = write(tmp_path / "mail.csv", some_rows(3, 40))
    with open(path, "ab") as out:
        out.write(b'E-x,"\xff\xfe\n\xe9",b,c,d\n')
    found = {r.record for r in split_records(spark, path).collect()}
    assert "E-x,\"\ufffd\ufffd\n\ufffd\",b,c,d" in found
    assert rows(read_event_csv(spark, path, multi_line="split")) == rows(read_event_csv(spark, path))


def test_lines_are_cut_where_they_are_read(spark, tmp_path, small_ranges):
    """No task gathers, sorts or joins whole lines: what is shuffled are parts of records that leave their range."""
    path = write(tmp_path / "mail.csv", [[f"E{k}", "a@b.c", "open", "2024-01-15", "{\n}"] for k in range(2000)])
    found = split_records(spark, path)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text and not re.search(r"Sort \[[^\]]*place", text)
    assert found.rdd.getNumPartitions() <= 2 * TASKS_A_CORE * spark.sparkContext.defaultParallelism
