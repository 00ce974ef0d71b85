import csv
import datetime as dt
import uuid
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

from touchtrail import configure, ingest_email_logs
from touchtrail.operators import judge, quarantined, validated
from touchtrail.sources import read_event_csv
from touchtrail.streaming import append_new_files

HEADER = ["event_id", "user_email", "event_type", "event_timestamp", "message_details"]


def write(path, rows, header=HEADER):
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow(header)
        writer.writerows(rows)
    return str(path)


def row(number, details, email="a@b.c"):
    return [f"E{number}", email, "open", "2024-01-15 08:30:00", details]


GOOD = '{"campaign_code": "A, B", "note": "say ""x"""}'.replace('""x""', '\\"x\\"')


@pytest.fixture
def tables(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    yield f"{name}.mail", f"{name}.mail_quarantine"
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_run(spark, tables, tmp_path):
    path = write(tmp_path / "mail.csv", [row(1, GOOD), row(2, ""), row(3, "{broken"), row(4, '{"a": 1}'), row(5, GOOD, "")])
    report = ingest_email_logs(spark, path, *tables)
    assert (report.total_rows, report.valid_rows, report.quarantined_rows) == (5, 2, 3)
    assert report.quarantine_rate_pct == 60.0
    assert report.high_quarantine_rate and report.has_rejects and not report.dry_run
    assert (report.status, report.source_file) == ("success", path)
    valid = {r.event_id: r for r in spark.table(tables[0]).collect()}
    assert valid["E1"].message_details == GOOD
    assert valid["E5"].user_email == ""
    assert valid["E1"]["_source_file"] == "mail.csv"
    assert dt.datetime.fromisoformat(valid["E1"]["_ingested_at"]).utcoffset() == dt.timedelta(0)
    assert spark.table(tables[0]).columns == [*HEADER, "_source_file", "_ingested_at"]
    rejects = spark.table(tables[1])
    assert {"_error_reason", "_quarantined_at", "_source_file", "_ingested_at"} < set(rejects.columns)
    assert sorted(r.event_id for r in rejects.collect()) == ["E2", "E3", "E4"]


def test_rerun_replaces_valid_rows_and_keeps_reject_history(spark, tables, tmp_path):
    path = write(tmp_path / "mail.csv", [row(1, GOOD), row(2, "")])
    for _ in range(2):
        ingest_email_logs(spark, path, *tables)
    assert spark.table(tables[0]).count() == 1
    assert spark.table(tables[1]).count() == 2


def test_input_without_valid_rows_leaves_the_old_table(spark, tables, tmp_path):
    ingest_email_logs(spark, write(tmp_path / "a.csv", [row(1, GOOD)]), *tables)
    report = ingest_email_logs(spark, write(tmp_path / "b.csv", [row(2, ""), row(3, "x")]), *tables)
    assert (report.total_rows, report.valid_rows, report.quarantine_rate_pct) == (2, 0, 100.0)
    assert [r.event_id for r in spark.table(tables[0]).collect()] == ["E1"]
    assert spark.table(tables[1]).count() == 2


def test_clean_and_empty_inputs(spark, tables, tmp_path):
    report = ingest_email_logs(spark, write(tmp_path / "a.csv", [row(1, GOOD)]), *tables)
    assert not report.has_rejects and report.quarantine_rate_pct == 0.0
    assert not spark.catalog.tableExists(tables[1])
    report = ingest_email_logs(spark, write(tmp_path / "b.csv", []), *tables)
    assert (report.total_rows, report.quarantine_rate_pct) == (0, 0)
    assert spark.table(tables[0]).count() == 1


def test_dry_run_writes_nothing(spark, tables, tmp_path):
    path = write(tmp_path / "mail.csv", [row(1, GOOD), row(2, "")])
    report = ingest_email_logs(spark, path, *tables, write=False)
    assert report.dry_run and report.valid_rows == 1
    assert not spark.catalog.tableExists(tables[0]) and not spark.catalog.tableExists(tables[1])
    assert [r.event_id for r in report.valid.limit(5).collect()] == ["E1"]
    sample = report.quarantine.select("event_id", "user_email", "_error_reason").collect()
    assert [tuple(r) for r in sample] == [("E2", "a@b.c", "message_details is null or empty")]


def test_missing_file(spark, tables, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        ingest_email_logs(spark, str(tmp_path / "none.csv"), *tables)


def test_missing_column(spark, tables, tmp_path):
    path = write(tmp_path / "mail.csv", [["E1", "a@b.c"]], header=HEADER[:2])
    with pytest.raises(ValueError, match="colunas obrigatórias"):
        ingest_email_logs(spark, path, *tables)


def test_columns_follow_the_header(spark, tmp_path):
    shuffled = ["message_details", "extra", "event_timestamp", "event_type", "user_email", "event_id"]
    path = write(tmp_path / "mail.csv", [[GOOD, "more", "2024-01-15 08:30:00", "open", "a@b.c", "E1"]], shuffled)
    (got,) = validated(judge(read_event_csv(spark, path))).collect()
    assert (got.event_id, got.message_details, got.extra) == ("E1", GOOD, "more")


def test_files_with_different_headers_are_refused(spark, tmp_path):
    write(tmp_path / "a.csv", [row(1, GOOD)])
    write(tmp_path / "b.csv", [[GOOD, "a@b.c", "open", "2024-01-15 08:30:00", "E2"]], HEADER[::-1])
    with pytest.raises(Exception, match="CSV header"):
        read_event_csv(spark, str(tmp_path)).collect()


def test_line_breaks_inside_fields(spark, tmp_path):
    broken = write(tmp_path / "broken.csv", [row(1, '{"campaign_code":\n "A"}'), row(2, GOOD)])
    got = sorted(r.event_id for r in validated(judge(read_event_csv(spark, broken))).collect())
    assert got == ["E1", "E2"]


@pytest.mark.parametrize("multi_line", [False, True])
def test_ragged_records_are_quarantined_whole(spark, tables, tmp_path, multi_line):
    path = tmp_path / "mail.csv"
    write(path, [row(1, GOOD)])
    with open(path, "a", encoding="utf-8") as out:
        out.write("E2,a@b.c,open\r\n")
        out.write('E3,a@b.c,open,2024-01-15 08:30:00,"{""campaign_code"": 1}",surplus\r\n')
    dry = ingest_email_logs(spark, str(path), *tables, multi_line=multi_line, write=False)
    report = ingest_email_logs(spark, str(path), *tables, multi_line=multi_line)
    assert (dry.total_rows, dry.valid_rows) == (report.total_rows, report.valid_rows)
    assert (report.total_rows, report.valid_rows, report.quarantined_rows) == (3, 1, 2)
    rejects = spark.table(tables[1]).collect()
    assert {r["_error_reason"] for r in rejects} == {"malformed CSV record"}
    assert sorted(r["_corrupt_record"].split(",")[0] for r in rejects) == ["E2", "E3"]
    assert [r.event_id for r in spark.table(tables[0]).collect()] == ["E1"]


def test_daily_stream_appends_new_files_once(spark, tmp_path):
    landing, valid, rejects, state = (str(tmp_path / n) for n in ("in", "valid", "rejects", "state"))
    Path(landing).mkdir()

    def run():
        append_new_files(spark, landing, valid, rejects, state, HEADER).awaitTermination()
        return spark.read.parquet(valid).count(), spark.read.parquet(rejects).count()

    write(Path(landing) / "a.csv", [row(1, GOOD), row(2, "")])
    assert run() == (1, 1)
    assert run() == (1, 1)
    write(Path(landing) / "b.csv", [row(3, GOOD), row(4, GOOD), row(5, "{")])
    assert run() == (3, 2)
    stored = spark.read.parquet(valid)
    assert {"ingest_date", "batch_id", "_source_file", "_ingested_at"} < set(stored.columns)
    assert sorted(r["_source_file"] for r in stored.collect()) == ["a.csv", "b.csv", "b.csv"]


@pytest.mark.parametrize("parts", [1, 7])
def test_dry_run_picks_the_same_rows_on_every_partitioning(spark, tables, tmp_path, parts):
    rows = [row(k, GOOD if k % 3 else "", f"m{k}@x") for k in range(60)]
    whole = write(tmp_path / "mail.csv", rows)
    for k in range(parts):
        write(tmp_path / f"part-{k}.csv", rows[k::parts])
    want = ingest_email_logs(spark, whole, *tables, write=False).sample
    report = ingest_email_logs(spark, str(tmp_path / "part-*.csv"), *tables, write=False)
    shown = lambda frame: sorted((r.event_id, r._error_reason) for r in frame.collect())
    assert shown(report.sample) == shown(want)
    assert [sum(r._error_reason is None for r in report.sample.collect()), report.sample.count()] == [5, 10]
    assert (report.total_rows, report.valid_rows, report.dry_run) == (60, 40, True)
    assert not spark.catalog.tableExists(tables[0])


def test_dry_run_of_no_rows(spark, tables, tmp_path):
    report = ingest_email_logs(spark, write(tmp_path / "mail.csv", []), *tables, write=False, sample=3)
    assert (report.total_rows, report.valid_rows, report.sample.count()) == (0, 0, 0)
