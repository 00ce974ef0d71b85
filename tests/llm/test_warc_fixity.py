import hashlib

import pytest
from pyspark.sql import functions as F

from touchtrail.llm import warc_fixity

SCHEMA = "page_id bigint, url string, html string, place int, archive int, offset int, record string"


def pages(n=300):
    rows = [(k, f"http://h/{k}", f"<p>{'x' * (k % 50)}{k}</p>") for k in range(n)]
    return rows + [(None, None, None), (None, None, None), (7, "", ""), (8, "u", "é" * 5000), (9, "u", "a"), (9, "u", "a")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "r") for r in rows], SCHEMA).repartition(3)


def replica(spark, rows, records=16):
    record = warc_fixity.record_bytes(F.col("url"), F.col("html"))
    pages = frame(spark, rows).drop("archive", "offset").withColumn("record", record)
    sized = pages.withColumn("n_bytes", F.octet_length("record").cast("bigint"))
    laid = warc_fixity.archived(sized, ["page_id", "url", "html"], records=records)
    return laid, laid.select("archive", "offset", "record")


def audit(first, second, *args):
    return warc_fixity.audit(warc_fixity.leaves(first), warc_fixity.leaves(second), *args)


def test_records_fill_archives_without_gaps(spark):
    laid, records = replica(spark, pages())
    by_archive = {}
    for r in records.collect():
        by_archive.setdefault(r.archive, []).append((r.offset, bytes(r.record)))
    assert len(by_archive) == -(-len(pages()) // 16)
    for parts in by_archive.values():
        at = 0
        for offset, record in sorted(parts):
            assert offset == at
            head, _, body = record.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.0\r\n")
            assert int(head.rpartition(b"Content-Length: ")[2]) == len(body) - 4
            at += len(record)


@pytest.mark.parametrize("range_bytes", [1, 700, 1 << 16])
def test_finds_exactly_the_damage(spark, range_bytes):
    _, records = replica(spark, pages())
    rows = sorted((r.archive, r.offset, bytes(r.record)) for r in records.collect())
    damaged = {k: r for k, r in enumerate(rows)}
    changed, lost = {5, 130, 299}, {17, 200}
    for k in changed:
        a, o, b = rows[k]
        damaged[k] = (a, o, b[:-6] + b"#" + b[-5:])
    for k in lost:
        del damaged[k]
    extra = (3, 10**6, b"new")
    other = spark.createDataFrame([*damaged.values(), extra], "archive bigint, offset bigint, record binary")
    found = {(r.archive, r.offset): r for r in audit(records, other, range_bytes).collect()}
    want = {rows[k][:2]: "changed" for k in changed} | {rows[k][:2]: "missing" for k in lost} | {extra[:2]: "extra"}
    assert {k: r.status for k, r in found.items()} == want
    for k in changed:
        r = found[rows[k][:2]]
        assert r.first_sha256 == hashlib.sha256(b"\0" + rows[k][2]).hexdigest()
        assert r.second_sha256 == hashlib.sha256(b"\0" + damaged[k][2]).hexdigest()


def test_equal_and_empty_replicas(spark):
    _, records = replica(spark, pages(40))
    assert audit(records, records).count() == 0
    none = records.limit(0)
    assert audit(none, none).count() == 0
    assert {r.status for r in audit(records, none).collect()} == {"missing"}
    assert replica(spark, [])[1].count() == 0


def test_branches_that_agree_are_not_descended(spark, monkeypatch):
    """Below the root only children of nodes that differ are compared."""
    _, records = replica(spark, pages(300), records=4)
    last = records.orderBy(F.col("archive").desc(), F.col("offset").desc()).limit(1)
    other = records.join(last.select("archive", "offset"), ["archive", "offset"], "left_anti")
    seen = []
    children = warc_fixity._children
    monkeypatch.setattr(warc_fixity, "_children", lambda *a: seen.append(children(*a)) or seen[-1])
    assert audit(records, other).count() == 1
    assert seen and all(df.count() <= warc_fixity.FAN_OUT for df in seen)
