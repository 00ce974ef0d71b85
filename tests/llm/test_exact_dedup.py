import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from touchtrail.llm import exact_dedup

from .helpers import AWKWARD, SCHEMA, empty, frame


def expected(rows):
    groups = defaultdict(list)
    for i, text, _ in rows:
        groups[text or ""].append(i)
    out = []
    for i, text, _ in rows:
        ids = groups[text or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("max_bits", [1 << 10, 1 << 28])
def test_groups_equal_brute_force(spark, max_bits):
    """Also with a second filter so full that rows without copies are taken for repeats."""
    rows = AWKWARD + [(100 + k, f"text {k % 700}", "s") for k in range(2000)]
    found = exact_dedup.copy_groups(frame(spark, rows), max_bits=max_bits)
    assert Counter(map(tuple, found.collect())) == expected(rows)


def test_only_rows_that_may_repeat_are_grouped(spark):
    rows = [(k, f"text {k}" if k % 10 else "same", "s") for k in range(3000)]
    digests = frame(spark, rows).select(F.xxhash64("text").alias("h"))
    flagged = digests.withColumn("m", exact_dedup.repeat_filter(digests)("h")).where("m").count()
    assert 300 <= flagged <= 330


def test_one_row_of_each_text_stays_with_its_columns(spark):
    kept = exact_dedup.drop_copies(frame(spark, AWKWARD))
    assert kept.schema.simpleString() == empty(spark).schema.simpleString()
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    best = {}
    for i, text, _ in AWKWARD:
        best[text or ""] = max(best.get(text or "", -(10**9)), -(10**9) if i is None else i)
    assert Counter((i, t or "") for i, t in rows) == Counter((i, t) for t, i in best.items())
    assert SCHEMA.startswith("doc_id")


def test_empty_table(spark):
    assert exact_dedup.copy_groups(empty(spark)).count() == 0
    assert exact_dedup.drop_copies(empty(spark)).count() == 0
