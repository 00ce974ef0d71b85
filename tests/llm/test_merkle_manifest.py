import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchtrail.llm import merkle_manifest as M

from .helpers import AWKWARD, empty, frame


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def told(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row):
    return H(*(told(row[c]) for c in M.FIELDS))


def rise(nodes):
    """All levels over nodes, and for each node its siblings with their sides."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H(*below[k : k + 2]) for k in range(0, len(below), 2)])
    paths = []
    for k in range(len(nodes)):
        path = []
        for level in levels[:-1]:
            path.append((k & 1, level[k ^ 1] if k ^ 1 < len(level) else None))
            k >>= 1
        paths.append(path)
    return levels[-1][0], paths


def brute(rows, tampered):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        trees[g] = rise([leaf_of(r) for r in groups[g]])
    root, above = rise([trees[g][0] for g in order])
    for g, upper in zip(order, above):
        for row, path in zip(groups[g], trees[g][1]):
            node = leaf_of(tampered(row))
            for right, beside in path + upper:
                node = H(beside, node) if right else H(node, beside or "")
            siblings = [s for _, s in path + upper if s]
            yield row["doc_id"], leaf_of(row), trees[g][0], root, H(*siblings), node, node == root


def tampered(row):
    row = dict(row)
    if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0 and row["n_chars"] is not None:
        row["n_chars"] += 1
    return row


def manifest(docs, **settings):
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return M.manifest(docs, changed, {"n_chars": F.col("n_chars").cast("decimal(38,0)") + 1}, **settings)


def check(docs, **settings):
    found = manifest(docs, **settings)
    found = found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("siblings", ""), 256), "folded_root", F.col("folded_root") == F.col("root")
    )
    rows = [r.asDict() for r in docs.collect()]
    assert Counter(map(tuple, found.collect())) == Counter(brute(rows, tampered))


@pytest.mark.parametrize("n", [0, 1, 5, 64, 3000, 9000, 65536])
def test_bitmaps_hold_their_members(n):
    rng = np.random.default_rng(n)
    for members in (np.sort(rng.choice(1 << 16, n, replace=False)), np.arange(n)):
        if not n:
            continue
        data = M.packed(members)
        assert len(data) <= 1 + min(2 * n, 8192)
        assert M.members_of(data).tolist() == members.tolist()
        bits = M.bits_of(data)
        assert np.flatnonzero(bits).tolist() == members.tolist()
        places = rng.integers(0, 1 << 16, 50)
        assert M.ranks(bits, M.directory(bits), places).tolist() == np.searchsorted(members, places).tolist()


def test_awkward_rows(spark):
    check(frame(spark, AWKWARD).withColumn("lang", F.when(F.col("doc_id") > 4, F.lit("xx")).when(F.col("doc_id") > 2, F.lit("é"))))


def test_spread_ids_and_many_groups(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(-(1 << 62), 1 << 62), f"t{k}", None) for k in range(150)]
    rows += [(rng.randrange(200_000), f"u{k}", "s") for k in range(150)]
    check(frame(spark, rows).withColumn("lang", F.concat(F.lit("g"), F.pmod("doc_id", F.lit(17)).cast("string"))))


@pytest.mark.parametrize("slot_bits", [1, 3])
def test_several_levels_of_slot_arrays(spark, slot_bits):
    rows = [(k * 3, f"t{k}", None) for k in range(70)] + [(1, "x", None)]
    check(frame(spark, rows).withColumn("lang", F.when(F.col("doc_id") > 150, "a")), slot_bits=slot_bits)


def test_many_rows_share_an_id(spark):
    rows = [(7, f"t{k % 40}", "s") for k in range(120)] + [(None, f"n{k}", "s") for k in range(60)] + [(k, "x", "s") for k in range(30)]
    check(frame(spark, rows))


def test_trees_of_several_blocks(spark):
    check(frame(spark, [(k * 5 % 10_007, f"t{k}", "s") for k in range(9_000)], partitions=5))


def test_empty_table(spark):
    assert manifest(empty(spark)).count() == 0
