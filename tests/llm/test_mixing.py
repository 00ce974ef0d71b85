from collections import Counter, defaultdict

import numpy as np
import pytest

from touchtrail.llm import mixing

from .helpers import AWKWARD, empty, frame, prose


def documents(n=600):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(n):
        source = ["a", "b", "c", "d", "e", None][min(5, int(rng.exponential(1.5)))]
        rows.append((k, prose(k, int(rng.lognormal(3.5, 1)) + 1), source))
    return rows


def plain_targets(sizes):
    """Words for each source, by filling up round after round."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in order if s not in full)
        target = {s: 2 * sizes[s] if s in full else rest * weight[s] / open_weight for s in order}
        over = {s for s in order if s not in full and target[s] > 2 * sizes[s]}
        if not over:
            return target
        full |= over


def test_targets_and_taken_words(spark):
    rows = documents() + [(None, "x y", "z"), (5000, None, "z"), (5001, "", "y")]
    found = mixing.mix_sources(frame(spark, rows)).collect()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").encode().split())
    targets, taken = plain_targets(sizes), Counter()
    assert len(found) == len(rows)
    for r in found:
        assert r.target == pytest.approx(targets[r.source], rel=1e-9)
        assert r.source_size == sizes[r.source]
        assert r.taken == r.copies * r.size and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for source, target in targets.items():
        assert abs(taken[source] - target) <= max(2, 0.01 * target)


def test_reruns_agree_whatever_the_partitions(spark):
    rows = documents(300) + AWKWARD
    a, b = (mixing.mix_sources(frame(spark, rows, n)).collect() for n in (1, 7))
    one, other = (Counter((r.doc_id, r.source, r.size, r.taken) for r in x) for x in (a, b))
    assert one == other


def test_many_blocks_balance_as_one(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_UNITS", 16)
    monkeypatch.setattr(mixing, "BLOCKS_TOGETHER", 4)
    monkeypatch.setattr(mixing, "LANDING_UNITS", 8)
    found = mixing.mix_sources(frame(spark, documents())).collect()
    by = defaultdict(list)
    for r in found:
        by[r.source].append(r)
    for rows in by.values():
        target = rows[0].target
        # Each step of the landing goes to the nearer side, so the error ends below half of the largest size.
        assert abs(sum(r.taken for r in rows) - target) <= max(r.size for r in rows) / 2
        docs = sum(r.copies for r in rows)
        assert abs(docs - target / rows[0].source_size * len(rows)) <= 0.1 * len(rows) + 2


def test_flight_keeps_both_sums_and_chances():
    rng = np.random.default_rng(0)
    sizes, chances = rng.integers(1, 500, 80).astype(float), np.full(80, 0.3)
    chosen = np.zeros(80)
    for _ in range(400):
        out = mixing.fly(sizes, chances, rng.random(80))
        assert ((out > 0) & (out < 1)).sum() <= 2
        assert out.sum() == pytest.approx(24) and out @ sizes == pytest.approx(chances @ sizes)
        chosen += out
    assert abs(chosen / 400 - 0.3).max() < 0.12


def test_equal_sizes_and_single_units():
    assert mixing.fly(np.array([7.0] * 10), np.full(10, 0.5), np.linspace(0, 0.9, 10)).sum() == pytest.approx(5)
    assert mixing.land(np.array([10.0]), np.array([0.7])).tolist() == [1.0]


def test_rows_come_as_often_as_they_are_taken(spark):
    rows = documents(200) + AWKWARD
    taken = Counter()
    for r in mixing.mix_sources(frame(spark, rows)).collect():
        taken[r.doc_id, r.source, r.size] += r.copies
    mix = mixing.take_mixture(frame(spark, rows))
    assert mix.schema.simpleString() == empty(spark).schema.simpleString()
    got = Counter((r.doc_id, r.source, len((r.text or "").encode().split())) for r in mix.collect())
    assert got == +taken


def test_empty_tables(spark):
    assert mixing.mix_sources(empty(spark)).count() == 0
    assert mixing.take_mixture(empty(spark)).count() == 0
    blank = frame(spark, [(1, None, "a"), (2, "  ", None)])
    assert [r.taken for r in mixing.mix_sources(blank).collect()] == [0, 0]


def test_rows_alike_are_dealt_to_many_blocks(spark, monkeypatch):
    """Rows without an id and of one size have luck of their own, and reruns agree."""
    units = []
    chosen = mixing.balanced_choice
    monkeypatch.setattr(mixing, "balanced_choice", lambda rows: units.append(rows) or chosen(rows))
    rows = [(None, f"w{k} x y", "a") for k in range(400)] + [(k, prose(k, 9), "b") for k in range(100)]
    for mix in (mixing.mix_sources, mixing.take_mixture):
        one, other = (Counter(map(tuple, mix(frame(spark, rows, n)).collect())) for n in (1, 5))
        assert one == other
    assert len(units) == 4
    for rows in units:
        alike = rows.where("source = 'a'")
        assert alike.select("luck").distinct().count() == alike.count() > 0
