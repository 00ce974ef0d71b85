import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchtrail.llm import collocations as C

from .helpers import AWKWARD, empty, frame

LOWER = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})


def brute(rows, least, top=2000):
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            total[lang] += len(words)
            for n in range(1, 5):
                for k in range(len(words) - n + 1):
                    counts[lang][tuple(words[k : k + n])] += 1
    for lang, f in counts.items():
        candidates = [p for p, a in f.items() if len(p) > 1 and a >= least]
        shadow = Counter()
        for p in candidates:
            for m in range(2, len(p)):
                for k in range(len(p) - m + 1):
                    shadow[p[k : k + m]] = max(shadow[p[k : k + m]], f[p])
        scored = []
        for p in candidates:
            a = f[p]
            if shadow[p] and 100 * shadow[p] >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            yield lang, rank, phrase.decode(), -a, left, right, total[lang], -score


def check(docs, least, top=2000, **settings):
    found = C.mine(docs, least=least, top=top, **settings).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    want = list(brute([(r.text, r.lang) for r in docs.select("text", "lang").collect()], least, top))
    assert Counter(map(tuple, found)) == Counter(want)
    return found


def talk(seed, n=200):
    rng = random.Random(seed)
    phrases = ["of the", "New  York\tCity", "a b a b", "x", "naïve é", "a", "b,", "the end.", "c!d", "q\x01r", "漢字 の"]
    return " ".join(rng.choice(phrases) for _ in range(n))


def test_automata_hold_sorted_phrases_and_share_states():
    rng = random.Random(3)
    words = [b"a", b"b", b"ab", b"\x01", b"z"]
    for _ in range(50):
        weighed = Counter(tuple(rng.choice(words) for _ in range(rng.randint(0, 4))) for _ in range(rng.randint(0, 60)))
        made = C.Automaton.built(sorted(weighed.items()))
        made = C.Automaton.loaded(made.dumped())
        assert list(made.phrases()) == sorted(weighed.items())
        assert all(made.weight(p) == n for p, n in weighed.items())
        assert made.weight((b"none",)) == made.weight((b"a", b"a", b"a", b"a", b"a")) == 0
        assert len(set(made.states)) == len(made.states)


def test_states_with_the_same_continuations_are_one():
    made = C.Automaton.built([((a, b, c), 7) for a in (b"1", b"2", b"3") for b in (b"x", b"y") for c in (b"p", b"q")])
    assert len(made.states) == 4


def tree_of(weighed, longest=4):
    words = sorted({w for p in weighed for w in p})
    rows = [[words.index(w) for w in p] + [-1] * (longest - len(p)) for p in sorted(weighed)]
    return C.Tree(words, np.array(rows), np.array([weighed[p] for p in sorted(weighed)]))


def closed(weighed):
    """With every beginning of every phrase."""
    return weighed | {p[:k]: 1 for p in weighed for k in range(len(p)) if p[:k] not in weighed}


def test_sums_of_trees():
    one, two = ({(b"a",): 2, (b"a", b"b"): 1, (): 5}, {(b"a",): 3, (b"c",): 1, (): 2})
    made = C.summed([tree_of(one), tree_of(two)], least=2)
    assert [(made.phrase(k), made.weights[k]) for k in range(len(made.rows))] == [((), 7), ((b"a",), 5)]


def test_trees_cut_anywhere_sum_to_the_whole():
    rng = random.Random(4)
    words = [b"a", b"b", b"ab", b"\x01", b"z"]
    for size in (1, 2, 3, 7):
        weighed = Counter(tuple(rng.choice(words) for _ in range(rng.randint(0, 4))) for _ in range(60))
        tree = tree_of(closed(weighed))
        parts = [C.Tree.loaded(tree.dumped(k, min(k + size, len(tree.rows)))) for k in range(0, len(tree.rows), size)]
        made = C.summed(parts)
        assert {made.phrase(k): made.weights[k] for k in range(len(made.rows))} == closed(weighed)
        low, high = ("g", (b"ab",)), ("g", (b"b", b"a"))
        found = list(C._within(made, "g", low, high).phrases())
        assert found == sorted((p, n) for p, n in closed(weighed).items() if low[1] <= p < high[1])


@pytest.mark.parametrize("text", ["", " \t ", "One two.THREE four", "a,,b  c\td\n\ne", "é ß " * 5 + "x" * 50])
def test_words_and_pieces(monkeypatch, text):
    monkeypatch.setattr(C, "_SEGMENT", 3)
    data = text.encode().translate(C._PLAIN)
    words = C.Words(data, 1)
    pieces = [re.findall(r"[^ \t]+", p) for p in re.split(r"[.,;:!?\n\x0b\x0c\r]", text.translate(LOWER))]
    assert [words.phrase(k, 1).decode() for k in range(len(words.hashes))] == [w for p in pieces for w in p]
    assert words.piece.tolist() == [k for k, p in enumerate(pieces) for _ in p]
    by_word = {words.phrase(k, 1): h for k, h in enumerate(words.hashes.tolist())}
    assert len(set(by_word.values())) == len(by_word)


@pytest.mark.parametrize("least", [2, 30])
def test_awkward_rows(spark, least):
    rows = AWKWARD + [(100 + k, talk(k), None) for k in range(30)]
    docs = frame(spark, rows).withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "fr").when(F.col("doc_id") % 3 == 1, "und"))
    assert check(docs, least)


def test_only_the_first_are_returned(spark):
    assert len(check(frame(spark, [(k, talk(k), "s") for k in range(20)]), 2, top=7)) == 7


def test_full_filter_loses_nothing(spark):
    check(frame(spark, [(k, talk(k), "s") for k in range(10)]), 3, max_bits=64)


def test_many_ranges_and_flushes(spark, monkeypatch):
    """The settings reach the tasks inside closures that are made here."""
    monkeypatch.setattr(C, "CHUNKS_PER_RANGE", 1)
    docs = frame(spark, [(k, talk(k, 400) + f" w{k} w{k + 1} w{k}" * 5, "s") for k in range(60)], partitions=6)
    check(docs.withColumn("lang", F.concat(F.lit("l"), (F.col("doc_id") % 5).cast("string"))), 2)


def test_big_numbers_are_exact(spark):
    big = 5_000_000_000_000
    row = spark.range(1).selectExpr(
        f"cast({C.SCALE} as decimal(18,0)) * cast({big}L as decimal(19,0)) div (cast({3 * big}L as decimal(19,0)) + cast({4 * big + 1}L as decimal(19,0))) AS s"
    )
    assert row.first().s == C.SCALE * big // (7 * big + 1)


def test_empty_table(spark):
    assert C.mine(empty(spark)).count() == 0
