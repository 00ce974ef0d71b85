import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from touchtrail.llm import common, substring_dedup

from .helpers import AWKWARD, empty, frame, prose


def expected(rows, window):
    order = [substring_dedup.NO_ID if i is None else i for i, _, _ in rows]
    words = [(t or "").encode().split() for _, t, _ in rows]
    first = {}
    for i, w in zip(order, words):
        for k in range(len(w) - window + 1):
            gram = tuple(w[k : k + window])
            first[gram] = min(first.get(gram, i), i)
    out = []
    for (doc, _, _), i, w in zip(rows, order, words):
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return Counter(out)


@pytest.mark.parametrize("window", [1, 3, 13, 30])
def test_equals_brute_force(spark, window):
    rng = random.Random(window)
    passage = prose(99, 45).split()
    rows = list(AWKWARD)
    for k in range(30):
        words = prose(1000 + k, rng.randrange(5, 80), 40 if k % 3 else 3).split()
        at = rng.randrange(len(words))
        a, b = sorted(rng.sample(range(46), 2))
        rows.append((50 + k // 2, " ".join(words[:at] + passage[a:b] + words[at:]), "s"))
    found = substring_dedup.remove_shared_windows(frame(spark, rows), window=window)
    assert Counter(map(tuple, found.collect())) == expected(rows, window)


def test_levels_at_most_double():
    assert substring_dedup.levels(13) == [7, 13]
    assert substring_dedup.levels(50) == [7, 13, 25, 50]
    assert substring_dedup.levels(5) == [5]


def test_word_hashes_tell_words_apart_across_pieces(monkeypatch):
    monkeypatch.setattr(common, "_SEGMENT", 64)
    texts = [prose(k, 50).encode() for k in range(9)] + [b"", b" \n ", b"x" * 500, b"ab ba aab aba baa a b", b"end"]
    hashes, counts = common.word_hashes(texts)
    assert counts.tolist() == [len(t.split()) for t in texts]
    words = [w for t in texts for w in t.split()]
    assert len({*zip(words, hashes.tolist())}) == len(set(words)) == len(np.unique(hashes))


def test_empty_table(spark):
    assert substring_dedup.remove_shared_windows(empty(spark)).count() == 0
