import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from touchtrail.llm import packing, queries

from .helpers import AWKWARD, empty, frame, prose
from .test_tokens import JSON, RANKS, texts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library() -> Tokenizer:
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def encoder() -> packing.Encoder:
    with open(JSON) as definition, open(RANKS, "rb") as ranks:
        return packing.Encoder(definition.read(), ranks.read(), P.PATTERN)


def held(pieces, size):
    """Checks the sequences of pieces, and gives every document's ids as laid out."""
    sequences, documents = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length == len(p.ids) // 4 > 0
        sequences[p.sequence_id].append((p.offset, p.length))
        documents[p.row].append(p)
    for laid in sequences.values():
        at = 0
        for offset, length in sorted(laid):
            assert offset == at
            at += length
        assert at == size or at < size and at & (at - 1) == 0
    out = []
    for cut in documents.values():
        cut.sort(key=lambda p: p.start)
        at = 0
        for p in cut:
            assert p.start == at
            at += p.length
        assert {p.doc_tokens for p in cut} == {at}
        out.append((cut[0].doc_id, tuple(np.frombuffer(b"".join(p.ids for p in cut), "<u4").tolist())))
    return out


def test_ids_equal_the_library(encoder, library):
    strange = ["’quoted’ — and “more”", "漢字 and a’b c", "x 　y z", "<|endoftext|>’s", "", "a" * 70_000 + " ’"]
    for text in [*texts(300, 30), *strange]:
        assert encoder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids
        assert encoder.ids(text, 1).tolist()[-1] == 1


def test_rooms_have_no_padding():
    for total in (0, 1, 7, 8, 9, 8191, 100_000):
        found = packing.rooms(total, 2048)
        assert sum(found) == total
        assert all(n == 2048 or n & (n - 1) == 0 for n in found)


def test_documents_go_whole_to_the_cheapest_sequence_with_room():
    found = packing.balanced([6, 5, 3, 2], 8)
    assert found == [(0, 0, 6, 0, 0), (1, 0, 5, 1, 0), (2, 0, 3, 1, 5), (3, 0, 2, 0, 6)]


def test_cut_documents_fill_every_sequence():
    rng = random.Random(5)
    for _ in range(50):
        lengths = [rng.randint(1, 15) for _ in range(rng.randint(0, 40))]
        found = packing.balanced(lengths, 16)
        used = Counter()
        for k, start, n, at, offset in sorted(found, key=lambda f: (f[3], f[4])):
            assert offset == used[at]
            used[at] += n
        assert [used[k] for k in range(len(used))] == packing.rooms(sum(lengths), 16)
        assert len(found) <= len(lengths) + len(used)
        for k, n in enumerate(lengths):
            cut = sorted((s, m) for d, s, m, _, _ in found if d == k)
            assert [s for s, _ in cut] == [sum(m for _, m in cut[:i]) for i in range(len(cut))]
            assert sum(m for _, m in cut) == n


def test_costs_come_out_alike():
    rng = random.Random(6)
    found = packing.balanced([rng.randint(20, 900) for _ in range(2000)], 2048)
    costs = Counter()
    for _, _, n, at, _ in found:
        costs[at] += packing.cost(n)
    whole = sorted(c for at, c in costs.items() if at < max(costs) - 11)
    by_chance = [packing.cost(20), packing.cost(900) * 2.2]
    assert whole[-1] < 1.35 * whole[len(whole) // 2] < 1.35 * by_chance[1]


@pytest.mark.parametrize("group_tokens", [500, 1 << 21])
def test_every_id_lies_in_one_piece(spark, library, group_tokens):
    rows = AWKWARD + [(500 + k, t, "s") for k, t in enumerate(texts(60, 40))]
    found = packing.pack_documents(frame(spark, rows), JSON, RANKS, P.PATTERN, size=64, group_tokens=group_tokens)
    want = [(i, (*library.encode(t or "", add_special_tokens=False).ids, 1)) for i, t, _ in rows]
    assert Counter(held(found.collect(), 64)) == Counter(want)


def test_reruns_agree(spark):
    docs = frame(spark, [(k, prose(k, 30), "s") for k in range(40)])
    one, two = (packing.pack_documents(docs, JSON, RANKS, P.PATTERN, size=64).drop("ids").collect() for _ in range(2))
    assert Counter(one) == Counter(two)


def test_empty_table(spark):
    assert packing.pack_documents(empty(spark), JSON, RANKS, P.PATTERN).count() == 0


def test_query(spark, library):
    found = queries.op11_cost_packing(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    pieces = defaultdict(list)
    for p in found.collect():
        pieces[p.doc_id].append(p)
    assert len(pieces) == len(docs)
    for doc in docs:
        ids = np.array([*library.encode(doc.text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(pieces[doc.doc_id], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            at += p.length
            assert p.ids_crc32 == zlib.crc32(ids[p.start : at].tobytes())
        assert at == len(ids)
    ends = found.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    for row in ends.collect():
        assert row.n == row.end and (row.n == 2048 or row.n < 2048 and row.n & (row.n - 1) == 0)
