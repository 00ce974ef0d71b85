import hashlib
import random
from collections import Counter

import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from touchtrail.llm import byte_bpe, token_counts

from .helpers import AWKWARD, empty, frame

RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
PARTS = [
    "a", "the", "'ll", "'re", "'s", "'", " ", "  ", "\n", "\t", "1", "23", "!", "!!", "é", "漢字", "՘x",
    "<|endoftext|>", "<|end", "😀", " ", " the", "\x1c", "\x85", "'l", "ing",
]


@pytest.fixture(scope="module")
def encoder() -> tiktoken.Encoding:
    with open(RANKS, "rb") as ranks:
        return byte_bpe.encoding(ranks.read(), P.PATTERN)


@pytest.fixture(scope="module")
def library() -> Tokenizer:
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def counter() -> token_counts.PrefixCounter:
    with open(JSON) as definition:
        return token_counts.PrefixCounter(definition.read(), P.PATTERN)


def texts(n, most):
    rng = random.Random(n)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize("size", [1, 5, 40])
def test_cut_texts_encode_as_whole_ones(encoder, size):
    for text in texts(200, 50):
        pieces = list(byte_bpe.pieces(text, size))
        assert "".join(p for p, _ in pieces) == text
        ids = [i for p, whole in pieces for i in (encoder._encode_single_piece(p) if whole else encoder.encode_ordinary(p))]
        assert ids == encoder.encode_ordinary(text)


@pytest.mark.parametrize("text", [" " * 300_000, " " * 300_000 + "a", "x" + "\n" * 5000 + " y" + " " * 2000, "a" * 200_000])
def test_very_long_runs(encoder, library, counter, text):
    """Runs of blanks that overflow the library's own stack."""
    ids = byte_bpe.encode(text, encoder)
    assert encoder.decode_bytes(ids) == text.encode()
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert counter.count(text) == len(ids)


def test_prefix_counts_equal_the_library(library, counter):
    for text in texts(150, 12):
        want = [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
        assert list(counter.prefixes(text)) == want
        assert counter.count(text) == want[-1]
        for budget in (0, 1, 4):
            assert counter.longest_prefix(text, budget) == max(k for k, n in enumerate(want) if n <= budget)


def test_splitter_agrees_with_the_library_below_the_doubtful(library, counter):
    for point in range(1, ord(token_counts.FIRST_DOUBTFUL)):
        for text in (f"a{chr(point)}b", f"1{chr(point)}!", f" {chr(point)} "):
            assert counter.matches(text) == [p for p, _ in library.pre_tokenizer.pre_tokenize_str(text)]


def test_ids_digests_and_decoding(spark, encoder):
    rows = AWKWARD + [(500 + k, t, "s") for k, t in enumerate(texts(60, 40))]
    found = byte_bpe.round_trip(frame(spark, rows), RANKS, P.PATTERN)
    want = []
    for i, text, _ in rows:
        ids = encoder.encode_ordinary(text or "")
        sha = [hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), (text or "").encode())]
        want.append((i, len(ids), *sha))
    assert Counter(map(tuple, found.collect())) == Counter(want)
    ids = byte_bpe.encode_texts(frame(spark, rows), RANKS, P.PATTERN)
    back = byte_bpe.decode_ids(ids, RANKS, P.PATTERN)
    assert Counter((r.doc_id, bytes(r.decoded)) for r in back.collect()) == Counter((i, (t or "").encode()) for i, t, _ in rows)


def test_counts_of_documents(spark, library):
    rows = AWKWARD + [(500 + k, t, "s") for k, t in enumerate(texts(60, 40))]
    found = token_counts.count_tokens(frame(spark, rows), JSON, P.PATTERN, limit=20)
    counts = [len(library.encode(t or "", add_special_tokens=False).ids) for _, t, _ in rows]
    want = [(i, len((t or "").encode()), n, n > 20) for (i, t, _), n in zip(rows, counts)]
    assert Counter(map(tuple, found.collect())) == Counter(want)
    cut = token_counts.truncate_texts(frame(spark, rows), JSON, P.PATTERN, 7).collect()
    assert all(len(library.encode(r.kept, add_special_tokens=False).ids) <= 7 for r in cut)


def test_empty_table(spark):
    assert byte_bpe.round_trip(empty(spark), RANKS, P.PATTERN).count() == 0
    assert token_counts.count_tokens(empty(spark), JSON, P.PATTERN).count() == 0
