"""Phrase collocations: counts of word sequences in weighted acyclic automata, merged by ranges of phrases."""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Callable, Iterable, Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import mixed, ready, text_or_empty

LEAST_COUNT = 30
LONGEST = 4
SHADOW_PERCENT = 80
SCALE = 2_000_000
TOP = 2000

BYTES_PER_PAGE = 1 << 22
MAX_PAGES = 1 << 20
SLICE_BYTES = 1 << 22
HASHES_HELD = 1 << 22
BITS_PER_HASH = 16
MAX_FILTER_BITS = 1 << 28
_SEGMENT_BITS = 1 << 19
PHRASES_HELD = 1 << 19
PHRASES_PER_CHUNK = 1 << 12
CHUNKS_PER_RANGE = 64
BOUNDARY_SAMPLE = 1 << 18

_U = np.uint64

# Lower case for A-Z, a line feed for whatever parts pieces, a space for whatever parts words.
_PARTS_PIECES = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(
    bytes(range(0x41, 0x5B)) + _PARTS_PIECES + b"\t", bytes(range(0x61, 0x7B)) + b"\n" * len(_PARTS_PIECES) + b" "
)
_BASE = 0x9E3779B97F4A7C15 | 3
_SEGMENT = 1 << 21


# Words of texts, as places and hashes.


class _Powers:
    """Powers of the base and of its inverse, grown as texts ask for them."""

    up = down = np.ones(1, _U)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = (
                np.multiply.accumulate(np.append(_U(1), np.full(n, b, _U))) for b in (_BASE, pow(_BASE, -1, 1 << 64))
            )
        return cls.up, cls.down


_LETTER = mixed(np.arange(1, 257, dtype=_U) * _U(_BASE))


def _segment_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of each word; the hash is a sum over bytes, so all are made at once."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = (data != 32) & (data != 10)
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _Powers.of(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(_LETTER[data] * up[: len(data)], out=sums[1:])
    return starts, ends, mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))


class Words:
    """Words of plain text: where they start and end, their hashes, and the piece of each."""

    def __init__(self, data: bytes, salt: int) -> None:
        self.data = data
        whole = np.frombuffer(data, np.uint8)
        found, at = [], 0
        while at < len(data):
            blanks = (data.find(c, at + _SEGMENT) for c in (b" ", b"\n"))
            stop = min((p for p in blanks if p >= 0), default=len(data))
            starts, ends, hashes = _segment_words(whole[at:stop])
            found.append((starts + at, ends + at, hashes))
            at = stop
        none = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, _U))
        self.starts, self.ends, hashes = (np.concatenate(x) for x in zip(*(found or [none])))
        self.hashes = mixed(hashes ^ _U(salt))
        self.piece = np.searchsorted(np.flatnonzero(whole == 10), self.starts)

    def grams(self, n: int) -> np.ndarray:
        """Hashes of ``n`` words in a row from each word on."""
        k = max(0, len(self.hashes) - n + 1)
        h = self.hashes[:k]
        for j in range(1, n):
            h = mixed(h * _U(_BASE) + self.hashes[j : j + k] + _U(n))
        return h

    def together(self) -> np.ndarray:
        """Whether a word and the next one lie in the same piece."""
        return self.piece[:-1] == self.piece[1:]

    def phrase(self, at: int, n: int) -> bytes:
        """``n`` words with one space between them."""
        return b" ".join(self.data[self.starts[at] : self.ends[at + n - 1]].split())


def _words_by_group(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, Words]]:
    """Words of batches of ``(grp, text)``, group by group, a few megabytes at a time.

    Long texts are cut where a piece ends, which no phrase crosses.
    """
    for batch in batches:
        coded = batch.column(0).dictionary_encode()
        codes = coded.indices.to_numpy()
        for code, group in enumerate(coded.dictionary.to_pylist()):
            salt = zlib.crc32(group.encode())
            texts = (batch.column(1)[int(k)].as_py().translate(_PLAIN) for k in np.flatnonzero(codes == code))
            held, size = [], 0
            for text in [*texts, None]:
                if text is not None:
                    held.append(text)
                    size += len(text)
                    if size < SLICE_BYTES:
                        continue
                data = b"\n".join(held)
                at = 0
                while at < len(data):
                    stop = data.find(b"\n", at + SLICE_BYTES)
                    stop = len(data) if stop < 0 else stop
                    yield group, Words(data[at:stop], salt)
                    at = stop
                held, size = [], 0


# A filter of the hashes of phrases that occur often enough, longer ones counted where all pairs in them do.


def _of_frequent_pairs(pairs: np.ndarray, n: int) -> np.ndarray:
    """Where ``n`` words in a row hold frequent pairs only."""
    k = max(0, len(pairs) - n + 2)
    fits = pairs[:k].copy()
    for j in range(1, n - 1):
        fits &= pairs[j : j + k]
    return fits


def _page_counts(pages: int, longest: int, made) -> Callable:
    """Hashes with their counts, packed for pages by their top bits.

    Those of words and pairs, or with a filter of these those of longer phrases.
    """
    shift = _U(64 - (pages.bit_length() - 1))

    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        hashes, counts = np.unique(np.concatenate(held), return_counts=True)
        page = (hashes >> shift).astype(np.int64) if pages > 1 else np.zeros(len(hashes), np.int64)
        cuts = np.flatnonzero(np.diff(page)) + 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(page[np.append(0, cuts)]),
                pa.array([h.tobytes() for h in np.split(hashes, cuts)], pa.binary()),
                pa.array([np.minimum(c, 65535).astype("<u2").tobytes() for c in np.split(counts, cuts)], pa.binary()),
            ],
            names=["page", "hashes", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for _, words in _words_by_group(batches):
            pairs = words.together()
            if made is None:
                found = [words.hashes, words.grams(2)[pairs]]
            else:
                pairs &= _passes(made.value, words.grams(2))
                found = [words.grams(m)[_of_frequent_pairs(pairs, m)] for m in range(3, longest + 1)]
            held += found
            n += sum(map(len, found))
            if n >= HASHES_HELD:
                yield from flush(held)
                held, n = [], 0
        if n:
            yield from flush(held)

    return run


def _often(least: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        hashes = np.concatenate([np.frombuffer(x, _U) for x in table.column("hashes").to_pylist()])
        counts = np.concatenate([np.frombuffer(x, "<u2") for x in table.column("counts").to_pylist()]).astype(np.int64)
        order = np.argsort(hashes)
        hashes, counts = hashes[order], counts[order]
        firsts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
        kept = hashes[firsts][np.add.reduceat(counts, firsts) >= least]
        return pa.table({"hash": pa.array(kept.view(np.int64))})

    return run


def _power_of_two(n: int) -> int:
    return 1 << max(10, int(n - 1).bit_length())


def _probes(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    low = _U(bits - 1)
    return (hashes & low).astype(np.int64), (mixed(hashes) & low).astype(np.int64)


def _filter_parts(bits: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for places in _probes(batch.column(0).to_numpy().view(_U), bits):
                np.bitwise_or.at(mine, places >> 3, np.left_shift(1, places & 7).astype(np.uint8))
        for k, part in enumerate(mine.reshape(-1, min(bits, _SEGMENT_BITS) // 8)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([part.tobytes()], pa.binary())], names=["segment", "bits"])

    return run


def _either(table: pa.Table) -> pa.Table:
    joined = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in table.column("bits").to_pylist()])
    return pa.table({"segment": table.column("segment")[:1], "bits": pa.array([joined.tobytes()], pa.binary())})


def _filter_of(hashes: DataFrame, max_bits: int):
    """A broadcast Bloom filter of ``hashes`` with ``BITS_PER_HASH`` bits for each and never more than ``max_bits``."""
    bits = min(max_bits, _power_of_two(BITS_PER_HASH * hashes.count() or 1))
    parts = hashes.mapInArrow(_filter_parts(bits), "segment bigint, bits binary").groupBy("segment")
    made = np.zeros(bits // 8, np.uint8)
    width = min(bits, _SEGMENT_BITS) // 8
    for segment, part in parts.applyInArrow(_either, "segment bigint, bits binary").collect():
        made[segment * width : (segment + 1) * width] = np.frombuffer(part, np.uint8)
    return hashes.sparkSession.sparkContext.broadcast(made.tobytes())


def often_filter(texts: DataFrame, least: int, longest: int, max_bits: int = MAX_FILTER_BITS):
    """A Bloom filter of the phrases that occur ``least`` times or more in ``texts(grp, text)``.

    Tasks count hashes and deal them, packed, to pages by their top bits; a page adds up and keeps what is
    frequent.  Words and pairs come first; of longer phrases only those are counted that hold nothing
    but frequent pairs.  The filter never has more than ``max_bits`` (32 MB).  Beyond that it lets more
    pass than need be, and nothing frequent is missed.
    """
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    pages = min(MAX_PAGES, 1 << max(0, int(n_bytes // BYTES_PER_PAGE).bit_length()))

    def often(made) -> DataFrame:
        packed = texts.mapInArrow(_page_counts(pages, longest, made), "page bigint, hashes binary, counts binary")
        return stored(packed.groupBy("page").applyInArrow(_often(least), "hash bigint"))

    short = often(None)
    made = _filter_of(short, max_bits)
    return _filter_of(short.union(often(made)), max_bits) if longest > 2 else made


def _passes(made: bytes, hashes: np.ndarray) -> np.ndarray:
    table = np.frombuffer(made, np.uint8)
    a, b = _probes(hashes, len(table) * 8)
    return (table[a >> 3] >> (a & 7) & table[b >> 3] >> (b & 7) & 1).astype(bool)


# Weighted acyclic automata over words.


class Automaton:
    """A minimal acyclic automaton that gives every phrase (a tuple of words) in it its weight.

    A state is its weight and its arrows, a rising list of words with the numbers of the states they
    lead to; states that give the same continuations the same weights are one.
    """

    def __init__(self, states: list[tuple], root: int) -> None:
        self.states, self.root = states, root

    @classmethod
    def built(cls, weighed: Iterable[tuple[tuple[bytes, ...], int]]) -> Automaton:
        """From phrases in rising order, one by one: what lies behind the last branch is final and looked up."""
        states: list[tuple] = []
        known: dict[tuple, int] = {}

        def closed(weight: int, arrows: list) -> int:
            state = (weight, tuple(arrows))
            at = known.get(state)
            if at is None:
                at = known[state] = len(states)
                states.append(state)
            return at

        open_ones: list[list] = [[0, []]]  # weight and arrows of each state on the last phrase's path
        last: tuple[bytes, ...] = ()
        for phrase, weight in weighed:
            shared = 0
            while shared < len(last) and shared < len(phrase) and last[shared] == phrase[shared]:
                shared += 1
            for k in range(len(last), shared, -1):
                made = closed(*open_ones.pop())
                open_ones[-1][1].append((last[k - 1], made))
            open_ones += ([0, []] for _ in phrase[shared:])
            open_ones[-1][0] += weight
            last = phrase
        for k in range(len(last), 0, -1):
            made = closed(*open_ones.pop())
            open_ones[-1][1].append((last[k - 1], made))
        return cls(states, closed(*open_ones[0]))

    def phrases(self, below: tuple[bytes, ...] = (), state: int | None = None) -> Iterator[tuple[tuple[bytes, ...], int]]:
        """All phrases in rising order, with their weights."""
        weight, arrows = self.states[self.root if state is None else state]
        if weight:
            yield below, weight
        for word, to in arrows:
            yield from self.phrases((*below, word), to)

    def weight(self, phrase: Iterable[bytes]) -> int:
        """The weight of one phrase; 0 if it is not there."""
        state = self.states[self.root]
        for word in phrase:
            at = bisect.bisect_left(state[1], (word,))
            if at == len(state[1]) or state[1][at][0] != word:
                return 0
            state = self.states[state[1][at][1]]
        return state[0]

    def dumped(self) -> bytes:
        """Words, then for each state its weight and number of arrows, then for each arrow its word and state."""
        words = sorted({word for _, arrows in self.states for word, _ in arrows})
        number = {word: k for k, word in enumerate(words)}
        parts = (
            np.array([w for w, _ in self.states], "<i8"),
            np.array([len(arrows) for _, arrows in self.states], "<i8"),
            np.array([x for _, arrows in self.states for word, to in arrows for x in (number[word], to)], "<i8"),
        )
        head = np.array([self.root, len(self.states), sum(map(len, words)) + len(words)], "<i8")
        told = b"".join(word + b"\n" for word in words)
        return zlib.compress(head.tobytes() + told + b"".join(p.tobytes() for p in parts), 1)

    @classmethod
    def loaded(cls, data: bytes) -> Automaton:
        data = zlib.decompress(data)
        root, n, told = np.frombuffer(data, "<i8", 3).tolist()
        words = data[24 : 24 + told].split(b"\n")
        numbers = np.frombuffer(data[24 + told :], "<i8")
        weights, sizes, arrows = numbers[:n].tolist(), numbers[n : 2 * n].tolist(), numbers[2 * n :].tolist()
        states, at = [], 0
        for weight, size in zip(weights, sizes):
            states.append((weight, tuple((words[arrows[k]], arrows[k + 1]) for k in range(at, at + 2 * size, 2))))
            at += 2 * size
        return cls(states, root)


def _joined(phrase: tuple[bytes, ...]) -> bytes:
    return b" ".join(phrase)


def _words_of(joined: bytes) -> tuple[bytes, ...]:
    return tuple(joined.split(b" ")) if joined else ()


# Shards: what a task has seen, as trees of sorted phrases.  A tree is an automaton that shares beginnings only;
# made of arrays, it costs little for the many phrases that turn out rare.


class Tree:
    """Sorted phrases with weights: a row of word numbers for each, filled up with -1, and the words in order.

    Sorted rows are the states of the tree, each behind the one it continues.  Where a slice of them is cut
    out, states that its first row continues come along with weight 0.
    """

    def __init__(self, words: list[bytes], rows: np.ndarray, weights: np.ndarray) -> None:
        self.words, self.rows, self.weights = words, rows, weights

    def phrase(self, k: int) -> tuple[bytes, ...]:
        return tuple(self.words[w] for w in self.rows[k].tolist() if w >= 0)

    def dumped(self, low: int, high: int) -> bytes:
        """Some rows: for each state its depth, the word that leads to it and its weight, and the words."""
        rows, weights = self.rows[low:high], self.weights[low:high]
        above = int((rows[0] >= 0).sum()) - 1
        if above > 0:
            path = np.full((above, rows.shape[1]), -1, rows.dtype)
            for k in range(above):
                path[k, : k + 1] = rows[0, : k + 1]
            rows, weights = np.concatenate([path, rows]), np.concatenate([np.zeros(above, np.int64), weights])
        depth = (rows >= 0).sum(1)
        label = np.where(depth > 0, rows[np.arange(len(rows)), np.maximum(depth, 1) - 1], -1)
        used, index = np.unique(label, return_inverse=True)
        told = b"\n".join(self.words[w] if w >= 0 else b"" for w in used.tolist())
        head = np.array([len(rows), rows.shape[1], len(told)], "<i8").tobytes()
        parts = (depth.astype("u1"), index.astype("<i4"), weights.astype("<i8"))
        return zlib.compress(head + told + b"".join(x.tobytes() for x in parts), 1)

    @classmethod
    def loaded(cls, data: bytes) -> Tree:
        data = zlib.decompress(data)
        n, width, size = np.frombuffer(data, "<i8", 3).tolist()
        at = 24 + size
        words = data[24:at].split(b"\n")
        depth = np.frombuffer(data, "u1", n, at)
        index = np.frombuffer(data, "<i4", n, at + n)
        weights = np.frombuffer(data, "<i8", n, at + 5 * n)
        rows = np.full((n, width), -1, np.int64)
        places = np.arange(n)
        for d in range(width):
            last = np.maximum.accumulate(np.where(depth == d + 1, places, -1))
            inside = depth > d
            rows[inside, d] = index[last[inside]]
        return cls(words, rows, weights)


def summed(trees: list[Tree], least: int = 1) -> Tree:
    """The union of trees, equal phrases adding their weights.

    Phrases of less than ``least`` go, but for the empty one, whose weight is the number of all words.
    """
    words = sorted({word for tree in trees for word in tree.words})
    number = {word: k for k, word in enumerate(words)}
    renamed = [np.array([*(number[w] for w in tree.words), -1], np.int64)[tree.rows] for tree in trees]
    rows, weights = np.concatenate(renamed), np.concatenate([tree.weights for tree in trees])
    order = np.lexsort(rows.T[::-1])
    rows, weights = rows[order], weights[order]
    firsts = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(1)))
    rows, weights = rows[firsts], np.add.reduceat(weights, firsts)
    kept = (weights >= least) | (rows[:, 0] < 0)
    return Tree(words, rows[kept], weights[kept])


_CHUNK = "grp string, first binary, last binary, tree binary"


class _Held:
    """Phrases of one group that a task has seen: hashes, counts, and the hashes of their words."""

    def __init__(self, longest: int) -> None:
        self.longest, self.total = longest, 0
        self.names: dict[int, bytes] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, words: Words, n: int, at: np.ndarray, hashes: np.ndarray) -> None:
        found, firsts, counts = np.unique(hashes, return_index=True, return_counts=True)
        at = at[firsts]
        if n == 1:
            for h, k in zip(found.tolist(), at.tolist()):
                if h not in self.names:
                    self.names[h] = words.phrase(k, 1)
        made_of = np.zeros((len(found), self.longest), _U)
        for j in range(n):
            made_of[:, j] = words.hashes[at + j]
        self.parts.append((found, counts, made_of))
        self.size += len(found)

    def merge(self) -> None:
        hashes, counts, made_of = (np.concatenate(x) for x in zip(*self.parts))
        found, firsts, at = np.unique(hashes, return_index=True, return_inverse=True)
        added = np.bincount(at, counts, len(found)).astype(np.int64)
        self.parts = [(found, added, made_of[firsts])]
        self.size = len(found)

    def tree(self) -> Tree:
        self.merge()
        _, counts, made_of = self.parts[0]
        hashes, words = zip(*sorted(self.names.items(), key=itemgetter(1))) if self.names else ((), ())
        named = np.array(hashes, _U)
        by_hash = np.argsort(named)
        rows = np.full((len(counts) + 1, self.longest), -1, np.int64)  # the first row is the empty phrase
        used = made_of != 0
        rows[1:][used] = by_hash[np.searchsorted(named[by_hash], made_of[used])]
        weights = np.append(self.total, counts)
        order = np.lexsort(rows.T[::-1])
        return Tree(list(words), rows[order], weights[order])


def _shards(made, longest: int) -> Callable:
    def flush(held: dict[str, _Held]) -> Iterator[pa.RecordBatch]:
        for group, mine in held.items():
            tree = mine.tree()
            chunks = [(k, min(k + PHRASES_PER_CHUNK, len(tree.rows))) for k in range(0, len(tree.rows), PHRASES_PER_CHUNK)]
            rows = [(group, _joined(tree.phrase(a)), _joined(tree.phrase(b - 1)), tree.dumped(a, b)) for a, b in chunks]
            kinds = (pa.string(), pa.binary(), pa.binary(), pa.binary())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["grp", "first", "last", "tree"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Held] = {}
        for group, words in _words_by_group(batches):
            mine = held.setdefault(group, _Held(longest))
            mine.total += len(words.hashes)
            hashes, pairs = words.hashes, words.together()
            fits = _passes(made.value, hashes)
            for n in range(1, longest + 1):
                if n > 1:  # both shorter phrases in it are frequent, and so are all its words
                    hashes = words.grams(n)
                    fits = fits[:-1] & fits[1:] if n > 2 else fits[:-1] & fits[1:] & pairs
                    at = np.flatnonzero(fits)
                    fits[at] = _passes(made.value, hashes[at])
                at = np.flatnonzero(fits)
                mine.add(words, n, at, hashes[at])
            if sum(x.size for x in held.values()) >= 2 * PHRASES_HELD:
                for other in held.values():
                    other.merge()
                if sum(x.size for x in held.values()) >= PHRASES_HELD:
                    yield from flush(held)
                    held = {}
        yield from flush(held)

    return run


# Ranges of phrases: every shard's part of a range meets there.


def _boundaries(chunks: DataFrame, per_range: int, sample: int) -> list[tuple[str, tuple[bytes, ...]]]:
    """Where ranges begin, so that each has about ``per_range`` chunks.

    They come from the first phrases of at most ``sample`` chunks; others would give the same counts.
    """
    n = chunks.count()
    if n <= per_range:
        return []
    firsts = chunks.select("grp", "first", "last")
    if n > sample:
        firsts = firsts.orderBy(F.xxhash64("grp", "first", "last")).limit(sample)
    starts = sorted((r["grp"], _words_of(bytes(r["first"]))) for r in firsts.collect())
    ranges = min(-(-n // per_range), len(starts))
    return sorted({starts[k * len(starts) // ranges] for k in range(1, ranges)})


_RANGED = "range bigint, grp string, tree binary"
_UNITED = "range bigint, grp string, automaton binary"


def _dealt(boundaries) -> Callable:
    """Chunks to every range that they reach into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = boundaries.value
        for batch in batches:
            at, ranges = [], []
            for k, row in enumerate(batch.select(["grp", "first", "last"]).to_pylist()):
                low, high = (bisect.bisect_right(starts, (row["grp"], _words_of(row[c]))) for c in ("first", "last"))
                at += [k] * (high - low + 1)
                ranges += range(low, high + 1)
            rows = batch.take(pa.array(at, pa.int64()))
            columns = [pa.array(ranges, pa.int64()), rows.column("grp"), rows.column("tree")]
            yield pa.RecordBatch.from_arrays(columns, names=["range", "grp", "tree"])

    return run


def _within(tree: Tree, group: str, low: tuple | None, high: tuple | None) -> Automaton:
    """The automaton of those phrases of a tree that lie in one range."""
    place = lambda k: (group, tree.phrase(k))
    first = 0 if low is None else bisect.bisect_left(range(len(tree.rows)), low, key=place)
    last = len(tree.rows) if high is None else bisect.bisect_left(range(len(tree.rows)), high, key=place)
    return Automaton.built((tree.phrase(k), int(tree.weights[k])) for k in range(first, last))


def _united(least: int, boundaries) -> Callable:
    """The sum of all chunks that reach into a range, as far as they do."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        starts, at = boundaries.value, key[0].as_py()
        low, high = starts[at - 1] if at else None, starts[at] if at < len(starts) else None
        shards: dict[str, list[bytes]] = {}
        for group, data in zip(table.column("grp").to_pylist(), table.column("tree").to_pylist()):
            shards.setdefault(group, []).append(data)
        made = {}
        for group, parts in shards.items():
            tree = summed([Tree.loaded(part) for part in parts], least)
            made[group] = _within(tree, group, low, high).dumped()
        columns = {
            "range": pa.array([at] * len(made), pa.int64()),
            "grp": pa.array(list(made), pa.string()),
            "automaton": pa.array(list(made.values()), pa.binary()),
        }
        return pa.table(columns)

    return run


def phrase_counts(
    texts: DataFrame, least: int = LEAST_COUNT, longest: int = LONGEST, max_bits: int = MAX_FILTER_BITS
) -> tuple[DataFrame, list]:
    """Automata of all phrases of up to ``longest`` words that occur ``least`` times in ``texts(grp, text)``.

    ``(range, grp, automaton)``, one row for each group and range of phrases, and where ranges begin.
    """
    spark = texts.sparkSession
    made = often_filter(texts, least, longest, max_bits)
    chunks = stored(texts.mapInArrow(_shards(made, longest), _CHUNK))
    boundaries = _boundaries(chunks, CHUNKS_PER_RANGE, BOUNDARY_SAMPLE)
    shared = spark.sparkContext.broadcast(boundaries)  # at most BOUNDARY_SAMPLE phrases
    ranged = chunks.mapInArrow(_dealt(shared), _RANGED)
    return stored(ranged.groupBy("range").applyInArrow(_united(least, shared), _UNITED)), boundaries


# Candidates, their parts and their scores.

_CUT = "grp string, phrase binary, a bigint, k bigint, first_part binary, rest binary"
_INNER = "grp string, inner binary, f bigint"


def _each(make: Callable, names: list[str]) -> Callable:
    """Rows made of each phrase of automata: strings for the group, bytes for phrases, integers for the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, data in zip(batch.column("grp").to_pylist(), batch.column("automaton").to_pylist()):
                rows = [(group, *row) for phrase, n in Automaton.loaded(data).phrases() for row in make(phrase, n)]
                if rows:
                    columns = list(zip(*rows))
                    kinds = [pa.string() if isinstance(c[0], str) else pa.binary() if isinstance(c[0], bytes) else pa.int64() for c in columns]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    return run


def _cuts(phrase: tuple[bytes, ...], n: int) -> Iterator[tuple]:
    """Every way to cut a candidate in two."""
    for k in range(1, len(phrase)):
        yield _joined(phrase), n, k, _joined(phrase[:k]), _joined(phrase[k:])


def _inner(phrase: tuple[bytes, ...], n: int) -> Iterator[tuple]:
    """Shorter candidates that lie inside a longer one."""
    inside = {phrase[i : i + m] for m in range(2, len(phrase)) for i in range(len(phrase) - m + 1)}
    for part in inside:
        yield _joined(part), n


def _total(phrase: tuple[bytes, ...], n: int) -> Iterator[tuple]:
    if not phrase:
        yield (n,)


def _range_of(boundaries) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = boundaries.value
        for batch in batches:
            asked = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            ranges = [bisect.bisect_right(starts, (group, _words_of(part))) for group, part in asked]
            yield pa.RecordBatch.from_arrays([pa.array(ranges, pa.int64()), *batch.columns], names=["range", "grp", "part"])

    return run


def _looked_up(asked: pa.Table, counted: pa.Table) -> pa.Table:
    """Weights of the parts asked for, read off the automata of their range."""
    automata = {g: Automaton.loaded(d) for g, d in zip(counted.column("grp").to_pylist(), counted.column("automaton").to_pylist())}
    groups, parts = asked.column("grp").to_pylist(), asked.column("part").to_pylist()
    found = [automata[g].weight(_words_of(p)) if g in automata else 0 for g, p in zip(groups, parts)]
    return pa.table({"grp": asked.column("grp"), "part": asked.column("part"), "f": pa.array(found, pa.int64())})


def part_counts(parts: DataFrame, counts: DataFrame, boundaries: list) -> DataFrame:
    """``(grp, part, f)`` for ``parts(grp, part)``: each is asked for once, in the range where it lies."""
    shared = parts.sparkSession.sparkContext.broadcast(boundaries)
    asked = parts.distinct().mapInArrow(_range_of(shared), "range bigint, grp string, part binary")
    together = asked.groupBy("range").cogroup(counts.groupBy("range"))
    return stored(together.applyInArrow(_looked_up, "grp string, part binary, f bigint"))


def mine(
    docs: DataFrame,
    least: int = LEAST_COUNT,
    longest: int = LONGEST,
    shadow_percent: int = SHADOW_PERCENT,
    scale: int = SCALE,
    top: int = TOP,
    text_col: str = "text",
    group: str | Column = "lang",
    no_group: str = "und",
    max_bits: int = MAX_FILTER_BITS,
) -> DataFrame:
    """Each group's ``top`` collocations: lang, rank, phrase, k, a, l, r, n, score.

    Texts, in lower case for A-Z, are parted at sentence marks and line ends into pieces and these at spaces
    and tabs into words.  A candidate is a phrase of 2 to ``longest`` words that lies ``least`` times or
    more (``a``) in pieces of its group.  Cut after ``k`` words, its parts occur ``l`` and ``r`` times, and
    the score is ``scale * a / (l + r)``, rounded down; the cut of least score counts, the first of equals.
    Candidates go that lie inside a longer one which is found ``shadow_percent`` in a hundred times as
    often or more.  The rest are ranked by score, count, and bytes of the phrase; ``n`` is the number of all
    words of the group.  A missing text is empty, a missing group is ``no_group``; an empty table
    gives no rows, as does a group without candidates.

    A phrase that is frequent holds frequent pairs only, so a filter built level by level (`often_filter`)
    keeps rare phrases from being gathered.  Each task builds trees of sorted phrases, which meet by ranges
    of phrases and are summed there into minimal automata; no range depends on one word or pair alone.  Phrases are told apart by
    64 bits of hash within a task, and by their words from there on.
    """
    spark = docs.sparkSession
    ready(spark)
    grp = F.coalesce((F.col(group) if isinstance(group, str) else group).cast("string"), F.lit(no_group))
    texts = docs.select(grp.alias("grp"), text_or_empty(text_col).cast("binary").alias("text"))
    counts, boundaries = phrase_counts(texts, least, longest, max_bits)
    cuts = stored(counts.mapInArrow(_each(_cuts, ["grp", "phrase", "a", "k", "first_part", "rest"]), _CUT))
    sides = cuts.select("grp", F.col("first_part").alias("part")).union(cuts.select("grp", "rest"))
    found = part_counts(sides, counts, boundaries)
    for side, count in (("first_part", "l"), ("rest", "r")):
        named = found.select(F.col("grp"), F.col("part").alias(side), F.col("f").alias(count))
        cuts = cuts.join(named.hint("merge"), ["grp", side])
    exact = f"cast({scale} as decimal(18,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))"
    lowest = F.min(F.struct(F.expr(exact).alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("grp", "phrase", "a").agg(lowest).select("grp", "phrase", "a", "cut.*")
    inner = counts.mapInArrow(_each(_inner, ["grp", "inner", "f"]), _INNER)
    longer = inner.groupBy(F.col("grp").alias("_g"), "inner").agg(F.max("f").alias("longer"))
    inside = (F.col("grp") == F.col("_g")) & (F.col("phrase") == F.col("inner"))
    big = lambda c: F.col(c).cast("decimal(19,0)")
    shown = F.col("longer").isNull() | (big("longer") * 100 < big("a") * shadow_percent)
    open_ones = scored.join(longer.hint("merge"), inside, "left").where(shown)
    order = Window.partitionBy("grp").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    best = open_ones.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = counts.mapInArrow(_each(_total, ["grp", "n"]), "grp string, n bigint")
    return best.select("grp", "rank", "phrase", "k", "a", "l", "r", "score").join(totals.hint("merge"), "grp").select(
        F.col("grp").alias("lang"),
        F.col("rank").cast("bigint").alias("rank"),
        F.col("phrase").cast("string").alias("phrase"),
        *("k", "a", "l", "r", "n", "score"),
    )
