"""Token counts by dynamic programming over prefixes of byte-level BPE."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from itertools import groupby
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import ready, text_or_empty

TOKEN_LIMIT = 512
CACHED_MATCHES = 400_000
CACHED_PAIRS = 500_000
CACHED_CHARS = 64

# Below this code point, the splitter of the library and the pattern here know the same letters.
FIRST_DOUBTFUL = "\u0558"
_DOUBTFUL = re.compile(f"[{FIRST_DOUBTFUL}-\U0010ffff]")
# Between a printable ASCII character and a space before another one, every splitter begins a match.
_CUT = re.compile(r"(?<=[!-~])(?= [!-~])")
_BLANK = regex.compile(r"\s")
_BLANKS_AT_END = regex.compile(r"\s+\Z")
_CONTRACTIONS = ("'re", "'ve", "'ll")
_CLASS = re.compile(r"\\p\{\w+\}|\\[sS]|\\.|\[\^?|\]|.", re.DOTALL)


def runs(text: str) -> Iterator[tuple[bool, str]]:
    """A text as runs of whole words with and without doubtful characters; each splits by itself."""
    if text.isascii() or not _DOUBTFUL.search(text):
        yield True, text
        return
    for known, words in groupby(_CUT.split(text), lambda word: not _DOUBTFUL.search(word)):
        yield known, "".join(words)


def _ranges(kind: str) -> str:
    """The characters below the doubtful ones that ``kind`` matches, as the inside of a bracketed class."""
    points = [p for p in range(ord(FIRST_DOUBTFUL)) if regex.match(kind, chr(p))]
    out, k = [], 0
    while k < len(points):
        first = points[k]
        while k + 1 < len(points) and points[k + 1] == points[k] + 1:
            k += 1
        out.append(rf"\u{first:04x}-\u{points[k]:04x}")
        k += 1
    return "".join(out)


def known_splitter(pattern: str) -> Callable[[str], list[str]]:
    """What ``pattern`` finds in a text without doubtful characters.

    Classes are spelled out, so that the standard module can be used, which is twice as fast here.
    """
    out, inside = [], False
    for part in _CLASS.findall(pattern):
        if part.startswith("["):
            inside = True
        elif part == "]":
            inside = False
        elif part.startswith("\\p") or part == r"\s":
            part = _ranges(part) if inside else f"[{_ranges(part)}]"
        elif part == r"\S":
            if inside:
                return regex.compile(pattern).findall
            part = f"[^{_ranges(r'\s')}]"
        out.append(part)
    return re.compile("".join(out)).findall


def _alphabet() -> list[str]:
    """The printable character that stands for each byte: itself, or the next one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


_SHOWN = {b: c for b, c in enumerate(_alphabet())}


def shown(text: str) -> str:
    """The bytes of a text in the alphabet of the vocabulary, a character for each byte."""
    return text.encode("utf-8", "replace").decode("latin-1").translate(_SHOWN)


class Aged(dict):
    """A bounded cache: what was asked for since the last but one time it was full is there."""

    def __init__(self, make: Callable, half: int) -> None:
        self.make, self.half = make, half
        self.older: dict = {}

    def __missing__(self, key):
        value = self.older.pop(key, None)
        if value is None:
            value = self.make(key)
        if len(key) <= CACHED_CHARS:
            if len(self) >= self.half:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class PrefixCounter:
    """Counts tokens of prefixes by the tokenizer in ``definition`` (the text of its .json file).

    The tokens of a prefix are those of a shorter prefix and one more; which one is settled by the
    two last tokens alone: they must stay apart when merged by themselves.  So a table holds, for
    every prefix of a match of the splitter, its last token and its count, and each place tries
    the few tokens that end there, found in a trie of reversed tokens.  Matches do not affect each
    other and come again, so the counts at their ends are kept for a bounded number of them.
    """

    def __init__(self, definition: str, pattern: str) -> None:
        self.library = Tokenizer.from_str(definition)
        told = json.loads(definition)
        self.special = [t["content"] for t in told["added_tokens"]]
        self.split = regex.compile(pattern)
        self.split_known = known_splitter(pattern)
        longest_first = sorted(self.special, key=len, reverse=True)
        self.parts = regex.compile("|".join(f"({regex.escape(s)})" for s in longest_first) or r"(?!)")
        self.ending: dict = {}  # a node holds the nodes one character further to the left, and at "" its token
        for token in told["model"]["vocab"]:
            node = self.ending
            for char in reversed(token):
                node = node.setdefault(char, {})
            node[""] = token
        # Keys of the first are matches as they stand in texts, of the second those in the shown alphabet.
        self.counts = Aged(lambda match: self.table(shown(match))[-1], CACHED_MATCHES)
        self.counts_of_shown = Aged(lambda match: self.table(match)[-1], CACHED_MATCHES // 4)
        self.apart = Aged(self._stay_apart, CACHED_PAIRS)

    def _stay_apart(self, pair: tuple[str, str]) -> bool:
        merged = self.library.model.tokenize(pair[0] + pair[1])
        return len(merged) == 2 and merged[0].value == pair[0]

    def table(self, match: str) -> list[int]:
        """Count of tokens of each prefix of one match, given and counted in the shown alphabet."""
        counts, last = [0], [""]
        ending, apart = self.ending, self.apart
        for upto in range(len(match)):
            node, start = ending, upto
            while True:
                node = node[match[start]]
                token = node.get("")
                if token is not None and (not start or apart[last[start], token]):
                    break
                start -= 1
            counts.append(counts[start] + 1)
            last.append(token)
        return counts

    def matches(self, text: str) -> list[str]:
        """What the splitter makes of a text without special tokens, in the shown alphabet."""
        out: list[str] = []
        for known, run in runs(text):
            if known:
                out += map(shown, self.split_known(run))
            else:
                out += (piece for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(run))
        return out

    def _plain(self, text: str) -> int:
        """Tokens of a text without special tokens."""
        total = 0
        for known, run in runs(text):
            if known:
                total += sum(map(self.counts.__getitem__, self.split_known(run)))
            else:
                pieces = self.library.pre_tokenizer.pre_tokenize_str(run)
                total += sum(self.counts_of_shown[piece] for piece, _ in pieces)
        return total

    def count(self, text: str) -> int:
        """Tokens of a whole text; special strings in it are one token each."""
        total = at = 0
        for found in self.parts.finditer(text):
            total += self._plain(text[at : found.start()]) + 1
            at = found.end()
        return total + self._plain(text[at:])

    def prefixes(self, text: str) -> Iterator[int]:
        """Exact count of the tokens of text[:0], text[:1], ... and of the whole text.

        Where the text is cut inside a match, the table has the answer, but for three cases in which
        the cut text splits otherwise: blanks at the end are one match; a cut contraction is an
        apostrophe and a letter; a cut special string is ordinary text.
        """
        yield 0
        at = total = 0
        for found in [*self.parts.finditer(text), None]:
            stop = found.start() if found else len(text)
            plain = text[at:stop]
            yield from (total + n for n in self._plain_prefixes(plain))
            total += self._plain(plain)
            if found:
                blanks = _BLANKS_AT_END.search(plain)
                safe = self._last_match(plain[: blanks.start()] if blanks else plain)
                before = total - self._plain(plain[safe:])
                for cut in range(1, found.end() - found.start()):
                    yield before + self._plain(plain[safe:] + found.group()[:cut])
                total += 1
                yield total
                at = found.end()

    def _last_match(self, plain: str) -> int:
        """Where the last match of a text that does not end in a blank begins."""
        at = 0
        for match in self.split.finditer(plain):
            at = match.start()
        return at

    def _plain_prefixes(self, text: str) -> Iterator[int]:
        total, run, before = 0, "", 0  # the blanks that the prefix ends in, and the count before them
        for match in self._source_matches(text):
            table = self.table(shown(match))
            width = 0
            for k, char in enumerate(match):
                width += len(char.encode("utf-8", "replace"))
                if _BLANK.match(char):
                    if not run:
                        before = total + table[width - len(char.encode("utf-8", "replace"))]
                    run += char
                    yield before + self.table(shown(run))[-1]
                    continue
                run = ""
                if k == 1 and match in _CONTRACTIONS:
                    yield total + 2
                else:
                    yield total + table[width]
            total += table[-1]

    def _source_matches(self, text: str) -> list[str]:
        if _DOUBTFUL.search(text):
            return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return self.split.findall(text)

    def longest_prefix(self, text: str, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens.

        A later prefix may need fewer tokens than an earlier one, but never fewer than the matches it
        holds whole, so the search ends behind the first match that goes over.
        """
        best = 0
        for at, count in enumerate(self.prefixes(text)):
            if count <= budget:
                best = at
            elif count > budget + 130:
                break
        return best


_counters: dict[tuple[str, str], PrefixCounter] = {}


def counter(definition: str, pattern: str) -> PrefixCounter:
    key = (definition, pattern)
    if key not in _counters:
        _counters[key] = PrefixCounter(definition, pattern)
    return _counters[key]


def _count_batches(definition, pattern: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(definition.value, pattern).count
        for batch in batches:
            texts = batch.column(1)
            sizes = [len(t.as_buffer()) for t in texts]
            tokens = [count(t.as_py().decode("utf-8", "replace")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    return run


def count_tokens(
    docs: DataFrame,
    path: str,
    pattern: str,
    limit: int = TOKEN_LIMIT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row's whole text; a missing one is empty.

    ``path`` is the .json file of a byte-level BPE tokenizer, ``pattern`` the one its splitter
    uses.  Special strings inside a text are one token each, as the library's default has it.
    The file (a few megabytes at most) is sent to every executor once; rows are not shuffled.
    """
    ready(docs.sparkSession)
    definition = docs.sparkSession.sparkContext.broadcast(Path(path).read_text())
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).cast("binary").alias("t"))
    counted = rows.mapInArrow(_count_batches(definition, pattern), "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def truncate_texts(
    docs: DataFrame, path: str, pattern: str, budget: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, kept)``: the longest prefix of every text that needs at most ``budget`` tokens.

    Bytes that are not UTF-8 count as the replacement character, as in `count_tokens`.
    """
    ready(docs.sparkSession)
    definition = docs.sparkSession.sparkContext.broadcast(Path(path).read_text())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longest = counter(definition.value, pattern).longest_prefix
        for batch in batches:
            texts = [t.as_py().decode("utf-8", "replace") for t in batch.column(1)]
            kept = [t[: longest(t, budget)] for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.string())], names=["doc_id", "kept"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).cast("binary").alias("t"))
    return rows.mapInArrow(run, "doc_id bigint, kept string")
