"""Packing token ids into sequences of equal length, balanced by the cost of attention."""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..session import stored
from .byte_bpe import encoding, pieces
from .common import ready, text_or_empty
from .token_counts import runs

SEQUENCE_TOKENS = 2048
END_ID = 1
GROUP_TOKENS = 1 << 21
ROWS_OUT_TOKENS = 1 << 20
# Cost of n tokens that see each other: n * LINEAR + n * n * QUADRATIC.  They weigh alike at 4,096 tokens.
LINEAR, QUADRATIC = 4096, 1

_ID = "<u4"
_PIECE = "doc_id bigint, row bigint, start bigint, length bigint, doc_tokens bigint, ids binary"
_GROUP = f"pack bigint, {_PIECE}, place bigint, offset bigint"


class Encoder:
    """Ids as the tokenizers library gives them for the .json file's text in ``definition``.

    Where both splitters know the characters, the ids come from tiktoken with the same ranks, which
    is several times as fast; words with other characters go to the library itself.  Special
    strings in a text are their own ids, as is the library's default.
    """

    def __init__(self, definition: str, ranks: bytes, pattern: str) -> None:
        self.library = Tokenizer.from_str(definition)
        self.fast = encoding(ranks, pattern)
        special = {t["content"]: t["id"] for t in json.loads(definition)["added_tokens"]}
        self.special = special
        longest_first = sorted(special, key=len, reverse=True)
        self.parts = regex.compile("|".join(regex.escape(s) for s in longest_first) or r"(?!)")

    def _plain(self, text: str) -> Iterator[list[int]]:
        """Ids of a text without special strings, in parts."""
        for known, run in runs(text):
            if not known:
                yield self.library.encode(run, add_special_tokens=False).ids
                continue
            for piece, whole in pieces(run):
                yield self.fast._encode_single_piece(piece) if whole else self.fast.encode_ordinary(piece)

    def ids(self, text: str, end_id: int | None = None) -> np.ndarray:
        """Ids of a whole text as unsigned 32-bit integers, and ``end_id`` behind them."""
        parts: list[np.ndarray] = []
        at = 0
        for found in [*self.parts.finditer(text), None]:
            plain = text[at : found.start() if found else len(text)]
            parts += (np.array(part, _ID) for part in self._plain(plain))
            if found:
                parts.append(np.array([self.special[found.group()]], _ID))
                at = found.end()
        if end_id is not None:
            parts.append(np.array([end_id], _ID))
        return np.concatenate(parts)


_encoders: dict[tuple[str, bytes, str], Encoder] = {}


def encoder(definition: str, ranks: bytes, pattern: str) -> Encoder:
    key = (definition, ranks, pattern)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def _piece_batches(shared, pattern: str, size: int, end_id: int) -> Callable:
    """Rows of documents to their pieces of ``size`` tokens and the shorter rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(*shared.value, pattern).ids
        for batch in batches:
            doc_ids, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found, held = [], 0
            for k, (doc_id, row) in enumerate(zip(doc_ids, rows)):
                ids = ids_of(batch.column(2)[k].as_py().decode("utf-8", "replace"), end_id)
                for start in range(0, len(ids), size):
                    piece = ids[start : start + size]
                    found.append((doc_id, row, start, len(piece), len(ids), piece.tobytes()))
                held += len(ids)
                if held >= ROWS_OUT_TOKENS:
                    yield _table(found)
                    found, held = [], 0
            if found:
                yield _table(found)

    return run


def _table(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found))
    return pa.RecordBatch.from_arrays(
        [*(pa.array(c, pa.int64()) for c in columns[:5]), pa.array(columns[5], pa.binary())],
        names=["doc_id", "row", "start", "length", "doc_tokens", "ids"],
    )


def rooms(total: int, size: int) -> list[int]:
    """Lengths of the sequences that ``total`` tokens fill: whole ones, and falling powers of two for the rest."""
    rest = total % size
    return [size] * (total // size) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def cost(n: int) -> int:
    """Estimated cost of attention among ``n`` tokens."""
    return LINEAR * n + QUADRATIC * n * n


def balanced(lengths: list[int], size: int) -> list[tuple[int, int, int, int, int]]:
    """``(document, start, length, sequence, offset)`` of every piece; together they fill every sequence.

    Documents by falling length go whole to the sequence of least cost that has room.  One that fits
    nowhere is cut: the sequence of least cost with any room is filled, and what is left waits for its
    turn among the others.  Each cut fills a sequence, so there are fewer cuts than sequences.
    """
    room = np.array(rooms(sum(lengths), size), np.int64)
    costs = np.zeros(len(room), np.float64)
    used = np.zeros(len(room), np.int64)
    waiting = [(-n, k, 0) for k, n in enumerate(lengths) if n]
    heapq.heapify(waiting)
    out = []
    never = math.inf
    while waiting:
        n, k, start = heapq.heappop(waiting)
        n = -n
        at = int(np.argmin(np.where(room >= n, costs, never)))
        if room[at] < n:
            at = int(np.argmin(np.where(room > 0, costs, never)))
            heapq.heappush(waiting, (int(room[at]) - n, k, start + int(room[at])))
            n = int(room[at])
        out.append((k, start, n, at, int(used[at])))
        used[at] += n
        room[at] -= n
        costs[at] += cost(n)
    return out


def _pack_group(size: int) -> Callable:
    def run(key: tuple, table: pa.Table) -> pa.Table:
        order = np.lexsort((table.column("row").to_numpy(), -table.column("length").to_numpy()))
        table = table.take(pa.array(order))  # as lengths and rows have it, not the exchange
        found = balanced(table.column("length").to_pylist(), size)
        of, begin, length, place, offset = (np.array([f[i] for f in found], np.int64) for i in range(5))
        held = table.column("ids").combine_chunks()
        cut = [held[k].as_buffer()[4 * b : 4 * (b + n)].to_pybytes() for k, b, n, _, _ in found]
        rows = table.take(pa.array(of))
        columns = {
            "pack": pa.array(np.full(len(found), key[0].as_py(), np.int64)),
            "doc_id": rows.column("doc_id"),
            "row": rows.column("row"),
            "start": pa.array(rows.column("start").to_numpy() + begin),
            "length": pa.array(length),
            "doc_tokens": rows.column("doc_tokens"),
            "ids": pa.array(cut, pa.binary()),
            "place": pa.array(place),
            "offset": pa.array(offset),
        }
        return pa.table(columns)

    return run


def _files(spark: SparkSession, definition: str, ranks: str):
    """Both files (a few megabytes at most), sent to every executor once."""
    ready(spark)
    return spark.sparkContext.broadcast((Path(definition).read_text(), Path(ranks).read_bytes()))


def pack_documents(
    docs: DataFrame,
    definition: str,
    ranks: str,
    pattern: str,
    size: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
    group_tokens: int = GROUP_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all rows of ``docs`` in sequences of ``size`` tokens, without padding.

    One row per piece: doc_id, row (a number of its own for each row of ``docs``), start, length,
    doc_tokens, sequence_id, offset, and ``ids``: the piece's ids as unsigned 32-bit integers, lowest
    byte first.  A document's ids are those of the tokenizer file ``definition`` (``ranks`` holds the
    same vocabulary by rank) and ``end_id``; a missing or empty text has ``end_id`` alone.

    A document of ``size`` tokens or more gives whole sequences at once.  What is shorter is dealt by
    chance to groups of about ``group_tokens`` tokens, counted beforehand, and a group fills sequences
    by falling length, the one of least cost first (`balanced`).  What does not fill a whole sequence of
    its group fills sequences of falling powers of two.  Rows alike in id and text are packed each for
    itself; an empty table gives no rows.  Texts are encoded once and stored as ids, so a lost executor
    costs no encoding but its own tasks'.
    """
    spark = docs.sparkSession
    shared = _files(spark, definition, ranks)
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        text_or_empty(text_col).cast("binary").alias("t"),
    )
    pieces = stored(rows.mapInArrow(_piece_batches(shared, pattern, size, end_id), _PIECE))
    whole, rest = pieces.where(F.col("length") == size), pieces.where(F.col("length") < size)
    groups = max(1, -(-(rest.agg(F.sum("length")).first()[0] or 0) // group_tokens))
    dealt = rest.withColumn("pack", F.pmod(F.xxhash64("row"), F.lit(groups)))
    packed = dealt.groupBy("pack").applyInArrow(_pack_group(size), _GROUP)
    # Sequences of groups have even numbers, those of one piece odd ones.
    shared_ones = packed.withColumn("sequence_id", (F.shiftleft("pack", 32) + F.col("place")) * 2)
    own = whole.withColumn("sequence_id", F.monotonically_increasing_id() * 2 + 1).withColumn("offset", F.lit(0).cast("bigint"))
    names = ["doc_id", "row", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    return own.select(*names).union(shared_ones.select(*names))
