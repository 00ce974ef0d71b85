"""Byte-level BPE with the tiktoken library: texts to ids and back."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ready, text_or_empty

PIECE_CHARS = 1 << 16
BLANK_RUN = 1024
ROWS_OUT_TOKENS = 1 << 20

# A match holds blanks only, or one leading space and no other blank, so none spans such a place.
_SAFE = regex.compile(r"(?<=\S)(?=[ \n])")
_LONG_BLANK = regex.compile(r"\s{%d,}" % BLANK_RUN)

_encodings: dict[tuple[bytes, str], tiktoken.Encoding] = {}


def encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    """The library's encoding for the lines of a rank file; made once in a process."""
    key = (ranks, pattern)
    if key not in _encodings:
        table = {base64.b64decode(t): int(r) for t, r in (line.split() for line in ranks.splitlines() if line)}
        _encodings[key] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return _encodings[key]


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[tuple[str, bool]]:
    """A long text cut where a match must begin, in pieces of about ``size`` characters.

    A run of very many blanks overflows the library's stack.  It is one match (but for its last
    blank, if a word follows), so it comes alone, marked to be merged without the pattern.
    """
    if len(text) <= size:
        spans = [(0, len(text))] if not _LONG_BLANK.search(text) else []
        if spans:
            yield text, False
            return
    at = 0
    for run in [*_LONG_BLANK.finditer(text), None]:
        a, b = run.span() if run else (len(text), len(text))
        if run and b < len(text):
            b -= 1
        while a - at > size:
            cut = _SAFE.search(text, at + size, a)
            if not cut:
                break
            yield text[at : cut.start()], False
            at = cut.start()
        if at < a:
            yield text[at:a], False
        if a < b:
            yield text[a:b], True
        at = b


def encode(text: str, encoder: tiktoken.Encoding) -> list[int]:
    """Ids of a whole text, without special tokens."""
    out: list[int] = []
    for piece, whole in pieces(text):
        out += encoder._encode_single_piece(piece) if whole else encoder.encode_ordinary(piece)
    return out


def _encode_batches(ranks, pattern: str, decoded: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(ranks.value, pattern)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                ids, size, began = [], 0, at
                while at < batch.num_rows and size < ROWS_OUT_TOKENS:
                    ids.append(encode(batch.column(1)[at].as_py().decode("utf-8", "replace"), encoder))
                    size += len(ids[-1])
                    at += 1
                yield _rows(batch.column(0).slice(began, at - began), ids, encoder, decoded)

    return run


def _rows(doc_ids: pa.Array, ids: list[list[int]], encoder: tiktoken.Encoding, decoded: bool) -> pa.RecordBatch:
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    flat = np.fromiter((i for row in ids for i in row), np.int32, int(ends[-1]))
    columns = [doc_ids, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
    if decoded:
        columns.append(pa.array([encoder.decode_bytes(row) for row in ids], pa.binary()))
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"][: len(columns)])


def _shared(spark: SparkSession, path: str):
    """The rank file's content (under one megabyte for 50,000 ranks), sent to every executor once."""
    ready(spark)
    return spark.sparkContext.broadcast(Path(path).read_bytes())


def encode_texts(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False
) -> DataFrame:
    """``(doc_id, ids)`` for every row: the ids of its whole text by the rank file at ``path``.

    ``pattern`` splits a text, and each match is merged by itself.  A missing text is empty and has
    no ids; bytes that are not UTF-8 count as the replacement character.  With ``decoded``, the bytes
    that the ids stand for come along.  Rows stay in their partitions: nothing is shuffled.
    """
    ranks = _shared(docs.sparkSession, path)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).cast("binary").alias("t"))
    schema = "doc_id bigint, ids array<int>" + ", decoded binary" * decoded
    return rows.mapInArrow(_encode_batches(ranks, pattern, decoded), schema)


def decode_ids(tokens: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(doc_id, decoded)`` for every row: the raw bytes of its ids; missing ids give no bytes.

    An id beyond the ranks fails the job, as in the library.
    """
    ranks = _shared(tokens.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(ranks.value, pattern)
        for batch in batches:
            texts = [encoder.decode_bytes(row.as_py() or []) for row in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=["doc_id", "decoded"])

    rows = tokens.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id bigint, decoded binary")


def round_trip(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids, one space between), decoded_sha256; and the ids."""
    found = encode_texts(docs, path, pattern, id_col, text_col, decoded=True)
    return found.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *["ids"] * keep_ids,
    )
