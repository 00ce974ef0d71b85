"""Substring dedup by level-wise doubling of windows of words."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, scratch_path, stored
from .common import mixed, ready, text_or_empty, word_hashes

WINDOW_WORDS = 13
FIRST_LEVEL = 7
WORDS_PER_GROUP = 1 << 19
MIN_GROUPS = 256
CHUNK_BYTES = 6 << 20
NO_ID = (1 << 63) - 1

_U = np.uint64
_FACTORS = mixed(np.arange(1, 4097, dtype=_U)) | _U(1)


def levels(window: int, first: int = FIRST_LEVEL) -> list[int]:
    """Window lengths from about ``first`` words on, each at most twice the one before."""
    out = [window]
    while out[0] > first:
        out.insert(0, -(-out[0] // 2))
    return out


def _windows(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the window that starts at each word, windows of all documents in one array."""
    n = len(words) - length + 1
    if n <= 0:
        return np.empty(0, _U)
    out = np.zeros(n, _U)
    for k in range(length):
        out += words[k : k + n] * (_FACTORS[k % len(_FACTORS)] + _U(2 * (k // len(_FACTORS))))
    return mixed(out)


def _starts(counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a whole window starts, and the document of each."""
    doc = np.repeat(np.arange(len(counts)), counts)
    ends = np.repeat(np.cumsum(counts), counts)
    fits = np.arange(len(doc)) + length <= ends
    return np.flatnonzero(fits), doc[fits]


def _group_of(hashes: np.ndarray, groups: int) -> np.ndarray:
    """The group of a hash, from a second stirring of its bits."""
    return ((mixed(hashes ^ _U(0x5851F42D4C957F2D)) >> _U(32)) * _U(groups) >> _U(32)).astype(np.int64)


_ROW = "deal bigint, grp bigint, docs binary, counts binary, hashes binary"
_REPLY = "id bigint, grp bigint, hashes binary"


def _packed(group: np.ndarray, doc: np.ndarray, hashes: np.ndarray, ids: np.ndarray, answer: bool) -> pa.RecordBatch:
    """A row for each group: the ids of its documents, how many hashes each has, and the hashes.

    Questions are dealt by the group of their hash.  Answers need no company, so they are dealt
    round by the chunk's first id: a hash that many documents share does not pile up.
    """
    order = np.lexsort((doc, group))
    group, doc, hashes = group[order], doc[order], hashes[order]
    cuts = _cuts(group)
    found: list[list] = [[], [], [], [], []]
    spread = int(mixed(ids[:1].astype(_U))[0] >> _U(40))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        at = _cuts(doc[a:b])
        g = int(group[a])
        found[0].append(-1 - (g + spread) % (1 << 16) if answer else g)
        found[1].append(g)
        found[2].append(ids[doc[a:b][at[:-1]]].tobytes())
        found[3].append(np.diff(at).astype(np.int32).tobytes())
        found[4].append(hashes[a:b].tobytes())
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    names = ["deal", "grp", "docs", "counts", "hashes"]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(found, types)], names=names)


def _cuts(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    return np.concatenate([[0], np.flatnonzero(np.diff(x)) + 1, [len(x)]]) if len(x) else np.array([0])


def _unpacked(row: dict, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and the id of the document of each."""
    ids, counts = np.frombuffer(row["docs"], np.int64), np.frombuffer(row["counts"], np.int32)
    return np.frombuffer(row["hashes"], kind), np.repeat(ids, counts)


def _first_of_each(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (hash, id); and for the ordered rows the least and the greatest id with that hash."""
    order = np.lexsort((ids, hashes))
    h, d = hashes[order], ids[order]
    new = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.empty(0, bool)
    run = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(h)]]) - 1 if len(h) else first
    return order, d[first][run], d[last][run]


def _ask(length: int, groups: int, last: bool, before: int) -> Callable:
    """Windows of ``length`` words that may repeat, packed for the group of their hash.

    Within a chunk of documents each hash is asked for once, by its first document; what the
    chunk itself tells about the others is sent along as answers.
    """
    kind = _U if last else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            ids = chunk.column(0).to_numpy(zero_copy_only=False)
            words, counts = word_hashes(_texts(chunk))
            at, doc = _starts(counts, length)
            hashes = _windows(words, length)[at]
            if before:
                again = _answered(words, counts, chunk.column(2), before, groups, np.uint32)
                ok = again[at] & again[at + length - before]
                hashes, doc = hashes[ok], doc[ok]
            if not len(hashes):
                continue
            order, least, greatest = _first_of_each(hashes, ids[doc])
            hashes, doc = hashes[order], doc[order]
            new, group = _cuts(hashes)[:-1], _group_of(hashes, groups)
            yield _packed(group[new], doc[new], hashes[new].astype(kind), ids, answer=False)
            known = ids[doc] > least if last else least < greatest
            if known.any():
                yield _packed(group[known], doc[known], hashes[known].astype(kind), ids, answer=True)

    return run


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts stay near CHUNK_BYTES (a longer text is alone)."""
    for batch in batches:
        size = np.cumsum([len(t) for t in batch.column(1).to_pylist()])
        limit = CHUNK_BYTES if batch.num_columns == 2 else CHUNK_BYTES // 2
        at = 0
        while at < batch.num_rows:
            upto = int(np.searchsorted(size, (size[at - 1] if at else 0) + limit, side="right"))
            yield batch.slice(at, max(1, upto - at))
            at = max(at + 1, upto)


def _texts(chunk: pa.RecordBatch) -> list[bytes]:
    """Texts of a chunk; beside answers they are compressed."""
    texts = chunk.column(1).to_pylist()
    if chunk.num_columns == 2:
        return texts
    unzip = zstandard.ZstdDecompressor()
    return [unzip.decompress(t) for t in texts]


def _answered(
    words: np.ndarray, counts: np.ndarray, replies: pa.ListArray, length: int, groups: int, kind: type
) -> np.ndarray:
    """For each word, whether the window of ``length`` words that starts there was answered yes."""
    out = np.zeros(len(words) + 1, bool)
    sizes = replies.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    rows = replies.flatten()
    if not len(rows):
        return out
    packed = rows.field("hashes").to_pylist()
    each = np.fromiter(map(len, packed), np.int64, len(packed)) // np.dtype(kind).itemsize
    told = np.frombuffer(b"".join(packed), kind)
    told_group = np.repeat(rows.field("grp").to_numpy(zero_copy_only=False), each)
    told_doc = np.repeat(np.repeat(np.arange(len(sizes)), sizes), each)
    at, doc = _starts(counts, length)
    hashes = _windows(words, length)[at]
    group, low = _group_of(hashes, groups), hashes.astype(kind)
    key = _joint(told, told_group, told_doc)
    order = np.argsort(key)
    place = np.minimum(np.searchsorted(key[order], ours := _joint(low, group, doc)), len(key) - 1)
    place = order[place]
    hit = (key[place] == ours) & (told[place] == low) & (told_group[place] == group) & (told_doc[place] == doc)
    out[at[hit]] = True
    return out


def _joint(hashes: np.ndarray, group: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return mixed(hashes.astype(_U) ^ mixed((group.astype(_U) << _U(32)) + doc.astype(_U)))


def _answer(last: bool) -> Callable:
    """Per document the hashes of this group that count: repeated, or (last) begun earlier elsewhere."""
    kind = _U if last else np.uint32

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        found: list[list] = [[], [], []]

        def tell(group: int, hashes: np.ndarray, ids: np.ndarray) -> None:
            order = np.argsort(ids, kind="stable")
            hashes, ids = hashes[order], ids[order]
            cuts = _cuts(ids)
            found[0].extend(ids[cuts[:-1]].tolist())
            found[1].extend([group] * (len(cuts) - 1))
            found[2].extend(hashes[a:b].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()))

        if rows[0]["deal"] < 0:
            for row in rows:
                tell(row["grp"], *_unpacked(row, kind))
        else:
            parts = [_unpacked(row, kind) for row in rows]
            hashes, ids = (np.concatenate(x) for x in zip(*parts))
            order, least, greatest = _first_of_each(hashes, ids)
            hashes, ids = hashes[order], ids[order]
            yes = ids > least if last else least < greatest
            tell(rows[0]["grp"], hashes[yes], ids[yes])
        types = [pa.int64(), pa.int64(), pa.binary()]
        return pa.table([pa.array(x, t) for x, t in zip(found, types)], names=["id", "grp", "hashes"])

    return run


def _zip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = [packer.compress(t.as_py()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(texts, pa.binary()), batch.column(2)], names=["id", "text", "doc_id"]
        )


def _cut(window: int, groups: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            texts = _texts(chunk)
            hashes, counts = word_hashes(texts)
            at = np.flatnonzero(_answered(hashes, counts, chunk.column(2), window, groups, _U))
            cover = np.zeros(len(hashes) + window + 1, np.int64)
            np.add.at(cover, at, 1)
            np.add.at(cover, at + window, -1)
            gone = np.cumsum(cover)[: len(hashes)] > 0
            upto = np.concatenate([[0], np.cumsum(counts)])
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[upto])
            kept = []
            for k, text in enumerate(texts):
                words = text.split()
                if removed[k]:
                    words = list(compress(words, ~gone[upto[k] : upto[k + 1]]))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column(3),
                    pa.array(counts, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    return run


def remove_shared_windows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_WORDS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, kept_text.

    A word goes if a window of ``window`` words covers it whose words also start in a row with a
    smaller id.  Words are runs without ASCII blanks, compared as they are; kept ones are joined
    by one space.  A missing text has no words.  A missing id counts as the largest bigint, and rows
    with equal ids do not remove each other's words.

    Levels: windows of about seven words first; where two neighbours of a length repeat in
    different documents, the window of up to twice that length over both is looked at next, until
    ``window`` is reached or nothing is left.  First levels send 32 bits of a hash (the group adds
    more), the last one 64, beside the group's.  A chunk of documents asks for a hash once, so a
    passage in a third of all rows costs its group one entry per chunk, not one per row.
    """
    spark = docs.sparkSession
    ready(spark)
    key = F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("id")
    source = docs.select(key, text_or_empty(text_col).cast("binary").alias("text"), F.col(id_col).cast("bigint").alias("doc_id"))
    groups = _group_count(docs, text_col)
    partitions = max(groups // 4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lengths = levels(window)
    replies, path, before = None, None, 0
    for length in lengths:
        last = length == window
        given = source.select("id", "text") if replies is None else _with_replies(source, replies).select("id", "text", "replies")
        asked = given.mapInArrow(_ask(length, groups, last, before), _ROW)
        answered = asked.repartition(partitions, "deal").groupBy("deal").applyInArrow(_answer(last), _REPLY)
        following = scratch_path(spark)
        replies = stored(answered, following)
        if path:
            discard(path)
        path, before = following, length
        if not last and replies.isEmpty():
            break
    return _with_replies(source, replies).select("id", "text", "replies", "doc_id").mapInArrow(
        _cut(window, groups),
        "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string",
    )


def _group_count(docs: DataFrame, text_col: str) -> int:
    """Groups of hashes, from the counted bytes of all texts (six to a word)."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(MIN_GROUPS, -(-size // (6 * WORDS_PER_GROUP)))


def _with_replies(source: DataFrame, replies: DataFrame) -> DataFrame:
    """Documents, their texts compressed for the exchange, beside all answers to their windows."""
    packed = source.mapInArrow(_zip, "id bigint, text binary, doc_id bigint")
    gathered = replies.groupBy("id").agg(F.collect_list(F.struct("grp", "hashes")).alias("replies"))
    return packed.join(gathered, "id", "left")
