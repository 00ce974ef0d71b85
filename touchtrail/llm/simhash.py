"""SimHash near-dedup: tables of distances to pivots discard pairs, a bit count verifies the rest."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import connected_components, fresh, mixed, ready, text_or_empty

SEED = 42
SHINGLE_WORDS = 4
MAX_BITS = 4
PIVOTS = 32
TILE_ROWS = 2048
_LOWER = bytes(range(256)).lower()


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash: a bit is set if it is set in over half of the hashes of the shingles.

    A-Z is lower-cased and words are runs without ASCII blanks.  Shingles count as often as they
    occur; a text with fewer words is one shingle, one without words has fingerprint zero.
    """
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    count = max(1, len(words) - shingle_words + 1)
    if count == 1:
        return digest(joined, SEED)
    ends = np.cumsum(np.fromiter((len(w) + 1 for w in words), np.int64, len(words))) - 1
    starts = np.concatenate([[0], ends[: count - 1] + 1])
    votes = np.zeros(64, np.int64)
    spans = zip(starts.tolist(), ends[shingle_words - 1 :].tolist())
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), "<u8", count)
    for at in range(0, count, 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > count, bitorder="little").view("<u8")[0])


def _fingerprint_batches(shingle_words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(t.as_py(), shingle_words) for t in batch.column(1)]
            signed = np.array(marks, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], names=["doc_id", "mark"])

    return run


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """``(doc_id, mark)``: the fingerprint of every row's whole text as a signed long; none: empty."""
    ready(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).cast("binary").alias("t"))
    return rows.mapInArrow(_fingerprint_batches(shingle_words), "doc_id bigint, mark bigint")


def _pivots(n: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _tables(marks: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distance of every fingerprint to every pivot, a row for each pivot."""
    return np.stack([np.bitwise_count(marks ^ p).astype(np.int8) for p in pivots])


def _roots(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Least row reachable over links a-b, going on from earlier labels."""
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while not np.array_equal(jumped := label[label], label):
            label = jumped
        if np.array_equal(before, label):
            return label


def linked(groups: np.ndarray, marks: np.ndarray, max_bits: int, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links among fingerprints of one group that differ in at most ``max_bits`` bits.

    ``groups`` is sorted.  Rows are compared with the row 1, 2, ... places on, whole columns at a
    time.  By the triangle inequality a pair whose distances to any pivot differ by more than
    ``max_bits`` cannot be linked; what passes every pivot is verified by its own bit count.
    """
    tables, n = _tables(marks, pivots), len(marks)
    last = np.searchsorted(groups, groups, side="right")
    rows = np.arange(n)
    label, step = rows.copy(), 1
    left, right = [], []
    waiting = 0
    while True:
        rows = rows[rows + step < last[rows]]
        if not len(rows):
            break
        pair = rows
        for table in tables:
            pair = pair[np.abs(table[pair] - table[pair + step]) <= max_bits]
            if not len(pair):
                break
        if len(pair):
            pair = pair[np.bitwise_count(marks[pair] ^ marks[pair + step]) <= max_bits]
            pair = pair[label[pair] != label[pair + step]]
            left.append(pair)
            right.append(pair + step)
            waiting += len(pair)
        if waiting > 1 << 20:
            label, waiting = _roots(n, np.concatenate(left), np.concatenate(right), label), 0
            left, right = [], []
        step += 1
    if left:
        label = _roots(n, np.concatenate(left), np.concatenate(right), label)
    at = np.flatnonzero(label != np.arange(n))
    return marks[at], marks[label[at]]


def _link_groups(max_bits: int, pivot_count: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, keep = _pivots(pivot_count), None
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False)
            mark = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if keep is not None:
                key, mark = np.concatenate([keep[0], key]), np.concatenate([keep[1], mark])
            first = int(np.searchsorted(key, key[-1])) if len(key) else 0  # the last group may go on
            keep = key[first:], mark[first:]
            if first:
                yield _as_links(linked(key[:first], mark[:first], max_bits, pivots))
        if keep is not None and len(keep[0]):
            yield _as_links(linked(*keep, max_bits, pivots))

    return run


def _as_links(ends: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in ends], names=["a", "b"])


def near_links(
    marks: DataFrame, max_bits: int = MAX_BITS, pivots: int = PIVOTS, tile_rows: int = TILE_ROWS
) -> DataFrame:
    """Links ``(a, b)`` that span all components of distinct fingerprints in ``marks(mark)``.

    Candidates: of ``max_bits + 2`` runs of bits, two fingerprints within ``max_bits`` agree on at
    least two, so each is filed under every pair of runs.  Keys held by one fingerprint go out at
    once.  A key held by many is cut in tiles by a hash, and every pair of tiles is one group of
    at most about two tiles, so no group grows with the data.  Each group is searched by `linked`
    and gives at most one link for each of its rows.
    """
    spark = marks.sparkSession
    ready(spark)
    runs = max_bits + 2
    edges = [64 * k // runs for k in range(runs + 1)]
    masks = [((1 << edges[k + 1]) - 1) & ~((1 << edges[k]) - 1) for k in range(runs)]
    pairs = [masks[i] | masks[j] for i, j in combinations(range(runs), 2)]
    signed = [m - (1 << 64) if m >> 63 else m for m in pairs]
    keys = F.array(*(F.xxhash64(F.lit(k), F.col("mark").bitwiseAND(F.lit(m))) for k, m in enumerate(signed)))
    filed = marks.select("mark", F.explode(keys).alias("key"))
    sizes = filed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = filed.join(sizes, "key")
    tiles = F.ceil(F.col("n") / F.lit(tile_rows)).cast("int")
    tile = F.pmod(F.xxhash64("mark", F.lit(1)), F.col("tiles")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    tiled = met.withColumn("tiles", tiles).withColumn("tile", tile).select("mark", "key", "tiles", "tile", other.alias("other"))
    lone = (F.col("tiles") > 1) & (F.col("tile") == F.col("other"))  # met in every pair with another tile
    group = F.when(F.col("tiles") == 1, F.col("key")).otherwise(
        F.xxhash64("key", F.least("tile", "other"), F.greatest("tile", "other"))
    )
    grouped = tiled.where(~lone).select(group.alias("g"), "mark")
    parted = grouped.repartition("g").sortWithinPartitions("g", "mark")
    return parted.mapInArrow(_link_groups(max_bits, pivots), "a bigint, b bigint")


def near_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Documents are linked when their fingerprints differ in at most ``max_bits`` bits; a component's
    id is the least doc_id in it.  A missing id is no candidate for that, so a component of rows
    without ids has none.  Rows with equal texts or ids are rows like any other.  Copies meet as
    one fingerprint before anything is compared.
    """
    marks = stored(fingerprints(docs, id_col, text_col, shingle_words))
    return _components(marks, max_bits).select("doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id")


def _components(marks: DataFrame, max_bits: int) -> DataFrame:
    distinct = stored(marks.groupBy("mark").agg(F.min("doc_id").alias("least")))
    links = stored(near_links(distinct.select("mark"), max_bits))
    roots = connected_components(links)
    rooted = stored(
        distinct.join(roots, distinct["mark"] == roots["node"], "left").select(
            "mark", "least", F.coalesce("root", "mark").alias("root")
        )
    )
    least = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    named = stored(rooted.select("mark", "root").join(least, "root"))
    return marks.join(named, "mark").select("doc_id", "mark", "root", "component_id")


def drop_near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``docs`` with one row of each component, columns as they were: the one with the least id.

    Of rows that share that id, one stays; of a component without ids, one row stays.  Rows whose id
    occurs once in all of ``docs`` are told by it; others, also of other components, by their texts.
    """
    marks = stored(fingerprints(docs, id_col, text_col, shingle_words))
    found = stored(_components(marks, max_bits))
    first = F.max(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("first")
    kept = stored(found.groupBy("doc_id").agg(F.count("*").alias("n"), first).where("first").select("doc_id", "n"))
    doc, mark, root, least = fresh(docs, "_doc", "_mark", "_root", "_least")
    # Texts are exchanged once, at every size: a broadcast of ids would grow with the documents.
    ids = kept.where("n = 1").select(F.col("doc_id").alias(doc)).hint("merge")
    alone = docs.join(ids, F.col(id_col).cast("bigint").eqNullSafe(F.col(doc))).select(*docs.columns)
    tied_ids = kept.where("n > 1").select(F.col("doc_id").alias(doc))
    if tied_ids.isEmpty():
        return alone
    # Ids that several rows share: those rows are fingerprinted again to tell which is which.
    rows = docs.join(tied_ids, F.col(id_col).cast("bigint").eqNullSafe(F.col(doc))).drop(doc)
    known = found.select(F.col("mark").alias(doc), F.col("root").alias(root), F.col("component_id").alias(least)).distinct()
    tied = (
        _tied_rows(rows, id_col, text_col, shingle_words, mark)
        .join(known, F.col(mark) == F.col(doc))
        .where(F.col(id_col).cast("bigint").eqNullSafe(F.col(least)))
        .dropDuplicates([root])
        .select(*docs.columns)
    )
    return alone.unionByName(tied)


def _tied_rows(rows: DataFrame, id_col: str, text_col: str, shingle_words: int, mark: str) -> DataFrame:
    @F.pandas_udf("bigint")
    def marks(texts):
        import pandas as pd

        return pd.Series(np.array([fingerprint(bytes(t), shingle_words) for t in texts], np.uint64).view(np.int64))

    return rows.withColumn(mark, marks(text_or_empty(text_col).cast("binary")))
