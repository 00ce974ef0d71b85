"""Exact dedup: two passes of Bloom filters find hashes that may repeat; only their rows shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import fresh, ready, text_or_empty

ROWS_PER_PAGE = 1 << 14
MIN_PAGES, MAX_PAGES = 64, 1 << 17
BITS_PER_ROW = 16
MAX_FILTER_BITS = 1 << 28
_SEGMENT_BITS = 1 << 19


def digest(text: Column) -> Column:
    """SHA-256 of a text in UTF-8, as 32 bytes."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _probes(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places of each hash in a filter whose size is a power of two."""
    h = hashes.view(np.uint64)
    low = np.uint64(bits - 1)
    return (h & low).astype(np.int64), ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20) & low).astype(np.int64)


def _power_of_two(n: int) -> int:
    return 1 << max(10, int(n - 1).bit_length())


def _deal(pages: int):
    """Hashes of a batch, dealt to pages by their top bits; those met twice come twice."""
    shift = np.uint64(64 - (pages.bit_length() - 1))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, met = np.unique(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), return_counts=True)
            hashes = np.concatenate([hashes, hashes[met > 1]])
            page = (hashes >> shift).astype(np.int64)
            order = np.argsort(page, kind="stable")
            cuts = np.flatnonzero(np.diff(page[order])) + 1
            parts = np.split(hashes[order], cuts) if len(order) else []
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(p[0] >> shift) for p in parts], pa.int64()),
                    pa.array([p.tobytes() for p in parts], pa.binary()),
                ],
                names=["page", "hashes"],
            )

    return deal


def _first_pass(bits: int):
    """One page of the first filter: hashes that find their places taken may repeat."""

    def repeated(table: pa.Table) -> pa.Table:
        taken = np.zeros(bits, bool)
        found = []
        for packed in table.column("hashes").to_pylist():
            hashes = np.frombuffer(packed, np.uint64)
            first, again = np.unique(hashes, return_counts=True)
            a, b = _probes(first, bits)
            found.append(first[taken[a] & taken[b] | (again > 1)])
            taken[a] = taken[b] = True
        maybe = np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)
        return pa.table({"hash": pa.array(maybe.view(np.int64), pa.int64())})

    return repeated


def _segments(bits: int):
    """The second filter, set by one task, as those of its segments that are not empty."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = np.zeros(bits, bool)
        for batch in batches:
            for places in _probes(batch.column(0).to_numpy(zero_copy_only=False), bits):
                mine[places] = True
        width = min(bits, _SEGMENT_BITS)
        for k, part in enumerate(mine.reshape(-1, width)):
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int64()), pa.array([np.packbits(part).tobytes()], pa.binary())],
                    names=["segment", "bits"],
                )

    return build


def _either(table: pa.Table) -> pa.Table:
    parts = [np.frombuffer(x, np.uint8) for x in table.column("bits").to_pylist()]
    joined = np.bitwise_or.reduce(parts)
    return pa.table({"segment": table.column("segment")[:1], "bits": pa.array([joined.tobytes()], pa.binary())})


def repeat_filter(hashes: DataFrame, max_bits: int = MAX_FILTER_BITS):
    """A column function: may this 64-bit hash stand in ``hashes`` (one bigint column) twice?

    Pass one: hashes are dealt to pages of a Bloom filter, one group per page, sized by the counted
    rows; a hash that finds its places taken may repeat.  A task sends a hash at most twice per
    batch, so copies do not pile up.  Pass two: those hashes alone set a second filter, broadcast
    to all tasks.  It has ``BITS_PER_ROW`` bits for each and never more than ``max_bits`` (32 MB).
    Beyond that, more rows than needed are taken for repeats, but none that repeats is missed.
    """
    spark = hashes.sparkSession
    ready(spark)
    rows = hashes.count()
    pages = min(MAX_PAGES, max(MIN_PAGES, _power_of_two(-(-rows // ROWS_PER_PAGE) or 1)))
    page_bits = _power_of_two(BITS_PER_ROW * -(-rows // pages) or 1)
    dealt = hashes.mapInArrow(_deal(pages), "page bigint, hashes binary")
    maybe = stored(dealt.groupBy("page").applyInArrow(_first_pass(page_bits), "hash bigint"))
    bits = min(max_bits, _power_of_two(BITS_PER_ROW * maybe.count() or 1))
    segments = (
        maybe.mapInArrow(_segments(bits), "segment bigint, bits binary")
        .groupBy("segment")
        .applyInArrow(_either, "segment bigint, bits binary")
    )
    width = min(bits, _SEGMENT_BITS)
    packed = np.zeros(bits // 8, np.uint8)
    for segment, part in segments.collect():
        packed[segment * width // 8 : (segment + 1) * width // 8] = np.frombuffer(part, np.uint8)
    shared = spark.sparkContext.broadcast(packed.tobytes())

    @F.pandas_udf("boolean")
    def may_repeat(hashes: pd.Series) -> pd.Series:
        table = np.frombuffer(shared.value, np.uint8)
        a, b = _probes(hashes.to_numpy(np.int64), bits)
        hit = table[a >> 3] >> (7 - (a & 7)) & table[b >> 3] >> (7 - (b & 7)) & 1
        return pd.Series(hit.astype(bool))

    return may_repeat


def copy_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_FILTER_BITS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; a missing text counts as empty.  Of equal texts the row
    with the largest id stays; a missing id is less than any other.  Rows that share id and text
    cannot be told apart here: all of them have ``kept`` if their id stays (`drop_copies` keeps one).
    Texts are read once: ids and digests are stored, and all passes work on those.  Rows whose
    digest may repeat are grouped by their whole digest, the others pass straight through.
    """
    digests = stored(
        docs.select(F.col(id_col).cast("bigint").alias("doc_id"), digest(text_or_empty(text_col)).alias("sha"))
    )
    may_repeat = repeat_filter(digests.select(F.xxhash64("sha").alias("h")), max_bits)
    marked = digests.withColumn("may_repeat", may_repeat(F.xxhash64("sha")))
    alone = marked.where(~F.col("may_repeat")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), "sha"
    )
    repeated = stored(marked.where("may_repeat").drop("may_repeat"))
    groups = stored(repeated.groupBy("sha").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    together = repeated.join(groups, "sha").select("doc_id", "keep_id", "group_size", "sha")
    return alone.union(together).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_FILTER_BITS
) -> DataFrame:
    """``docs`` with one row of each group of equal texts, columns as they were.

    The row with the largest id stays, as in `copy_groups`; of rows that share id and text, one
    does.  Rows whose digest cannot repeat never shuffle; of the others the digests and ids do,
    and then the rows that stay, once.
    """
    sha, key, may, rank_id, best = fresh(docs, "_sha", "_key", "_may", "_id", "_best")
    rows = docs.withColumn(sha, digest(text_or_empty(text_col))).withColumn(key, F.xxhash64(sha))
    may_repeat = repeat_filter(rows.select(key), max_bits)
    rows = rows.withColumn(may, may_repeat(key))
    alone = rows.where(~F.col(may))
    repeated = rows.where(F.col(may))
    largest = stored(
        repeated.select(F.col(sha), F.col(id_col).cast("bigint").alias(rank_id))
        .groupBy(sha)
        .agg(F.max(rank_id).alias(best))
        .withColumnRenamed(sha, rank_id)
    )
    staying = (
        repeated.join(largest.hint("merge"), F.col(sha) == F.col(rank_id))
        .where(F.col(id_col).cast("bigint").eqNullSafe(F.col(best)))
        .drop(rank_id, best)
        .repartition(sha)  # a large group is split in the join, which the next step alone would forbid
        .dropDuplicates([sha])
    )
    return alone.unionByName(staying).select(*docs.columns)
