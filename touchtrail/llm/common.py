"""What several operators for training data share: columns, hashes of words, ranks, components."""

from __future__ import annotations

from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import discard, scratch_path, stored

# Bytes that part words: the blanks of ASCII, which are also what bytes.split() parts at.
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True

_SEGMENT = 1 << 21
_BASE = 0x9E3779B97F4A7C15 | 3
_U = np.uint64


def ready(spark: SparkSession) -> None:
    """Let Python workers of this machine import the package wherever the driver was started."""
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(":"):
        known["PYTHONPATH"] = ":".join(filter(None, [root, known.get("PYTHONPATH", "")]))


def text_or_empty(column: str | Column) -> Column:
    """A text, a missing one being empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have, close to those asked for."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit integers with every bit stirred into every other (the finalizer of SplitMix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_LETTER = mixed(np.arange(1, 257, dtype=_U) * _U(_BASE))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_BASE, 1)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), 1)


def _segment_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of a piece of text."""
    global _UP, _DOWN
    if len(_UP) < len(data) + 1:
        _UP = _powers(_BASE, len(data) + 1)
        _DOWN = _powers(pow(_BASE, -1, 1 << 64), len(data) + 1)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_BLANK[data]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(_LETTER[data] * _UP[: len(data)], out=sums[1:])
    return starts, mixed((sums[ends] - sums[starts]) * _DOWN[starts] + (ends - starts).astype(_U))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in order, and how many words each text has.

    A word is a run of bytes without a blank of ASCII.  Hashes are sums over bytes, so whole arrays
    are worked on at once, in pieces of about two megabytes that end at a blank.
    """
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    at, starts, hashes = 0, [], []
    while at < len(data):
        stop = min(len(data), at + _SEGMENT)
        while stop < len(data):
            blanks = np.flatnonzero(_BLANK[data[stop : stop + _SEGMENT]])
            if len(blanks):
                stop += int(blanks[0])
                break
            stop = min(len(data), stop + _SEGMENT)
        s, h = _segment_hashes(data[at:stop])
        starts.append(s + at)
        hashes.append(h)
        at = stop
    if not starts:
        return np.empty(0, _U), np.zeros(len(texts), np.int64)
    upto = np.searchsorted(np.concatenate(starts), ends)
    return np.concatenate(hashes), np.diff(upto, prepend=0)


def ranked(df: DataFrame, *order: Column, rank: str = "rank") -> DataFrame:
    """Rows numbered from 0 in a total order, without one task that sorts them all.

    Rows are sorted by ranges and stored; a row's number is its place in its range after the
    sizes of the ranges in front (one number per range goes through the driver).
    """
    place, part, front = fresh(df.withColumn(rank, F.lit(0)), "_place", "_part", "_front")
    rows = stored(
        df.orderBy(*order)
        .withColumn(place, F.monotonically_increasing_id())
        .withColumn(part, F.shiftright(place, 33))
    )
    sizes = sorted(tuple(r) for r in rows.groupBy(part).count().collect())
    before = np.cumsum([0, *(n for _, n in sizes)]).tolist()
    offsets = df.sparkSession.createDataFrame(
        [(p, b) for (p, _), b in zip(sizes, before)], f"{part} bigint, {front} bigint"
    )
    number = F.col(front) + F.col(place).bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(F.broadcast(offsets), part).withColumn(rank, number).drop(part, place, front)


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; the root is the least node reachable.

    Alternates two steps until nothing changes: every larger neighbour of a node is linked to the
    least one, then every smaller neighbour is.  Rounds grow with the logarithm of the links.
    Each round is stored, so no lineage builds up.  Joins are on a node and its complement, so
    both sides are exchanged for the join and a node with many links can be split.
    """
    spark = links.sparkSession
    path = scratch_path(spark)
    pairs = stored(
        links.where("a <> b")
        .select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
        .distinct(),
        path,
    )
    state = _state(pairs)
    while state[0]:
        both = pairs.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(
            pairs.select(F.col("hi"), F.col("lo"))
        )
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = (
            _with_least(both.where("v > u"), least)
            .select(F.col("m").alias("lo"), F.col("v").alias("hi"))
            .where("lo <> hi")
            .distinct()
        )
        down = large.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            _with_least(down, least)
            .select(F.explode(F.array("u", "v")).alias("hi"), F.col("m").alias("lo"))
            .where("lo <> hi")
            .select("lo", "hi")
            .distinct()
        )
        following = scratch_path(spark)
        pairs = stored(small, following)
        discard(path)
        path, before, state = following, state, _state(pairs)
        if state == before:
            break
    down = pairs.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return down.union(down.select("root", "root").distinct())


def _with_least(rows: DataFrame, least: DataFrame) -> DataFrame:
    left = rows.withColumn("w", F.bitwise_not("u"))
    return left.join(least.withColumn("w", F.bitwise_not("u")), ["u", "w"])


def _state(pairs: DataFrame) -> tuple:
    """Equal for equal sets of links."""
    mark = F.xxhash64("lo", "hi").cast("decimal(38,0)")
    return tuple(pairs.agg(F.count("*"), F.sum(mark), F.sum(F.col("lo").cast("decimal(38,0)"))).first())
