"""Mixing sources to target weights by balanced sampling with the cube method."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import fresh, ranked, ready, text_or_empty

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
BLOCK_UNITS = 1024
BLOCKS_TOGETHER = 256
LANDING_UNITS = 32
SEED = 20240607
_EPSILON = 1e-9


def _count_words(texts: pd.Series) -> pd.Series:
    return pd.Series([len(t.split()) for t in texts], dtype="int64")


def word_count(text: Column) -> Column:
    """Runs without ASCII blanks in a text; a missing text has none."""
    return F.pandas_udf(_count_words, "bigint")(text_or_empty(text).cast("binary"))


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """``(source, source_size, target)`` for ``sizes(source, size)``.

    Sources in order of code points, a missing one last, have the weights in turn.  They divide
    ``share`` of all words by weight; what would lift a source above ``cap`` times its own words
    is divided again among the others, until none is above.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = (F.col("source").isNull(), F.col("source").cast("binary"))
    numbered = ranked(sources, *order, rank="n")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("n") % len(weights) + 1).cast("int"))
    weighed = stored(numbered.withColumn("weight", weight).withColumn("most", F.col("source_size") * cap))
    total = share * (weighed.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0  # words for each unit of weight; it rises until no further source is full
    while True:
        full = F.col("most") <= F.col("weight") * level
        held, open_weight = weighed.agg(
            F.sum(F.when(full, F.col("most")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
        ).first()
        if not open_weight:
            break
        higher = (total - held) / open_weight
        if higher <= level * (1 + 1e-12):
            break
        level = higher
    target = F.least("most", F.col("weight") * level)
    return weighed.select("source", "source_size", target.alias("target"))


def fly(sizes: np.ndarray, chances: np.ndarray, luck: np.ndarray) -> np.ndarray:
    """Flight: move inclusion chances to 0 or 1 without changing expected documents or words.

    Three open units at a time have one direction that leaves both sums as they are; a random step
    along it, fair for every unit, closes at least one of them.  At most two stay open.
    """
    p = chances.tolist()
    s = sizes.tolist()
    held: list[int] = []
    for k in range(len(p)):
        if not _EPSILON < p[k] < 1 - _EPSILON:
            p[k] = float(round(p[k]))
            continue
        held.append(k)
        if len(held) < 3:
            continue
        i, j, h = held
        u = (s[h] - s[j], s[i] - s[h], s[j] - s[i])
        if not any(u):
            u = (1, -1, 0)
        up = min(((1 - p[x]) if d > 0 else p[x]) / abs(d) for x, d in zip(held, u) if d)
        down = min((p[x] if d > 0 else (1 - p[x])) / abs(d) for x, d in zip(held, u) if d)
        step = up if luck[k] * (up + down) < down else -down
        for x, d in zip(held, u):
            p[x] += step * d
        for x in held:
            if p[x] < _EPSILON or p[x] > 1 - _EPSILON:
                p[x] = float(round(p[x]))
        held = [x for x in held if 0 < p[x] < 1]
    return np.array(p)


def land(sizes: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """Landing: close the few units left, largest first, each to the side that keeps words nearer."""
    out, error = chances.copy(), 0.0
    for k in np.argsort(-sizes, kind="stable"):
        if 0 < out[k] < 1:
            above, below = error + sizes[k] * (1 - out[k]), error - sizes[k] * out[k]
            out[k] = 1.0 if abs(above) < abs(below) else 0.0
            error = above if out[k] else below
    return out


def _level(last: bool):
    """One group: a flight over its open units by falling size; the last level lands as well.

    Before landing, units of every size are held back, so that the landing can even out what the
    flight leaves.
    """

    def run(table: pa.Table) -> pa.Table:
        order = np.lexsort((table.column("luck").to_numpy(), -table.column("size").to_numpy()))
        table = table.take(pa.array(order))  # as chance has it, not the exchange
        size = table.column("size").to_numpy().astype(float)
        chance = table.column("chance").to_numpy().copy()
        luck = table.column("luck").to_numpy()
        if last:
            spare = np.linspace(0, len(size) - 1, min(LANDING_UNITS, len(size))).astype(int)
            flying = np.setdiff1d(np.arange(len(size)), spare)
        else:
            flying = np.arange(len(size))
        chance[flying] = fly(size[flying], chance[flying], luck[flying])
        if last:
            chance = land(size, chance)
        at = table.schema.get_field_index("chance")
        return table.set_column(at, "chance", pa.array(chance, pa.float64()))

    return run


_UNITS = "row bigint, source string, block bigint, size bigint, chance double, luck double"


def balanced_choice(units: DataFrame) -> DataFrame:
    """``(row, chosen)`` for ``units(row, source, size, chance, luck)``: 0 or 1 for every unit.

    Units of a source are dealt to blocks of about ``BLOCK_UNITS``, so a large source has many.  A
    flight in each block leaves at most two units open; what many blocks leave makes one block of
    the next level, until a source has one block, where the rest lands.
    """
    count = units.groupBy("source").agg(F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / BLOCK_UNITS)
    sized = units.join(count.select(F.col("source").alias("_of"), blocks.alias("blocks")), F.col("source").eqNullSafe(F.col("_of")))
    block = F.least(F.floor(F.col("luck") * F.col("blocks")), F.col("blocks") - 1)
    waiting = stored(sized.select("row", "source", block.alias("block"), "size", "chance", "luck"))
    most = waiting.agg(F.max("block")).first()[0] or 0
    closed = []
    while True:
        last = most == 0
        flown = stored(waiting.groupBy("source", "block").applyInArrow(_level(last), _UNITS))
        open_unit = (F.col("chance") > 0) & (F.col("chance") < 1)
        closed.append(flown.where(~open_unit).select("row", F.col("chance").cast("int").alias("chosen")))
        if last:
            break
        waiting = flown.where(open_unit).withColumn("block", F.floor(F.col("block") / BLOCKS_TOGETHER))
        most //= BLOCKS_TOGETHER
    out = closed[0]
    for part in closed[1:]:
        out = out.union(part)
    return out


def _told_apart(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with a ``key`` of its own for each: those alike in it are numbered, in the given order.

    A key that one row holds stays as it is.  Every join is on stored rows, so a key with many can be split.
    """
    count = stored(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"))
    if count.isEmpty():
        return rows
    many = ranked(rows.join(count, "key", "left_semi").select("key", *order), F.col("key"), *map(F.col, order), rank="n")
    many = stored(many)
    first = stored(many.groupBy("key").agg(F.min("n").alias("first")))
    place = F.col("n") - F.col("first")
    named = many.join(first, "key").select("row", F.xxhash64("key", place).alias("_key"))
    return rows.join(stored(named), "row", "left").withColumn("key", F.coalesce("_key", "key")).drop("_key")


def _mixed(rows: DataFrame, weights, share, cap, seed) -> DataFrame:
    """``rows(row, doc_id, source, size, key)`` with source_size, target and the copies taken."""
    targets = stored(source_targets(rows, weights, share, cap)).select(F.col("source").alias("_s"), "source_size", "target")
    known = rows.join(targets, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(ratio + _EPSILON)
    luck = F.shiftrightunsigned(F.xxhash64("key", F.lit(seed)), 11) / F.lit(float(1 << 53))
    known = stored(
        known.withColumn("whole", whole).withColumn("chance", F.greatest(ratio - whole, F.lit(0.0))).withColumn("luck", luck)
    )
    open_unit = (F.col("chance") > _EPSILON) & (F.col("size") > 0)
    chosen = balanced_choice(known.where(open_unit).select("row", "source", "size", "chance", "luck"))
    return known.join(chosen, "row", "left").withColumn("copies", F.col("whole") + F.coalesce("chosen", F.lit(0)))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies, taken.

    A source's documents are all taken the whole number of times its target asks for; for the rest
    the cube method takes some once more, so that documents and words come out right.  Sizes are
    counted in words; documents without words, and sources without, take nothing.  Choices depend
    on ids, sources and sizes only, so reruns agree; rows alike in those are numbered to have luck of
    their own, and which of them is taken makes no difference.
    """
    ready(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"),
    )
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()))
    keyed = _told_apart(rows.withColumn("key", F.xxhash64("doc_id", "source", "size")), "row")
    return _mixed(keyed, weights, share, cap, seed).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def take_mixture(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    seed: int = SEED,
) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as they are taken, columns as they were.

    Rows equal in every column count as one entry here: what they take together is given to it.
    """
    ready(docs.sparkSession)
    a, b, n = fresh(docs, "_a", "_b", "_n")
    digests = (F.xxhash64(*docs.columns), F.xxhash64(F.lit(1), *docs.columns))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"),
        digests[0].alias("a"),
        digests[1].alias("b"),
    )
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()))
    keyed = _told_apart(rows.withColumn("key", F.xxhash64("doc_id", "source", "size")), "a", "b", "row")
    mixed = _mixed(keyed, weights, share, cap, seed)
    takes = stored(mixed.groupBy("a", "b").agg(F.sum("copies").alias("n"), F.count("*").alias("alike")).where("n > 0"))

    def taken(part: DataFrame) -> DataFrame:
        # Texts are exchanged once, at every size: a broadcast of choices would grow with the documents.
        named = part.select(F.col("a").alias(a), F.col("b").alias(b), F.col("n").alias(n)).hint("merge")
        return docs.join(named, (digests[0] == F.col(a)) & (digests[1] == F.col(b)))

    found, alike = taken(takes.where("alike = 1")), takes.where("alike > 1")
    if not alike.isEmpty():
        found = found.unionByName(taken(alike).dropDuplicates([a, b]))
    times = F.explode(F.array_repeat(F.lit(0), F.col(n).cast("int")))
    return found.select(*docs.columns, times.alias(a)).select(*docs.columns)
