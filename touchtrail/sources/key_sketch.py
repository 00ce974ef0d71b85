"""Which days of a stored history may hold a batch's keys, from sketches of the days' keys.

A day's sketch is its number of keys, the least and the greatest, and a Bloom filter cut into pages of
32,768 bits, a power of two of them.  Sketches are only ever added to: what a load is about to append is
sketched first, so a load that fails half-way leaves a sketch that says too much, never one that says too
little.  A batch is looked up a few keys first: one key that a day may hold settles the day, and all
keys are looked up only in days that are not settled.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .tables import append_table, partition_dates

PROBES = 4
BITS_PER_KEY = 16
PAGE_BITS = 1 << 15
MOST_PAGES = 1 << 20
# Keys of a batch that are looked up first, and how many times more each time after that.
FIRST_KEYS, MORE_KEYS = 4096, 64


def _told(keys: Sequence[str]) -> Column:
    """A key as one text; which columns are missing counts."""
    return F.to_json(F.struct(*(F.col(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys))))


def _bits(key: Column, pages: Column) -> Column:
    """Pages and places in them that a key sets."""
    slots = [F.pmod(F.xxhash64(key, F.lit(i)), pages * PAGE_BITS) for i in range(PROBES)]
    each = [F.struct(F.floor(s / PAGE_BITS).alias("page"), (s % PAGE_BITS).cast("int").alias("bit")) for s in slots]
    return F.array(*each)


def _pages(count: Column) -> Column:
    """Pages of a filter for so many keys: a power of two, as every size of filter is asked for every key."""
    enough = F.ceil(count * BITS_PER_KEY / PAGE_BITS).cast("bigint")
    rounded = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.length(F.bin(enough - 1)))
    return F.when(enough <= 1, F.lit(1)).otherwise(F.least(rounded, F.lit(MOST_PAGES))).cast("bigint")


def add_sketches(rows: DataFrame, sketches: str, keys: Sequence[str], day: str) -> None:
    """Add what ``rows`` hold to the sketches of their days; every load has filters of its own size."""
    named = rows.select(F.col(day).alias("day"), _told(keys).alias("key"))
    count = named.groupBy("day").agg(
        F.count(F.lit(1)).alias("n"), F.min("key").alias("least"), F.max("key").alias("greatest")
    )
    sized = count.withColumn("pages", _pages(F.col("n")))
    # Loads of a day with filters of one size share its pages: bits are put together when they are read.
    wide = named.join(sized.select("day", "pages").hint("merge"), "day")
    bits = wide.select("day", "pages", F.inline(_bits(F.col("key"), F.col("pages"))))
    packed = bits.groupBy("day", "pages", "page").agg(F.bitmap_construct_agg(F.col("bit")).alias("bits"))
    append_table(packed, f"{sketches}_pages")
    append_table(sized.select("day", "n", "least", "greatest", "pages"), f"{sketches}_days")


def _days_hit(told: DataFrame, near: DataFrame, pages: DataFrame) -> set[dt.date]:
    """Days among ``near`` whose filters hold all bits of one of the keys."""
    asked = None
    for row in near.select("pages").distinct().collect():  # sizes are few: they are powers of two
        size = F.lit(row.pages)
        probes = told.select("key", size.alias("pages"), F.inline(_bits(F.col("key"), size)))
        asked = probes if asked is None else asked.union(probes)
    if asked is None:
        return set()
    here = pages.join(F.broadcast(near), ["day", "pages"], "left_semi")
    whole = here.groupBy("day", "pages", "page").agg(F.bitmap_or_agg("bits").alias("bits"))
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = byte.bitwiseAND(F.pow(F.lit(2), F.col("bit") % 8).cast("int")) != 0
    hits = asked.join(whole.hint("merge"), ["pages", "page"]).where(is_set)
    full = hits.groupBy("day", "pages", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == PROBES)
    return {r.day for r in full.select("day").distinct().collect()}


def days_that_may_hold(
    spark: SparkSession, batch: DataFrame, table: str, sketches: str, keys: Sequence[str], day: str
) -> list[dt.date]:
    """Days of ``table`` that may hold a key of ``batch``; days that were never sketched are among them."""
    stored = partition_dates(spark, table, day)
    if not spark.catalog.tableExists(f"{sketches}_days"):
        return stored
    heads = spark.table(f"{sketches}_days")
    sketched = {r.day for r in heads.select("day").distinct().collect()}
    told = batch.select(_told(keys).alias("key"))
    least, greatest, count = told.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if least is None:
        return [d for d in stored if d not in sketched]
    near = heads.where((F.col("greatest") >= least) & (F.col("least") <= greatest)).select("day", "pages").distinct()
    pages, held = spark.table(f"{sketches}_pages"), set()
    open_days = {r.day for r in near.select("day").distinct().collect()}
    one_of = count // FIRST_KEYS
    while open_days:
        some = told.where(F.pmod(F.xxhash64("key", F.lit(PROBES)), F.lit(one_of)) == 0) if one_of > 1 else told
        hit = _days_hit(some.distinct(), near.where(F.col("day").isin(sorted(open_days))), pages)
        held, open_days = held | hit, open_days - hit
        if one_of <= 1:
            break
        one_of //= MORE_KEYS
    return [d for d in stored if d in held or d not in sketched]
