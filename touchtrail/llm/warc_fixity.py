"""WARC fixity audit: Merkle trees over records and ordered offset ranges, compared from the root down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import fresh, ranked, text_or_empty

RECORDS_PER_ARCHIVE = 1024
RANGE_BYTES = 1 << 16
FAN_OUT = 16
_KEY = ["archive", "part"]


def record_bytes(url: Column, body: Column) -> Column:
    """A WARC resource record; a missing URL or body is empty.  The date is fixed, as none is known."""
    url, body = text_or_empty(url), text_or_empty(body)
    lines = (
        F.lit("WARC/1.0"),
        F.lit("WARC-Type: resource"),
        F.concat(F.lit("WARC-Record-ID: <urn:md5:"), F.md5(F.concat(url, F.lit("\n"), body).cast("binary")), F.lit(">")),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z"),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    )
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n")).cast("binary")


def leaf(record: Column) -> Column:
    """Digest of a record's bytes, set apart from those of nodes by its first byte."""
    return F.unhex(F.sha2(F.concat(F.lit(b"\x00"), record), 256))


def archived(rows: DataFrame, order: list[str], records: int = RECORDS_PER_ARCHIVE) -> DataFrame:
    """``rows`` (with ``n_bytes`` of their records) and where each lies: ``archive`` and ``offset``.

    Rows in the given order fill archives of ``records`` records; the offset is where a record
    starts in its archive.  Rows equal in that order may change places, as their records may.
    Give it digests instead of bodies, and no body moves.
    """
    place = fresh(rows, "place")[0]
    numbered = ranked(rows, *(F.col(c) for c in order), rank=place)
    before = Window.partitionBy("archive").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    return (
        numbered.withColumn("archive", F.floor(F.col(place) / records))
        .withColumn("offset", F.coalesce(F.sum("n_bytes").over(before), F.lit(0)))
        .drop(place)
    )


def leaves(replica: DataFrame) -> DataFrame:
    """``(archive, offset, n_bytes, digest)`` of ``replica(archive, offset, record)``, hashed where it lies."""
    size = F.octet_length("record").cast("bigint").alias("n_bytes")
    return replica.select("archive", "offset", size, leaf(F.col("record")).alias("digest"))


def _node(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One node for each key: the digest of what it holds, in order."""
    told = F.array_sort(F.collect_list(F.struct(*order, "digest")))
    each = F.transform(told, lambda x: F.concat_ws(" ", *(x[c].cast("string") for c in order), F.hex(x["digest"])))
    joined = F.concat(F.lit("\x01"), F.array_join(each, "|"))
    return rows.groupBy(*keys).agg(F.unhex(F.sha2(joined, 256)).alias("digest"))


class Tree:
    """Levels of one replica, from offset ranges of records up to one root; every level is stored.

    A node of the lowest level holds the records that start in one range of an archive, a node
    above up to ``FAN_OUT`` neighbours: ranges of the archive first, then archives.  Groups are
    bounded by the range's bytes or the fan-out, whatever the archives hold.
    """

    def __init__(self, records: DataFrame, range_bytes: int = RANGE_BYTES) -> None:
        self.records = stored(records.withColumn("part", F.floor(F.col("offset") / range_bytes)))
        self.levels = [stored(_node(self.records, _KEY, ["offset", "n_bytes"]))]

    def grow(self, within: int, across: int) -> None:
        """Levels so that ``FAN_OUT ** within`` ranges and ``FAN_OUT ** across`` archives meet in one root."""
        for level in range(within + across):
            child, parent = ("part", F.floor(F.col("part") / FAN_OUT)) if level < within else ("archive", F.floor(F.col("archive") / FAN_OUT))
            up = self.levels[-1].withColumn("child", F.col(child)).withColumn(child, parent)
            self.levels.append(stored(_node(up, _KEY, ["child"])))


def _depth(top: int | None) -> int:
    """Levels above numbers 0 .. top until one node is left."""
    depth = 0
    while (top or 0) > 0:
        top //= FAN_OUT
        depth += 1
    return depth


def audit(first: DataFrame, second: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Records in which two replicas differ: archive, offset, status, first_sha256, second_sha256.

    Both are ``(archive, offset, n_bytes, digest)``, as `leaves` gives them.  Roots are compared; where they differ, the children of
    nodes that differ are, level by level, so equal branches are never looked at again.  Status is
    ``changed``, ``missing`` (not in the second) or ``extra`` (only there).  Records at a shared
    offset are compared in order; equal replicas and empty ones give no rows.
    """
    one, two = Tree(first, range_bytes), Tree(second, range_bytes)
    tops = [t.levels[0].agg(F.max("part"), F.max("archive")).first() for t in (one, two)]
    within, across = (_depth(max((t[k] or 0) for t in tops)) for k in (0, 1))
    for tree in (one, two):
        tree.grow(within, across)
    differing = None
    for level in range(within + across, -1, -1):
        a, b = one.levels[level], two.levels[level]
        if differing is not None:
            inside = "part" if level < within else "archive"
            a, b = (_children(side, differing, inside) for side in (a, b))
        met = a.withColumnRenamed("digest", "d1").join(b.withColumnRenamed("digest", "d2"), _KEY, "full")
        differing = stored(met.where(~F.col("d1").eqNullSafe(F.col("d2"))).select(*_KEY))
    count = Window.partitionBy("archive", "offset").orderBy("digest", "n_bytes")
    sides = [
        t.records.join(differing, _KEY, "left_semi").withColumn("k", F.row_number().over(count)).select("archive", "offset", "k", F.col("digest").alias(d))
        for t, d in ((one, "d1"), (two, "d2"))
    ]
    met = sides[0].join(sides[1], ["archive", "offset", "k"], "full").where(~F.col("d1").eqNullSafe(F.col("d2")))
    status = F.when(F.col("d2").isNull(), "missing").when(F.col("d1").isNull(), "extra").otherwise("changed")
    return met.select(
        "archive",
        "offset",
        status.alias("status"),
        F.lower(F.hex("d1")).alias("first_sha256"),
        F.lower(F.hex("d2")).alias("second_sha256"),
    )


def _children(nodes: DataFrame, parents: DataFrame, inside: str) -> DataFrame:
    """Nodes below ``parents``."""
    up = parents.select(*(F.col(c).alias(f"_{c}") for c in _KEY))
    same = [
        (F.floor(F.col(c) / FAN_OUT) if c == inside else F.col(c)) == F.col(f"_{c}") for c in _KEY
    ]
    return nodes.join(up, same[0] & same[1], "left_semi")
