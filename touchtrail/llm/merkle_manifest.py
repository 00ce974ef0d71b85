"""Merkle manifest of a dataset: leaf places by bitmap ranks, levels reduced in keyed slot arrays."""

from __future__ import annotations

import hashlib
from binascii import hexlify
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import fresh, ranked, ready

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
CHUNK_BITS = 16
IDS_PER_PAGE = 1 << 18
IDS_HELD = 1 << 22
SLOT_BITS = 12
_BLOCK_OF_BITS = 1024


# Compressed bitmaps: members of one chunk of ids, as an array, as runs or as bits, whichever is least.


def packed(members: np.ndarray) -> bytes:
    """A set of rising places (16 bits each): ``A`` and the places, ``R`` and first and last of each run, or ``B`` and bits."""
    cuts = np.flatnonzero(np.diff(members.astype(np.int64)) != 1)
    runs = np.stack([members[np.append(0, cuts + 1)], members[np.append(cuts, len(members) - 1)]], 1)
    least = min(2 * len(members), runs.size * 2, 1 << CHUNK_BITS - 3)
    if least == runs.size * 2:
        return b"R" + runs.astype("<u2").tobytes()
    if least == 2 * len(members):
        return b"A" + members.astype("<u2").tobytes()
    bits = np.zeros(1 << CHUNK_BITS, np.uint8)
    bits[members] = 1
    return b"B" + np.packbits(bits).tobytes()


def bits_of(data: bytes) -> np.ndarray:
    """The places of a compressed bitmap as one boolean for each bit."""
    out = np.zeros(1 << CHUNK_BITS, bool)
    if data[:1] == b"B":
        return np.unpackbits(np.frombuffer(data, np.uint8, offset=1)).astype(bool)
    places = np.frombuffer(data, "<u2", offset=1)
    if data[:1] == b"A":
        out[places] = True
    else:
        for first, last in places.reshape(-1, 2):
            out[first : int(last) + 1] = True
    return out


def members_of(data: bytes) -> np.ndarray:
    """The places of a compressed bitmap, rising."""
    if data[:1] == b"A":
        return np.frombuffer(data, "<u2", offset=1).astype(np.int64)
    return np.flatnonzero(bits_of(data))


def directory(bits: np.ndarray) -> np.ndarray:
    """Popcounts: how many bits are set before each block of ``_BLOCK_OF_BITS``."""
    return np.cumsum(bits.reshape(-1, _BLOCK_OF_BITS).sum(1)) - bits.reshape(-1, _BLOCK_OF_BITS).sum(1)


def ranks(bits: np.ndarray, before: np.ndarray, places: np.ndarray) -> np.ndarray:
    """How many set bits lie before each place: its block's entry, and the bits before it in the block."""
    blocks = bits.reshape(-1, _BLOCK_OF_BITS)
    inside = np.cumsum(blocks, 1) - blocks
    return before[places // _BLOCK_OF_BITS] + inside[places // _BLOCK_OF_BITS, places % _BLOCK_OF_BITS]


_PARTIAL = "page bigint, grp string, chunk bigint, n_rows bigint, bitmap binary, again binary, times binary"
_CONTAINER = "grp string, chunk bigint, n_rows bigint, n_ids bigint, bitmap binary, again binary, times binary"


def _row(group, chunk: int, places: np.ndarray, times: np.ndarray) -> dict:
    """A container: its bitmap, and the places that several rows share with their numbers of rows."""
    again = times > 1
    return {
        "grp": group,
        "chunk": chunk,
        "n_rows": int(times.sum()),
        "n_ids": len(places),
        "bitmap": packed(places),
        "again": places[again].astype("<u2").tobytes(),
        "times": times[again].astype("<i8").tobytes(),
    }


def _arrow(columns: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in columns.split(", "))])


def _page(group, chunk: int, pages: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{chunk} {group}".encode(), digest_size=8).digest(), "big") % pages


def _containers(pages: int) -> Callable:
    """``(grp, id)`` to compressed bitmaps of what a task has seen, one for each chunk of ids."""
    schema = _arrow(_PARTIAL)

    def flush(held: list[tuple[np.ndarray, np.ndarray]], names: list) -> Iterator[pa.RecordBatch]:
        codes, ids = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((ids, codes))
        codes, ids = codes[order], ids[order]
        new = np.append(True, (np.diff(codes) != 0) | (np.diff(ids) != 0))
        firsts = np.flatnonzero(new)
        times = np.diff(np.append(firsts, len(ids)))
        codes, ids = codes[firsts], ids[firsts]
        chunks = ids >> CHUNK_BITS
        edges = np.flatnonzero((np.diff(codes) != 0) | (np.diff(chunks) != 0)) + 1
        found = []
        for a, b in zip(np.append(0, edges).tolist(), np.append(edges, len(ids)).tolist()):
            group, chunk = names[codes[a]], int(chunks[a])
            made = _row(group, chunk, ids[a:b] & ((1 << CHUNK_BITS) - 1), times[a:b])
            del made["n_ids"]
            found.append(made | {"page": _page(group, chunk, pages)})
        yield from pa.Table.from_pylist(found, schema).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        held, n = [], 0
        for batch in batches:
            coded = batch.column(0).dictionary_encode(null_encoding="encode")
            codes = np.array([known.setdefault(name, len(known)) for name in coded.dictionary.to_pylist()], np.int64)
            if batch.num_rows:
                held.append((codes[coded.indices.to_numpy()], batch.column(1).to_numpy()))
            n += batch.num_rows
            if n >= IDS_HELD:
                yield from flush(held, list(known))
                held, n = [], 0
        if held:
            yield from flush(held, list(known))

    return run


def _merged(table: pa.Table) -> pa.Table:
    """One page: bitmaps of the same chunk as one, and rows that share an id counted over all."""
    together: dict = {}
    for row in table.to_pylist():
        together.setdefault((row["grp"], row["chunk"]), []).append(row)
    found = []
    for (group, chunk), rows in together.items():
        places, times = [], []
        for row in rows:
            own = members_of(row["bitmap"])
            n = np.ones(len(own), np.int64)
            n[np.searchsorted(own, np.frombuffer(row["again"], "<u2"))] = np.frombuffer(row["times"], "<i8")
            places.append(own)
            times.append(n)
        every, at = np.unique(np.concatenate(places), return_inverse=True)
        total = np.zeros(len(every), np.int64)
        np.add.at(total, at, np.concatenate(times))
        found.append(_row(group, chunk, every, total))
    return pa.Table.from_pylist(found, _arrow(_CONTAINER))


_ANSWER = "grp string, id bigint, first bigint, times bigint"


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Containers with the rows before them to the place of every id: rank queries on their popcounts."""
    schema = _arrow(_ANSWER)
    for batch in batches:
        for row in batch.to_pylist():
            if row["chunk"] is None:
                columns = [[row["grp"]], [None], [row["before"]], [row["n_rows"]]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
                continue
            bits = bits_of(row["bitmap"])
            places = np.flatnonzero(bits)
            rank = ranks(bits, directory(bits), places)
            times = np.ones(len(places), np.int64)
            again = np.searchsorted(places, np.frombuffer(row["again"], "<u2"))
            times[again] = np.frombuffer(row["times"], "<i8")
            more = np.cumsum(times - 1) - (times - 1)  # rows before it that share an id with another
            columns = [
                pa.array([row["grp"]] * len(places), pa.string()),
                pa.array((row["chunk"] << CHUNK_BITS) + places),
                pa.array(row["before"] + rank + more),
                pa.array(times),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _with_rows_before(containers: DataFrame) -> DataFrame:
    """``before``: rows of the group in smaller chunks; only sizes of containers are sorted, by ranges."""
    order = [F.col("grp").asc(), F.col("chunk").asc()]
    sizes = stored(
        containers.select("grp", "chunk", "n_rows")
        .orderBy(*order)
        .withColumn("place", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("place", 33))
    )
    totals = sorted(tuple(r) for r in sizes.groupBy("part").agg(F.sum("n_rows")).collect())
    fronts = np.cumsum([0, *(n for _, n in totals)]).tolist()
    offsets = containers.sparkSession.createDataFrame(
        [(part, front) for (part, _), front in zip(totals, fronts)], "part bigint, front bigint"
    )
    inside = F.sum("n_rows").over(Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    running = stored(
        sizes.withColumn("inside", F.coalesce(inside, F.lit(0)))
        .join(F.broadcast(offsets), "part")  # one row for each range of the sort
        .select(F.col("grp").alias("_g"), F.col("chunk").alias("_c"), (F.col("front") + F.col("inside")).alias("running"))
    )
    starts = running.groupBy(F.col("_g").alias("_h")).agg(F.min("running").alias("start"))
    placed = running.join(starts.hint("merge"), F.col("_g").eqNullSafe(F.col("_h")))
    same = F.col("grp").eqNullSafe(F.col("_g")) & F.col("chunk").eqNullSafe(F.col("_c"))
    found = containers.join(placed.hint("merge"), same)
    return found.withColumn("before", F.col("running") - F.col("start")).select(*containers.columns, "before")


def leaf_places(leaves: DataFrame) -> DataFrame:
    """``leaves(grp, id, leaf, ...)`` with ``pos``: from 0 within the group by id, without sorting rows.

    Tasks send one compressed bitmap for each group and chunk of ids; merged ones have popcount
    directories, and the rank of an id, after the rows in smaller chunks, is its place.  Rows without an
    id come first.  Rows that share an id, and those alone, are sorted (by ranges): they lie by leaf.
    """
    spark = leaves.sparkSession
    ready(spark)
    ids = leaves.select("grp", F.col("id"))
    n_rows = leaves.count()
    pages = max(1, -(-n_rows // IDS_PER_PAGE))
    partial = ids.where("id is not null").mapInArrow(_containers(pages), _PARTIAL)
    without = ids.where("id is null").groupBy("grp").agg(F.count("*").alias("n_rows"))
    none = F.lit(b"")
    containers = stored(
        partial.groupBy("page")
        .applyInArrow(_merged, _CONTAINER)
        .unionByName(
            without.select(
                "grp", F.lit(None).cast("bigint").alias("chunk"), "n_rows", F.lit(1).cast("bigint").alias("n_ids"),
                none.alias("bitmap"), none.alias("again"), none.alias("times"),
            )
        )
    )
    answers = _with_rows_before(containers).mapInArrow(_answers, _ANSWER)
    answers = answers.select(F.col("grp").alias("_g"), F.col("id").alias("_i"), "first", "times")
    same = F.col("grp").eqNullSafe(F.col("_g")) & F.col("id").eqNullSafe(F.col("_i"))
    placed = leaves.join(answers.hint("merge"), same).drop("_g", "_i")
    n_ids = containers.agg(F.sum("n_ids")).first()[0] or 0
    if n_ids == n_rows:
        return placed.withColumnRenamed("first", "pos").drop("times")
    placed = stored(placed)
    once = placed.where("times = 1").withColumn("pos", F.col("first"))
    many = stored(ranked(placed.where("times > 1"), F.col("grp"), F.col("id"), F.col("leaf"), rank="k"))
    least = many.groupBy(F.col("grp").alias("_g"), F.col("id").alias("_i")).agg(F.min("k").alias("least"))
    tied = many.join(least.hint("merge"), same).withColumn("pos", F.col("first") + F.col("k") - F.col("least"))
    return once.select(*leaves.columns, "pos").union(tied.select(*leaves.columns, "pos"))


# Slot arrays: 4,096 neighbours of one tree make one row, and twelve levels are reduced in it.


def _hash(*nodes: bytes) -> bytes:
    return hashlib.sha256(b"".join(nodes)).hexdigest().encode()


def levels(nodes: list[bytes], depth: int) -> list[list[bytes]]:
    """``depth`` levels above ``nodes`` (hex digests), each two consecutive ones hashed, a last one alone."""
    out = [nodes]
    for _ in range(depth):
        nodes = [_hash(*nodes[k : k + 2]) for k in range(0, len(nodes), 2)]
        out.append(nodes)
    return out


def _depth(n: int, block: int, bits: int) -> int:
    """A block that is its whole tree ends at one node; any other has all its levels."""
    return (n - 1).bit_length() if not block and n < 1 << bits else bits


def _split(data: bytes) -> list[bytes]:
    return [hexlify(data[k : k + 32]) for k in range(0, len(data), 32)]


_ARRAY = "grp string, block bigint, nodes binary, top binary"
_LEAF_ARRAY = f"{_ARRAY}, ids array<bigint>, others binary"


def _slots(leaves: bool, bits: int) -> Callable:
    """One block of a tree: its nodes in one array, and the node on top of them."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        block = key[1].as_py()
        table = table.take(pa.array(np.argsort(table.column("pos").to_numpy())))
        nodes = b"".join(table.column("node").to_pylist())
        top = bytes.fromhex(levels(_split(nodes), _depth(table.num_rows, block, bits))[-1][0].decode())
        columns = {
            "grp": pa.array([key[0].as_py()], pa.string()),
            "block": pa.array([block], pa.int64()),
            "nodes": pa.array([nodes], pa.binary()),
            "top": pa.array([top], pa.binary()),
        }
        if leaves:
            columns["ids"] = pa.array([table.column("id").to_pylist()], pa.list_(pa.int64()))
            columns["others"] = pa.array([b"".join(table.column("other").to_pylist())], pa.binary())
        return pa.table(columns)

    return run


def _arrays(nodes: DataFrame, bits: int, leaves: bool = False) -> DataFrame:
    block = F.shiftright("pos", bits).alias("block")
    kept = ["grp", "pos", "node", *(["id", "other"] if leaves else [])]
    keyed = nodes.select(*kept, block)
    return stored(keyed.groupBy("grp", "block").applyInArrow(_slots(leaves, bits), _LEAF_ARRAY if leaves else _ARRAY))


def _tree(nodes: DataFrame, bits: int, leaves: bool = False) -> list[DataFrame]:
    """Slot arrays of all trees, from those of ``nodes(grp, pos, node)`` up to one row for each tree."""
    out = [_arrays(nodes, bits, leaves)]
    while (out[-1].agg(F.max("block")).first()[0] or 0) > 0:
        above = out[-1].select("grp", F.col("block").alias("pos"), F.col("top").alias("node"))
        out.append(_arrays(above, bits))
    return out


def _paths(nodes: list[bytes], block: int, bits: int) -> Iterator[list[bytes]]:
    """For each node its siblings up to the block's top: a side (``-`` for none) and 64 hex digits."""
    made = levels(nodes, _depth(len(nodes), block, bits))
    for slot in range(len(nodes)):
        path, at = [], slot
        for level in made[:-1]:
            beside = at ^ 1
            path.append(b"-" if beside >= len(level) else (b"L" if at & 1 else b"R") + level[beside])
            at >>= 1
        yield path


def fold(leaf: bytes, path: list[bytes]) -> bytes:
    """The root that a leaf and the siblings on its path give."""
    for step in path:
        side, beside = step[:1], step[1:]
        leaf = _hash(beside, leaf) if side == b"L" else _hash(leaf, beside)
    return leaf


_PATH = "grp string, pos bigint, path string, subroot string"


def _down(bits: int) -> Callable:
    """Slot arrays with their own paths to the paths of their slots."""
    schema = _arrow(_PATH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rest = [row["path"]] if row["path"] else []
                paths = [[x.decode() for x in path] for path in _paths(_split(row["nodes"]), row["block"], bits)]
                columns = [
                    [row["grp"]] * len(paths),
                    [(row["block"] << bits) + slot for slot in range(len(paths))],
                    [" ".join(path + rest) for path in paths],
                    [row["subroot"]] * len(paths),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


_PROOF = "doc_id bigint, leaf string, subroot string, siblings array<string>, folded_root string"


def _proofs(bits: int) -> Callable:
    """Slot arrays of leaves with their own paths to one row for each leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rest = [x.encode() for x in row["path"].split()]
                nodes, others = _split(row["nodes"]), _split(row["others"])
                siblings, folded = [], []
                for other, path in zip(others, _paths(nodes, row["block"], bits)):
                    whole = path + rest
                    siblings.append([step[1:].decode() for step in whole if len(step) > 1])
                    folded.append(fold(other, whole).decode())
                columns = [
                    pa.array(row["ids"], pa.int64()),
                    pa.array([n.decode() for n in nodes]),
                    pa.array([row["subroot"]] * len(nodes)),
                    pa.array(siblings, pa.list_(pa.string())),
                    pa.array(folded),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "leaf", "subroot", "siblings", "folded_root"])

    return run


def _descend(arrays: list[DataFrame], paths: DataFrame, bits: int) -> DataFrame:
    """The lowest of ``arrays`` with the path of each of its rows; ``paths(grp, pos, path, subroot)`` are those of the highest."""
    for k in range(len(arrays) - 1, -1, -1):
        named = paths.select(F.col("grp").alias("_g"), F.col("pos").alias("_p"), "path", "subroot").hint("merge")
        same = F.col("grp").eqNullSafe(F.col("_g")) & (F.col("block") == F.col("_p"))
        met = arrays[k].join(named, same).drop("_g", "_p")
        if not k:
            return met
        paths = stored(met.mapInArrow(_down(bits), _PATH))


def record(fields: list[Column]) -> Column:
    """The text that a leaf is the digest of: ``-`` for a missing field, else its bytes' number, a colon and the field."""
    told = []
    for field in fields:
        text = field.cast("string")
        told.append(F.when(text.isNull(), F.lit(b"-")).otherwise(
            F.concat(F.octet_length(text).cast("string").cast("binary"), F.lit(b":"), text.cast("binary"))
        ))
    return F.concat(*told)


def manifest(
    docs: DataFrame,
    changed: Column,
    change: dict[str, Column],
    fields: tuple[str, ...] = FIELDS,
    id_col: str = "doc_id",
    group_col: str = "lang",
    slot_bits: int = SLOT_BITS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, siblings, folded_root.

    A leaf is the SHA-256 of the row's fields (`record`).  The leaves of each group make a binary tree in
    order of their ids, its root being the subroot; subroots in order of the groups' bytes, a missing
    group first, make another tree with the root.  ``siblings`` are the digests beside the path from the
    leaf to the root.  ``folded_root`` is what they and the row's leaf give, read anew from a copy of the
    dataset in which rows where ``changed`` holds have the columns of ``change`` instead; it is the root
    where the copy is sound.

    Rows that share an id lie by their leaves, rows without one come first; a missing text is unlike an
    empty one.  Other columns of ``docs`` count for nothing.  An empty table gives no rows.  Whole
    rows are read once; after that only ids and digests move.  No task holds more than 4,096 neighbours of
    a tree or the ids of some chunks, and only the number of levels, sizes of sort ranges and the root
    pass through the driver.
    """
    spark = docs.sparkSession
    ready(spark)
    names = fresh(docs, "_grp", "_id", "_leaf", "_other")
    grp, id_, leaf, other = names
    digest = lambda columns: F.unhex(F.sha2(record(columns), 256))
    own = digest([F.col(c) for c in fields])
    moved = digest([change.get(c, F.col(c)) for c in fields])
    differs = F.coalesce(changed, F.lit(False))
    leaves = stored(
        docs.select(
            F.col(group_col).cast("string").alias(grp),
            F.col(id_col).cast("bigint").alias(id_),
            own.alias(leaf),
            F.when(differs, moved).alias(other),
        ).toDF("grp", "id", "leaf", "other")
    )
    nodes = leaf_places(leaves).select("grp", "pos", F.col("leaf").alias("node"), "id", F.coalesce("other", "leaf").alias("other"))
    trees = _tree(nodes, slot_bits, leaves=True)
    tops = trees[-1].select("grp", F.col("top").alias("node"))
    groups = stored(ranked(tops, F.col("grp").asc(), rank="pos"))
    above = _tree(groups.select(F.lit("").alias("grp"), "pos", "node"), slot_bits)
    last = above[-1].first()
    if last is None:
        return spark.createDataFrame([], f"{_PROOF}, root string").select("doc_id", "leaf", "subroot", "root", "siblings", "folded_root")
    root = bytes(last["top"]).hex()
    start = spark.createDataFrame([("", 0, "", "")], _PATH)
    highest = _descend(above, start, slot_bits).mapInArrow(_down(slot_bits), _PATH).select(F.col("pos").alias("_p"), "path")
    paths = groups.join(highest.hint("merge"), F.col("pos") == F.col("_p")).select(
        "grp", F.lit(0).cast("bigint").alias("pos"), "path", F.lower(F.hex("node")).alias("subroot")
    )
    found = _descend(trees, stored(paths), slot_bits).mapInArrow(_proofs(slot_bits), _PROOF)
    return found.select("doc_id", "leaf", "subroot", F.lit(root).alias("root"), "siblings", "folded_root")
