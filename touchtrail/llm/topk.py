"""Exact top-k by inner product: long vectors first, partial sums in a rotated basis, residual bounds."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import ranked, ready

TOP = 5
SCALE = 256
QUERY_BLOCK_BYTES = 32 << 20
SEED_ROWS = 4096
CANDIDATE_ROWS = 2048
QUERY_ROWS = 1024
FIRST_SHARE = 4
_EXACT = float(1 << 53)


def integer_vectors(
    df: DataFrame, is_query: Column, id_col: str, vector_col: str, scale: float = SCALE
) -> DataFrame:
    """``(vec_id, is_query, v, norm, row)``: floor(scale * x) of every component; rows that hold none are left out.

    A vector that is missing, or has a missing, infinite or not-a-number component, takes no part.
    """
    x = F.col(vector_col).cast("array<double>")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf"))))
    v = F.transform(x, lambda e: F.floor(e * F.lit(float(scale))).cast("bigint"))
    kept = df.where(x.isNotNull() & ~F.coalesce(bad, F.lit(True))).select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.coalesce(is_query.cast("boolean"), F.lit(False)).alias("is_query"),
        v.alias("v"),
    )
    square = F.aggregate("v", F.lit(0.0), lambda a, e: a + e.cast("double") * e.cast("double"))
    return kept.withColumn("norm", F.sqrt(square)).withColumn("row", F.monotonically_increasing_id())


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as rows; a shorter one goes on with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    for k, n in enumerate(sizes):
        out[k, :n] = flat[ends[k] : ends[k + 1]]
    return out


def _gram(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch.column(0), width).astype(float)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["g"])

    return run


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all ``v``, most of the length first (from their width x width product)."""
    partial = vectors.select("v").mapInArrow(_gram(width), "g binary")
    total = np.zeros((width, width))
    for row in partial.toLocalIterator():
        total += np.frombuffer(row.g).reshape(width, width)
    if not width or not np.isfinite(total).all():
        return np.eye(width)
    return np.linalg.eigh(total)[1][:, ::-1].copy()


class _Queries:
    """A block of queries, and for each the best scores met so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, floors: np.ndarray, basis: np.ndarray, top: int) -> None:
        self.ids, self.vectors, self.basis, self.top = ids, vectors, basis, top
        self.norms = np.sqrt((vectors.astype(float) ** 2).sum(1))
        self.first = max(1, vectors.shape[1] // FIRST_SHARE) if vectors.shape[1] else 0
        turned = vectors.astype(float) @ basis
        self.head = turned[:, : self.first]
        self.rest = np.sqrt((turned[:, self.first :] ** 2).sum(1))
        self.floors = floors.astype(float)  # no score below can be among the best
        self.best = np.full((len(ids), top), -np.inf)

    def meet(self, rows: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of places (query, candidate) that may be among the best, with their exact scores."""
        norms = np.sqrt((vectors.astype(float) ** 2).sum(1))
        longest = norms.max(initial=0.0)
        slack = 1e-9 * self.norms * longest + 1e-6
        open_queries = np.flatnonzero(self.norms * longest + slack >= self.floors)
        found = [np.empty(0, np.int64)] * 3
        if not len(open_queries) or not len(rows):
            return found[0], found[1], found[2]
        turned = vectors.astype(float) @ self.basis
        head, rest = turned[:, : self.first], np.sqrt((turned[:, self.first :] ** 2).sum(1))
        out = []
        for at in range(0, len(open_queries), QUERY_ROWS):
            q = open_queries[at : at + QUERY_ROWS]
            bound = self.head[q] @ head.T + np.outer(self.rest[q], rest)
            i, j = np.nonzero(bound >= (self.floors[q] - slack[q])[:, None])
            other = self.ids[q[i]] != rows[j]
            i, j = i[other], j[other]
            if self.norms.max(initial=0.0) * longest < _EXACT and len(i) * 4 > len(q) * len(rows):
                score = (self.vectors[q].astype(float) @ vectors.T.astype(float))[i, j].astype(np.int64)
            else:
                score = np.empty(len(i), np.int64)
                for a in range(0, len(i), 1 << 16):
                    part = slice(a, a + (1 << 16))
                    score[part] = np.einsum("ij,ij->i", self.vectors[q[i[part]]], vectors[j[part]])
            keep = score >= self.floors[q[i]]
            out.append((q[i[keep]], j[keep], score[keep]))
        i, j, score = (np.concatenate(x) for x in zip(*out))
        self._raise(i, score)
        keep = score >= self.floors[i]
        return i[keep], j[keep], score[keep]

    def _raise(self, i: np.ndarray, score: np.ndarray) -> None:
        order = np.lexsort((-score, i))
        i, score = i[order], score[order]
        starts = np.searchsorted(i, i)
        place = np.arange(len(i)) - starts
        near = place < self.top
        fresh = np.full((len(self.ids), self.top), -np.inf)
        fresh[i[near], place[near]] = score[near]
        self.best = -np.sort(-np.concatenate([self.best, fresh], axis=1), axis=1)[:, : self.top]
        self.floors = np.maximum(self.floors, self.best[:, -1])


def _search(shared, top: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, floors, basis = shared.value
        queries = _Queries(ids, vectors, floors, basis, top)
        found: list[tuple] = []
        for batch in batches:
            rows, names = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
            m = _matrix(batch.column(1), vectors.shape[1])
            for at in range(0, len(rows), CANDIDATE_ROWS):
                part = slice(at, at + CANDIDATE_ROWS)
                i, j, score = queries.meet(rows[part], m[part])
                found.append((i, rows[part][j], names[part][j], score))
            if sum(len(x[0]) for x in found) > 1 << 20:
                found = [_best(found, top)]
        if found:
            i, rows, _, score = _best(found, top)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[i]), pa.array(rows), pa.array(score)], names=["query_row", "row", "score"]
            )

    return run


def _best(found: list[tuple], top: int) -> tuple:
    """For each query the best few of what a task found; copies of a vector do not pile up."""
    i, rows, names, score = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((rows, names, -score, i))
    place = np.arange(len(order)) - np.searchsorted(i[order], i[order])
    order = order[place < top]
    return i[order], rows[order], names[order], score[order]


def _floors(shared, width: int, top: int) -> Callable:
    """Queries with a first lower bound: their k-th best score among the longest vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed_rows, seeds = shared.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            queries = _Queries(ids, _matrix(batch.column(2), width), np.full(len(ids), -np.inf), np.eye(width), top)
            for at in range(0, len(seed_rows), CANDIDATE_ROWS):
                part = slice(at, at + CANDIDATE_ROWS)
                queries.meet(seed_rows[part], seeds[part])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(queries.floors)], names=["row", "vec_id", "v", "low"]
            )

    return run


def exact_top_k(
    df: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    top: int = TOP,
    scale: float = SCALE,
) -> DataFrame:
    """The ``top`` rows of greatest integer inner product with each query row, but for itself.

    Returns query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id (a missing one
    last).  A query is a row for which ``is_query`` holds (it may use the columns of ``df``); rows that
    share an id are rows of their own.  Shorter vectors go on with zeros.

    Candidates are stored by falling length.  A task takes them in that order in blocks and skips
    a block for every query whose length times the block's greatest length stays below the query's
    floor, its k-th best score so far.  In a block, the first quarter of the components in the basis
    of the singular vectors is multiplied out, and the rest bounded by the lengths that remain
    (Cauchy-Schwarz); only pairs whose bound reaches the floor get an exact score, over integers.
    Floors start from the longest ``SEED_ROWS`` vectors.  Queries are sent round in blocks of at
    most ``QUERY_BLOCK_BYTES``, one pass over the candidates for each.
    """
    spark = df.sparkSession
    ready(spark)
    every = stored(integer_vectors(df, is_query, id_col, vector_col, scale))
    width = every.agg(F.max(F.size("v"))).first()[0] or 0
    basis = rotation(every, width)
    by_length = (F.col("norm").desc(), F.xxhash64("row"))
    name = F.coalesce("vec_id", F.lit((1 << 63) - 1)).alias("name")
    sorted_rows = every.repartitionByRange(*by_length).sortWithinPartitions(*by_length)
    candidates = stored(sorted_rows.select("row", "v", name))
    seeds = every.orderBy(F.col("norm").desc(), "row").limit(SEED_ROWS).select("row", "v").toArrow().combine_chunks()
    seed_matrix = _matrix(seeds.column("v").combine_chunks(), width) if len(seeds) else np.zeros((0, width), np.int64)
    shared = spark.sparkContext.broadcast((seeds.column("row").to_numpy(), seed_matrix))
    asked = every.where("is_query").select("row", "vec_id", "v").mapInArrow(
        _floors(shared, width, top), "row bigint, vec_id bigint, v array<bigint>, low double"
    )
    queries = stored(ranked(asked, F.col("row"), rank="number"))
    rows_in_block = max(1, QUERY_BLOCK_BYTES // (8 * max(1, width)))
    count = queries.count()
    parts = []
    for block in range(-(-count // rows_in_block)):
        mine = queries.where(F.floor(F.col("number") / rows_in_block) == block).toArrow().combine_chunks()
        vectors = _matrix(mine.column("v").combine_chunks(), width)
        told = spark.sparkContext.broadcast(
            (mine.column("row").to_numpy(), vectors, mine.column("low").to_numpy(), basis)
        )
        hits = stored(candidates.mapInArrow(_search(told, top), "query_row bigint, row bigint, score bigint"))
        parts.append(hits)
    if not parts:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    hits = parts[0]
    for part in parts[1:]:
        hits = hits.union(part)
    ids = every.select(F.col("row"), "vec_id")
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    chosen = hits.join(ids, "row").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    asked_ids = ids.select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"))
    return chosen.join(asked_ids, "query_row").select("query_id", "rank", "vec_id", "score")
