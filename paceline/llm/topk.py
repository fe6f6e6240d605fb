"""Exact top-k inner products by columnar branch-and-bound.

Vectors stand in blocks, cut into groups of dimensions (vertical layout). A query walks through a block's groups, adds up
partial products, and after each group keeps only the candidates whose partial product plus the most that the remaining
dimensions can add (Cauchy-Schwarz on the remaining norms, kept for each vector and group) still reaches the query's k-th
best. That bound starts from a first block of candidates and rises as blocks are scanned.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paceline.llm.common import hashed_sample, materialize
from paceline.llm.vectors import DATA_BLOCK, blocks, common_length, numbered_queries, paired, valid_vectors

#: Dimensions that are added before candidates are compacted; query blocks whose best are held at once.
GROUP, HELD = 16, 64
_LEAST = np.iinfo(np.int64).min


class Vertical:
    """A block of whole vectors, a matrix for each group of dimensions, with the norm that remains after each group."""

    def __init__(self, v: np.ndarray, group: int = GROUP):
        self.cuts = list(range(0, v.shape[1], group))
        self.parts = [np.ascontiguousarray(v[:, lo : lo + group]) for lo in self.cuts]
        squares = [(p.astype(np.float64) ** 2).sum(1) for p in self.parts]
        rest = np.zeros(len(v))
        self.rest = []
        for s in reversed(squares):
            self.rest.append(np.sqrt(rest))
            rest = rest + s
        self.rest.reverse()

    def search(self, query: np.ndarray, bound: int, skip: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Places whose product may reach the bound, with their exact products."""
        at = np.arange(len(self.parts[0])) if skip is None else np.flatnonzero(~skip)
        score = np.zeros(len(at), query.dtype)
        group = self.parts[0].shape[1]
        squares = np.cumsum((query.astype(np.float64) ** 2)[::-1])[::-1]
        for g, lo in enumerate(self.cuts):
            part = self.parts[g] if len(at) == len(self.parts[g]) else self.parts[g][at]
            score = score + part @ query[lo : lo + group]
            if bound > _LEAST:
                left = np.sqrt(squares[lo + group]) if lo + group < len(query) else 0.0
                keep = score + self.rest[g][at] * (left * (1 + 1e-9)) + (1.0 + np.abs(score) * 2.0**-50 if left else 0.0) >= bound
                if not keep.all():
                    at, score = at[keep], score[keep]
                    if not len(at):
                        break
        return at, score


def _merge(best: tuple[np.ndarray, np.ndarray], score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    score, ids = np.concatenate([best[0], score]), np.concatenate([best[1], ids])
    order = np.lexsort((ids, ~score))[:k]
    return score[order], ids[order]


def _scan(k: int, dim: int, scale: float):
    """rows of (q, qids, qv, bounds or null, ids, v) to the k best of each query over a partition's blocks."""

    # Sums of `dim` products of two components up to this size fit 64 bits; beyond it Python's integers multiply.
    largest = isqrt((1 << 62) // dim)

    def whole(x: bytes) -> np.ndarray:
        return np.floor(np.frombuffer(x, "<f8").reshape(-1, dim) * scale)

    def emit(state: dict) -> Iterator[pa.RecordBatch]:
        for qids, _, _, found in state.values():
            rows = [(q, s, i) for q, (scores, ids) in zip(qids.tolist(), found, strict=True) for s, i in zip(scores.tolist(), ids.tolist(), strict=True)]
            if rows:
                yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], ["query_id", "score", "vec_id"])
        state.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["q"] not in state:
                    if len(state) >= HELD:
                        yield from emit(state)
                    qids = np.frombuffer(row["qids"], "<i8")
                    bounds = np.frombuffer(row["bounds"], "<i8") if row["bounds"] else np.full(len(qids), _LEAST)
                    state[row["q"]] = (qids, whole(row["qv"]), bounds, [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(qids))
                qids, queries, bounds, found = state[row["q"]]
                ids, v = np.frombuffer(row["ids"], "<i8"), whole(row["v"])
                wide, wide_query = np.abs(v).max(1) > largest, np.abs(queries).max(1) > largest
                narrow = np.flatnonzero(~wide)
                small, asked = v[narrow], np.where(wide_query[:, None], 0, queries)
                # Doubles are exact as long as no partial sum can pass 2**53; else 64-bit integers.
                kind = np.float64 if dim * np.abs(small).max(initial=0) * np.abs(asked).max(initial=0) < 2**53 else np.int64
                block, asked = Vertical(small.astype(kind)), asked.astype(kind)
                for i, q in enumerate(qids.tolist()):
                    own = ids == q
                    if not wide_query[i]:
                        bound = max(int(bounds[i]), int(found[i][0][-1]) if len(found[i][0]) == k else _LEAST)
                        at, score = block.search(asked[i], bound, own[narrow] if own.any() else None)
                        if len(at):
                            found[i] = _merge(found[i], score.astype(np.int64), ids[narrow[at]], k)
                    at = np.flatnonzero(~own & (wide | wide_query[i]))
                    if len(at):
                        query = [int(x) for x in queries[i].tolist()]
                        score = [sum(map(mul, query, map(int, x))) for x in v[at].tolist()]
                        found[i] = _merge(found[i], np.array(score, np.int64), ids[at], k)  # an error beyond 64 bits
        yield from emit(state)

    return run


def exact_top_k(vectors: DataFrame, k: int = 10, every: int = 100, scale: float = 1024.0, id_col: str = "vec_id", vector_col: str = "embedding", block: int = DATA_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of floor(scale * vector) for each query, ties to the
    smaller id. Queries are the vectors whose id is divisible by `every`; candidates all but those of the query's own id.

    Vectors without an id, null, empty, with null or non-finite components, or of another length than most have take no
    part. An inner product of large components that does not fit 64 bits is an error, as in the query's SQL. Repeated queries count once, repeated candidates each."""
    rows = valid_vectors(vectors, id_col, vector_col, zero=True)
    dim, total = common_length(rows)
    if not dim:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")).limit(0)
    rows = rows.where(F.size("v") == dim)
    queries, n = numbered_queries(rows, dim, every)
    queries = materialize(queries, "queries")
    data = blocks(rows, dim, block)
    run, schema = _scan(k, dim, scale), "query_id long, score long, vec_id long"
    # Bounds to begin with: each query's k-th best among a block of vectors, whichever.
    first = materialize(blocks(hashed_sample(rows, "vec_id", DATA_BLOCK, total).repartition(1), dim, DATA_BLOCK), "first")
    columns = ["q", "qids", "qv", "bounds", "ids", "v"]
    tried = paired(first, queries, n, 1).withColumn("bounds", F.lit(None).cast("binary")).select(*columns).mapInArrow(run, schema)
    kth = tried.groupBy("query_id").agg(F.min("score").alias("score"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
    bounded = materialize(_with_bounds(queries, kth), "bounded")
    found = paired(data, bounded, n, total).select(*columns).mapInArrow(run, schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _with_bounds(queries: DataFrame, kth: DataFrame) -> DataFrame:
    """Query blocks with the bounds of their queries, side by side; those without one have the least."""

    def ids_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.frombuffer(x, "<i8")
                yield pa.record_batch([pa.array(np.full(len(ids), q), pa.int64()), pa.array(ids, pa.int64()), pa.array(np.arange(len(ids)), pa.int64())], ["q", "query_id", "place"])

    def side_by_side(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [np.array([y["score"] for y in x], "<i8").tobytes() for x in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(values, pa.binary())], ["q", "bounds"])

    places = queries.select("q", "qids").mapInArrow(ids_of, "q long, query_id long, place long")
    joined = places.join(kth.select("query_id", "score"), "query_id", "left").withColumn("score", F.coalesce("score", F.lit(_LEAST)))
    grouped = joined.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("place", "score"))).alias("x"))
    return queries.join(grouped.mapInArrow(side_by_side, "q long, bounds binary"), "q")
