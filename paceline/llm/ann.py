"""Approximate nearest neighbours: score-aware anisotropic quantisation, four-bit table scans, exact reranking.

The nearest by Euclidean distance are those of the largest q.x - |x|^2 / 2, a search for the maximum inner product. A
vector is cut into pairs of dimensions; each pair is one of 16 codewords, four bits. Codewords and codes minimise
|r|^2 + (eta - 1) (r.x / |x|)^2: the residual r parallel to x, which is what errors of large inner products are made of,
costs eta times as much (eta from the score threshold, as published for this loss). |x|^2 is kept exactly. A scan adds up
table entries, two codes (one byte) at a time, which gives the angle between q and x's code; the angle between x and its
code is kept, and the angle between q and x is at least their difference. Exact distances are taken of the `depth` best of
a block, and then of all others whose bound does not put them beyond the k-th best, however many those are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paceline.llm.common import hashed_sample
from paceline.llm.vectors import DATA_BLOCK, blocks, common_length, numbered_queries, paired, valid_vectors

#: Vectors that the codewords are fitted on, at most; rounds of fitting; score threshold of the loss; reranked first for each query.
SAMPLE, ROUNDS, THRESHOLD, DEPTH = 8192, 8, 0.2, 160
HELD = 16


class Codebook:
    """16 codewords for each pair of dimensions (the last pair of an odd length is filled up with zeros)."""

    def __init__(self, words: np.ndarray, eta: float):
        self.words, self.eta = words, eta  # words: pairs x 16 x 2

    @staticmethod
    def pairs(x: np.ndarray) -> np.ndarray:
        if x.shape[1] % 4:
            x = np.concatenate([x, np.zeros((len(x), -x.shape[1] % 4))], axis=1)
        return x.reshape(len(x), -1, 2)

    @classmethod
    def fit(cls, x: np.ndarray, rounds: int = ROUNDS, threshold: float = THRESHOLD) -> Codebook:
        dim = x.shape[1]
        eta = max(1.0, (dim - 1) * threshold**2 / (1 - threshold**2))
        p = cls.pairs(x)
        rng = np.random.default_rng(7)
        chosen = rng.integers(0, len(p), (p.shape[1], 16))
        words = np.stack([p[chosen[m], m] + rng.normal(0, 1e-6, (16, 2)) * (np.abs(p[:, m]).max() + 1e-12) for m in range(p.shape[1])])
        book = cls(words, 1.0)
        for k in range(rounds):
            book.eta = eta if k >= rounds // 2 else 1.0
            book._update(p, book._codes(p, sweeps=1))
        book.eta = eta
        return book

    def _residual(self, p: np.ndarray, codes: np.ndarray) -> np.ndarray:
        return p - self.words[np.arange(p.shape[1]), codes]

    @staticmethod
    def _unit(p: np.ndarray) -> np.ndarray:
        return p / np.maximum(np.sqrt((p**2).sum((1, 2), keepdims=True)), 1e-300)

    def _codes(self, p: np.ndarray, sweeps: int = 2) -> np.ndarray:
        """Codes by coordinate descent on the loss, from the nearest codewords."""
        codes = np.stack([((p[:, m, None] - self.words[m]) ** 2).sum(2).argmin(1) for m in range(p.shape[1])], axis=1)
        if self.eta == 1.0:
            return codes
        u = self._unit(p)
        along = (self._residual(p, codes) * u).sum(2)
        total = along.sum(1)
        for _ in range(sweeps):
            for m in range(p.shape[1]):
                r = p[:, m, None] - self.words[m]
                part = (r * u[:, m, None]).sum(2)
                other = total - along[:, m]
                codes[:, m] = ((r**2).sum(2) + (self.eta - 1) * (other[:, None] + part) ** 2).argmin(1)
                along[:, m] = part[np.arange(len(p)), codes[:, m]]
                total = other + along[:, m]
        return codes

    def _update(self, p: np.ndarray, codes: np.ndarray) -> None:
        """The codewords that minimise the loss for these codes, pair by pair: 2 x 2 normal equations."""
        u = self._unit(p)
        along = (self._residual(p, codes) * u).sum(2)
        total = along.sum(1)
        for m in range(p.shape[1]):
            other = total - along[:, m]
            for c in range(16):
                of = codes[:, m] == c
                if not of.any():
                    continue
                um, pm = u[of, m], p[of, m]
                a = of.sum() * np.eye(2) + (self.eta - 1) * um.T @ um
                b = pm.sum(0) + (self.eta - 1) * (um * (other[of] + (pm * um).sum(1))[:, None]).sum(0)
                self.words[m, c] = np.linalg.solve(a, b)
            along[:, m] = ((p[:, m] - self.words[m, codes[:, m]]) * u[:, m]).sum(1)
            total = other + along[:, m]

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Two codes in a byte."""
        out = [self._codes(self.pairs(x[lo : lo + 2048])) for lo in range(0, len(x), 2048)]
        codes = np.concatenate(out).astype(np.uint8)
        return codes[:, 0::2] | (codes[:, 1::2] << 4)

    def nearness(self, x: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The norm of each vector's code, and the cosine between the two (-1, which excludes nothing, if it is not known)."""
        both = np.stack([codes & 15, codes >> 4], axis=2).reshape(len(codes), -1)
        coded = self.words[np.arange(both.shape[1]), both].reshape(len(x), -1)
        with np.errstate(all="ignore"):
            norm = np.sqrt((coded**2).sum(1))
            cosine = (self.pairs(x).reshape(len(x), -1) * coded).sum(1) / (norm * np.sqrt((x**2).sum(1)))
        return np.stack([norm, np.where(np.isfinite(cosine), np.clip(cosine, -1, 1), -1.0)])

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """queries x bytes x 256: the part of the inner product that a byte of codes stands for."""
        t = np.einsum("qmd,mcd->qmc", self.pairs(queries), self.words)
        return (t[:, 1::2, :, None] + t[:, 0::2, None, :]).reshape(len(queries), -1, 256).astype(np.float32)


def fit_sample(rows: DataFrame, dim: int, total: int, sample: int = SAMPLE) -> np.ndarray:
    """At most `sample` vectors, chosen by hashes of their ids."""
    kept = hashed_sample(rows.select("vec_id", "v"), "vec_id", sample, total)
    return np.array([r.v for r in kept.select("v").collect()], dtype=np.float64).reshape(-1, dim)


def build_index(rows: DataFrame, dim: int, book: Codebook, block: int = DATA_BLOCK) -> DataFrame:
    """Every vector beside its codes, half squared norm, and norm and cosine of its code, in blocks: block, ids, v, codes,
    half, near."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                v = np.frombuffer(row["v"], "<f8").reshape(-1, dim)
                half = ((v**2).sum(1) / 2).astype("<f8")
                codes = book.encode(v)
                near = book.nearness(v, codes).astype("<f8")
                yield pa.record_batch([pa.array([row["block"]], pa.int64()), *[pa.array([x], pa.binary()) for x in (row["ids"], row["v"], codes.tobytes(), half.tobytes(), near.tobytes())]], ["block", "ids", "v", "codes", "half", "near"])

    return blocks(rows, dim, block).mapInArrow(run, "block long, ids binary, v binary, codes binary, half binary, near binary")


#: More than what single precision of the tables takes from a cosine; the same for distances in double precision.
COSINE_ERROR, SQUARE_ERROR = 1e-6, 1e-12


def least_squares(products: np.ndarray, square: float, half: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Bounds that no squared distance is below, from inner products with the codes; square: |q|^2.

    With the angles a (q and code) and b (x and code), q and x are at least a - b apart."""
    norm, by_code = near
    with np.errstate(all="ignore"):
        to_code = np.clip(products / (np.sqrt(square) * norm) + COSINE_ERROR, -1, 1)
        cosine = np.where(to_code >= by_code - COSINE_ERROR, 1.0, to_code * by_code + np.sqrt((1 - to_code**2) * (1 - by_code**2)))
        least = square + 2 * half - 2 * np.sqrt(square * 2 * half) * cosine - SQUARE_ERROR * (square + 2 * half)
    return np.where(np.isfinite(least), least, -np.inf)


def _scan(book: Codebook, dim: int, k: int, depth: int):
    width = len(book.words) // 2

    def emit(state: dict) -> Iterator[pa.RecordBatch]:
        for qids, _, found in state.values():
            for q, (scores, ids) in zip(qids.tolist(), found, strict=True):
                if len(ids):
                    yield pa.record_batch([pa.array(np.full(len(ids), q), pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.float64())], ["query_id", "vec_id", "score"])
        state.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["q"] not in state:
                    if len(state) >= HELD:
                        yield from emit(state)
                    qids = np.frombuffer(row["qids"], "<i8")
                    state[row["q"]] = (qids, np.frombuffer(row["qv"], "<f8").reshape(-1, dim), [(np.zeros(0), np.zeros(0, np.int64))] * len(qids))
                qids, queries, found = state[row["q"]]
                ids, half, v = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["half"], "<f8"), np.frombuffer(row["v"], "<f8").reshape(-1, dim)
                near = np.frombuffer(row["near"], "<f8").reshape(2, -1)
                codes = np.frombuffer(row["codes"], np.uint8).reshape(-1, width).T.copy()
                for lo in range(0, len(qids), 64):
                    for i, table in enumerate(book.tables(queries[lo : lo + 64]), lo):
                        query = queries[i]
                        products = np.zeros(len(ids))
                        for b in range(width):
                            products += table[b][codes[b]]
                        least = least_squares(products, (query**2).sum(), half, near)
                        least[ids == qids[i]] = np.inf
                        kth = found[i][0][-1] ** 2 * (1 + SQUARE_ERROR) if len(found[i][0]) == k else np.inf
                        at = np.flatnonzero((least <= kth) & (least < np.inf))
                        if len(at) > depth:
                            first = at[np.argpartition((half - products)[at], depth - 1)[:depth]]
                            kth = min(kth, np.partition(((v[first] - query) ** 2).sum(1), k - 1)[k - 1] * (1 + SQUARE_ERROR))
                            at = at[least[at] <= kth]
                        if len(at):
                            scores, of = np.concatenate([found[i][0], np.sqrt(((v[at] - query) ** 2).sum(1))]), np.concatenate([found[i][1], ids[at]])
                            order = np.lexsort((of, scores))[:k]
                            found[i] = (scores[order], of[order])
        yield from emit(state)

    return run


def nearest(vectors: DataFrame, k: int = 10, every: int = 100, depth: int = DEPTH, sample: int = SAMPLE, id_col: str = "vec_id", vector_col: str = "embedding", block: int = DATA_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for each vector whose id is divisible by `every` its k nearest found, by Euclidean
    distance in double precision, nearest first, ties to the smaller id; never a row of the query's own id.

    Vectors without an id, null, empty, zero, with null or non-finite components, or of another length than most have take
    no part. Codewords are fitted on at most `sample` vectors; every vector is indexed and scanned. Repeated queries count
    once. `depth` is how many of a block's best are ranked exactly first; others follow unless their bound excludes them, so
    that nothing among the k nearest is lost to the codes, near copies by the thousand included."""
    rows = valid_vectors(vectors, id_col, vector_col, zero=False)
    dim, total = common_length(rows)
    if not dim:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    rows = rows.where(F.size("v") == dim)
    book = Codebook.fit(fit_sample(rows, dim, total, sample))
    queries, n = numbered_queries(rows, dim, every)
    depth = max(depth, k)
    scanned = paired(build_index(rows, dim, book, block), queries, n, total).select("q", "qids", "qv", "ids", "v", "codes", "half", "near").mapInArrow(_scan(book, dim, k, depth), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return scanned.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
