"""Vectors in blocks: what exact and approximate search share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vectors in a block of candidates and of queries.
DATA_BLOCK, QUERY_BLOCK = 4096, 1024


def valid_vectors(vectors: DataFrame, id_col: str, vector_col: str, zero: bool) -> DataFrame:
    """vec_id, v array<double>, without null ids, null or empty vectors, and null or non-finite components; zero: whether
    zero vectors take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).where(F.coalesce(finite, F.lit(False)))
    return rows if zero else rows.where(F.exists("v", lambda x: x != 0))


def common_length(rows: DataFrame) -> tuple[int, int]:
    """The length that most vectors have (ties: the larger) and how many those are; 0 without vectors. Only vectors of one
    length compare."""
    top = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("k"), F.desc("n")).first()
    return (top.n, top.k) if top else (0, 0)


def blocks(rows: DataFrame, dim: int, size: int, group: str = "") -> DataFrame:
    """(group or the first id, ids binary, v binary): vectors side by side, as 64-bit integers and doubles; at most `size`
    of a partition, or, with a column `group` that rows are sorted by, all neighbours of one group."""

    def emit(key: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        ids = np.concatenate([b.column(0).to_numpy(zero_copy_only=False) for b in held])
        v = np.concatenate([b.column(1).flatten().to_numpy(zero_copy_only=False) for b in held])
        return pa.record_batch([pa.array([key], pa.int64()), pa.array([ids.astype("<i8").tobytes()], pa.binary()), pa.array([v.astype("<f8").tobytes()], pa.binary())], ["block", "ids", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n, key = 0, 0
        for batch in batches:
            keys = batch.column(2).to_numpy(zero_copy_only=False) if group else np.zeros(len(batch), np.int64)
            cuts = np.flatnonzero(np.diff(keys)) + 1 if group else np.arange(size, len(batch), size)
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)], strict=True):
                if hi == lo:
                    continue
                part = batch.slice(lo, hi - lo)
                if held and (keys[lo] != key if group else n + len(part) > size):
                    yield emit(key, held)
                    held, n = [], 0
                if not held:
                    key = int(keys[lo]) if group else part.column(0)[0].as_py()
                held.append(part)
                n += len(part)
        if held:
            yield emit(key, held)

    return rows.select("vec_id", "v", *[group] * bool(group)).mapInArrow(run, "block long, ids binary, v binary")


def paired(data: DataFrame, queries: DataFrame, n: int, total: int) -> DataFrame:
    """Every block of data beside every numbered block of queries: an equi-join on the number of the query block and a salt
    of the data block, so that even a single block of queries is searched by many tasks (some four blocks of data each)."""
    salts = max(1, -(-total // (4 * DATA_BLOCK * n)))
    parts = min(4096, n * salts)
    series = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long")))
    left = data.withColumn("q", series(n)).withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)))
    right = queries.withColumn("salt", series(salts))
    return left.repartition(parts, "q", "salt").join(right.repartition(parts, "q", "salt"), ["q", "salt"])


def numbered_queries(rows: DataFrame, dim: int, every: int, size: int = QUERY_BLOCK) -> tuple[DataFrame, int]:
    """Blocks of the vectors whose id is divisible by `every`, as (q, qids, qv), and how many numbers there are."""
    wanted = rows.where(F.pmod(F.col("vec_id"), F.lit(every)) == 0).dropDuplicates(["vec_id", "v"])
    n = max(1, -(-wanted.count() // size))
    dealt = wanted.withColumn("q", F.pmod(F.xxhash64("vec_id"), F.lit(n))).repartition(n, "q").sortWithinPartitions("q", "vec_id")
    return blocks(dealt, dim, 0, "q").select(F.col("block").alias("q"), F.col("ids").alias("qids"), F.col("v").alias("qv")), n


