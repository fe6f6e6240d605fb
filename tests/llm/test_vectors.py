import math
import random

import numpy as np

from paceline.llm import ann, topk


def rows_of(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


def plain_topk(rows, k=10, every=100):
    rows = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in rows:
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in rows if i != q)
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def odd_vectors(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(5)]) for i in range(300)]
    rows += [(300 + i, [0.5] * 5) for i in range(50)] + [(400, [0.0] * 5), (401, None), (402, []), (403, [None] * 5), (404, [math.nan] * 5), (405, [math.inf] * 5), (None, [1.0] * 5)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, v int, q int")
    return rows, df


def test_exact_top_k(spark, embeddings):
    rows = [(r.vec_id, r.embedding) for r in embeddings.collect()]
    for size in (4096, 37):
        assert rows_of(topk.exact_top_k(embeddings, block=size)) == plain_topk(rows)
    rows, df = odd_vectors(spark)
    assert rows_of(topk.exact_top_k(df, block=16)) == plain_topk(rows)
    assert rows_of(topk.exact_top_k(df.limit(0))) == []
    assert rows_of(topk.exact_top_k(df.where("vec_id < 4"), k=10)) == plain_topk([x for x in rows if x[0] is not None and x[0] < 4])


def test_whole_numbers_beyond_doubles(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.integers(-260_000, 260_000, 40) + rng.random(40)).tolist()) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert rows_of(topk.exact_top_k(df, block=50)) == plain_topk(rows)


def test_large_components_take_part(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.uniform(-1, 1, 5).tolist()) for i in range(300)]
    for i, size in ((7, 1e6), (100, 3e5), (150, 5e5), (200, 3e6)):
        rows[i] = (i, (rng.uniform(0.5, 1, 5) * size).tolist())
    rows[100] = (100, [262_145.0, 0.5, -0.25, 0.0, 1.0])
    rows[200] = (200, [1.5e6 + 0.25, -1.0, 0.0, 0.5, 2e5])
    rows[9] = (9, [4e6, 0.5, 0.0, 0.0, 0.0])
    rows[0] = (0, [0.5] * 5)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert rows_of(topk.exact_top_k(df, block=50)) == plain_topk(rows)


def plain_nearest(rows, k=10, every=100):
    rows = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, a in rows:
        if q % every == 0:
            out[q] = sorted((math.dist(a, b), i) for i, b in rows if i != q)[:k]
    return out


def test_recall_and_distances(spark, embeddings):
    rows, df = odd_vectors(spark)
    cases = [(embeddings, [(r.vec_id, r.embedding) for r in embeddings.collect()]), (df, rows)]
    for vectors, plain in cases:
        want, got = plain_nearest(plain), {}
        by_id = {i: v for i, v in plain if v}
        for q, rank, i, score in rows_of(ann.nearest(vectors)):
            got.setdefault(q, []).append((score, i))
            assert rank == len(got[q]) and abs(score - math.dist(by_id[q], by_id[i])) < 1e-12
        assert got.keys() == want.keys()
        hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
        assert hits >= 0.95 * sum(map(len, want.values()))
    assert ann.nearest(df.limit(0)).collect() == []


def test_nearest_within_thousands_of_near_copies(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(6000, 16))
    x[::2] = x[0] + rng.normal(size=(3000, 16)) * np.repeat([1e-1, 1e-3, 1e-6], 1000)[:, None]
    x /= np.sqrt((x**2).sum(1, keepdims=True))
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for q, _, i, _ in rows_of(ann.nearest(df, block=1500)):
        got.setdefault(q, set()).add(i)
    for q in range(0, 6000, 100):
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        assert got[q] == set(np.argsort(d, kind="stable")[:10].tolist())


def test_parallel_error_is_less_than_without_the_weight():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 16))
    book = ann.Codebook.fit(x, threshold=0.5)
    flat = ann.Codebook.fit(x, threshold=0.0)

    def parallel(b):
        codes = b._codes(b.pairs(x))
        r = b._residual(b.pairs(x), codes).reshape(len(x), -1)
        return ((r * x).sum(1) ** 2 / (x**2).sum(1)).mean()

    assert parallel(book) < 0.8 * parallel(flat)
