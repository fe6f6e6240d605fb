import hashlib
import random
import subprocess
import sys
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paceline.llm import suffix_dedup
from paceline.llm.induced import repeated_starts


def plain_starts(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    return [[i for i in range(len(t) - length + 1) if seen[t[i : i + length]] > 1] for t in texts]


def plain(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    out = []
    for (i, _), t, starts in zip(rows, texts, plain_starts(texts, length), strict=True):
        gone = suffix_dedup.merged([(s, s + length) for s in starts])
        kept, at = b"", 0
        for s, e in gone:
            kept, at = kept + t[at:s], e
        out.append((i, len(t), sum(e - s for s, e in gone), len(gone), hashlib.sha256(kept + t[at:]).hexdigest(), bool(gone)))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=25).map(str.encode) | st.binary(max_size=12), max_size=6), st.integers(1, 7), st.sampled_from([1 << 25, 3000, 64]))
def test_induced_sorting(texts, length, memory):
    assert [x.tolist() for x in repeated_starts(texts, length, memory)] == plain_starts(texts, length)


def order(rows):
    return sorted(rows, key=str)


def check(docs, length, **sizes):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    have = [tuple(r) for r in suffix_dedup.remove_repeats(docs, length, **sizes).collect()]
    assert order(have) == order(plain(rows, length))


@pytest.mark.parametrize("sizes", [{}, {"shard": 150_000, "together": 2, "memory": 5000}])
def test_documents(documents, sizes):
    check(documents, 400, **sizes)
    check(documents, 50, **sizes)


def test_odd_rows(odd):
    for length in (400, 20, 3):
        check(odd, length)
    assert suffix_dedup.remove_repeats(odd.limit(0)).collect() == []


def test_shared_passages(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 7)))
    passages = [" ".join(word() for _ in range(n)) for n in (30, 60, 90)]
    rows = []
    for i in range(120):
        parts = [" ".join(word() for _ in range(rng.randint(0, 40)))]
        for p in rng.sample(passages, rng.randint(0, 3)):
            lo = rng.choice([0, 0, rng.randint(0, 80)])
            parts += [p[lo:], " ".join(word() for _ in range(rng.randint(0, 5)))]
        rows.append((i, " ".join(parts)))
    rows += [(500, "z" * 3000), (501, "z" * 120), (502, "xyz " * 700), (503, "long " + " ".join(word() for _ in range(3000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for sizes in ({}, {"shard": 30_000, "together": 2, "memory": 2000}):
        check(docs, 100, **sizes)
        check(docs, 400, **sizes)


def test_long_texts_in_segments(spark, monkeypatch):
    rng = random.Random(8)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 700)
    a, b = ("".join(rng.choices("abcdef ", k=5000)) for _ in range(2))
    texts = [a, b[:2000] + a[1000:3000] + b[2000:], a[4000:] + b[100:900]]
    assert sum(x[5] for t in texts for x in suffix_dedup.anchored([t.encode()], 200)) == sum(len(t) - 199 for t in texts)
    groups = {}
    for k, t in enumerate(texts):
        for _, g, _, _, lo, span, total, _, far in suffix_dedup.anchored([t.encode()], 200):
            for j in range(total):
                groups.setdefault(t[lo + j : lo + j + 200], set()).add((g, far - j % span if total > span else far - j))
    assert all(len(x) == 1 for x in groups.values())


def test_a_hot_anchor_is_dealt_to_many_shards(spark, monkeypatch):
    rng = random.Random(8)
    letters = lambda n: "".join(rng.choices("abcdefghijklmnop", k=n))
    hot, long_hot = letters(30), letters(55)
    rows = [(i, letters(60) + (hot, long_hot)[i % 2] + letters(60)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    largest, kind = [], type(docs)
    deal = kind.repartitionById

    def seen(self, n, column):
        if "shard" in self.columns:
            largest.append(self.groupBy("shard").agg(F.countDistinct("bytes").alias("n")).agg(F.max("n")).first()[0])
            return deal(self, 4, F.pmod("shard", F.lit(4)).cast("int"))
        return deal(self, n, column)

    monkeypatch.setattr(kind, "repartitionById", seen)
    check(docs, 50, shard=1300, together=2)
    assert largest[0] < 150


LARGE = """
import random, resource, sys
from collections import defaultdict
import numpy as np
from paceline.llm.induced import Shard

rng = random.Random(5)
part = [bytes(rng.choices(b"ab", weights=[5, 1], k=600)) for _ in range(8000)]
texts = part + [b"c" * 40 + x[100:] for x in part[::2]]
held = int(next(x for x in open("/proc/self/status") if x.startswith("VmData")).split()[1]) << 10
resource.setrlimit(resource.RLIMIT_DATA, (held + (96 << 20),) * 2)
with Shard(400, 1 << 25) as shard:
    for x in texts:
        shard.add(x)
    found = [x.tolist() for x in shard.repeated()]
assert all(x == list(range(100, 201)) if k % 2 == 0 else x == [] for k, x in enumerate(found[: len(part)])), "first"
assert all(x == list(range(40, 141)) for x in found[len(part) :]), "second"
print("sorted", sum(map(len, texts)))
"""


def test_shard_larger_than_memory():
    """Seven million places at some thirty bytes each, sorted with 96 MB of memory."""
    run = subprocess.run([sys.executable, "-c", LARGE], capture_output=True, text=True, timeout=600)
    assert run.returncode == 0 and run.stdout.startswith("sorted"), run.stderr[-2000:]
