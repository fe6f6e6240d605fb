import random
import re

import numpy as np
import pytest

from paceline.llm import common, graph, minhash


def plain_sets(rows, width):
    out = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out.append({tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set())
    return out


def plain(rows, width, percent):
    """component of each row: by all pairs; rows that share an id are one vertex."""
    sets = plain_sets(rows, width)
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and min(len(sets[a]), len(sets[b])) * 100 >= percent * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = root(rows[a][0]), root(rows[b][0])
                    parent[max(x, y)] = min(x, y)
    return [(i, len(s), root(i), root(i) == i) for (i, _), s in zip(rows, sets, strict=True)]


def got(df, width, percent):
    return sorted(tuple(r) for r in minhash.near_duplicates(df, width, percent).collect())


@pytest.mark.parametrize("width", [4, 5])
def test_documents(documents, width):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert got(documents, width, 80) == sorted(plain(rows, width, 80))


def test_groups_and_chains(spark, monkeypatch):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):  # a group whose members differ from one another in a few places
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(120)] = f"x{rng.randrange(1000)}"
        rows.append((i, " ".join(words)))
    words = [f"c{i}" for i in range(200)]
    for i in range(60):  # a chain: each differs from the next a little, the ends altogether
        words[i * 3] = f"d{i}"
        rows.append((1000 - i, " ".join(words)))
    rows += [(2000 + i, f"short {i % 7}") for i in range(40)] + [(3000, None), (3001, ""), (3002, " \n"), (3003, "one"), (3004, "ONE")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, rep int, bucket string")
    want = sorted(plain(rows, 4, 80))
    assert got(df, 4, 80) == want
    monkeypatch.setattr(minhash, "PAIRS_EACH", 0)
    assert got(df, 4, 80) == want
    assert got(df.limit(0), 4, 80) == []


def test_odd_rows(odd):
    rows = {(r.doc_id, r.n_shingles): r for r in minhash.near_duplicates(odd, 5, 80).collect()}
    assert len(rows) == odd.distinct().count()
    assert rows[6, 2].component_id == 1 and not rows[6, 2].kept and rows[1, 2].kept
    assert rows[2, 0].component_id == 2 and rows[None, 2].component_id is None and rows[None, 2].kept
    kept = minhash.keep_one(odd, 5, 80)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 2, 3, None, 5, 7, 8, 9, 10]))


def test_estimate_is_corrected():
    rng = np.random.default_rng(0)
    seen = []
    for _ in range(60):
        shared, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (200, 50, 50))
        x, y = (minhash.packed(minhash.minima(np.unique(np.concatenate([shared, s])))) for s in (a, b))
        differ = [int((x[k] ^ y[k]) | (x[k + 2] ^ y[k + 2])).bit_count() for k in range(2)]
        seen.append(minhash.estimate(1 - sum(differ) / minhash.MINIMA))
    assert abs(np.mean(seen) - 200 / 300) < 0.03


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(70)]
    parent = {v: v for e in edges for v in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    found = {r.v: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {v: root(v) for e in edges if e[0] != e[1] for v in e}
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_small_tables_are_a_file_each(spark, documents, monkeypatch):
    written = []

    def recorded(df, label, *files):
        out = common.materialize(df, label, *files)
        written.append((label, len(out.inputFiles())))
        return out

    for module in (graph, minhash):
        monkeypatch.setattr(module, "materialize", recorded)
    several = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    before = {k: spark.conf.get(k) for k in several}
    try:
        for k, v in several.items():
            spark.conf.set(k, v)
        found = minhash.near_duplicates(documents, 4).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(map(tuple, found)) == sorted(plain([(r.doc_id, r.text) for r in documents.collect()], 4, 80))
    small = {"shared", "members", "central", "scored", "pairs", "links", "placed", "open", "hooks", "roots", "contracted"}
    assert small <= {label for label, _ in written}
    assert max(n for label, n in written if label in small) == 1
