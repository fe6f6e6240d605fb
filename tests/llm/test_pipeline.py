import gc
import re
import time
from collections import Counter
from itertools import product

import __spark_entry__
import corpus_pipeline as P
import numpy as np
import pytest
from paceline.llm import secrets
from paceline.llm.packing import best_fit_but_last, pack_in_order, shared_sequences
from paceline.llm.queries import tokenizer_path
from paceline.llm.toxicity import CATEGORIES, fit, score
from test_minhash import plain
from test_tokens import check_packing, plain as encoded

SF = "/root/testdata/sf0.001"


def redacted(text):
    spans = []
    for r in secrets.RULES:
        for m in re.finditer(r.pattern, text, r.flags):
            if m.end(r.group) - m.start(r.group) >= r.at_least:
                spans.append((m.start(), m.end()))
    out, at = "", 0
    for s, e in sorted(spans):
        if s >= at:
            out += text[at:s] + "[SECRET]"
        at = max(at, e)
    return out + text[at:]


def test_stages(spark, documents):
    stages = dict(P.STAGES)
    assert list(stages) == ["toxicity", "near_duplicates", "secret_scans", "source_mix", "packing"]
    assert __spark_entry__.queries()["pipeline"] is P.run
    clean = stages["toxicity"](spark, documents, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rejected = {r.doc_id for r in score(documents, fit(documents, labels, CATEGORIES)).where("rejected").collect()}
    rows = clean.collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in documents.collect()} - rejected and len(rows) < documents.count()
    one = stages["near_duplicates"](spark, clean, SF)
    kept = sorted(r.doc_id for r in one.collect())
    assert kept == sorted(i for i, _, _, k in plain([(r.doc_id, r.text) for r in rows], 5, 80) if k)
    safe = stages["secret_scans"](spark, one, SF)
    before, after = {r.doc_id: r for r in one.collect()}, {r.doc_id: r for r in safe.collect()}
    assert before.keys() == after.keys()
    assert all(after[i].text == redacted(before[i].text) and after[i].n_chars == len(after[i].text) for i in after)
    mixed = stages["source_mix"](spark, safe, SF)
    order = mixed.collect()
    assert Counter(map(tuple, order)) == Counter(map(tuple, safe.collect()))
    assert len({r.source for r in order[: 64 * 3]}) > 1 or len({r.source for r in order}) == 1
    assert all(df.columns == documents.columns for df in (clean, one, safe, mixed))
    packed = stages["packing"](spark, mixed, SF).collect()
    total = sum(len(x) // 4 + 1 for x in encoded(tokenizer_path("byte_bpe_50k.json"), [r.text for r in order]))
    assert sum(r.length for r in packed) == total and check_packing(packed, 1024) <= -(-total // 1024) * 1.05 + 2


def test_sequences_follow_the_mix(spark):
    sizes = {"a": 6000, "b": 2500, "c": 500}
    sources = [s for s, n in sizes.items() for _ in range(n)]
    docs = spark.createDataFrame([(i, f"document {i} " * (1 + i * 7 % 40), s) for i, s in enumerate(sources)], "doc_id long, text string, source string").repartition(7)
    stages = dict(P.STAGES)
    mixed = stages["source_mix"](spark, docs, SF)
    order = [r.doc_id for r in mixed.collect()]
    for rows, want in ((mixed, order), (mixed.orderBy("doc_id"), sorted(order))):
        packed = stages["packing"](spark, rows, SF).collect()
        check_packing(packed, 1024)
        got = list(dict.fromkeys(r.doc_id for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset))))
        place = {i: k for k, i in enumerate(want)}
        assert sorted(got) == sorted(want)
        for k in range(0, len(got), 4096):  # windows of documents
            assert {place[i] for i in got[k : k + 4096]} == set(range(k, min(k + 4096, len(got))))
        least = {}
        for r in packed:
            least[r.sequence_id] = min(least.get(r.sequence_id, len(got)), place[r.doc_id])
        assert [least[k] for k in sorted(least)] == sorted(least.values())


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES if n != "toxicity"])
def test_stages_begin_with_the_heap_given_back(spark, documents, monkeypatch, name):
    gateway = spark.sparkContext._gateway
    runtime = gateway.jvm.java.lang.Runtime.getRuntime()
    for inner in ("keep_one", "redact", "tempered", "pack_in_order"):
        monkeypatch.setattr(P, inner, lambda docs, *_, **__: docs)
    monkeypatch.setattr(P, "arranged", lambda docs, _: docs)
    held = [gateway.new_array(gateway.jvm.long, 2_500_000) for _ in range(60)]
    grown = runtime.totalMemory()
    del held
    gc.collect()
    time.sleep(3)  # a thread of py4j's lets the arrays go
    dict(P.STAGES)[name](spark, documents, SF)
    assert runtime.totalMemory() < grown


@pytest.mark.parametrize(("window", "most"), [(2, 6), (3, 4), (40, 1)])
def test_open_sequences_of_neighbouring_windows_meet(spark, window, most):
    docs = spark.createDataFrame([(i, f"word {i}") for i in range(24)], "doc_id long, text string").coalesce(1)
    rows = pack_in_order(docs, tokenizer_path("byte_bpe_50k.json"), window=window).collect()
    assert len(rows) == 24 and check_packing(rows, 1024) == most
    assert [r.doc_id // window for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset))] == [i // window for i in range(24)]


@pytest.mark.parametrize(("words", "window", "most"), [(255, 5, 15), (255, 7, 21), (1279, 5, 78)])
def test_windows_share_what_they_leave_open(spark, words, window, most):
    docs = spark.createDataFrame([(i, "a" + " a" * (words - 1)) for i in range(12 * window)], "doc_id long, text string").coalesce(1)
    rows = pack_in_order(docs, tokenizer_path("byte_bpe_50k.json"), window=window).collect()
    assert sum(r.length for r in rows) == 12 * window * (words + 1) and check_packing(rows, 1024) == most
    order = list(dict.fromkeys(r.doc_id for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset))))
    assert [i // window for i in order] == [i // window for i in range(12 * window)]


def test_shared_sequences_are_as_few_as_by_trying_all():
    rng = np.random.default_rng(3)
    for _ in range(60):
        sizes = [rng.integers(1, 65, rng.integers(1, 6)).tolist() for _ in range(4)]
        counts, rooms = shared_sequences([sum(x) for x in sizes], [x[::-1] for x in sizes], 64)

        def cost(picked):
            n = room = 0
            for x, k in zip(sizes, picked, strict=True):
                tail = sum(x[len(x) - k :])
                if tail > 64:
                    return 1 << 30
                n, room = n - (-max(sum(x) - tail - room, 0) // 64) + (k > 0), 64 - tail if k else 0
            return n

        assert cost(counts) == min(map(cost, product(*[range(len(x) + 1) for x in sizes])))
        assert all(r == 0 or r == 64 - sum(x[len(x) - k :]) for r, x, k in zip(rooms[1:], sizes, counts, strict=False)) and rooms[0] == 0


def test_room_is_in_the_bin_of_the_last_items():
    sizes = np.random.default_rng(0).integers(1, 200, 500)
    bins, at, fill = best_fit_but_last(sizes, 1024)
    assert len(fill) == -(-sizes.sum() // 1024) and bins[-1] == len(fill) - 1 and fill.sum() == sizes.sum()
    for k in range(len(fill)):
        mine = sorted(zip(at[bins == k].tolist(), sizes[bins == k].tolist(), strict=True))
        assert [x for x, _ in mine] == np.cumsum([0, *(n for _, n in mine)])[:-1].tolist() and sum(n for _, n in mine) == fill[k] <= 1024
    assert bins[np.flatnonzero(bins == len(fill) - 1)[0] :].tolist() == [len(fill) - 1] * int((bins == len(fill) - 1).sum())


def test_run_and_odd_rows(spark, odd):
    assert P.run(spark, SF).count() > 0
    for docs in (odd, odd.limit(0)):
        for name, stage in P.STAGES:
            before = docs
            docs = stage(spark, docs, SF)
            if name != "packing":
                assert docs.columns == before.columns
        assert np.sum([r.length for r in docs.collect()]) >= 0
