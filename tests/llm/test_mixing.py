from collections import Counter
from fractions import Fraction
from math import ceil, floor

from hypothesis import given, settings
from hypothesis import strategies as st

from paceline.llm import mixing


def plain(blocks, weights):
    """Earliest deadline first, looking at every source in each slot."""
    left, done, out = {s: n for s, n in blocks.items() if n}, dict.fromkeys(blocks, 0), []
    while left:
        total = sum(Fraction(weights[s]) for s in left)
        share = {s: Fraction(weights[s]) / total for s in left}
        ran, t = dict.fromkeys(left, 0), 0
        while all(left.values()):
            ready = [(ceil((ran[s] + 1) / share[s]), s) for s in left if floor(ran[s] / share[s]) <= t]
            deadline, s = min(ready)
            assert t < deadline
            out.append((s, done[s]))
            ran[s], done[s], left[s], t = ran[s] + 1, done[s] + 1, left[s] - 1, t + 1
        left = {s: n for s, n in left.items() if n}
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(0.01, 50), min_size=1, max_size=12), st.lists(st.integers(0, 60), min_size=12, max_size=12))
def test_schedule_is_earliest_deadline_first(weights, blocks):
    weights = {f"s{i}": w for i, w in enumerate(weights)}
    blocks = {s: blocks[i] for i, s in enumerate(weights)}
    assert list(mixing.schedule(blocks, weights)) == plain(blocks, weights)


def within_one_block(order, sizes, weights):
    """Each prefix of each phase holds less than one block more or less than a source's share."""
    left, seen, at = dict(sizes), Counter(), 0
    total = sum(weights[x] for x, n in left.items() if n)
    for s in order:
        seen[s] += 1
        at += 1
        assert all(abs(seen[x] - weights[x] / total * at) < 1 + 1e-6 for x, n in left.items() if n)
        if seen[s] == left[s]:  # a phase ends with the last block of a source
            left, seen, at = {x: n - seen[x] for x, n in left.items()}, Counter(), 0
            total = sum(weights[x] for x, n in left.items() if n)
    assert not any(left.values())


def test_many_blocks_against_the_target_weights(spark):
    sizes = {"hot": 60_000, "rare": 40} | {f"s{i:02d}": 5000 for i in range(9)}
    weights = {"hot": 0.5, "rare": 0.0004} | {f"s{i:02d}": 0.0551 for i in range(9)}
    source = "case " + " ".join(f"when id < {sum(list(sizes.values())[: k + 1])} then '{s}'" for k, s in enumerate(sizes)) + " end"
    docs = spark.range(sum(sizes.values())).selectExpr("id as doc_id", f"{source} as source")
    order = [r.source for r in mixing.mix(docs, weights, 1).orderBy("position").select("source").collect()]
    assert len(order) > 100_000
    within_one_block(order, sizes, weights)


def test_less_than_one_block_from_the_given_weights(spark):
    sizes = {"hot": 2500, "rare": 9} | {f"s{i:02d}": 150 for i in range(9)}
    weights = {"hot": 2500**0.5, "rare": 0.01} | {f"s{i:02d}": 150**0.5 for i in range(9)}
    docs = spark.createDataFrame([(i, s) for s, n in sizes.items() for i in range(n)], "doc_id long, source string")
    order = [r.source for r in mixing.mix(docs, weights, 1).orderBy("position").collect()]
    within_one_block(order, sizes, weights)


def test_rows_are_arranged_and_moved_once(spark, documents, odd):
    null_ids = spark.range(5000).selectExpr("cast(null as long) as doc_id", "concat('t', id) as text", "if(id % 3 = 0, 'a', 'b') as source", "id as __s", "id as part", "id as slot")
    for docs, size, chars in ((documents, 4, 20_000), (odd, 2, 50_000), (null_ids, 8, 2_000)):
        docs = mixing.materialize(docs, "test")
        order = mixing.arranged(docs, {"src0": 3.0, "a": 2.0}, size, chars)
        plan = order._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
        assert order.columns == docs.columns
        got = [tuple(r) for r in order.collect()]
        assert Counter(got) == Counter(map(tuple, docs.collect()))
        mixed = mixing.mix(docs, {"src0": 3.0, "a": 2.0}, size).orderBy("position").collect()
        at = docs.columns.index("doc_id"), docs.columns.index("source")
        assert [(r[at[0]], r[at[1]]) for r in got] == [(r.doc_id, r.source) for r in mixed]
    assert mixing.arranged(odd.limit(0)).count() == 0


def test_rows(documents, odd):
    for docs, size in ((documents, 4), (odd, 2), (odd, 64), (odd.limit(0), 4)):
        rows = mixing.mix(docs, {"src0": 3.0, None: 0.5, "it's": 1.0}, size, 50, 7).collect()
        assert sorted(r.position for r in rows) == list(range(docs.count()))
        assert Counter((r.doc_id, r.source) for r in rows) == Counter((r.doc_id, r.source) for r in docs.collect())
        by_position = sorted(rows, key=lambda r: r.position)
        assert [r.slot for r in by_position] == sorted(r.slot for r in rows)
        assert len({(r.source, r.block) for r in rows}) == len({r.slot for r in rows})
        per_block = Counter((r.source, r.block) for r in rows)
        assert all(n <= size for n in per_block.values())


def test_plan_is_native(documents):
    plan = mixing.mix(documents)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
