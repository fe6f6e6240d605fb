"""Mixing sources to target weights by Pfair scheduling, with DataFrame operations only.

Rows of a source are dealt into blocks. With w the source's share of the target weight, its j-th block (from 0) may run in
the slots from floor(j / w) (release) to ceil((j + 1) / w) (deadline, exclusive). One block runs in each slot: of those
released the one with the earliest deadline (ties: the source's name). With shares that sum to 1 this meets every deadline,
so in each prefix of the schedule a source is less than one block from its share.

Shares are the exact quotients of the weights: releases and deadlines come from whole numbers of any size, and the driver
goes through the blocks slot by slot, with one heap entry for each source, and writes the schedule as it goes. When a source
has no blocks left, the next phase begins: the others' shares are scaled up and their schedule starts anew, so the bound
holds within each phase. All rows are kept; none is repeated.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice
from math import lcm

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paceline.llm.common import file_number, materialize, of_files, text_partitions, workspace

#: Rows in a block; slots that are written at a time; rows that are ranked together, at most (in the mean).
BLOCK_ROWS, AT_ONCE, RANKED_TOGETHER = 64, 10_000, 1000
#: Characters of text that a part of the schedule aims at; begins of parts, over all sources, at most (16 bytes each).
PART_CHARS, BOUNDS = 16_000_000, 1_000_000


def schedule(blocks: dict[str, int], weights: dict[str, float]) -> Iterator[tuple[str, int]]:
    """The source and its block (from 0) that run in each slot, for exact weights: earliest deadline first among the
    released blocks, in phases that end with the last block of some source."""
    left = {s: n for s, n in blocks.items() if n > 0}
    done = dict.fromkeys(left, 0)
    while left:
        exact = {s: Fraction(weights[s]) for s in left}
        common = lcm(*(x.denominator for x in exact.values()))
        parts = {s: int(x * common) for s, x in exact.items()}
        total = sum(parts.values())
        coming = [(0, s, 0) for s in sorted(left)]  # release, source, block of this phase
        ready: list[tuple[int, str, int]] = []  # deadline, source, block of this phase
        t, over = 0, None
        while over is None:
            while coming and coming[0][0] <= t:
                _, s, j = heapq.heappop(coming)
                heapq.heappush(ready, (-(-(j + 1) * total // parts[s]), s, j))
            _, s, j = heapq.heappop(ready)
            yield s, done[s]
            done[s] += 1
            left[s] -= 1
            t += 1
            if left[s]:
                heapq.heappush(coming, ((j + 1) * total // parts[s], s, j + 1))
            else:
                over = s
        del left[over]


def _written(spark: SparkSession, sizes: dict[str, int], weights: dict[str, float], block_rows: int, at_once: int, ranked_together: int) -> tuple[DataFrame, DataFrame]:
    """The schedule as a table: __s (the source's key), block, slot, start (the position of the block's first row), and the
    table of sources: __s and the bits of a hash that cut the source into ranges of `ranked_together` rows or fewer. The
    driver holds `at_once` slots; a row for each source is broadcast."""
    path, number = workspace(spark, "schedule"), {s: k for k, s in enumerate(sorted(sizes))}
    file_system = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def write(name: str, lines: Iterator[str]) -> None:
        out = file_system.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"))
        try:
            while some := list(islice(lines, at_once)):
                out.write("".join(some).encode())
        finally:
            out.close()

    def slots() -> Iterator[str]:
        missing = 0  # rows that short blocks before this slot are without
        for slot, (s, j) in enumerate(schedule({s: -(-n // block_rows) for s, n in sizes.items()}, weights)):
            yield f"{number[s]},{j},{slot},{slot * block_rows - missing}\n"
            missing += max(0, (j + 1) * block_rows - sizes[s])

    bits = {s: max(1, (n // ranked_together).bit_length()) for s, n in sizes.items()}
    write("sources.json", (json.dumps({"__k": k, "__s": s, "__bits": bits[s]}) + "\n" for s, k in number.items()))
    write("slots.csv", slots())
    names = spark.read.schema("__k int, __s string, __bits int").json(f"{path}/sources.json")
    slots = spark.read.schema("__k int, block long, slot long, start long").csv(f"{path}/slots.csv")
    return slots.join(F.broadcast(names.drop("__bits")), "__k").drop("__k"), names.drop("__k")


def _key(source: Column) -> Column:
    """A null source is one of its own."""
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source.cast("string")))


def _order(docs: DataFrame) -> Column:
    """A hash of doc_id and the row's place in its file, so that rows that share an id (or have none) have different ones.
    What is not a table of files has no places; its texts, if there are any, stand in for them."""
    if of_files(docs):
        place = docs.metadataColumn("_metadata")
        return F.xxhash64(F.col("doc_id").cast("long"), file_number(place["file_path"]), place["row_index"])
    return F.xxhash64(F.col("doc_id").cast("long"), *[F.col("text")] * ("text" in docs.columns))


def _planned(docs: DataFrame, weights: dict[str | None, float] | None, block_rows: int, at_once: int, ranked_together: int) -> tuple[DataFrame, DataFrame, int, int] | None:
    """Rows (doc_id, source, __s, __h, __rank within the source by __h), the schedule, its number of slots, the number of
    sources; None without rows."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), _key(F.col("source")).alias("__s"), _order(docs).alias("__h"))
    sizes = {r["__s"]: r.n for r in rows.groupBy("__s").agg(F.count(F.lit(1)).alias("n")).collect()}
    given = {("" if s is None else f"={s}"): float(w) for s, w in (weights or {}).items()}
    if any(w <= 0 for w in given.values()):
        raise ValueError("weights must be above 0")
    if not sizes:
        return None
    slots, bits = _written(docs.sparkSession, sizes, {s: given.get(s, 1.0) for s in sizes}, block_rows, at_once, ranked_together)

    # The rank of a row within its source: rows in earlier ranges of hashes, plus its rank within its own range.
    hashed = rows.join(F.broadcast(bits), "__s").withColumn("__g", F.expr("shiftright(__h, 64 - __bits)")).drop("__bits")
    counts = hashed.groupBy("__s", "__g").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.withColumn("__before", F.coalesce(F.sum("__n").over(Window.partitionBy("__s").orderBy("__g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    ranked = hashed.withColumn("__k", F.row_number().over(Window.partitionBy("__s", "__g").orderBy("__h", "doc_id")))
    ranked = ranked.join(before, ["__s", "__g"]).withColumn("__rank", F.col("__before") + F.col("__k") - 1).drop("__g", "__k", "__before")
    return ranked, slots, sum(-(-n // block_rows) for n in sizes.values()), len(sizes)


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, block_rows: int = BLOCK_ROWS, at_once: int = AT_ONCE, ranked_together: int = RANKED_TOGETHER) -> DataFrame:
    """doc_id, source, block (of its source), slot (of the schedule), position (gapless, from 0) for each row of docs.

    weights: of sources, above 0; a source that is not named has weight 1 (without weights all sources weigh the same).
    Within a source rows stand in the order of a hash of doc_id and the row's place in its file, so repeated rows and rows
    without an id are spread as all others are (with no files: in the order of a hash of doc_id and text). Null sources are
    a source of their own, an empty table gives an empty result. One row for each source goes to the driver, which writes
    `at_once` slots of the schedule at a time; a source of any size is ranked in groups of at most about `ranked_together` rows."""
    plan = _planned(docs, weights, block_rows, at_once, ranked_together)
    if plan is None:
        none = F.lit(0).cast("long")
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), none.alias("block"), none.alias("slot"), none.alias("position"))
    ranked, slots, _, _ = plan
    out = ranked.withColumn("block", F.expr(f"__rank div {block_rows}")).join(slots, ["__s", "block"])
    position = F.col("start") + F.pmod(F.col("__rank"), F.lit(block_rows))
    return out.select("doc_id", "source", "block", "slot", position.alias("position"))


def arranged(docs: DataFrame, weights: dict[str | None, float] | None = None, block_rows: int = BLOCK_ROWS, chars: int = PART_CHARS) -> DataFrame:
    """The rows of docs in the order of mix(); written as files, their partitions stand in this order, too.

    Whole rows move once. The schedule is cut into parts of equally many slots, of some `chars` characters. For each source
    the hash at which each part begins is known from the ranks, so that a row finds its part in an array of its source (all
    arrays together hold `BOUNDS` hashes at most, whatever the table). The slots travel to their parts beside the rows, and
    within a part windows bring rows and slots together. An empty table stays empty."""
    columns = docs.columns
    if not of_files(docs):
        docs = materialize(docs, "unordered")
    plan = _planned(docs, weights, block_rows, AT_ONCE, RANKED_TOGETHER)
    if plan is None:
        return docs
    ranked, slots, n_slots, n_sources = plan
    parts = max(1, min(text_partitions(docs, chars), n_slots, BOUNDS // n_sources))
    slots = slots.withColumn("part", F.expr(f"slot div {-(-n_slots // parts)}").cast("int"))
    first = slots.groupBy("__s", "part").agg((F.min("block") * block_rows).alias("__rank"))
    begin = first.join(ranked.select("__s", "__rank", "__h"), ["__s", "__rank"]).groupBy("__s").agg(F.array_sort(F.collect_list(F.struct(F.col("__h").alias("h"), "part"))).alias("begin"))
    begin = materialize(begin, "begin")  # a row for each source

    # Binary search for the last part that begins at or before the row's hash: the steps are powers of two.
    steps = F.array(*[F.lit(1 << k) for k in range(parts.bit_length(), -1, -1)])
    here = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.coalesce(F.get(F.col("begin"), at + step)["h"] <= F.col("h"), F.lit(False)), at + step).otherwise(at))
    rows = docs.select(F.struct(*[docs[c] for c in columns]).alias("row"), _key(F.col("source")).alias("__s"), _order(docs).alias("h"))
    rows = rows.join(F.broadcast(begin), "__s").select("row", "__s", "h", F.get(F.col("begin"), here)["part"].alias("part"), F.lit(None).cast("long").alias("slot"))
    both = rows.unionByName(slots.select("__s", "part", "slot"), allowMissingColumns=True).repartitionById(parts, F.col("part"))

    source = Window.partitionBy("part", "__s").orderBy(F.col("slot").asc_nulls_last(), "h")
    so_far = F.count("slot").over(source.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    both = both.withColumns({"k": F.row_number().over(source), "m": so_far})
    block = F.when(F.col("slot").isNotNull(), F.col("k") - 1).otherwise(F.floor((F.col("k") - F.col("m") - 1) / block_rows))
    both = both.withColumn("block", block).withColumn("at", F.max("slot").over(Window.partitionBy("part", "__s", "block")))
    return both.where(F.col("slot").isNull()).sortWithinPartitions("part", F.col("at").asc_nulls_last(), "k").select("row.*")


def tempered(docs: DataFrame, power: float = 0.5) -> dict[str | None, float]:
    """Target weights of sources in proportion to a power of their rows: below 1, small sources gain."""
    return {r.source: float(r.n) ** power for r in docs.groupBy(F.col("source").cast("string").alias("source")).agg(F.count(F.lit(1)).alias("n")).collect()}
