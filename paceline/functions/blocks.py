"""Windows over an entity's whole history, block of time by block of time.

A window by entity puts all rows of an entity into one task. Here rows are dealt by (entity, block); what a block needs to
know of the others (the row before it, a count so far, the last and the next known value of a column) is aggregated to one row
for each block, brought together over the blocks of an entity, and added to each block as a row in front of it and one behind
it. Recipes then run as they are over the block's window, and these rows go again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from paceline.functions.scalar import micros

#: Seconds of a block of time, rows of a block in order of arrival, ticks of a block of a grid.
BLOCK_SEC, BLOCK_ROWS, BLOCK_TICKS = 86_400, 1_000_000, 100_000
BLOCK, SIDE = "__block", "__side"


def block_of(number: Column, size: int) -> Column:
    """The block of a whole number; without one, the first block."""
    return F.coalesce(F.floor(number / size).cast("long"), F.lit(-(1 << 62)))


def time_block(ts: Column, seconds: float = BLOCK_SEC) -> Column:
    return block_of(micros(ts), round(seconds * 1_000_000))


def window(key: str, *order: str) -> WindowSpec:
    """The window of a block, with the rows in front of and behind it."""
    return Window.partitionBy(key, BLOCK).orderBy(SIDE, *order)


def bridged(df: DataFrame, key: str, order: list[str], block: Column, last: tuple = (), sums: tuple = (), known: tuple = ()) -> DataFrame:
    """df with a row in front of each block and one behind it (SIDE -1 and 1). In front: columns of `last` as in the row before
    the block, sums of the columns of `sums` over all blocks before, the last known values of the columns of `known`; behind:
    the next known values. All other columns of these rows are null."""
    at = F.struct(*order)
    rows = df.withColumn(BLOCK, block)
    value = F.col
    found = [F.max_by(F.struct(*last), at).alias("__last")] if last else []
    found += [F.sum(c).alias(f"__sum_{c}") for c in sums]
    for c in known:
        there = F.when(value(c).isNotNull(), at)
        found += [F.max_by(c, there).alias(f"__to_{c}"), F.min_by(c, there).alias(f"__from_{c}")]
    edges = rows.groupBy(key, BLOCK).agg(*found)
    blocks = Window.partitionBy(key).orderBy(BLOCK)
    earlier, later = blocks.rowsBetween(Window.unboundedPreceding, -1), blocks.rowsBetween(1, Window.unboundedFollowing)
    front = [F.lag("__last").over(blocks)[c].alias(c) for c in last]
    front += [F.coalesce(F.sum(f"__sum_{c}").over(earlier), F.lit(0)).alias(c) for c in sums]
    front += [F.last(f"__to_{c}", ignorenulls=True).over(earlier).alias(c) for c in known]
    out = rows.withColumn(SIDE, F.lit(0)).unionByName(edges.select(key, BLOCK, F.lit(-1).alias(SIDE), *front), allowMissingColumns=True)
    if known:
        behind = [F.first(f"__from_{c}", ignorenulls=True).over(later).alias(c) for c in known]
        out = out.unionByName(edges.select(key, BLOCK, F.lit(1).alias(SIDE), *behind), allowMissingColumns=True)
    return out


def rows_only(df: DataFrame) -> DataFrame:
    """The rows themselves, after a chain of recipes over bridged ones."""
    return df.where(F.col(SIDE) == 0).drop(SIDE, BLOCK)


def with_halo(df: DataFrame, tick: str, reach: int, size: int = BLOCK_TICKS) -> DataFrame:
    """Rows of a grid that has every tick: a row is in its own block (SIDE 0) and, less than `reach` from another one, in that
    one, too (SIDE 1)."""
    places = F.array_distinct(F.transform(F.array(F.lit(-reach), F.lit(0), F.lit(reach)), lambda d: block_of(F.col(tick) + d, size)))
    return df.withColumn(BLOCK, F.explode(places)).withColumn(SIDE, F.when(F.col(BLOCK) == block_of(F.col(tick), size), 0).otherwise(1))
