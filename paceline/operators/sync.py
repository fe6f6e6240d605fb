"""All entities on one timeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paceline.functions.scalar import micros
from paceline.functions.windows import in_time
from paceline.operators.resample import carried_on, grid


def global_range(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.min(micros(F.col(ts))).alias("start_us"), F.max(micros(F.col(ts))).alias("end_us"))


def synchronised(df: DataFrame, key: str, ts: str, freq_hz: float, columns: list[str], limit_sec: float | None = None, exact: bool = False) -> DataFrame:
    """key, tick, t_us and columns for every entity at every tick of the common grid. Rows go to their nearest tick (exact:
    only those on one); limit_sec carries values forward over that time at most.

    The grid is made for each entity from a row of (entity, common range): a generator, not a product of rows."""
    step = round(1e6 / freq_hz)
    bounds = global_range(df, ts).first()  # one row of two numbers
    if bounds.start_us is None:
        return df.select(key, F.lit(0).cast("long").alias("tick"), F.lit(0).cast("long").alias("t_us"), *columns).limit(0)
    entities = df.select(key).distinct().withColumns({"start_us": F.lit(bounds.start_us), "end_us": F.lit(bounds.end_us)})
    off = micros(F.col(ts)) - bounds.start_us
    placed = df.withColumn("tick", F.round(off / step).cast("long"))
    placed = placed.where(F.pmod(off, F.lit(step)) == 0) if exact else placed
    first = placed.groupBy(key, "tick").agg(F.min_by(F.struct(*columns), micros(F.col(ts))).alias("__r"))
    out = grid(entities, freq_hz, [key]).join(first, [key, "tick"], "left").select(key, "tick", "t_us", *[F.col(f"__r.{c}").alias(c) for c in columns])
    if limit_sec is None:
        return out
    return carried_on(out, key, columns, int(limit_sec * freq_hz))


def coverage(synced: DataFrame, key: str, column: str) -> DataFrame:
    """key, frames, frames_present, coverage_pct, first_us, last_us."""
    there = F.col(column).isNotNull()
    n, present = F.count(F.lit(1)), F.count_if(there)
    return synced.groupBy(key).agg(n.alias("frames"), present.alias("frames_present"), (100.0 * present / n).alias("coverage_pct"), F.min(F.when(there, F.col("t_us"))).alias("first_us"), F.max(F.when(there, F.col("t_us"))).alias("last_us"))


def entities_per_frame(synced: DataFrame, key: str, column: str) -> DataFrame:
    """frames, frames_with_data, avg, min and max of entities with data at a frame."""
    per = synced.groupBy("tick").agg(F.countDistinct(F.when(F.col(column).isNotNull(), F.col(key))).alias("n"))
    return per.agg(F.count(F.lit(1)).alias("frames"), F.count_if(F.col("n") > 0).alias("frames_with_data"), F.avg("n").alias("avg_entities"), F.min("n").alias("min_entities"), F.max("n").alias("max_entities"))


def full_windows(synced: DataFrame, key: str, column: str, least: int = 3) -> DataFrame:
    """start_tick, end_tick, frames of runs of frames in which at least `least` entities have data. Neighbours are told by
    frames' numbers; frames are counted per block of 4096 first, so that no single task sorts them all."""
    per = synced.groupBy("tick").agg(F.countDistinct(F.when(F.col(column).isNotNull(), F.col(key))).alias("n")).where(F.col("n") >= least)
    block = per.withColumn("block", F.floor(F.col("tick") / 4096))
    w = in_time(["block"], "tick")
    runs = block.withColumn("island", F.col("tick") - F.row_number().over(w)).groupBy("block", "island").agg(F.min("tick").alias("s"), F.max("tick").alias("e"))
    # Runs that meet at a block's edge are joined: a row for each run of a block is left here.
    all_runs = Window.orderBy("s")
    starts = runs.withColumn("new", F.coalesce((F.col("s") != F.lag("e").over(all_runs) + 1), F.lit(True)).cast("long"))
    numbered = starts.withColumn("k", F.sum("new").over(all_runs.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("k").agg(F.min("s").alias("start_tick"), F.max("e").alias("end_tick")).select("start_tick", "end_tick", (F.col("end_tick") - F.col("start_tick") + 1).alias("frames"))
