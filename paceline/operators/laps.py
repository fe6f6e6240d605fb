"""Cycle boundaries from distance resets and counter increments, and cycle numbers as of a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paceline.functions.blocks import bridged, rows_only, time_block, window
from paceline.functions.scalar import without_sentinel
from paceline.functions.windows import in_time, increments, resets, since_previous, up_to_here

KEY = "chassis_id"


def with_boundaries(df: DataFrame, key: str = KEY, ts: str = "time_corrected", distance: str | None = "track_distance_m", track_length_m: float = 3700.0, reset: float = -100.0, order: str = "row_id") -> DataFrame:
    """lap_fixed, pre_lap, by_reset, by_increment and is_boundary for each row."""
    w = window(key, ts, order)
    df = df.withColumn("lap_fixed", without_sentinel(F.col("lap")))
    by_distance = distance if distance and distance in df.columns else None
    last = ("lap_fixed", by_distance) if by_distance else ("lap_fixed",)
    df = bridged(df, key, [ts, order], time_block(F.col(ts)), last=last)
    by_reset = resets(F.col(distance), w, reset, 0.8 * track_length_m) if by_distance else F.lit(False)
    df = rows_only(df.withColumns({"by_reset": by_reset, "by_increment": increments(F.col("lap_fixed"), w), "pre_lap": F.lag("lap_fixed").over(w)}))
    return df.withColumn("is_boundary", F.col("by_reset") | F.col("by_increment"))


def boundaries(marked: DataFrame, key: str = KEY, ts: str = "time_corrected", least_sec: float = 90.0, most_sec: float = 300.0, order: str = "row_id") -> DataFrame:
    """key, boundary_time, pre_lap, post_lap, reason, confidence, duration_sec, is_valid. An entity's first boundary is an
    increment of confidence 0.9; short cycles halve the confidence, long ones take 0.7 of it; none is dropped."""
    w = in_time([key], ts, order)
    found = marked.where("is_boundary").withColumns({"n": F.row_number().over(w).cast("long"), "duration_sec": since_previous(F.col(ts), w)})
    first = F.col("n") == 1
    reason = F.when(first, "lap_increment").when(F.col("by_reset"), "lapdist_reset").when(F.col("by_increment"), "lap_increment").otherwise("unknown")
    base = F.when(first, 0.9).when(F.col("by_reset"), 1.0).when(F.col("by_increment"), 0.8).otherwise(0.5)
    factor = F.when(first, 1.0).when(F.col("duration_sec") < least_sec, 0.5).when(F.col("duration_sec") > most_sec, 0.7).otherwise(1.0)
    return found.select(
        key, F.col(ts).alias("boundary_time"), "pre_lap", F.coalesce("lap_fixed", F.col("n")).cast("long").alias("post_lap"),
        reason.alias("reason"), (base * factor).alias("confidence"), "duration_sec", F.coalesce(F.col("duration_sec") >= least_sec, F.lit(True)).alias("is_valid"),
    )


def with_laps(marked: DataFrame, key: str = KEY, ts: str = "time_corrected", order: str = "row_id", fill_first: bool = True) -> DataFrame:
    """lap_repaired: post_lap of the last boundary at or before each row's time (ties in time included), an as-of join as
    windows over rows that carry the boundaries themselves, block by block. Rows before the first boundary: 1, or NULL."""
    at = [ts, order]
    rows = bridged(marked.withColumn("__n", F.col("is_boundary").cast("long")), key, at, time_block(F.col(ts)), sums=("__n",))
    number = F.sum("__n").over(up_to_here(window(key, *at)))
    rows = rows_only(rows.withColumn("__post", F.when(F.col("is_boundary"), F.coalesce(F.col("lap_fixed").cast("long"), number))))
    rows = bridged(rows, key, at, time_block(F.col(ts)), known=("__post",))
    same_time = window(key, ts).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last("__post", ignorenulls=True).over(same_time)
    rows = rows.withColumn("lap_repaired", F.coalesce(last, F.lit(1).cast("long")) if fill_first else last)
    return rows_only(rows).drop("__post", "__n")


def durations(found: DataFrame, key: str = KEY, least_sec: float = 60.0, most_sec: float = 300.0) -> DataFrame:
    """key, post_lap, boundary_time, duration_sec, ok, reason in words."""
    w = in_time([key], "boundary_time", "post_lap")
    d = since_previous(F.col("boundary_time"), w)
    out = found.select(key, "post_lap", "boundary_time", d.alias("duration_sec"))
    short, long_ = F.col("duration_sec") < least_sec, F.col("duration_sec") > most_sec
    words = F.when(F.col("duration_sec").isNull(), "first lap").when(short, F.format_string("too short: %.1fs", "duration_sec")).when(long_, F.format_string("too long: %.1fs", "duration_sec")).otherwise("valid")
    return out.withColumns({"ok": F.coalesce(~short & ~long_, F.lit(True)), "reason": words})


def boundary_report(found: DataFrame, key: str = KEY, short_sec: float = 85.0, long_sec: float = 200.0) -> DataFrame:
    return found.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_boundaries"),
        F.count_if(F.col("reason") == "lapdist_reset").alias("n_resets"),
        F.count_if(F.col("reason") == "lap_increment").alias("n_increments"),
        F.avg("confidence").alias("avg_confidence"),
        F.avg("duration_sec").alias("avg_duration"), F.min("duration_sec").alias("min_duration"), F.max("duration_sec").alias("max_duration"),
        F.count_if(F.col("duration_sec") < short_sec).alias("n_short"), F.count_if(F.col("duration_sec") > long_sec).alias("n_long"),
    )
