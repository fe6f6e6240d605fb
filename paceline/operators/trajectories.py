"""Map-ready trajectories on a common list of times."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paceline.functions.geometry import on_line_by_index


def timeline(df: DataFrame, t_us: str = "t_us", block: int = 1 << 16) -> DataFrame:
    """t_us, frame: the distinct times numbered from 0. Numbers are a prefix sum over counts of blocks of time plus the rank
    within a block, so no task sorts all times."""
    times = df.select(t_us).distinct()
    low = times.agg(F.min(t_us).alias("__low")).withColumn("__one", F.lit(1))
    blocks = times.withColumn("__one", F.lit(1)).join(F.broadcast(low), "__one").withColumn("__b", F.floor((F.col(t_us) - F.col("__low")) / F.lit(block * 50_000))).drop("__one", "__low")
    counts = blocks.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    rank = F.row_number().over(Window.partitionBy("__b").orderBy(t_us)) - 1
    return blocks.withColumn("__k", rank).join(before, "__b").select(t_us, (F.col("__before") + F.col("__k")).cast("long").alias("frame"))


def trajectories(df: DataFrame, points: DataFrame, track_length: float, key: str = "chassis_id", distance: str = "track_distance_m", line_of=None, frames: DataFrame | None = None) -> DataFrame:
    """key, n_frames, path array<struct<frame,x,y>> by frame: places on each entity's line from its distance (a distance that
    is missing has no place). line_of: the line's name from df's columns (default: center)."""
    frames = timeline(df) if frames is None else frames
    rows = df.where(F.col(distance).isNotNull()).withColumn("line", line_of if line_of is not None else F.lit("center"))
    placed = on_line_by_index(rows, points, F.col(distance), track_length).join(frames, "t_us")
    return placed.groupBy(key).agg(F.count(F.lit(1)).alias("n_frames"), F.sort_array(F.collect_list(F.struct("frame", "x", "y"))).alias("path"))
