"""Polylines as rows (line, idx, x, y): lengths, areas, places along them, nearest points. Lines are small dimension tables;
a line that joins to large data is broadcast only if its rows are counted and few."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Points of lines that a broadcast takes.
BROADCAST_POINTS = 200_000


def small(points: DataFrame, limit: int = BROADCAST_POINTS) -> DataFrame:
    """points with a broadcast hint if there are few; without it joins shuffle."""
    return F.broadcast(points) if points.limit(limit + 1).count() <= limit else points


def _order(line: str = "line"):
    return Window.partitionBy(line).orderBy("idx")


def with_arc_length(points: DataFrame) -> DataFrame:
    """points with cum: the distance along the line from its first point."""
    step = F.hypot(F.col("x") - F.lag("x").over(_order()), F.col("y") - F.lag("y").over(_order()))
    return points.withColumn("cum", F.sum(F.coalesce(step, F.lit(0.0))).over(_order().rowsBetween(Window.unboundedPreceding, 0)))


def without_repeats(points: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Points that are no farther than the tolerance from the one before go."""
    step = F.hypot(F.col("x") - F.lag("x").over(_order()), F.col("y") - F.lag("y").over(_order()))
    return points.withColumn("__step", step).where(F.col("__step").isNull() | (F.col("__step") > tolerance)).drop("__step")


def signed_area(points: DataFrame) -> DataFrame:
    """line, area (shoelace; the line is closed), direction."""
    whole = Window.partitionBy("line").orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nx = F.coalesce(F.lead("x").over(_order()), F.first("x").over(whole))
    ny = F.coalesce(F.lead("y").over(_order()), F.first("y").over(whole))
    parts = points.withColumn("part", F.col("x") * ny - nx * F.col("y"))
    out = parts.groupBy("line").agg((F.sum("part") / 2).alias("area"))
    return out.withColumn("direction", F.when(F.col("area") > 0, "counter-clockwise").otherwise("clockwise"))


def reversed_line(points: DataFrame) -> DataFrame:
    last = F.max("idx").over(Window.partitionBy("line"))
    return points.withColumn("idx", last - F.col("idx"))


def scaled_to_length(points: DataFrame, length: float) -> DataFrame:
    """Lines centred on their bounding box and scaled to a length; lines of no length give NULL."""
    whole = Window.partitionBy("line")
    scale = F.lit(length) / F.nullif(F.max("cum").over(whole), F.lit(0.0))
    centred = lambda c: (F.col(c) - (F.min(c).over(whole) + F.max(c).over(whole)) / 2) * scale
    return with_arc_length(points).withColumns({"__x": centred("x"), "__y": centred("y")}).select("line", "idx", F.col("__x").alias("x"), F.col("__y").alias("y"))


def resampled_line(points: DataFrame, n: int) -> DataFrame:
    """n points at equal distances along each line, linear between points."""
    cum = with_arc_length(points)
    nxt = cum.select("line", "idx", "x", "y", "cum", *[F.lead(c).over(_order()).alias(f"{c}1") for c in ("x", "y", "cum")])
    grid = cum.groupBy("line").agg(F.max("cum").alias("length")).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn("d", F.col("length") * F.col("k") / (n - 1))
    part = (F.col("cum1") - F.col("cum"))
    share = F.when(part > 0, (F.col("d") - F.col("cum")) / part).otherwise(0.0)
    hit = grid.alias("g").join(nxt.alias("p"), (F.col("g.line") == F.col("p.line")) & (F.col("d") >= F.col("cum")) & ((F.col("d") < F.col("cum1")) | F.col("cum1").isNull()))
    return hit.select("g.line", F.col("k").alias("idx"), (F.col("x") + F.coalesce((F.col("x1") - F.col("x")) * share, F.lit(0.0))).alias("x"), (F.col("y") + F.coalesce((F.col("y1") - F.col("y")) * share, F.lit(0.0))).alias("y"))


def offset_line(points: DataFrame, distance: float, name: str) -> DataFrame:
    """A line beside each line: every point moved along its normal (the left side for a distance above 0)."""
    dx = F.coalesce(F.lead("x").over(_order()), F.col("x")) - F.coalesce(F.lag("x").over(_order()), F.col("x"))
    dy = F.coalesce(F.lead("y").over(_order()), F.col("y")) - F.coalesce(F.lag("y").over(_order()), F.col("y"))
    n = F.nullif(F.hypot(dx, dy), F.lit(0.0))
    moved = points.withColumns({"__x": F.col("x") - distance * F.coalesce(dy / n, F.lit(0.0)), "__y": F.col("y") + distance * F.coalesce(dx / n, F.lit(0.0))})
    return moved.select(F.lit(name).alias("line"), "idx", F.col("__x").alias("x"), F.col("__y").alias("y"))


def on_line_by_index(rows: DataFrame, points: DataFrame, distance: Column, track_length: float) -> DataFrame:
    """rows with x, y at the share (distance mod length) / length of the line `line`, points counting as evenly spread."""
    order = _order()
    seg = points.select("line", "idx", F.col("x").alias("x0"), F.col("y").alias("y0"), F.lead("x").over(order).alias("x1"), F.lead("y").over(order).alias("y1"), F.count(F.lit(1)).over(Window.partitionBy("line")).alias("__n"))
    n = points.groupBy("line").agg((F.count(F.lit(1)) - 1).alias("__last"))
    at = F.pmod(distance, F.lit(track_length)) / track_length * F.col("__last")
    placed = rows.join(small(n), "line").withColumn("__at", at).withColumn("idx", F.floor("__at").cast("int"))
    share = F.col("__at") - F.col("idx")
    out = placed.join(small(seg), ["line", "idx"])
    lerp = lambda c: F.col(f"{c}0") + F.coalesce((F.col(f"{c}1") - F.col(f"{c}0")) * share, F.lit(0.0))
    return out.withColumns({"x": lerp("x"), "y": lerp("y")}).drop("x0", "y0", "x1", "y1", "__n", "__last", "__at", "idx")


def on_line_by_length(rows: DataFrame, points: DataFrame, distance: Column, cell_m: float = 50.0) -> DataFrame:
    """rows with x, y at a distance (mod its length) along the line `line`. Segments are listed in every cell of `cell_m`
    metres that they touch, so the join is an equi-join on (line, cell)."""
    order = _order()
    seg = with_arc_length(points).select("line", F.col("x").alias("x0"), F.col("y").alias("y0"), F.col("cum").alias("c0"), *[F.lead(c).over(order).alias(f"{c[0]}1") for c in ("x", "y", "cum")])
    seg = seg.where(F.col("c1") > F.col("c0")).withColumn("cell", F.explode(F.sequence(F.floor(F.col("c0") / cell_m), F.floor(F.col("c1") / cell_m))))
    length = seg.groupBy("line").agg(F.max("c1").alias("__length"))
    placed = rows.join(small(length), "line").withColumn("__d", F.pmod(distance, F.col("__length"))).withColumn("cell", F.floor(F.col("__d") / cell_m))
    hit = placed.join(small(seg), ["line", "cell"]).where((F.col("__d") >= F.col("c0")) & (F.col("__d") < F.col("c1")))
    share = (F.col("__d") - F.col("c0")) / (F.col("c1") - F.col("c0"))
    return hit.withColumns({"x": F.col("x0") + (F.col("x1") - F.col("x0")) * share, "y": F.col("y0") + (F.col("y1") - F.col("y0")) * share}).drop("x0", "y0", "c0", "x1", "y1", "c1", "cell", "__d", "__length")


def nearest_point(rows: DataFrame, points: DataFrame, x: str = "x", y: str = "y", key: str = "row_id") -> DataFrame:
    """key, idx, distance: the nearest point (ties: the least idx) of the line `line` for each row with a place.

    A line is one row with an array of its points, joined by its name; a higher-order function finds the least distance, so
    rows are neither multiplied nor shuffled. Lines of more than BROADCAST_POINTS points in all raise an error."""
    if points.limit(BROADCAST_POINTS + 1).count() > BROADCAST_POINTS:
        raise ValueError("too many points for a line")
    lines = points.groupBy("line").agg(F.sort_array(F.collect_list(F.struct("idx", "x", "y"))).alias("__line"))
    d = lambda p: F.hypot(p["x"] - F.col(x), p["y"] - F.col(y))
    best = F.array_min(F.transform("__line", lambda p: F.struct(d(p).alias("distance"), p["idx"].alias("idx"))))
    placed = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).join(F.broadcast(lines), "line")
    return placed.withColumn("__best", best).select(key, F.col("__best.idx").alias("idx"), F.col("__best.distance").alias("distance"))


def bounding_box(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    return points.agg(*[f(c).alias(f"{n}_{c}") for c in (x, y) for n, f in (("min", F.min), ("max", F.max))])
