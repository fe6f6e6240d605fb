"""Uniform time grids, and rows brought on to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.functions.blocks import BLOCK, BLOCK_TICKS, block_of, bridged, rows_only, window, with_halo
from paceline.functions.scalar import has_position, micros
from paceline.functions.windows import between, haversine_m, in_time, rolling_median, up_to_here


def grid(bounds: DataFrame, freq_hz: float, keep: list[str]) -> DataFrame:
    """keep, tick, t_us for each tick from start_us to end_us (on the grid, included) of each row of bounds."""
    step = round(1e6 / freq_hz)
    last = F.floor((F.col("end_us") - F.col("start_us")) / step)
    # Blocks of ticks first, which are dealt out, then the ticks of a block: no row holds all ticks of an entity.
    blocks = bounds.withColumn("__last", last).withColumn("__first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__last"), F.lit(BLOCK_TICKS).cast("long"))))
    blocks = blocks.repartition(*[F.col(k) for k in keep], "__first")
    ticks = F.sequence(F.col("__first"), F.least(F.col("__last"), F.col("__first") + BLOCK_TICKS - 1))
    return blocks.withColumn("tick", F.explode(ticks)).select(*keep, "tick", (F.col("start_us") + F.col("tick") * step).alias("t_us"))


def span(df: DataFrame, key: str, ts: str) -> DataFrame:
    return df.groupBy(key).agg(F.min(micros(F.col(ts))).alias("start_us"), F.max(micros(F.col(ts))).alias("end_us"))


def on_grid(df: DataFrame, key: str, ts: str, freq_hz: float, exact: bool = False) -> DataFrame:
    """df's rows at the ticks of their entity's own grid, and ticks without rows. exact: only rows that stand on a tick;
    else each goes to the nearest one. Of several at a tick the first in time. The join is an equi-join on whole numbers."""
    step = round(1e6 / freq_hz)
    bounds = span(df, key, ts)
    rest = [c for c in df.columns if c not in (key, ts)]
    off = micros(F.col(ts)) - F.col("start_us")
    placed = df.join(bounds, key).withColumn("tick", F.round(off / step).cast("long"))
    placed = placed.where(F.pmod(off, F.lit(step)) == 0) if exact else placed
    first = placed.groupBy(key, "tick").agg(F.min_by(F.struct(*rest), micros(F.col(ts))).alias("__r"))
    return grid(bounds, freq_hz, [key]).join(first, [key, "tick"], "left").select(key, "tick", "t_us", *[F.col(f"__r.{c}").alias(c) for c in rest])


def resampled(df: DataFrame, key: str, ts: str, freq_hz: float, numeric: list[str], discrete: list[str], exact: bool = False, max_gap_ticks: int | None = None) -> DataFrame:
    """Numeric columns linear between rows on the grid (not across max_gap_ticks), discrete ones carried forward. One window
    specification, over blocks of ticks, serves all columns, so there is one sort."""
    gap = None if max_gap_ticks is None else F.lit(max_gap_ticks)
    out, points = _with_points(on_grid(df, key, ts, freq_hz, exact), key, [*numeric, *discrete])
    w = window(key, "tick")
    filled = {c: between(F.col(c), F.col("tick"), F.col(points[c]), w, max_gap=gap) for c in numeric}
    filled |= {c: F.last(points[c], ignorenulls=True).over(up_to_here(w))["v"] for c in discrete}
    return rows_only(out.withColumns(filled)).drop(*points.values())


def _with_points(out: DataFrame, key: str, columns: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """Rows of a grid, bridged, and for each column the name of the one that holds its known values with their ticks."""
    points = {c: f"__point_{c}" for c in columns}
    out = out.withColumns({p: F.when(F.col(c).isNotNull(), F.struct(F.col("tick").alias("i"), F.col(c).alias("v"))) for c, p in points.items()})
    return bridged(out, key, ["tick"], block_of(F.col("tick"), BLOCK_TICKS), known=tuple(points.values())), points


def carried(df: DataFrame, key: str, ts: str, freq_hz: float, columns: list[str], limit_sec: float = 0.2) -> DataFrame:
    """Columns carried forward over limit_sec at most."""
    return carried_on(on_grid(df, key, ts, freq_hz), key, columns, int(limit_sec * freq_hz))


def carried_on(grid_rows: DataFrame, key: str, columns: list[str], limit: int) -> DataFrame:
    """Columns of a grid's rows carried forward over `limit` ticks at most."""
    out, points = _with_points(grid_rows, key, columns)
    w = up_to_here(window(key, "tick"))
    lo = {c: F.last(points[c], ignorenulls=True).over(w) for c in columns}
    return rows_only(out.withColumns({c: F.when(F.col("tick") - lo[c]["i"] <= limit, lo[c]["v"]) for c in columns})).drop(*points.values())


def with_derived_speed(df: DataFrame, key: str, freq_hz: float, track: str | None = "track_distance_m", lat: str = "gps_lat", lon: str = "gps_lon", track_length_m: float | None = None) -> DataFrame:
    """speed_derived: change of track distance (or great-circle distance) for each second, median of five; a track length
    takes out the jump at the end of a cycle. speed_final: the speed, where there is none the derived one."""
    columns = df.columns
    df = with_halo(df, "tick", 3)
    w = in_time([key, BLOCK], "tick")
    if track and track in df.columns:
        step = F.col(track) - F.lag(track).over(w)
        step = F.pmod(step, F.lit(track_length_m)) if track_length_m else step
    else:
        step = haversine_m(F.lag(lat).over(w), F.lag(lon).over(w), F.col(lat), F.col(lon))
    out = df.withColumn("__v", step * freq_hz).withColumn("speed_derived", rolling_median(F.col("__v"), w)).drop("__v")
    out = rows_only(out).select(*columns, "speed_derived")
    return out.withColumn("speed_final", F.coalesce("speed", "speed_derived") if "speed" in columns else F.col("speed_derived"))


def stats(df: DataFrame, key: str, freq_hz: float) -> DataFrame:
    """key, ticks, span_sec, actual_hz, and coverage of speed_final, positions and both."""
    n = F.count(F.lit(1))
    lat, lon, track = (F.col(c) if c in df.columns else F.lit(None) for c in ("gps_lat", "gps_lon", "track_distance_m"))
    ok = has_position(lat, lon, track)
    pct = lambda c: 100.0 * F.count_if(c) / n
    span_sec = (F.max("t_us") - F.min("t_us")) / 1e6
    return df.groupBy(key).agg(n.alias("ticks"), span_sec.alias("span_sec"), (n / F.nullif(span_sec, F.lit(0.0))).alias("actual_hz"), pct(F.col("speed_final").isNotNull()).alias("speed_pct"), pct(ok).alias("position_pct"), pct(ok & F.col("speed_final").isNotNull()).alias("ready_pct"))
