"""Window recipes over one entity's rows in time. One window specification serves a whole chain of them."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from paceline.functions.scalar import seconds_between, true_or_false

EARTH_M = 6_371_000.0


def in_time(keys: list[str], *order: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def up_to_here(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def from_here(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.currentRow, Window.unboundedFollowing)


def since_previous(ts: Column, w: WindowSpec) -> Column:
    return seconds_between(F.lag(ts).over(w), ts)


def is_backwards(ts: Column, arrival: WindowSpec, tolerance_sec: float = 0.001) -> Column:
    """In order of arrival the clock goes back by more than the tolerance."""
    return true_or_false(since_previous(ts, arrival) < -tolerance_sec)


def is_gap(ts: Column, w: WindowSpec, threshold_sec: float = 2.0) -> Column:
    return true_or_false(since_previous(ts, w) > threshold_sec)


def segment(starts: Column, w: WindowSpec) -> Column:
    """Numbers of segments from 0: how many rows so far start a new one."""
    return F.sum(starts.cast("long")).over(up_to_here(w))


def resets(x: Column, w: WindowSpec, drop: float = -100.0, least: float = 50.0) -> Column:
    """x falls by more than `drop` from a value above `least`."""
    before = F.lag(x).over(w)
    return true_or_false((x - before < drop) & (before > least))


def increments(x: Column, w: WindowSpec) -> Column:
    return true_or_false(x - F.lag(x).over(w) > 0)


def filled_forward(x: Column, w: WindowSpec) -> Column:
    return F.last(x, ignorenulls=True).over(up_to_here(w))


def filled_forward_within(x: Column, index: Column, w: WindowSpec, limit: int) -> Column:
    """Forward fill over at most `limit` steps of index."""
    lo = F.last(F.when(x.isNotNull(), F.struct(index.alias("i"), x.alias("v"))), ignorenulls=True).over(up_to_here(w))
    return F.when(index - lo["i"] <= limit, lo["v"])


def interpolated(x: Column, index: Column, w: WindowSpec, both_ends: bool = False, max_gap: Column | None = None) -> Column:
    """Linear in index between neighbours that have values; both_ends: edges take the nearest value. max_gap: neighbours
    farther apart than that leave a hole."""
    return between(x, index, F.when(x.isNotNull(), F.struct(index.alias("i"), x.alias("v"))), w, both_ends, max_gap)


def between(x: Column, index: Column, point: Column, w: WindowSpec, both_ends: bool = False, max_gap: Column | None = None) -> Column:
    """As interpolated, from points (i, v) that may stand in rows of their own."""
    lo, hi = F.last(point, ignorenulls=True).over(up_to_here(w)), F.first(point, ignorenulls=True).over(from_here(w))
    on_line = lo["v"] + (hi["v"] - lo["v"]) * (index - lo["i"]) / (hi["i"] - lo["i"])
    inside = F.when(hi["i"] == lo["i"], lo["v"]).otherwise(on_line)  # between rows of one time the earlier value holds
    if max_gap is not None:
        inside = F.when(hi["i"] - lo["i"] <= max_gap, inside)
    return F.coalesce(x, inside, lo["v"], hi["v"]) if both_ends else F.coalesce(x, inside)


def rolling_median(x: Column, w: WindowSpec, width: int = 5) -> Column:
    """Centred, of what there is."""
    return F.percentile(x, F.lit(0.5)).over(w.rowsBetween(-(width // 2), width // 2))


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_M * F.asin(F.sqrt(a))


def jump_m(lat: Column, lon: Column, w: WindowSpec, strict_parity: bool = False) -> Column:
    """Planar distance from the row before, in metres; strict_parity takes radians for degrees as the source does."""
    unit = (lambda d: F.radians(d)) if strict_parity else (lambda d: d)
    dy = unit(lat - F.lag(lat).over(w)) * 111000.0
    dx = unit(lon - F.lag(lon).over(w)) * 111000.0 * F.cos(F.radians(lat))
    return F.sqrt(dx * dx + dy * dy)
