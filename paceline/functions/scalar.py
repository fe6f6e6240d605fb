"""Column expressions on single rows. NaN counts as missing: normalise() turns it into NULL at the boundary."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VEHICLE_PATTERN = r"^GR86-(\d+)-(\d+)"  # fixed value: the source's key


def normalise(df: DataFrame) -> DataFrame:
    """df with NaN as NULL in all float columns."""
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c, t in df.dtypes if t in ("double", "float")})


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def seconds_between(start: Column, end: Column) -> Column:
    return (micros(end) - micros(start)) / F.lit(1e6)


def shifted(ts: Column, seconds: Column) -> Column:
    return F.timestamp_micros(micros(ts) + F.round(seconds * 1e6).cast("long"))


def true_or_false(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def vehicle_identity(vehicle_id: Column, pattern: str = VEHICLE_PATTERN) -> tuple[Column, Column]:
    """chassis and car; what doesn't match is UNKNOWN in both."""
    part = lambda k: F.coalesce(F.nullif(F.regexp_extract(vehicle_id, pattern, k), F.lit("")), F.lit("UNKNOWN"))
    return part(1), part(2)


def without_sentinel(lap: Column, sentinel: int = 32768) -> Column:
    return F.when(lap != sentinel, lap)


def drift_valid(samples: Column, std: Column) -> Column:
    return true_or_false((samples > 10) & (std < 30))


def drift_quality(std: Column) -> Column:
    return F.when(std < 1, "EXCELLENT").when(std < 5, "GOOD").when(std < 10, "ACCEPTABLE").when(std < 30, "POOR").otherwise("INVALID")


def delta_pct(baseline: Column, actual: Column) -> Column:
    """Percent by which actual differs from baseline; from 0: 0 if actual is 0, else 100."""
    return F.when(baseline == 0, F.when(actual == 0, 0.0).otherwise(100.0)).otherwise((actual - baseline) * 100.0 / baseline)


def degrees_from_minutes(x: Column, strict_parity: bool = False) -> Column:
    """DDMM.MMMM to degrees; strict_parity floors negative values as the source does."""
    of = lambda v: F.floor(v / 100) + (v - F.floor(v / 100) * 100) / 60
    return of(x) if strict_parity else F.signum(x) * of(F.abs(x))


def within(x: Column, low: float, high: float, tolerance: float = 0.01) -> Column:
    """The bounds are widened in decimal: -86.55 + 0.01 is -86.54 here, and the double above it in binary."""
    low, high, tolerance = (Decimal(str(v)) for v in (low, high, tolerance))
    return true_or_false(x.between(float(low - tolerance), float(high + tolerance)))


def position_quality(gps: Column, lapdist: Column, outliers: Column, out_of_bounds: Column, of: Column | float = 100) -> Column:
    """From percentages, or from counts `of` so many rows: a count's share is rounded once, so a score on a rating's very
    border falls as in SQL."""
    one = F.lit(1.0)
    share = lambda c, times: F.least(times * c / of, one)
    raw = 0.4 * share(gps, 1.0) + 0.3 * share(lapdist, 1.0) - 0.15 * share(outliers, 10.0) - 0.15 * share(out_of_bounds, 20.0)
    return F.greatest(F.lit(0.0), F.least(one, raw))


def quality_rating(score: Column) -> Column:
    return F.when(score >= 0.8, "EXCELLENT").when(score >= 0.6, "GOOD").when(score >= 0.4, "ACCEPTABLE").otherwise("POOR")


def speed_in_ms(speed: Column, mean: Column) -> Column:
    """Speeds whose mean is above 150 are taken for km/h."""
    return F.when(mean > 150, speed / 3.6).otherwise(speed)


def has_position(lat: Column, lon: Column, track: Column) -> Column:
    return (lat.isNotNull() & lon.isNotNull()) | track.isNotNull()


def local_xy(lat: Column, lon: Column, lat0: Column, lon0: Column, exact: bool = True) -> tuple[Column, Column]:
    """Metres east and north of a reference; exact: with the longitude's scale at lat0, else fixed scales."""
    if exact:
        return (lon - lon0) * 111320.0 * F.cos(F.radians(lat0)), (lat - lat0) * 111320.0
    return (lon - lon0) * 91000.0, (lat - lat0) * 111000.0


def to_pixels(x: Column, low: Column, high: Column, size: float, scale: Column, flipped: bool = False, padding: float = 0.05) -> Column:
    """An axis of an aspect-preserving map: centred, `padding` on either side."""
    at = F.lit(size / 2) + (x - (low + high) / 2) * scale
    return F.lit(size) - at if flipped else at


def from_pixels(at: Column, low: Column, high: Column, size: float, scale: Column, flipped: bool = False) -> Column:
    return (low + high) / 2 + ((F.lit(size) - at if flipped else at) - size / 2) / scale


def pixel_scale(width: Column, height: Column, size_x: float, size_y: float, padding: float = 0.05) -> Column:
    return F.least(F.lit(size_x * (1 - 2 * padding)) / width, F.lit(size_y * (1 - 2 * padding)) / height)


def ribbon_of(car: Column, ribbons_each_side: int = 1) -> Column:
    """center, left_k or right_k from the car's number; other names by a stable hash."""
    n = 2 * ribbons_each_side + 1
    slot = F.pmod(F.coalesce(car.try_cast("bigint"), F.xxhash64(car)), F.lit(n))
    return F.when(slot == 0, "center").when(slot <= ribbons_each_side, F.concat(F.lit("left_"), slot.cast("string"))).otherwise(F.concat(F.lit("right_"), (slot - ribbons_each_side).cast("string")))


def frame_after(start: Column, elapsed: Column, speed: Column, total: Column) -> Column:
    return F.pmod((start + elapsed * speed).cast("long"), total)


def clock_label(seconds: Column) -> Column:
    return F.format_string("%02d:%02d", F.floor(seconds / 60), F.floor(F.pmod(seconds, F.lit(60))))
