"""Long readings to one row for each entity and time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paceline.functions.scalar import speed_in_ms
from paceline.schema import RENAMES, SIGNALS


def signal_names(df: DataFrame, signal: str = "telemetry_name") -> list[str]:
    return [r[0] for r in df.select(signal).where(F.col(signal).isNotNull()).distinct().orderBy(signal).collect()]


def pivoted(df: DataFrame, index: list[str], signals: tuple[str, ...] = SIGNALS, signal: str = "telemetry_name", value: str = "telemetry_value", order: str = "row_id", strict_parity: bool = True) -> DataFrame:
    """A column for each of the given signals: its first value that is there, by `order`. The list is fixed, so there is no
    pass over the data to find it, and one hash aggregate does it all. strict_parity drops rows with NULL in the index."""
    rows = df.dropna(subset=index) if strict_parity else df
    first = lambda s: F.min_by(F.when(F.col(signal) == s, F.col(value)), F.when((F.col(signal) == s) & F.col(value).isNotNull(), F.col(order)))
    return rows.groupBy(*index).agg(*[first(s).alias(s) for s in signals])


def with_units(wide: DataFrame, key: str = "chassis_id") -> DataFrame:
    """Renamed position columns; aps in 0..1 with aps_raw; speed in m/s with speed_raw (km/h told by the entity's mean)."""
    wide = wide.withColumnsRenamed({a: b for a, b in RENAMES.items() if a in wide.columns})
    if "aps" in wide.columns:
        wide = wide.withColumns({"aps_raw": F.col("aps"), "aps": F.col("aps") / 100})
    if "speed" in wide.columns:
        mean = F.avg("speed").over(Window.partitionBy(key))
        wide = wide.withColumns({"speed_raw": F.col("speed"), "speed": speed_in_ms(F.col("speed"), mean)})
    return wide


def pivot_stats(long: DataFrame, wide: DataFrame, key: str = "chassis_id", signals: tuple[str, ...] = SIGNALS, signal: str = "telemetry_name") -> DataFrame:
    """key, rows_before, signals_before, rows_after, signals_after, missing_signals, coverage_pct."""
    before = long.groupBy(key).agg(F.count(F.lit(1)).alias("rows_before"), F.countDistinct(signal).alias("signals_before"))
    there = F.array_compact(F.array(*[F.when(F.count(F.col(s)) > 0, F.lit(s)) for s in signals]))
    after = wide.groupBy(key).agg(F.count(F.lit(1)).alias("rows_after"), there.alias("there"))
    missing = F.concat_ws(",", F.array_sort(F.array_except(F.array(*map(F.lit, signals)), F.col("there"))))
    n = F.size("there").cast("long")
    return before.join(after, key).select(key, "rows_before", "signals_before", "rows_after", n.alias("signals_after"), missing.alias("missing_signals"), (100.0 * n / len(signals)).alias("coverage_pct"))
