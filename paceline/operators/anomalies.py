"""Duplicates, backwards clocks and gaps in long readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.functions.blocks import BLOCK_ROWS, BLOCK_SEC, SIDE, block_of, bridged, rows_only, time_block, window
from paceline.functions.scalar import vehicle_identity
from paceline.functions.windows import is_backwards, is_gap, segment, since_previous

KEYS = ["vehicle_id", "timestamp", "telemetry_name"]


def with_identity(df: DataFrame) -> DataFrame:
    chassis, car = vehicle_identity(F.col("vehicle_id"))
    return df.withColumns({"chassis_id": chassis, "car_no": car})


def keep_last(df: DataFrame, keys: list[str] = KEYS, arrival: str = "row_id") -> DataFrame:
    """Of rows with equal keys the one that arrived last: an aggregate with partial results before the shuffle, not a window."""
    rest = [c for c in df.columns if c not in keys]
    kept = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(arrival)).alias("__r"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"__r.{c}") for c in df.columns])


def duplicate_stats(df: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """rows, duplicate_members (all rows of groups with several), rows_dropped, rows_kept."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return groups.agg(total("n").alias("n_rows"), total(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("duplicate_members"), total(F.col("n") - 1).alias("rows_dropped"), F.count(F.lit(1)).alias("rows_kept"))


def backwards_counts(df: DataFrame, key: str = "vehicle_id", ts: str = "timestamp", arrival: str = "row_id", tolerance_sec: float = 0.001, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """key, backwards: how often an entity's clock goes back in order of arrival; entities without go."""
    rows = bridged(df.select(key, ts, arrival), key, [arrival], block_of(F.col(arrival), block_rows), last=(ts,))
    flagged = rows_only(rows.withColumn("__b", is_backwards(F.col(ts), window(key, arrival), tolerance_sec)))
    return flagged.groupBy(key).agg(F.count_if("__b").alias("backwards")).where(F.col("backwards") > 0)


def gaps(df: DataFrame, key: str = "vehicle_id", ts: str = "timestamp", threshold_sec: float = 2.0, order: tuple = ("row_id",), strict_parity: bool = False, block_sec: float = BLOCK_SEC) -> DataFrame:
    """key, start_time (the row after which there is nothing; strict_parity: the row that ends the gap), gap_sec."""
    w = window(key, ts, *order)
    rows = bridged(df.select(key, ts, *order), key, [ts, *order], time_block(F.col(ts), block_sec), last=(ts,))
    found = rows.select(key, SIDE, (F.col(ts) if strict_parity else F.lag(ts).over(w)).alias("start_time"), since_previous(F.col(ts), w).alias("gap_sec"))
    return found.where((F.col(SIDE) == 0) & (F.col("gap_sec") > threshold_sec)).drop(SIDE)


def with_gap_segments(df: DataFrame, key: str, ts: str, threshold_sec: float, arrival: str = "row_id", begins: str | None = None, block_sec: float = BLOCK_SEC) -> DataFrame:
    """is_gap (in time) and segment_id from 0: a gap begins a segment, and so does a row where the column `begins` holds."""
    w, order = window(key, ts, arrival), [ts, arrival]
    rows = rows_only(bridged(df, key, order, time_block(F.col(ts), block_sec), last=(ts,)).withColumn("is_gap", is_gap(F.col(ts), w, threshold_sec)))
    starts = F.col("is_gap") | F.col(begins) if begins else F.col("is_gap")
    rows = bridged(rows.withColumn("__starts", starts.cast("long")), key, order, time_block(F.col(ts), block_sec), sums=("__starts",))
    return rows_only(rows.withColumn("segment_id", segment(F.col("__starts"), w))).drop("__starts")


def with_segments(df: DataFrame, key: str = "vehicle_id", ts: str = "timestamp", threshold_sec: float = 2.0, arrival: str = "row_id", tolerance_sec: float = 0.001, block_sec: float = BLOCK_SEC, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """is_gap (in time), is_backwards (in order of arrival) and segment_id from 0; both begin a segment."""
    rows = bridged(df, key, [arrival], block_of(F.col(arrival), block_rows), last=(ts,))
    rows = rows_only(rows.withColumn("is_backwards", is_backwards(F.col(ts), window(key, arrival), tolerance_sec)))
    out = with_gap_segments(rows, key, ts, threshold_sec, arrival, "is_backwards", block_sec)
    return out.select(*df.columns, "is_gap", "is_backwards", "segment_id")


def ingest_stats(df: DataFrame) -> DataFrame:
    """One row: what the readings hold. Counts of distinct values are exact and pre-aggregated."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("vehicle_id").alias("vehicles"), F.countDistinct("telemetry_name").alias("signals"), F.min("timestamp").alias("start_time"), F.max("timestamp").alias("end_time"))
