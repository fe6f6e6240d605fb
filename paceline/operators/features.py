"""Features of cycles and entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.functions.scalar import micros
from paceline.functions.windows import in_time


def lap_features(df: DataFrame, key: str = "chassis_id", lap: str = "lap_repaired", ts: str = "time_corrected", order: str = "row_id", critical: tuple[str, ...] = ("speed", "aps", "gear")) -> DataFrame:
    """A row for each cycle: times, speeds, shares of throttle and brake, engine, gear changes, distance, missing values.
    Columns that df lacks count as missing everywhere."""
    for c in ("speed", "aps", "pbrake_f", "nmot", "gear", "track_distance_m"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("double"))
    w = in_time([key, lap], ts, order)
    df = df.withColumn("__shift", F.coalesce((F.col("gear") != F.lag("gear").over(w)).cast("long"), F.lit(0)))
    n = F.count(F.lit(1))
    share = lambda c: 100.0 * F.count_if(c) / n
    null = F.lit(False)
    for c in critical:
        null = null | F.col(c).isNull()
    t = micros(F.col(ts))
    return df.groupBy(key, lap).agg(
        F.min(t).alias("lap_start_us"), F.max(t).alias("lap_end_us"), ((F.max(t) - F.min(t)) / 1e6).alias("lap_time"),
        F.avg("speed").alias("avg_speed"), F.max("speed").alias("max_speed"), F.min("speed").alias("min_speed"),
        share(F.col("aps") > 0.1).alias("throttle_pct_time"), share(F.col("aps") > 0.9).alias("full_throttle_pct_time"), share(F.col("pbrake_f") > 0).alias("brake_pct_time"),
        F.avg("nmot").alias("avg_rpm"), F.max("nmot").alias("max_rpm"), F.sum("__shift").alias("gear_changes"),
        (F.max("track_distance_m") - F.min("track_distance_m")).alias("distance_covered"), n.alias("frame_count"), share(null).alias("nan_pct"),
    )


def lap_summary(features: DataFrame, key: str = "chassis_id", lap: str = "lap_repaired") -> DataFrame:
    """A row for each entity; the best cycle is the shortest of more than no time (ties: the first)."""
    real = F.when(F.col("lap_time") > 0, F.col("lap_time"))
    return features.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_laps"), F.sum("distance_covered").alias("total_distance"), F.sum("lap_time").alias("total_time"),
        F.min(real).alias("best_lap_time"), F.min_by(lap, F.when(F.col("lap_time") > 0, F.struct("lap_time", lap))).alias("best_lap_number"),
        F.avg(real).alias("avg_lap_time"), F.avg("avg_speed").alias("avg_speed_overall"), F.stddev_samp(real).alias("lap_time_std"),
        (100.0 * F.count_if(F.col("nan_pct") == 0) / F.count(F.lit(1))).alias("valid_lap_pct"),
    )


def pairings(df: DataFrame, key: str = "chassis_id", other: str = "car_no", ts: str = "timestamp") -> DataFrame:
    return df.groupBy(key, other).agg(F.min(micros(F.col(ts))).alias("first_seen_us"), F.max(micros(F.col(ts))).alias("last_seen_us"), F.count(F.lit(1)).alias("n_rows"))


def profile(df: DataFrame, key: str = "chassis_id", signal: str = "telemetry_name", ts: str = "timestamp") -> DataFrame:
    """key, rows and share of all, span, cycles, range of cycle numbers, rate."""
    total = df.agg(F.count(F.lit(1)).alias("__total")).withColumn("__one", F.lit(1))
    n, span = F.count(F.lit(1)), (F.max(micros(F.col(ts))) - F.min(micros(F.col(ts)))) / 1e6
    per = df.groupBy(key).agg(n.alias("n_rows"), F.countDistinct(signal).alias("signals"), F.countDistinct("lap").alias("laps"), F.min("lap").alias("min_lap"), F.max("lap").alias("max_lap"), span.alias("span_sec"), F.when(span > 0, n / span).otherwise(0.0).alias("hz"))
    return per.withColumn("__one", F.lit(1)).join(F.broadcast(total), "__one").withColumn("share_pct", 100.0 * F.col("n_rows") / F.col("__total")).drop("__one", "__total")


def top_signals(df: DataFrame, k: int, key: str = "chassis_id", signal: str = "telemetry_name") -> DataFrame:
    """key, signal, n, rank: the k signals with most rows; rows are counted before they are ranked."""
    from pyspark.sql import Window

    counts = df.groupBy(key, signal).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), signal)).cast("long")).where(F.col("rank") <= k)
