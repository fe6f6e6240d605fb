"""Clock drift in tumbling windows, its correction, and a global timeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paceline.functions.scalar import drift_quality, drift_valid, micros, seconds_between, shifted, true_or_false

KEY = "chassis_id"


def _center(x: Column, method: str) -> Column:
    if method not in ("median", "mean"):
        raise ValueError(f"unknown method: {method}")
    return F.median(x) if method == "median" else F.avg(x)


def window_start(ts: Column, minutes: int) -> Column:
    """Start of the tumbling window, as microseconds; windows stand from the epoch on."""
    size = minutes * 60_000_000
    return micros(ts) - F.pmod(micros(ts), F.lit(size))


def drift_windows(df: DataFrame, key: str = KEY, minutes: int = 5, method: str = "median", ts: str = "timestamp", meta: str = "meta_time") -> DataFrame:
    """key, window_start_us, drift_sec, drift_std, samples: meta_time minus timestamp in each window; rows without go."""
    rows = df.where(F.col(ts).isNotNull() & F.col(meta).isNotNull()).select(key, window_start(F.col(ts), minutes).alias("window_start_us"), seconds_between(F.col(ts), F.col(meta)).alias("d"))
    return rows.groupBy(key, "window_start_us").agg(_center(F.col("d"), method).alias("drift_sec"), F.stddev_samp("d").alias("drift_std"), F.count("d").alias("samples"))


def calibrated(windows: DataFrame, key: str = KEY, spike_threshold: float = 3.0, minutes: int = 5, method: str = "median") -> DataFrame:
    """drift_windows with window_end_us, step_detected, is_valid, quality, method and the number of the window. The windows
    of an entity are few: a row for each `minutes`."""
    w = Window.partitionBy(key)
    step = true_or_false(F.col("drift_std") > spike_threshold * F.median("drift_std").over(w))
    return windows.withColumns(
        {
            "window_end_us": F.col("window_start_us") + minutes * 60_000_000,
            "step_detected": step,
            "is_valid": drift_valid(F.col("samples"), F.col("drift_std")),
            "quality": drift_quality(F.col("drift_std")),
            "method": F.lit(method),
            "drift_window_id": F.row_number().over(w.orderBy("window_start_us")).cast("long") - 1,
        }
    )


def corrected(df: DataFrame, calibration: DataFrame, key: str = KEY, minutes: int = 5, ts: str = "timestamp") -> DataFrame:
    """df with time_corrected and drift_window_id. A row's window is computed from its time, so the interval join is an
    equi-join; rows outside valid windows keep their time."""
    valid = calibration.where("is_valid").select(key, "window_start_us", "drift_sec", "drift_window_id")
    out = df.withColumn("window_start_us", window_start(F.col(ts), minutes)).join(valid, [key, "window_start_us"], "left")
    return out.withColumn("time_corrected", F.coalesce(shifted(F.col(ts), F.col("drift_sec")), F.col(ts).cast("timestamp"))).drop("window_start_us", "drift_sec")


def overall_drift(calibration: DataFrame, key: str = KEY, method: str = "median") -> DataFrame:
    """key, drift_sec, drift_std (of the population) over valid windows; without any 0 and 0."""
    valid = F.when(F.col("is_valid"), F.col("drift_sec"))
    return calibration.groupBy(key).agg(F.coalesce(_center(valid, method), F.lit(0.0)).alias("drift_sec"), F.coalesce(F.stddev_pop(valid), F.lit(0.0)).alias("drift_std"))


def huber_mean(df: DataFrame, key: str, value: Column, delta: float = 1.5) -> DataFrame:
    """key, huber: one reweighting step about the median, scaled by the median absolute deviation. Medians are aggregates
    that are joined back, so a large entity is not gathered in a window."""
    rows = df.select(key, value.alias("v")).where(F.col("v").isNotNull())
    med = rows.groupBy(key).agg(F.median("v").alias("m"))
    off = rows.join(med, key).withColumn("r", F.abs(F.col("v") - F.col("m")))
    mad = off.groupBy(key).agg((F.median("r") * 1.4826).alias("s"))
    z = F.col("r") / F.col("s")
    weight = F.when((F.col("s") == 0) | (z <= delta), 1.0).otherwise(delta / z)
    return off.join(mad, key).withColumn("w", weight).groupBy(key).agg(F.when(F.max("s") == 0, F.max("m")).otherwise(F.sum(F.col("w") * F.col("v")) / F.sum("w")).alias("huber"))


def drift_methods(df: DataFrame, key: str = KEY, ts: str = "timestamp", meta: str = "meta_time") -> DataFrame:
    d = seconds_between(F.col(ts), F.col(meta))
    plain = df.groupBy(key).agg(F.avg(d).alias("mean"), F.median(d).alias("median"), F.stddev_samp(d).alias("std"), F.count(d).alias("samples"))
    return plain.join(huber_mean(df, key, d), key)


def calibration_report(calibration: DataFrame, key: str = KEY) -> DataFrame:
    return calibration.groupBy(key).agg(
        F.count(F.lit(1)).alias("windows"),
        F.count_if("is_valid").alias("valid"),
        F.count_if("step_detected").alias("steps"),
        F.avg("drift_sec").alias("avg_drift"),
        F.avg("drift_std").alias("avg_std"),
        *[F.count_if(F.col("quality") == q).alias(q.lower()) for q in ("EXCELLENT", "GOOD", "ACCEPTABLE", "POOR", "INVALID")],
    )


def on_global_time(df: DataFrame, reference: str | None = None, key: str = KEY) -> DataFrame:
    """time_global, and session_start: the first corrected time, of the reference entity or of all."""
    of = df if reference is None else df.where(F.col(key) == reference)
    start = of.agg(F.min("time_corrected").alias("session_start")).withColumn("__one", F.lit(1))
    return df.withColumns({"time_global": F.col("time_corrected"), "__one": F.lit(1)}).join(F.broadcast(start), "__one").drop("__one")
