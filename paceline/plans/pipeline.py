"""From raw readings to synchronised frames: one lazy plan over all entities."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline.config import Settings
from paceline.functions.scalar import normalise
from paceline.operators import anomalies, laps, position, resample, reshape, sync, timesync
from paceline.schema import DISCRETE, SIGNALS


@dataclass
class Layers:
    clean: DataFrame
    calibration: DataFrame
    timed: DataFrame
    wide: DataFrame
    resampled: DataFrame
    synchronised: DataFrame


def run(raw: DataFrame, settings: Settings = Settings(), cut: str | None = None) -> Layers:
    """raw has row_id, the order of arrival. cut: a folder where the wide and the resampled layers are written and read
    again, so that what follows does not repeat what came before."""
    spark = raw.sparkSession
    clean = normalise(anomalies.with_identity(anomalies.keep_last(raw)))
    minutes = settings.drift_window_minutes
    calibration = timesync.calibrated(timesync.drift_windows(clean, minutes=minutes), spike_threshold=settings.spike_threshold, minutes=minutes)
    timed = timesync.corrected(clean, calibration, minutes=minutes)
    index = ["chassis_id", "car_no", "time_corrected"]
    # One key column of the pivot is the time; cycles are repaired on the wide rows, which hold distance and counter together.
    wide = reshape.pivoted(timed, index, SIGNALS)
    counter = timed.groupBy(*index).agg(F.min("lap").alias("lap"), F.min("row_id").alias("row_id"))
    wide = reshape.with_units(wide.join(counter, index))
    circuit = settings.circuit
    marked = laps.with_boundaries(wide, track_length_m=circuit.track_length_m)
    wide = laps.with_laps(marked).drop("lap_fixed", "pre_lap", "by_reset", "by_increment", "is_boundary")
    wide = position.cleaned(wide, circuit, max_jump_m=settings.policy.gps_jump_m).drop("lat_ok", "lon_ok", "is_outlier")
    wide = _cut(spark, wide, cut, "wide")
    discrete = [c for c in DISCRETE if c in wide.columns and c != "chassis_id"]
    numeric = [c for c, t in wide.dtypes if t == "double" and c not in discrete]
    on = resample.resampled(wide.drop("row_id", "lap"), "chassis_id", "time_corrected", settings.freq_hz, numeric, discrete, max_gap_ticks=int(settings.gap_sec * settings.freq_hz))
    on = _cut(spark, resample.with_derived_speed(on, "chassis_id", settings.freq_hz, track_length_m=circuit.track_length_m), cut, "resampled")
    frames = on.withColumn("time_global", F.timestamp_micros("t_us")).drop("tick", "t_us")
    columns = [c for c in frames.columns if c not in ("chassis_id", "time_global")]
    synced = sync.synchronised(frames, "chassis_id", "time_global", settings.freq_hz, columns, settings.ffill_limit_sec)
    return Layers(clean, calibration, timed, wide, on, synced)


def _cut(spark: SparkSession, df: DataFrame, folder: str | None, name: str) -> DataFrame:
    if folder is None:
        return df
    df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return spark.read.parquet(f"{folder}/{name}")
