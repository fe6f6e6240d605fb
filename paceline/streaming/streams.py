"""The same operators over streams: watermarks bound what is held, windows are those of the batch operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.functions.scalar import seconds_between
from paceline.operators.anomalies import with_identity
from paceline.sources.writers import write_curated


def with_event_time(df: DataFrame, ts: str = "timestamp", late: str = "10 minutes") -> DataFrame:
    """Event time must be a timestamp with a zone."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)


def deduplicated(df: DataFrame, keys: list[str]) -> DataFrame:
    """The first of rows with equal keys within the watermark (batches keep the last; a stream can't wait for it)."""
    return df.dropDuplicatesWithinWatermark(keys)


def drift_stream(df: DataFrame, key: str = "chassis_id", window: str = "5 minutes", ts: str = "timestamp", meta: str = "meta_time") -> DataFrame:
    """Drift of each entity in tumbling windows, each given out when the watermark has passed it."""
    d = seconds_between(F.col(ts), F.col(meta))
    return df.groupBy(key, F.window(ts, window).alias("w")).agg(F.median(d).alias("drift_sec"), F.stddev_samp(d).alias("drift_std"), F.count(d).alias("samples")).select(key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "drift_sec", "drift_std", "samples")


def sessions(df: DataFrame, key: str = "chassis_id", gap: str = "2 seconds", ts: str = "timestamp") -> DataFrame:
    """Segments of readings without a longer gap."""
    return df.groupBy(key, F.session_window(ts, gap).alias("w")).agg(F.count(F.lit(1)).alias("n_rows")).select(key, F.col("w.start").alias("start_time"), F.col("w.end").alias("end_time"), "n_rows")


def sliding(df: DataFrame, key: str, value: str, window: str, slide: str, ts: str = "timestamp") -> DataFrame:
    return df.groupBy(key, F.window(ts, window, slide).alias("w")).agg(F.avg(value).alias("mean"), F.count(value).alias("n")).select(key, F.col("w.start").alias("window_start"), "mean", "n")


def backwards_stream(df: DataFrame, key: str = "chassis_id", ts: str = "timestamp", tolerance_sec: float = 0.001) -> DataFrame:
    """key, n, backwards for each entity and batch: readings, and how many went back in order of arrival. The state is the
    last time that was seen."""

    def step(k: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        n = back = 0
        for pdf in batches:
            t = pdf["__us"].sort_index().to_numpy()
            if not len(t):
                continue
            before = [last if last is not None else t[0], *t[:-1]]
            back += int(((t - before) < -tolerance_sec * 1e6).sum())
            n, last = n + len(t), int(t[-1])
        if last is not None:
            state.update((last,))
        yield pd.DataFrame({key: [k[0]], "n": [n], "backwards": [back]})

    rows = df.withColumn("__us", F.unix_micros(F.col(ts).cast("timestamp"))).select(key, "__us")
    return rows.groupBy(key).applyInPandasWithState(step, f"{key} string, n long, backwards long", "last long", "append", "NoTimeout")


def ingest(df: DataFrame, path: str, event: str, checkpoint: str, after: Callable[[DataFrame, int], None] | None = None):
    """A query that appends each batch of raw readings to the curated layer; `after` sees each batch, too."""

    def write(batch: DataFrame, n: int) -> None:
        batch = with_identity(batch).persist()
        write_curated(batch, path, event)
        if after:
            after(batch, n)
        batch.unpersist()

    return df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
