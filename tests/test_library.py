import json
import math
import random
import re
from datetime import datetime, timedelta, timezone

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from paceline.config import CIRCUITS, Policy, Settings, circuit
from paceline.functions import geometry, scalar
from paceline.functions.windows import filled_forward_within, in_time, interpolated, rolling_median
from paceline.operators import anomalies, laps, position, quality, reshape, resample, sync, timesync, trajectories
from paceline.plans import pipeline
from paceline.schema import SIGNALS, require_columns
from paceline.sources import readers, writers
from paceline.streaming import streams

T0 = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_identity_matches_the_beginning(spark):
    df = spark.createDataFrame([("GR86-004-78",), ("GR86-004-78x",), ("x",), (None,)], "vehicle_id string")
    assert [(r.chassis_id, r.car_no) for r in anomalies.with_identity(df).collect()] == [("004", "78"), ("004", "78"), ("UNKNOWN", "UNKNOWN"), ("UNKNOWN", "UNKNOWN")]


def test_scalar_rules(spark):
    lit = lambda x: F.lit(x).cast("double")
    r = one(
        spark, a=scalar.delta_pct(lit(0), lit(0)), b=scalar.delta_pct(lit(0), lit(3)), c=scalar.delta_pct(lit(50), lit(40)), d=scalar.drift_valid(F.lit(11), lit(None)), e=scalar.drift_valid(F.lit(11), lit(29)),
        f=scalar.drift_quality(lit(None)), g=scalar.drift_quality(lit(7)), h=scalar.degrees_from_minutes(lit(-8637.182)), i=scalar.degrees_from_minutes(lit(-8637.182), True), j=scalar.position_quality(lit(100), lit(100), lit(0), lit(0)),
        k=scalar.ribbon_of(F.lit("5")), m=scalar.ribbon_of(F.lit("3")), n=scalar.ribbon_of(F.lit("4")), o=scalar.clock_label(lit(125)), p=scalar.frame_after(F.lit(8), lit(3), lit(2), F.lit(10)), q=scalar.within(lit(float("nan")), 0, 1),
    )
    assert (r.a, r.b, r.c, r.d, r.e, r.f, r.g) == (0, 100, -20, False, True, "INVALID", "ACCEPTABLE")
    assert r.h == pytest.approx(-86.6197) and r.i == pytest.approx(-85.95303, abs=1e-4) and r.j == pytest.approx(0.7)
    assert (r.k, r.m, r.n, r.o, r.p, r.q) == ("right_1", "center", "left_1", "02:05", 4, False)


@pytest.mark.parametrize("seed", range(4))
def test_window_recipes_equal_pandas(spark, seed):
    rng = np.random.default_rng(seed)
    v = np.where(rng.random(60) < 0.5, np.nan, rng.normal(size=60).round(3))
    df = spark.createDataFrame([(0, i, None if math.isnan(x) else float(x)) for i, x in enumerate(v)], "k int, i long, v double")
    w, c = in_time(["k"], "i"), F.col("v")
    got = df.select("i", interpolated(c, F.col("i"), w).alias("a"), interpolated(c, F.col("i"), w, True).alias("b"), filled_forward_within(c, F.col("i"), w, 2).alias("c"), rolling_median(c, w).alias("d")).toPandas().sort_values("i")
    s = pd.Series(v)
    for name, want in (("a", s.interpolate(limit_area="inside")), ("b", s.interpolate(limit_direction="both")), ("c", s.ffill(limit=2)), ("d", s.rolling(5, center=True, min_periods=1).median())):
        assert np.allclose(got[name].astype(float), want, equal_nan=True), name


def test_duplicates_count_members_and_dropped(spark):
    df = spark.createDataFrame([("a", 1, "s", 1, 1.0), ("a", 1, "s", 2, 2.0), ("a", 1, "s", 3, None), ("a", 2, "s", 4, 4.0)], "vehicle_id string, timestamp int, telemetry_name string, row_id long, v double")
    assert tuple(anomalies.duplicate_stats(df).first()) == (4, 3, 2, 2)
    assert sorted(r.row_id for r in anomalies.keep_last(df).collect()) == [3, 4]
    assert tuple(anomalies.duplicate_stats(df.limit(0)).first()) == (0, 0, 0, 0)


def test_boundaries(spark):
    rows = [(0, 1, 100.0), (100, 1, 3500.0), (110, 1, 20.0), (150, 32768, 900.0), (160, 1, 1000.0), (170, 2, 1100.0), (600, 3, None)]
    df = spark.createDataFrame([("c", at(t), lap, d, i) for i, (t, lap, d) in enumerate(rows)], "chassis_id string, time_corrected timestamp, lap int, track_distance_m double, row_id long")
    marked = laps.with_boundaries(df)
    found = [(r.post_lap, r.reason, round(r.confidence, 3), r.is_valid) for r in laps.boundaries(marked).orderBy("boundary_time").collect()]
    assert found == [(1, "lap_increment", 0.9, True), (2, "lap_increment", 0.4, False), (3, "lap_increment", 0.56, True)]
    assert [r.lap_repaired for r in laps.with_laps(marked).orderBy("row_id").collect()] == [1, 1, 1, 1, 1, 2, 3]
    assert [r.lap_repaired for r in laps.with_laps(marked, fill_first=False).orderBy("row_id").collect()][0] is None
    words = [r.reason for r in laps.durations(laps.boundaries(marked), most_sec=300).orderBy("boundary_time").collect()]
    assert words == ["first lap", "valid", "too long: 430.0s"]


def test_drift_is_corrected_in_valid_windows_only(spark):
    rows = [("a", at(i), at(i + 5), i) for i in range(20)] + [("a", at(400 + i), at(400 + i + 9), 100 + i) for i in range(3)]
    df = spark.createDataFrame(rows, "chassis_id string, timestamp timestamp, meta_time timestamp, row_id long")
    cal = timesync.calibrated(timesync.drift_windows(df))
    out = timesync.corrected(df, cal).orderBy("row_id").collect()
    assert out[0].time_corrected == out[0].meta_time and out[-1].time_corrected == out[-1].timestamp
    assert timesync.overall_drift(cal).first().drift_sec == 5 and timesync.on_global_time(df.withColumn("time_corrected", F.col("timestamp"))).select("session_start").distinct().count() == 1
    with pytest.raises(ValueError):
        timesync.drift_windows(df, method="mode")


def test_jumps_in_degrees_and_as_the_source_takes_them(spark):
    df = spark.createDataFrame([("a", at(i), 33.55 + (0.01 if i == 2 else 0), -86.6, float(i), i) for i in range(4)], "chassis_id string, time_corrected timestamp, gps_lat double, gps_lon double, track_distance_m double, row_id long")
    flags = lambda **o: [r.is_outlier for r in position.cleaned(df, circuit("barber"), **o).orderBy("row_id").collect()]
    assert flags() == [False, False, True, True] and not any(flags(strict_parity=True))
    assert position.quality(df, position.cleaned(df, circuit("barber"))).first().rating in ("ACCEPTABLE", "GOOD", "POOR")


def test_grid_and_sync(spark):
    df = spark.createDataFrame([("a", at(0), 1.0), ("a", at(0.1), 3.0), ("b", at(0.26), 5.0), ("b", at(0.3), 6.0)], "k string, t timestamp, speed double")
    out = resample.resampled(df, "k", "t", 20, ["speed"], []).orderBy("k", "tick").collect()
    assert [(r.k, r.tick, r.speed) for r in out] == [("a", 0, 1.0), ("a", 1, 2.0), ("a", 2, 3.0), ("b", 0, 5.0)]
    synced = sync.synchronised(df, "k", "t", 20, ["speed"], limit_sec=0.1)
    got = {(r.k, r.tick): r.speed for r in synced.collect()}
    assert len(got) == 14 and got["a", 4] == 3.0 and got["a", 5] is None and got["b", 5] == 5.0 and got["b", 6] == 6.0
    assert sync.full_windows(synced, "k", "speed", 1).count() == 1
    assert sync.synchronised(df.limit(0), "k", "t", 20, ["speed"]).count() == 0


def test_lines(spark):
    pts = spark.createDataFrame([("l", i, x, y) for i, (x, y) in enumerate([(0.0, 0.0), (3.0, 0.0), (3.0, 0.0), (3.0, 4.0)])], "line string, idx int, x double, y double")
    clean = geometry.without_repeats(pts)
    assert clean.count() == 3 and geometry.with_arc_length(clean).agg(F.max("cum")).first()[0] == 7.0
    rows = spark.createDataFrame([(0, "l", 5.0), (1, "l", -2.0), (2, "l", 7.0)], "row_id long, line string, d double")
    got = {r.row_id: (round(r.x, 6), round(r.y, 6)) for r in geometry.on_line_by_length(rows, clean, F.col("d"), 2.0).collect()}
    assert got == {0: (3, 2), 1: (3, 2), 2: (0, 0)}
    assert [round(r.x + r.y, 6) for r in geometry.resampled_line(clean, 8).orderBy("idx").collect()] == [0, 1, 2, 3, 4, 5, 6, 7]
    square = spark.createDataFrame([("s", i, float(x), float(y)) for i, (x, y) in enumerate([(0, 0), (2, 0), (2, 2), (0, 2)])], "line string, idx int, x double, y double")
    assert geometry.signed_area(square).first().area == 4 and geometry.signed_area(geometry.reversed_line(square)).first().direction == "clockwise"
    assert geometry.with_arc_length(geometry.scaled_to_length(square, 12)).agg(F.max("cum")).first()[0] == pytest.approx(12)
    assert geometry.offset_line(square.limit(2), 1.0, "left").orderBy("idx").first().y == 1.0
    box = geometry.bounding_box(square).first()
    assert (box.min_x, box.max_y) == (0, 2)


def test_pixels_go_there_and_back(spark):
    lit = F.lit
    scale = scalar.pixel_scale(lit(2.0), lit(4.0), 100, 100)
    x = scalar.to_pixels(lit(1.5), lit(0.0), lit(2.0), 100, scale, True)
    r = one(spark, x=x, back=scalar.from_pixels(x, lit(0.0), lit(2.0), 100, scale, True))
    assert r.x == pytest.approx(38.75) and r.back == pytest.approx(1.5)


def test_expectations_and_strict_baseline(spark):
    df = spark.createDataFrame([("a", "speed", 1.0, at(0)), ("a", "speed", None, at(1)), ("a", "aps", -3.0, at(1))], "chassis_id string, telemetry_name string, telemetry_value double, timestamp timestamp")
    by = {r.expectation: r.passed for r in quality.report(df, quality.refined_suite()).collect()}
    assert by["least speed"] and not by["time_corrected exists"] and not by["time_corrected not null"]
    assert not {r.expectation: r.passed for r in quality.report(df, quality.refined_suite(True)).collect()}["least speed"]
    base = quality.signal_baseline(df)
    assert quality.require(quality.against_baseline(base, base)).count() == 8
    with pytest.raises(quality.ValidationError):
        quality.require(quality.against_baseline(base, quality.signal_baseline(df.where("telemetry_value IS NULL OR telemetry_name = 'aps'"))))
    with pytest.raises(ValueError):
        quality.suite("unknown", df)
    assert quality.report(df, quality.simulation_suite(Policy())).count() == 16
    assert [r.status for r in quality.range_checks(df, Policy()).orderBy("telemetry_name").collect()] == ["FAIL", "PASS"]


def raw_rows():
    rows, rng = [], np.random.default_rng(5)
    for car in ("004", "010"):
        for i in range(240):
            t = i * 0.05
            values = {"speed": 30 + t, "aps": 50.0, "gear": 3.0, "VBOX_Lat_Min": 33.55 + t / 1e5, "VBOX_Long_Minutes": -86.6, "Laptrigger_lapdist_dls": (3600 + 30 * t) % 3700}
            rows += [(at(t), at(t + 2), f"GR86-{car}-7", 1 + (t > 3.4), s, float(x)) for s, x in values.items() if rng.random() < 0.9]
    rows += rows[:50]
    return [(*r, k) for k, r in enumerate(rows)]


def test_pipeline(spark, tmp_path):
    raw = spark.createDataFrame(raw_rows(), "timestamp timestamp, meta_time timestamp, vehicle_id string, lap int, telemetry_name string, telemetry_value double, row_id long")
    layers = pipeline.run(raw, Settings(drift_window_minutes=1440), str(tmp_path))
    frames = layers.synchronised.toPandas()
    assert set(frames.chassis_id) == {"004", "010"} and frames.groupby("chassis_id").size().nunique() == 1
    assert frames.speed_final.notna().mean() > 0.95 and frames.aps.dropna().between(0, 1).all()
    assert layers.clean.count() == raw.count() - 50 and layers.timed.select("time_corrected").first()[0] is not None
    line = spark.createDataFrame([("center", i, float(i), 0.0) for i in range(11)], "line string, idx int, x double, y double")
    paths = trajectories.trajectories(layers.synchronised, line, 3700.0).collect()
    assert len(paths) == 2 and all(len(p.path) == p.n_frames for p in paths)


def test_sources_and_sinks(spark, tmp_path):
    raw = spark.createDataFrame(raw_rows()[:400], "timestamp timestamp, meta_time timestamp, vehicle_id string, lap int, telemetry_name string, telemetry_value double, row_id long")
    csv = str(tmp_path / "csv")
    raw.drop("row_id").write.option("header", True).csv(csv)
    back = readers.read_csv(spark, csv)
    assert back.count() == 400 and dict(back.dtypes)["telemetry_value"] == "double"
    with pytest.raises(ValueError):
        require_columns(raw.drop("lap"))
    curated = str(tmp_path / "curated")
    for _ in range(2):
        writers.write_curated(anomalies.with_identity(back), curated, "r1")
    read = readers.read_curated(spark, curated, "r1", ["004"], ["speed"])
    assert read.count() > 0 and set(r.chassis_id for r in read.select("chassis_id").distinct().collect()) == {"004"}
    assert readers.read_curated(spark, curated).count() == 800
    assert {"time_corrected", "lap_repaired", "segment_id"} <= set(readers.read_refined(spark, curated).columns)
    assert set(SIGNALS) <= set(readers.read_wide(spark, curated).columns)
    assert reshape.signal_names(read) == ["speed"]
    plan = read._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull" in plan
    found = readers.files(spark, curated, "*.parquet", 3).collect()
    assert found and all(len(r.sha256) == 64 for r in found)
    assert not writers.write_table(read.limit(0), str(tmp_path / "none"), skip_empty=True) and writers.write_table(read, str(tmp_path / "some"))
    doc = tmp_path / "base.json"
    doc.write_text(json.dumps({"cars": {"004": {"time_span_sec": 9.0, "signals": {"speed": {"sample_count": 3, "coverage_pct": 100.0, "time_span_sec": 9.0, "hz_avg": 0.3}}}}}))
    assert readers.read_baseline(spark, str(doc)).first().hz_avg == 0.3 and readers.read_document(spark, str(doc))["cars"]
    lines = tmp_path / "lines.json"
    lines.write_text(json.dumps({"ribbons": {"center": [[0, 0], [1, 2]]}}))
    assert [(r.idx, r.y) for r in readers.read_lines(spark, str(lines)).orderBy("idx").collect()] == [(0, 0.0), (1, 2.0)]
    with pytest.raises(ValueError):
        readers.read_entities(spark, str(tmp_path / "some"), ["999"])
    with pytest.raises(ValueError):
        circuit("nowhere")
    assert CIRCUITS["barber"].track_length_m == 3700 and readers.position_columns(["VBOX_x", "speed", "Latitude"]) == ["VBOX_x", "Latitude"]


def test_streams_equal_batches(spark, tmp_path):
    rows = [("a", at(i * 30), at(i * 30 + 4), i) for i in range(40)] + [("b", at(5), at(6), 40), ("b", at(4000), at(4001), 41), ("b", at(3990), at(4001), 42)]
    df = spark.createDataFrame(rows, "chassis_id string, timestamp timestamp, meta_time timestamp, row_id long")
    source = str(tmp_path / "in")
    df.coalesce(1).sortWithinPartitions("row_id").write.parquet(source)
    stream = lambda: streams.with_event_time(spark.readStream.schema(df.schema).parquet(source), late="1 second")

    def collected(out, name, mode="append"):
        q = out.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).start()
        q.processAllAvailable()
        q.stop()
        return spark.table(name).collect()

    got = {(r.chassis_id, r.window_start): (r.drift_sec, r.samples) for r in collected(streams.drift_stream(stream()), "drift")}
    want = {(r.chassis_id, datetime.fromtimestamp(r.window_start_us / 1e6)): (r.drift_sec, r.samples) for r in timesync.drift_windows(df).collect()}
    assert got and all(want[k] == v for k, v in got.items())
    assert {r.n_rows for r in collected(streams.sessions(stream(), gap="1 minute"), "sessions")} >= {40, 1}
    assert sum(r.n for r in collected(streams.sliding(stream().withColumn("v", F.lit(1.0)), "chassis_id", "v", "10 minutes", "5 minutes"), "sliding", "complete")) == 86
    back = {r.chassis_id: (r.n, r.backwards) for r in collected(streams.backwards_stream(spark.readStream.schema(df.schema).parquet(source)), "backwards")}
    assert back == {"a": (40, 0), "b": (3, 1)}
    assert len(collected(streams.deduplicated(stream(), ["chassis_id", "timestamp"]), "dedup")) == 43
    raw = spark.createDataFrame(raw_rows()[:60], "timestamp timestamp, meta_time timestamp, vehicle_id string, lap int, telemetry_name string, telemetry_value double, row_id long")
    raw.write.parquet(str(tmp_path / "raw"))
    q = streams.ingest(spark.readStream.schema(raw.schema).parquet(str(tmp_path / "raw")), str(tmp_path / "curated"), "r1", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    assert readers.read_curated(spark, str(tmp_path / "curated"), "r1").count() == 60


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_blocks_of_one_entity(spark):
    """Block by block gives what one window over the entity gives, whatever the blocks, with nulls, ties and empty blocks."""
    from paceline.functions import blocks
    from paceline.functions.windows import between, in_time, interpolated, up_to_here

    rng = random.Random(4)
    seconds = sorted(rng.choice([rng.randint(0, 500), rng.randint(9000, 9500)]) for _ in range(400))
    rows = [(None if i % 5 == 4 else "e", i, t, rng.choice([None, None, rng.random()])) for i, t in enumerate(seconds)]
    df = spark.createDataFrame(rows, "k string, row_id long, sec long, x double").withColumn("ts", F.timestamp_seconds("sec"))
    one = in_time(["k"], "ts", "row_id")
    want = df.withColumns({"is_gap": F.coalesce(F.col("sec") - F.lag("sec").over(one) > 7, F.lit(False)), "x2": interpolated(F.col("x"), F.col("sec"), one), "before": F.lag("x").over(one)})
    want = want.withColumn("segment_id", F.sum(F.col("is_gap").cast("long")).over(up_to_here(one)))
    for size in (3, 40, 10**6):
        got = anomalies.with_gap_segments(df, "k", "ts", 7, block_sec=size)
        got = got.withColumn("p", F.when(F.col("x").isNotNull(), F.struct(F.col("sec").alias("i"), F.col("x").alias("v"))))
        w = blocks.window("k", "ts", "row_id")
        got = blocks.bridged(got, "k", ["ts", "row_id"], blocks.time_block(F.col("ts"), size), last=("x",), known=("p",))
        got = blocks.rows_only(got.withColumns({"before": F.lag("x").over(w), "x2": between(F.col("x"), F.col("sec"), F.col("p"), w)}))
        columns = ["row_id", "is_gap", "segment_id", "before", "x2"]
        assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"hashpartitioning\(k#\d+, __block", plan) and not re.search(r"specifiedwindowframe[^\n]*\], \[k#\d+\], \[ts", plan)
    empty = anomalies.with_gap_segments(df.limit(0), "k", "ts", 7)
    assert empty.count() == 0
