"""The catalogue of registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paceline.config import Circuit, Policy
from paceline.functions import geometry
from paceline.functions.scalar import clock_label, degrees_from_minutes, delta_pct, frame_after, from_pixels, local_xy, micros, normalise, pixel_scale, ribbon_of, seconds_between, shifted, to_pixels
from paceline.functions.windows import filled_forward, filled_forward_within, in_time, interpolated, is_gap, rolling_median, segment
from paceline.operators import anomalies, features, laps, position, quality, resample, reshape, sync, timesync, trajectories
from paceline.plans.views import DAY_MIN, GRID_HZ, L, R, W, G, line, readings, wide

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}
SIGNALS = ("click", "error", "purchase", "signup", "view")


#: Doubles are rounded to six places a hair away from zero, in Spark and in SQL, so that halves fall alike in both.
HAIR = 1.00000000001


def nudged(sql: str) -> str:
    """sql with round(x, 6) as round((x) * HAIR, 6)."""
    out, opened = [], []
    at = 0
    while at < len(sql):
        if sql.startswith("round(", at):
            opened.append((len(out) + 1, 0))
            out.append("round(")
            at += 6
            continue
        c = sql[at]
        if opened and c in "()":
            start, depth = opened[-1]
            if c == ")" and depth == 0:
                opened.pop()
                body = "".join(out[start:])
                if body.endswith(", 6"):
                    out[start:] = [f"({body[:-3]}) * {HAIR}, 6"]
            else:
                opened[-1] = (start, depth + (1 if c == "(" else -1))
        out.append(c)
        at += 1
    return "".join(out)


def rounded(c):
    return F.round(c * HAIR, 6)


def query(sql: str | None = None):
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = nudged(sql)
        return f

    return add


def tidy(df: DataFrame) -> DataFrame:
    """Doubles to six places, whole numbers as long, times as microseconds."""
    out = []
    for f in df.schema.fields:
        t, c = f.dataType.simpleString(), F.col(f"`{f.name}`")
        out.append((rounded(c) if t == "double" else c.cast("long") if t in ("int", "smallint", "tinyint") else micros(c) if t.startswith("timestamp") else c).alias(f.name))
    return df.select(*out)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Anomalies


@query(
    f"""WITH {R}, d AS (SELECT *, us - lag(us) OVER (PARTITION BY user_id ORDER BY us, row_id) AS gap FROM r),
s AS (SELECT *, sum(CASE WHEN gap > 43200000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY us, row_id ROWS UNBOUNDED PRECEDING) AS segment_id FROM d)
SELECT user_id, CAST(segment_id AS BIGINT) AS segment_id, count(*) AS n_rows, min(us) AS start_us, max(us) AS end_us, round(sum(value), 6) AS total FROM s GROUP BY 1, 2"""
)
def gap_segments(spark, sf_dir):
    s = anomalies.with_gap_segments(readings(spark, sf_dir), "user_id", "timestamp", 43_200, block_sec=30 * 86_400)
    t = micros(F.col("timestamp"))
    return tidy(s.groupBy("user_id", "segment_id").agg(F.count(F.lit(1)).alias("n_rows"), F.min(t).alias("start_us"), F.max(t).alias("end_us"), F.sum("telemetry_value").alias("total")))


@query(
    f"""WITH {R}, d AS (SELECT user_id, lag(us) OVER w AS start_time, (us - lag(us) OVER w) / 1e6 AS gap_sec FROM r WINDOW w AS (PARTITION BY user_id ORDER BY us, row_id))
SELECT user_id, start_time, round(gap_sec, 6) AS gap_sec FROM d WHERE gap_sec > 43200"""
)
def gap_events(spark, sf_dir):
    return tidy(anomalies.gaps(readings(spark, sf_dir), "user_id", threshold_sec=43_200, block_sec=30 * 86_400))


@query(
    f"""WITH {R}, d AS (SELECT user_id, us AS start_time, (us - lag(us) OVER w) / 1e6 AS gap_sec FROM r WINDOW w AS (PARTITION BY user_id ORDER BY us, row_id))
SELECT user_id, start_time, round(gap_sec, 6) AS gap_sec FROM d WHERE gap_sec > 43200"""
)
def gap_events_parity(spark, sf_dir):
    return tidy(anomalies.gaps(readings(spark, sf_dir), "user_id", threshold_sec=43_200, strict_parity=True))


_ARRIVAL = "(row_id * 7919) % 100003 * 10000000 + row_id"


@query(
    f"""WITH {R}, d AS (SELECT vehicle_id, (us - lag(us) OVER (PARTITION BY vehicle_id ORDER BY {_ARRIVAL})) / 1e6 AS dt FROM r)
SELECT vehicle_id, count(*) AS backwards FROM d WHERE dt < -0.001 GROUP BY 1"""
)
def backwards_count(spark, sf_dir):
    return tidy(anomalies.backwards_counts(readings(spark, sf_dir).withColumn("row_id", F.expr(_ARRIVAL)), block_rows=10**11))


@query(
    f"""WITH {R}, d AS (SELECT *, row_number() OVER (PARTITION BY user_id, name, us // 86400000000 ORDER BY row_id DESC) AS k FROM r)
SELECT user_id, name AS telemetry_name, us // 86400000000 AS day, row_id, us, value FROM d WHERE k = 1"""
)
def dedup_keep_last(spark, sf_dir):
    r = readings(spark, sf_dir).withColumns({"us": micros(F.col("timestamp")), "day": F.expr("unix_micros(timestamp) div 86400000000")})
    kept = anomalies.keep_last(r.select("user_id", "telemetry_name", "day", "row_id", "us", F.col("telemetry_value").alias("value")), ["user_id", "telemetry_name", "day"])
    return kept


@query(
    f"""WITH {R}, d AS (SELECT count(*) AS n FROM r GROUP BY user_id, name, us // 86400000000)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS duplicate_members, CAST(sum(n - 1) AS BIGINT) AS rows_dropped, count(*) AS rows_kept FROM d"""
)
def duplicate_stats(spark, sf_dir):
    r = readings(spark, sf_dir).withColumn("day", F.expr("unix_micros(timestamp) div 86400000000"))
    return anomalies.duplicate_stats(r, ["user_id", "telemetry_name", "day"])


@query(
    f"""WITH {R}, d AS (SELECT row_id, CASE WHEN row_id % 7 = 0 THEN 'x-' || vehicle_id ELSE vehicle_id END AS v FROM r)
SELECT row_id, coalesce(nullif(regexp_extract(v, '^GR86-(\\d+)-(\\d+)', 1), ''), 'UNKNOWN') AS chassis_id, coalesce(nullif(regexp_extract(v, '^GR86-(\\d+)-(\\d+)', 2), ''), 'UNKNOWN') AS car_no FROM d"""
)
def vehicle_identity(spark, sf_dir):
    r = readings(spark, sf_dir).select("row_id", F.when(F.col("row_id") % 7 == 0, F.concat(F.lit("x-"), "vehicle_id")).otherwise(F.col("vehicle_id")).alias("vehicle_id"))
    return anomalies.with_identity(r).select("row_id", "chassis_id", "car_no")


@query(f"WITH {R} SELECT count(*) AS n_rows, count(DISTINCT vehicle_id) AS vehicles, count(DISTINCT name) AS signals, min(us) AS start_time, max(us) AS end_time FROM r")
def ingest_stats(spark, sf_dir):
    return tidy(anomalies.ingest_stats(readings(spark, sf_dir)))


@query(
    f"""WITH {R}, a AS (SELECT *, us - lag(us) OVER (PARTITION BY vehicle_id ORDER BY {_ARRIVAL}) AS back, {_ARRIVAL} AS arrived FROM r),
g AS (SELECT *, us - lag(us) OVER (PARTITION BY vehicle_id ORDER BY us, arrived) AS gap FROM a)
SELECT row_id, coalesce(gap > 172800000000, false) AS is_gap, coalesce(back < -1000, false) AS is_backwards,
CAST(sum(CASE WHEN gap > 172800000000 OR back < -1000 THEN 1 ELSE 0 END) OVER (PARTITION BY vehicle_id ORDER BY us, arrived ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment_id FROM g"""
)
def gap_backwards_segments(spark, sf_dir):
    r = readings(spark, sf_dir).withColumns({"row": F.col("row_id"), "row_id": F.expr(_ARRIVAL)})
    return anomalies.with_segments(r, threshold_sec=172_800).select(F.col("row").alias("row_id"), "is_gap", "is_backwards", "segment_id")


# Time


def _calibration(spark, sf_dir):
    return timesync.calibrated(timesync.drift_windows(readings(spark, sf_dir), minutes=DAY_MIN), spike_threshold=1.5, minutes=DAY_MIN)


_D = f"""{R}, dw AS (SELECT chassis_id, us // 86400000000 * 86400000000 AS window_start_us, median((meta_us - us) / 1e6) AS drift_sec, stddev_samp((meta_us - us) / 1e6) AS drift_std, count(*) AS samples FROM r GROUP BY 1, 2),
cal AS (SELECT *, window_start_us + 86400000000 AS window_end_us,
  coalesce(drift_std > 1.5 * median(drift_std) OVER (PARTITION BY chassis_id), false) AS step_detected, coalesce(samples > 10 AND drift_std < 30, false) AS is_valid,
  CASE WHEN drift_std < 1 THEN 'EXCELLENT' WHEN drift_std < 5 THEN 'GOOD' WHEN drift_std < 10 THEN 'ACCEPTABLE' WHEN drift_std < 30 THEN 'POOR' ELSE 'INVALID' END AS quality,
  row_number() OVER (PARTITION BY chassis_id ORDER BY window_start_us) - 1 AS drift_window_id FROM dw)"""


@query(f"WITH {_D} SELECT chassis_id, window_start_us, round(drift_sec, 6) AS drift_sec, round(drift_std, 6) AS drift_std, samples FROM dw")
def drift_windows(spark, sf_dir):
    return tidy(timesync.drift_windows(readings(spark, sf_dir), minutes=DAY_MIN))


@query(f"WITH {_D} SELECT chassis_id, window_start_us, round(avg((meta_us - us) / 1e6), 6) AS drift_sec FROM (SELECT *, us // 86400000000 * 86400000000 AS window_start_us FROM r) GROUP BY 1, 2")
def drift_windows_mean(spark, sf_dir):
    return tidy(timesync.drift_windows(readings(spark, sf_dir), minutes=DAY_MIN, method="mean").select("chassis_id", "window_start_us", "drift_sec"))


@query(f"WITH {_D} SELECT chassis_id, window_start_us, window_end_us, step_detected, drift_window_id FROM cal")
def clock_steps(spark, sf_dir):
    return _calibration(spark, sf_dir).select("chassis_id", "window_start_us", "window_end_us", "step_detected", "drift_window_id")


@query(f"WITH {_D} SELECT chassis_id, window_start_us, is_valid, quality FROM cal")
def drift_quality(spark, sf_dir):
    return _calibration(spark, sf_dir).select("chassis_id", "window_start_us", "is_valid", "quality")


@query(
    f"""WITH {_D} SELECT r.row_id, r.us + coalesce(CAST(round(c.drift_sec * 1e6) AS BIGINT), 0) AS time_us, coalesce(c.drift_window_id, -1) AS drift_window_id FROM r
LEFT JOIN (SELECT * FROM cal WHERE is_valid) c ON r.chassis_id = c.chassis_id AND r.us >= c.window_start_us AND r.us < c.window_end_us"""
)
def drift_corrected(spark, sf_dir):
    out = timesync.corrected(readings(spark, sf_dir), _calibration(spark, sf_dir), minutes=DAY_MIN)
    return tidy(out.select("row_id", F.col("time_corrected").alias("time_us"), F.coalesce("drift_window_id", F.lit(-1)).alias("drift_window_id")))


@query(f"WITH {_D} SELECT chassis_id, round(coalesce(median(drift_sec) FILTER (is_valid), 0), 6) AS drift_sec, round(coalesce(stddev_pop(drift_sec) FILTER (is_valid), 0), 6) AS drift_std FROM cal GROUP BY 1")
def overall_drift(spark, sf_dir):
    return tidy(timesync.overall_drift(_calibration(spark, sf_dir)))


_H = f"""{R}, v AS (SELECT chassis_id, (meta_us - us) / 1e6 AS v FROM r), m AS (SELECT chassis_id, median(v) AS m FROM v GROUP BY 1),
o AS (SELECT v.chassis_id, v, m, abs(v - m) AS r FROM v JOIN m USING (chassis_id)), s AS (SELECT chassis_id, median(r) * 1.4826 AS s FROM o GROUP BY 1),
h AS (SELECT chassis_id, CASE WHEN max(s) = 0 THEN max(m) ELSE sum(CASE WHEN s = 0 OR r / s <= 1.5 THEN 1 ELSE 1.5 / (r / s) END * v) / sum(CASE WHEN s = 0 OR r / s <= 1.5 THEN 1 ELSE 1.5 / (r / s) END) END AS huber FROM o JOIN s USING (chassis_id) GROUP BY 1)"""


@query(f"WITH {_H} SELECT chassis_id, round(huber, 6) AS huber FROM h")
def huber_mean(spark, sf_dir):
    return tidy(timesync.huber_mean(readings(spark, sf_dir), "chassis_id", seconds_between(F.col("timestamp"), F.col("meta_time"))))


@query(f"WITH {_H} SELECT chassis_id, round(avg(v), 6) AS mean, round(median(v), 6) AS median, round(stddev_samp(v), 6) AS std, count(v) AS samples, round(max(huber), 6) AS huber FROM v JOIN h USING (chassis_id) GROUP BY 1")
def drift_methods(spark, sf_dir):
    return tidy(timesync.drift_methods(readings(spark, sf_dir)))


@query(
    f"""WITH {_D} SELECT chassis_id, count(*) AS windows, count(*) FILTER (is_valid) AS valid, count(*) FILTER (step_detected) AS steps, round(avg(drift_sec), 6) AS avg_drift, round(avg(drift_std), 6) AS avg_std,
count(*) FILTER (quality = 'EXCELLENT') AS excellent, count(*) FILTER (quality = 'GOOD') AS good, count(*) FILTER (quality = 'ACCEPTABLE') AS acceptable, count(*) FILTER (quality = 'POOR') AS poor, count(*) FILTER (quality = 'INVALID') AS invalid FROM cal GROUP BY 1"""
)
def calibration_report(spark, sf_dir):
    return tidy(timesync.calibration_report(_calibration(spark, sf_dir)))


@query(f"WITH {R} SELECT row_id, us AS time_global, (SELECT min(us) FROM r WHERE chassis_id = '000003') AS session_start FROM r")
def global_time(spark, sf_dir):
    out = timesync.on_global_time(readings(spark, sf_dir).withColumn("time_corrected", F.col("timestamp")), "000003")
    return tidy(out.select("row_id", "time_global", "session_start"))


@query(f"WITH {R} SELECT row_id, us + CAST(round(value * 1e6) AS BIGINT) AS shifted FROM r")
def apply_drift(spark, sf_dir):
    return tidy(readings(spark, sf_dir).select("row_id", shifted(F.col("timestamp"), F.col("telemetry_value")).alias("shifted")))


# Cycles

_B = f"""{W}, f AS (SELECT *, CASE WHEN lap <> 32768 THEN lap END AS lap_fixed FROM w),
p AS (SELECT *, lag(lap_fixed) OVER o AS pre_lap, lag(track_distance_m) OVER o AS before FROM f WINDOW o AS (PARTITION BY chassis_id ORDER BY t_us, row_id)),
q AS (SELECT *, coalesce(track_distance_m - before < -100 AND before > 2960, false) AS by_reset, coalesce(lap_fixed - pre_lap > 0, false) AS by_increment FROM p),
z AS (SELECT *, row_number() OVER o AS n, (t_us - lag(t_us) OVER o) / 1e6 AS duration_sec FROM q WHERE by_reset OR by_increment WINDOW o AS (PARTITION BY chassis_id ORDER BY t_us, row_id)),
bd AS (SELECT chassis_id, t_us AS boundary_time, CAST(pre_lap AS BIGINT) AS pre_lap, CAST(coalesce(lap_fixed, n) AS BIGINT) AS post_lap,
  CASE WHEN n = 1 THEN 'lap_increment' WHEN by_reset THEN 'lapdist_reset' ELSE 'lap_increment' END AS reason,
  CASE WHEN n = 1 THEN 0.9 WHEN by_reset THEN 1.0 ELSE 0.8 END * CASE WHEN n = 1 THEN 1.0 WHEN duration_sec < 28800 THEN 0.5 WHEN duration_sec > 129600 THEN 0.7 ELSE 1.0 END AS confidence,
  duration_sec, coalesce(duration_sec >= 28800, true) AS is_valid FROM z)"""


def _marked(spark, sf_dir):
    return laps.with_boundaries(wide(spark, sf_dir))


def _boundaries(spark, sf_dir):
    return laps.boundaries(_marked(spark, sf_dir), least_sec=28_800, most_sec=129_600)


@query(f"WITH {_B} SELECT chassis_id, boundary_time, coalesce(pre_lap, -1) AS pre_lap, post_lap, reason, round(CAST(confidence AS DOUBLE), 6) AS confidence, round(duration_sec, 6) AS duration_sec, is_valid FROM bd")
def lap_boundaries(spark, sf_dir):
    return tidy(_boundaries(spark, sf_dir).withColumn("pre_lap", F.coalesce("pre_lap", F.lit(-1))))


@query(
    f"""WITH {_B}, a AS (SELECT w.chassis_id, w.t_us, max(boundary_time) AS bt FROM w LEFT JOIN bd ON bd.chassis_id = w.chassis_id AND boundary_time <= t_us GROUP BY 1, 2)
SELECT a.chassis_id, a.t_us, coalesce(bd.post_lap, 1) AS lap_repaired FROM a LEFT JOIN bd ON bd.chassis_id = a.chassis_id AND bd.boundary_time = a.bt"""
)
def lap_assignment(spark, sf_dir):
    return laps.with_laps(_marked(spark, sf_dir)).select("chassis_id", "t_us", "lap_repaired")


@query(
    f"""WITH {_B}, d AS (SELECT chassis_id, post_lap, boundary_time, (boundary_time - lag(boundary_time) OVER (PARTITION BY chassis_id ORDER BY boundary_time, post_lap)) / 1e6 AS duration_sec FROM bd)
SELECT chassis_id, post_lap, boundary_time, round(duration_sec, 6) AS duration_sec, coalesce(duration_sec BETWEEN 28800 AND 129600, true) AS ok,
CASE WHEN duration_sec IS NULL THEN 'first lap' WHEN duration_sec < 28800 THEN printf('too short: %.1fs', duration_sec) WHEN duration_sec > 129600 THEN printf('too long: %.1fs', duration_sec) ELSE 'valid' END AS reason FROM d"""
)
def lap_durations(spark, sf_dir):
    return tidy(laps.durations(_boundaries(spark, sf_dir), least_sec=28_800, most_sec=129_600))


@query(
    f"""WITH {_B} SELECT chassis_id, count(*) AS n_boundaries, count(*) FILTER (reason = 'lapdist_reset') AS n_resets, count(*) FILTER (reason = 'lap_increment') AS n_increments,
round(avg(confidence), 6) AS avg_confidence, round(avg(duration_sec), 6) AS avg_duration, round(min(duration_sec), 6) AS min_duration, round(max(duration_sec), 6) AS max_duration,
count(*) FILTER (duration_sec < 28800) AS n_short, count(*) FILTER (duration_sec > 129600) AS n_long FROM bd GROUP BY 1"""
)
def boundary_report(spark, sf_dir):
    return tidy(laps.boundary_report(_boundaries(spark, sf_dir), short_sec=28_800, long_sec=129_600))


# Wide rows


@query(f"WITH {W} SELECT chassis_id, t_us, speed, aps, round(track_distance_m, 6) AS track_distance_m, round(gps_lat, 6) AS gps_lat, round(gps_lon, 6) AS gps_lon, CAST(lap AS BIGINT) AS lap FROM w")
def pivot_wide(spark, sf_dir):
    return tidy(wide(spark, sf_dir).drop("time_corrected", "row_id"))


@query(
    f"""WITH {W}, n AS (SELECT chassis_id, count(*) AS rows_before, count(DISTINCT name) AS signals_before FROM r WHERE name <> 'error' GROUP BY 1),
c AS (SELECT chassis_id, us // 3600000000 AS h, max(name = 'click') AS click FROM r WHERE name <> 'error' GROUP BY 1, 2), m AS (SELECT chassis_id, count(*) AS rows_after FROM c GROUP BY 1)
SELECT chassis_id, rows_before, signals_before, rows_after, CAST(4 AS BIGINT) AS signals_after, 'error' AS missing_signals, 80.0 AS coverage_pct FROM n JOIN m USING (chassis_id)"""
)
def pivot_stats(spark, sf_dir):
    r = readings(spark, sf_dir).where("telemetry_name <> 'error'").withColumn("h", F.expr("unix_micros(timestamp) div 3600000000"))
    return tidy(reshape.pivot_stats(r, reshape.pivoted(r, ["chassis_id", "h"], SIGNALS), signals=SIGNALS))


@query(f"WITH {R} SELECT DISTINCT name AS telemetry_name FROM r")
def signal_names(spark, sf_dir):
    return readings(spark, sf_dir).select("telemetry_name").where("telemetry_name IS NOT NULL").distinct()


@query(
    f"""WITH {W}, m AS (SELECT *, speed * 8 AS s, avg(speed * 8) OVER (PARTITION BY chassis_id) AS mean FROM w)
SELECT chassis_id, t_us, round(aps / 100, 6) AS aps, aps AS aps_raw, round(CASE WHEN mean > 150 THEN s / 3.6 ELSE s END, 6) AS speed, round(s, 6) AS speed_raw FROM m"""
)
def unit_normalise(spark, sf_dir):
    w = wide(spark, sf_dir).select("chassis_id", "t_us", "aps", (F.col("speed") * 8).alias("speed"))
    return tidy(reshape.with_units(w)).select("chassis_id", "t_us", "aps", "aps_raw", "speed", "speed_raw")


# Positions

_CIRCUIT = Circuit()
_P = f"""{W}, ok AS (SELECT *, coalesce(gps_lat BETWEEN 33.49 AND 33.61, false) AS lat_ok, coalesce(gps_lon BETWEEN -86.66 AND -86.54, false) AS lon_ok FROM w),
nn AS (SELECT *, CASE WHEN lat_ok THEN gps_lat END AS la, CASE WHEN lon_ok THEN gps_lon END AS lo FROM ok),
j AS (SELECT *, (la - lag(la) OVER o) * 111000.0 AS dy, (lo - lag(lo) OVER o) * 111000.0 * cos(radians(la)) AS dx FROM nn WINDOW o AS (PARTITION BY chassis_id ORDER BY t_us, row_id)),
k AS (SELECT *, coalesce(sqrt(dx * dx + dy * dy) > 3000, false) AS is_outlier FROM j)"""


def _moved(spark, sf_dir, **options):
    # Bounds end between two values of the view, so that rounding can't decide.
    w = wide(spark, sf_dir)
    return position.cleaned(w, _CIRCUIT, max_jump_m=3000, **options)


@query(f"WITH {_P} SELECT chassis_id, t_us, lat_ok, lon_ok, is_outlier FROM k")
def jump_outliers(spark, sf_dir):
    return _moved(spark, sf_dir, interpolate=False).select("chassis_id", "t_us", "lat_ok", "lon_ok", "is_outlier")


@query(f"WITH {_P} SELECT chassis_id, t_us, round(CASE WHEN NOT is_outlier THEN la END, 6) AS gps_lat, round(CASE WHEN NOT is_outlier THEN lo END, 6) AS gps_lon FROM k")
def range_null_out(spark, sf_dir):
    return tidy(_moved(spark, sf_dir, interpolate=False).select("chassis_id", "t_us", "gps_lat", "gps_lon"))


def _interp_sql(source: str, columns: dict[str, str], index: str, order: str, both: bool = False) -> str:
    """A select list: columns interpolated in `index`."""
    out = []
    for c, name in columns.items():
        o = f"PARTITION BY chassis_id ORDER BY {order}"
        lo = f"last_value(CASE WHEN {c} IS NOT NULL THEN {{f}} END IGNORE NULLS) OVER ({o} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        hi = f"first_value(CASE WHEN {c} IS NOT NULL THEN {{f}} END IGNORE NULLS) OVER ({o} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
        li, lv, hi_, hv = lo.format(f=index), lo.format(f=c), hi.format(f=index), hi.format(f=c)
        between = f"({lv}) + (({hv}) - ({lv})) * ({index} - ({li})) / nullif(({hi_}) - ({li}), 0)"
        ends = f", {lv}, {hv}" if both else ""
        out.append(f"round(coalesce({c}, {between}{ends}), 6) AS {name}")
    return ", ".join(out)


@query(
    f"""WITH {_P}, i AS (SELECT chassis_id, t_us, row_id, CASE WHEN NOT is_outlier THEN la END AS la, CASE WHEN NOT is_outlier THEN lo END AS lo, row_number() OVER (PARTITION BY chassis_id ORDER BY t_us, row_id) AS i FROM k)
SELECT chassis_id, t_us, {_interp_sql("i", {"la": "gps_lat", "lo": "gps_lon"}, "i", "i", both=True)} FROM i"""
)
def interp_both(spark, sf_dir):
    return tidy(_moved(spark, sf_dir).select("chassis_id", "t_us", "gps_lat", "gps_lon"))


@query(
    f"""WITH {_P}, a AS (SELECT chassis_id, count(*) AS n_rows, count(gps_lat) AS gps_before, count(track_distance_m) AS lapdist,
  count(*) FILTER (NOT is_outlier AND la IS NOT NULL AND lo IS NOT NULL) AS gps_after, count(*) FILTER (is_outlier) AS outliers, count(*) FILTER (NOT lat_ok OR NOT lon_ok) AS out_of_bounds FROM k GROUP BY 1),
s AS (SELECT *, greatest(0, least(1, 0.4 * least(1.0 * gps_after / n_rows, 1) + 0.3 * least(1.0 * lapdist / n_rows, 1) - 0.15 * least(10.0 * outliers / n_rows, 1) - 0.15 * least(20.0 * out_of_bounds / n_rows, 1))) AS score FROM a)
SELECT chassis_id, gps_after, outliers, out_of_bounds, round(CAST(score AS DOUBLE), 6) AS score, CASE WHEN score >= 0.8 THEN 'EXCELLENT' WHEN score >= 0.6 THEN 'GOOD' WHEN score >= 0.4 THEN 'ACCEPTABLE' ELSE 'POOR' END AS rating FROM s"""
)
def quality_score(spark, sf_dir):
    found = position.quality(wide(spark, sf_dir), _moved(spark, sf_dir, interpolate=False))
    return tidy(found.select("chassis_id", "gps_after", "outliers", "out_of_bounds", "score", "rating"))


@query(
    f"""WITH {R} SELECT row_id, round(sign(v) * (floor(abs(v) / 100) + (abs(v) - floor(abs(v) / 100) * 100) / 60), 6) AS degrees, round(floor(v / 100) + (v - floor(v / 100) * 100) / 60, 6) AS parity
FROM (SELECT row_id, CASE WHEN row_id % 2 = 0 THEN -value * 20 ELSE value * 20 END AS v FROM r)"""
)
def gps_degrees(spark, sf_dir):
    v = F.when(F.col("row_id") % 2 == 0, -F.col("telemetry_value") * 20).otherwise(F.col("telemetry_value") * 20)
    return tidy(readings(spark, sf_dir).select("row_id", degrees_from_minutes(v).alias("degrees"), degrees_from_minutes(v, True).alias("parity")))


# Sequences and grids


@query(f"WITH {G} SELECT chassis_id, tick, t_us FROM g")
def uniform_grid(spark, sf_dir):
    return resample.grid(resample.span(wide(spark, sf_dir), "chassis_id", "time_corrected"), GRID_HZ, ["chassis_id"])


_SEL = "chassis_id, tick, t_us"


@query(f"WITH {G} SELECT {_SEL}, speed, aps, CAST(coalesce(lap, -1) AS BIGINT) AS lap FROM g")
def grid_rows(spark, sf_dir):
    return tidy(_on_grid(spark, sf_dir).select("chassis_id", "tick", "t_us", "speed", "aps", F.coalesce("lap", F.lit(-1)).alias("lap")))


def _on_grid(spark, sf_dir):
    return resample.on_grid(wide(spark, sf_dir).drop("t_us"), "chassis_id", "time_corrected", GRID_HZ)


@query(f"WITH {G} SELECT {_SEL}, last_value(aps IGNORE NULLS) OVER (PARTITION BY chassis_id ORDER BY tick ROWS UNBOUNDED PRECEDING) AS aps FROM g")
def ffill(spark, sf_dir):
    return tidy(_on_grid(spark, sf_dir).select("chassis_id", "tick", "t_us", filled_forward(F.col("aps"), in_time(["chassis_id"], "tick")).alias("aps")))


@query(
    f"""WITH {G}, x AS (SELECT *, last_value(CASE WHEN aps IS NOT NULL THEN tick END IGNORE NULLS) OVER o AS seen, last_value(aps IGNORE NULLS) OVER o AS v FROM g WINDOW o AS (PARTITION BY chassis_id ORDER BY tick ROWS UNBOUNDED PRECEDING))
SELECT {_SEL}, CASE WHEN tick - seen <= 1 THEN v END AS aps FROM x"""
)
def ffill_limit(spark, sf_dir):
    return tidy(_on_grid(spark, sf_dir).select("chassis_id", "tick", "t_us", filled_forward_within(F.col("aps"), F.col("tick"), in_time(["chassis_id"], "tick"), 1).alias("aps")))


@query(f"WITH {G} SELECT {_SEL}, {_interp_sql('g', {'speed': 'speed'}, 'tick', 'tick')} FROM g")
def interp_inside(spark, sf_dir):
    return tidy(_on_grid(spark, sf_dir).select("chassis_id", "tick", "t_us", interpolated(F.col("speed"), F.col("tick"), in_time(["chassis_id"], "tick")).alias("speed")))


@query(f"WITH {G} SELECT {_SEL}, round(median(speed) OVER (PARTITION BY chassis_id ORDER BY tick ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 6) AS speed FROM g")
def rolling_median5(spark, sf_dir):
    return tidy(_on_grid(spark, sf_dir).select("chassis_id", "tick", "t_us", rolling_median(F.col("speed"), in_time(["chassis_id"], "tick")).alias("speed")))


_RS = f"""{G}, rs AS (SELECT {_SEL}, {_interp_sql("g", {"speed": "speed", "track_distance_m": "track_distance_m", "gps_lat": "gps_lat", "gps_lon": "gps_lon"}, "tick", "tick")},
  last_value(lap IGNORE NULLS) OVER (PARTITION BY chassis_id ORDER BY tick ROWS UNBOUNDED PRECEDING) AS lap FROM g)"""


def _resampled(spark, sf_dir):
    w = wide(spark, sf_dir).drop("t_us", "row_id")
    out = resample.resampled(w, "chassis_id", "time_corrected", GRID_HZ, ["speed", "track_distance_m", "gps_lat", "gps_lon"], ["lap"])
    return out.withColumns({c: rounded(F.col(c)) for c in ("speed", "track_distance_m", "gps_lat", "gps_lon")})


@query(f"WITH {_RS} SELECT {_SEL}, speed, track_distance_m, gps_lat, gps_lon, CAST(lap AS BIGINT) AS lap FROM rs")
def resample_grid(spark, sf_dir):
    return tidy(_resampled(spark, sf_dir).select("chassis_id", "tick", "t_us", "speed", "track_distance_m", "gps_lat", "gps_lon", "lap"))


_DS = f"""{_RS}, st AS (SELECT *, track_distance_m - lag(track_distance_m) OVER (PARTITION BY chassis_id ORDER BY tick) AS d FROM rs),
ds AS (SELECT *, median((d - 3700 * floor(d / 3700)) / 21600) OVER (PARTITION BY chassis_id ORDER BY tick ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS speed_derived FROM st)"""


def _derived(spark, sf_dir):
    return resample.with_derived_speed(_resampled(spark, sf_dir), "chassis_id", GRID_HZ, track_length_m=3700.0)


@query(f"WITH {_DS} SELECT {_SEL}, round(speed_derived, 6) AS speed_derived, round(coalesce(speed, speed_derived), 6) AS speed_final FROM ds")
def derived_speed(spark, sf_dir):
    return tidy(_derived(spark, sf_dir).select("chassis_id", "tick", "t_us", "speed_derived", "speed_final"))


@query(
    f"""WITH {_RS}, st AS (SELECT *, lag(gps_lat) OVER o AS la0, lag(gps_lon) OVER o AS lo0 FROM rs WINDOW o AS (PARTITION BY chassis_id ORDER BY tick)),
hv AS (SELECT *, 2 * 6371000.0 * asin(sqrt(power(sin(radians(gps_lat - la0) / 2), 2) + cos(radians(la0)) * cos(radians(gps_lat)) * power(sin(radians(gps_lon - lo0) / 2), 2))) / 21600 AS v FROM st)
SELECT {_SEL}, round(median(v) OVER (PARTITION BY chassis_id ORDER BY tick ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 6) AS speed_derived FROM hv"""
)
def derived_speed_gps(spark, sf_dir):
    return tidy(resample.with_derived_speed(_resampled(spark, sf_dir), "chassis_id", GRID_HZ, track=None).select("chassis_id", "tick", "t_us", "speed_derived"))


@query(
    f"""WITH {_DS}, f AS (SELECT *, coalesce(speed, speed_derived) IS NOT NULL AS sp, (gps_lat IS NOT NULL AND gps_lon IS NOT NULL) OR track_distance_m IS NOT NULL AS pos FROM ds)
SELECT chassis_id, count(*) AS ticks, round((max(t_us) - min(t_us)) / 1e6, 6) AS span_sec, round(count(*) / nullif((max(t_us) - min(t_us)) / 1e6, 0), 6) AS actual_hz,
round(100.0 * count(*) FILTER (sp) / count(*), 6) AS speed_pct, round(100.0 * count(*) FILTER (pos) / count(*), 6) AS position_pct, round(100.0 * count(*) FILTER (pos AND sp) / count(*), 6) AS ready_pct FROM f GROUP BY 1"""
)
def resample_stats(spark, sf_dir):
    return tidy(resample.stats(_derived(spark, sf_dir), "chassis_id", GRID_HZ))


# Synchronised frames

_M = f"""{W}, gb AS (SELECT min(t_us) AS lo, max(t_us) AS hi FROM w),
gt AS (SELECT chassis_id, unnest(generate_series(0, (hi - lo) // 21600000000)) AS tick, lo FROM (SELECT DISTINCT chassis_id FROM w), gb),
gp AS (SELECT chassis_id, CAST(round((t_us - lo) / 21600000000.0) AS BIGINT) AS tick, arg_min(row_id, t_us) AS row_id FROM w, gb GROUP BY 1, 2),
ms AS (SELECT t.chassis_id, t.tick, t.lo + t.tick * 21600000000 AS t_us, w.speed, w.aps, w.track_distance_m FROM gt t LEFT JOIN gp USING (chassis_id, tick) LEFT JOIN w ON w.chassis_id = gp.chassis_id AND w.row_id = gp.row_id)"""


def _synced(spark, sf_dir, **options):
    return sync.synchronised(wide(spark, sf_dir).drop("t_us"), "chassis_id", "time_corrected", GRID_HZ, ["speed", "aps", "track_distance_m"], **options)


@query(f"WITH {_M} SELECT chassis_id, tick, t_us, speed, aps FROM ms")
def multi_sync(spark, sf_dir):
    return tidy(_synced(spark, sf_dir).select("chassis_id", "tick", "t_us", "speed", "aps"))


@query(
    f"""WITH {_M}, x AS (SELECT *, last_value(CASE WHEN speed IS NOT NULL THEN tick END IGNORE NULLS) OVER o AS seen, last_value(speed IGNORE NULLS) OVER o AS v FROM ms WINDOW o AS (PARTITION BY chassis_id ORDER BY tick ROWS UNBOUNDED PRECEDING))
SELECT chassis_id, tick, t_us, CASE WHEN tick - seen <= 2 THEN v END AS speed FROM x"""
)
def multi_sync_carried(spark, sf_dir):
    return tidy(_synced(spark, sf_dir, limit_sec=43_200).select("chassis_id", "tick", "t_us", "speed"))


@query(
    f"""WITH {_M} SELECT chassis_id, count(*) AS frames, count(speed) AS frames_present, round(100.0 * count(speed) / count(*), 6) AS coverage_pct,
min(CASE WHEN speed IS NOT NULL THEN t_us END) AS first_us, max(CASE WHEN speed IS NOT NULL THEN t_us END) AS last_us FROM ms GROUP BY 1"""
)
def car_coverage(spark, sf_dir):
    return tidy(sync.coverage(_synced(spark, sf_dir), "chassis_id", "speed"))


@query(
    f"""WITH {_M}, n AS (SELECT tick, count(DISTINCT CASE WHEN speed IS NOT NULL THEN chassis_id END) AS n FROM ms GROUP BY 1)
SELECT count(*) AS frames, count(*) FILTER (n > 0) AS frames_with_data, round(avg(n), 6) AS avg_entities, min(n) AS min_entities, max(n) AS max_entities FROM n"""
)
def cars_per_frame(spark, sf_dir):
    return tidy(sync.entities_per_frame(_synced(spark, sf_dir), "chassis_id", "speed"))


@query(
    f"""WITH {_M}, n AS (SELECT tick, count(DISTINCT CASE WHEN speed IS NOT NULL THEN chassis_id END) AS n FROM ms GROUP BY 1),
i AS (SELECT tick, tick - row_number() OVER (ORDER BY tick) AS island FROM n WHERE n >= 8)
SELECT min(tick) AS start_tick, max(tick) AS end_tick, max(tick) - min(tick) + 1 AS frames FROM i GROUP BY island"""
)
def coverage_windows(spark, sf_dir):
    return tidy(sync.full_windows(_synced(spark, sf_dir), "chassis_id", "speed", 8))


# Baselines and expectations

_SB = f"""{R}, sb AS (SELECT chassis_id, name AS telemetry_name, count(*) AS sample_count, count(value) AS non_null, 100.0 * count(value) / count(*) AS coverage_pct, min(us) AS start_us, max(us) AS end_us, (max(us) - min(us)) / 1e6 AS span_sec,
  CASE WHEN max(us) > min(us) THEN round(count(*) / ((max(us) - min(us)) / 1e6) * 1000, 2) ELSE 0 END AS hz_avg FROM r GROUP BY 1, 2)"""


def _baseline(spark, sf_dir, part=None):
    """Rates for each thousand seconds: those of a second would all round to 0."""
    r = readings(spark, sf_dir)
    out = quality.signal_baseline(r if part is None else r.where(part))
    rate = F.when(F.col("span_sec") > 0, F.round(F.col("sample_count") / F.col("span_sec") * 1000, 2)).otherwise(0.0)
    return out.withColumn("hz_avg", rate)


@query(f"WITH {_SB} SELECT chassis_id, telemetry_name, sample_count, non_null, round(coverage_pct, 6) AS coverage_pct, start_us, end_us, round(span_sec, 6) AS span_sec, round(CAST(hz_avg AS DOUBLE), 6) AS hz_avg FROM sb")
def signal_baseline(spark, sf_dir):
    return tidy(_baseline(spark, sf_dir))


@query(f"WITH {R} SELECT chassis_id, name AS telemetry_name, grouping(chassis_id) * 2 + grouping(name) AS level, count(*) AS n_rows, round((max(us) - min(us)) / 1e6, 6) AS span_sec FROM r GROUP BY ROLLUP (chassis_id, name)")
def car_baseline(spark, sf_dir):
    return tidy(quality.entity_baseline(readings(spark, sf_dir)))


@query(f"WITH {_SB} SELECT chassis_id, telemetry_name, round(CASE WHEN max(hz_avg) OVER (PARTITION BY chassis_id) > 0 THEN 100.0 * hz_avg / max(hz_avg) OVER (PARTITION BY chassis_id) ELSE 0 END, 6) AS expected_pct FROM sb")
def expected_coverage(spark, sf_dir):
    return tidy(quality.expected_coverage(_baseline(spark, sf_dir)).select("chassis_id", "telemetry_name", "expected_pct"))


_CK = f"""{_SB}, rb AS (SELECT * FROM r WHERE row_id % 10 <> 3),
ab AS (SELECT chassis_id, name AS telemetry_name, count(*) AS sample_count, 100.0 * count(value) / count(*) AS coverage_pct, (max(us) - min(us)) / 1e6 AS span_sec, CASE WHEN max(us) > min(us) THEN round(count(*) / ((max(us) - min(us)) / 1e6) * 1000, 2) ELSE 0 END AS hz_avg FROM rb GROUP BY 1, 2),
jn AS (SELECT chassis_id, telemetry_name, unnest(['sample_count', 'time_coverage', 'signal_presence', 'sampling_rate']) AS "check", unnest([CAST(b.sample_count AS DOUBLE), b.span_sec, b.coverage_pct, b.hz_avg]) AS expected, unnest([CAST(a.sample_count AS DOUBLE), a.span_sec, a.coverage_pct, a.hz_avg]) AS actual,
  unnest([10, 1, 5, 10]) AS lim, unnest(['WARN', 'WARN', 'PASS', 'WARN']) AS gain FROM sb b JOIN ab a USING (chassis_id, telemetry_name)),
dl AS (SELECT *, CASE WHEN "check" = 'signal_presence' THEN actual - expected WHEN expected = 0 THEN CASE WHEN actual = 0 THEN 0 ELSE 100 END ELSE (actual - expected) * 100.0 / expected END AS delta FROM jn),
ck AS (SELECT *, CASE WHEN abs(delta) <= lim THEN 'PASS' WHEN delta < 0 THEN 'FAIL' ELSE gain END AS status FROM dl)"""


def _checks(spark, sf_dir):
    return quality.against_baseline(_baseline(spark, sf_dir), _baseline(spark, sf_dir, F.col("row_id") % 10 != 3))


@query(f'WITH {_CK} SELECT chassis_id, telemetry_name, "check", round(expected, 6) AS expected, round(actual, 6) AS actual, round(delta, 6) AS delta, status FROM ck')
def baseline_checks(spark, sf_dir):
    return tidy(_checks(spark, sf_dir))


@query(
    f"""WITH {_CK} SELECT chassis_id, CASE max(CASE status WHEN 'FAIL' THEN 2 WHEN 'WARN' THEN 1 ELSE 0 END) WHEN 2 THEN 'FAIL' WHEN 1 THEN 'WARN' ELSE 'PASS' END AS status, count(*) AS checks, count(*) FILTER (status = 'PASS') AS passed FROM ck GROUP BY 1"""
)
def baseline_status(spark, sf_dir):
    return quality.rolled_up(_checks(spark, sf_dir))


@query(f"WITH {R} SELECT row_id, round(CASE WHEN row_id % 5 = 0 THEN CASE WHEN lap = 1 THEN 0.0 ELSE 100.0 END ELSE (value - row_id % 5) * 100.0 / (row_id % 5) END, 6) AS delta FROM r")
def delta_percent(spark, sf_dir):
    b = (F.col("row_id") % 5).cast("double")
    a = F.when(b == 0, F.when(F.col("lap") == 1, 0.0).otherwise(1.0)).otherwise(F.col("telemetry_value"))
    return tidy(readings(spark, sf_dir).select("row_id", delta_pct(b, a).alias("delta")))


@query(
    f"""WITH {R}, n AS (SELECT count(*) AS n, count(chassis_id) AS c, count(CASE WHEN lap <> 32768 THEN lap END) AS l, count(*) FILTER (NOT value BETWEEN 0 AND 400) AS o, count(DISTINCT chassis_id) AS d, min(value) AS m FROM r)
SELECT unnest(['chassis_id exists', 'missing exists', 'chassis_id not null', 'lap_fixed not null', 'telemetry_value in range', 'distinct chassis_id', 'least value', 'telemetry_value is double']) AS expectation,
unnest([1.0, NULL, c / n, l / n, o, d, m, 1.0]) AS measured, unnest([true, false, c = n, l / n >= 0.95, o = 0, d >= 3, m >= 0, true]) AS passed FROM n"""
)
def expectation_report(spark, sf_dir):
    r = readings(spark, sf_dir).withColumn("lap_fixed", F.when(F.col("lap") != 32768, F.col("lap")))
    found = [
        quality.exists("chassis_id"), quality.exists("missing"), quality.not_null("chassis_id"), quality.not_null("lap_fixed", 0.95), quality.between("telemetry_value", 0, 400),
        quality.at_least_distinct("chassis_id", 3), quality.Expectation("least value", F.min("telemetry_value"), 0.0), quality.has_type(r, "telemetry_value", "double"),
    ]
    return tidy(quality.report(r, found))


@query(
    f"""WITH {R} SELECT CAST(11 AS BIGINT) AS checks, CAST(11 AS BIGINT) AS passed, 100.0 AS pass_rate FROM (SELECT 1) WHERE (SELECT count(*) FROM r WHERE chassis_id IS NULL OR name IS NULL) = 0"""
)
def raw_suite_rate(spark, sf_dir):
    r = readings(spark, sf_dir)
    return tidy(quality.pass_rate(quality.report(r, quality.suite("raw_curated", r))))


@query(
    f"""WITH {_M}, fr AS (SELECT count(DISTINCT t_us) AS frames FROM ms), p AS (SELECT chassis_id, count(DISTINCT CASE WHEN speed IS NOT NULL OR aps IS NOT NULL THEN t_us END) AS n, (max(CASE WHEN speed IS NOT NULL OR aps IS NOT NULL THEN t_us END) - min(CASE WHEN speed IS NOT NULL OR aps IS NOT NULL THEN t_us END)) / 1e6 AS d FROM ms GROUP BY 1)
SELECT chassis_id, round(100.0 * n / frames, 6) AS coverage_pct, round(coalesce(d, 0), 6) AS duration_sec, 100.0 * n / frames >= 90 AS coverage_ok, coalesce(d, 0) >= 2500000 AS duration_ok FROM p, fr"""
)
def entity_expectations(spark, sf_dir):
    return tidy(quality.entity_expectations(_synced(spark, sf_dir), columns=("speed", "aps"), min_coverage_pct=90, min_duration_sec=2_500_000))


_RANGES = Policy(ranges={"click": (0.0, "FAIL", 100.0, "WARN"), "view": (1.0, "FAIL", 200.0, "FAIL"), "error": (0.0, "FAIL", None, "WARN")})


@query(
    f"""WITH {R} SELECT name AS telemetry_name, count(*) FILTER (value < CASE name WHEN 'view' THEN 1 ELSE 0 END) AS below, count(*) FILTER (value > CASE name WHEN 'click' THEN 100 WHEN 'view' THEN 200 END) AS above,
CASE name WHEN 'error' THEN 'PASS' WHEN 'view' THEN 'FAIL' ELSE CASE WHEN count(*) FILTER (value > 100) > 0 THEN 'WARN' ELSE 'PASS' END END AS status FROM r WHERE name IN ('click', 'view', 'error') GROUP BY name"""
)
def range_policy(spark, sf_dir):
    return quality.range_checks(readings(spark, sf_dir), _RANGES)


@query(
    f"""WITH {W}, n AS (SELECT chassis_id, 100.0 * count(*) FILTER (speed IS NULL) / count(*) AS speed, 100.0 * count(*) FILTER (aps IS NULL) / count(*) AS aps, 0.0 AS lap FROM w GROUP BY 1),
u AS (SELECT chassis_id, unnest(['speed', 'aps', 'lap']) AS signal, unnest([speed, aps, lap]) AS null_pct FROM n)
SELECT chassis_id, signal, round(null_pct, 6) AS null_pct, CASE WHEN null_pct > 5 THEN 'FAIL' WHEN null_pct > 1 THEN 'WARN' ELSE 'PASS' END AS status FROM u"""
)
def nan_policy(spark, sf_dir):
    return tidy(quality.nan_checks(wide(spark, sf_dir), Policy()))


@query(f"WITH {_D} SELECT chassis_id, round(max(drift_std), 6) AS worst_std, CASE WHEN max(drift_std) > 30 THEN 'FAIL' WHEN max(drift_std) > 10 THEN 'WARN' ELSE 'PASS' END AS status FROM cal GROUP BY 1")
def drift_policy(spark, sf_dir):
    return tidy(quality.drift_checks(_calibration(spark, sf_dir), Policy()))


@query(f"WITH {R} SELECT chassis_id, 'gear' AS missing, false AS ready FROM r GROUP BY 1")
def required_signals(spark, sf_dir):
    return quality.missing_signals(readings(spark, sf_dir), ["click", "view", "gear"], [["error", "signup"]])


_EXIST = "unnest([{}]) AS expectation, unnest([{}]) AS measured, unnest([{}]) AS passed"


def _suite_sql(names, rest) -> str:
    """SELECT list of a suite: columns that exist, then (name, measure, condition) each."""
    rows = [(f"{n} exists", "1.0", "true") for n in names] + rest
    return _EXIST.format(", ".join(f"'{a}'" for a, _, _ in rows), ", ".join(f"round(CAST({b} AS DOUBLE), 6)" for _, b, _ in rows), ", ".join(c for _, _, c in rows))


_REFINED = _suite_sql(
    ("time_corrected", "chassis_id", "car_no", "lap_repaired", "segment_id", "telemetry_name", "telemetry_value"),
    [("chassis_id not null", "c / n", "c = n"), ("time_corrected not null", "t / n", "t = n"), ("least speed", "coalesce(m, 0)", "coalesce(m, 0) >= 0")],
)


@query(f"WITH {R}, v AS (SELECT count(*) AS n, count(chassis_id) AS c, count(us) AS t, min(CASE WHEN name = 'click' THEN value - 50 END) AS m FROM r) SELECT {_REFINED} FROM v")
def refined_suite(spark, sf_dir):
    r = readings(spark, sf_dir)
    name = F.when(F.col("telemetry_name") == "click", "speed").otherwise(F.col("telemetry_name"))
    value = F.when(F.col("telemetry_name") == "click", F.col("telemetry_value") - 50).otherwise(F.col("telemetry_value"))
    r = r.withColumns({"telemetry_value": value, "telemetry_name": name, "time_corrected": F.col("timestamp"), "lap_repaired": F.col("lap"), "segment_id": F.lit(0)})
    return tidy(quality.report(r, quality.suite("refined", r)))


_SIMULATION = _suite_sql(
    ("time_global", "chassis_id", "car_no", "speed_final", "gear", "aps", "gps_lat", "gps_lon"),
    [
        ("time_global not null", "t / n", "t / n >= 0.95"), ("chassis_id not null", "c / n", "c / n >= 0.95"), ("speed_final not null", "s / n", "s / n >= 0.95"), ("gear not null", "g / n", "g / n >= 0.95"),
        ("speed_final in range", "so", "so = 0"), ("gear in range", "go", "go = 0"), ("aps in range", "ao", "ao = 0"), ("distinct chassis_id", "d", "d >= 3"),
    ],
)


@query(
    f"""WITH {W}, v AS (SELECT count(*) AS n, count(t_us) AS t, count(chassis_id) AS c, count(speed) AS s, count(lap) AS g, count(*) FILTER (NOT speed BETWEEN 0 AND 100) AS so, count(*) FILTER (NOT lap BETWEEN -1 AND 10) AS go,
count(*) FILTER (NOT aps / 100 BETWEEN 0 AND 1) AS ao, count(DISTINCT chassis_id) AS d FROM w) SELECT {_SIMULATION} FROM v"""
)
def simulation_suite(spark, sf_dir):
    w = wide(spark, sf_dir).withColumns({"time_global": F.col("time_corrected"), "car_no": F.col("chassis_id"), "speed_final": F.col("speed"), "gear": F.col("lap"), "aps": F.col("aps") / 100})
    return tidy(quality.report(w, quality.suite("simulation_ready", w)))


@query(
    f"""WITH {W}, n AS (SELECT chassis_id, 100.0 * count(*) FILTER ((gps_lat IS NULL OR gps_lon IS NULL) AND track_distance_m IS NULL) / count(*) AS missing_pct FROM w GROUP BY 1)
SELECT chassis_id, round(missing_pct, 6) AS missing_pct, CASE WHEN missing_pct > 10 THEN 'FAIL' WHEN missing_pct > 0 THEN 'WARN' ELSE 'PASS' END AS status FROM n"""
)
def position_policy(spark, sf_dir):
    return tidy(quality.position_checks(wide(spark, sf_dir), Policy()))


@query(
    f"""WITH {R}, n AS (SELECT chassis_id, 100.0 * count(*) FILTER (lap = 32768) / count(*) AS sentinel_pct, count(DISTINCT lap) FILTER (lap <> 32768) AS laps FROM r GROUP BY 1)
SELECT chassis_id, round(sentinel_pct, 6) AS sentinel_pct, laps, CASE WHEN sentinel_pct > 10 THEN 'FAIL' WHEN sentinel_pct > 0 OR laps < 10 THEN 'WARN' ELSE 'PASS' END AS status FROM n"""
)
def lap_policy(spark, sf_dir):
    return tidy(quality.lap_checks(readings(spark, sf_dir), Policy()))


# Features

_F = f"""{_B}, a AS (SELECT w.chassis_id, w.t_us, max(boundary_time) AS bt FROM w LEFT JOIN bd ON bd.chassis_id = w.chassis_id AND boundary_time <= t_us GROUP BY 1, 2),
lr AS (SELECT w.*, coalesce(bd.post_lap, 1) AS lap_repaired FROM w JOIN a USING (chassis_id, t_us) LEFT JOIN bd ON bd.chassis_id = a.chassis_id AND bd.boundary_time = a.bt),
gs AS (SELECT *, CASE WHEN lap <> lag(lap) OVER (PARTITION BY chassis_id, lap_repaired ORDER BY t_us, row_id) THEN 1 ELSE 0 END AS shift FROM lr),
lf AS (SELECT chassis_id, lap_repaired, min(t_us) AS lap_start_us, max(t_us) AS lap_end_us, (max(t_us) - min(t_us)) / 1e6 AS lap_time, avg(speed) AS avg_speed, max(speed) AS max_speed, min(speed) AS min_speed,
  100.0 * count(*) FILTER (aps > 0.1) / count(*) AS throttle_pct_time, 100.0 * count(*) FILTER (aps > 0.9) / count(*) AS full_throttle_pct_time, CAST(sum(shift) AS BIGINT) AS gear_changes,
  max(track_distance_m) - min(track_distance_m) AS distance_covered, count(*) AS frame_count, 100.0 * count(*) FILTER (speed IS NULL OR aps IS NULL) / count(*) AS nan_pct FROM gs GROUP BY 1, 2)"""


def _features(spark, sf_dir):
    timed = laps.with_laps(_marked(spark, sf_dir)).withColumn("gear", F.col("lap").cast("double"))
    return features.lap_features(timed, critical=("speed", "aps"))


@query(
    f"""WITH {_F} SELECT chassis_id, lap_repaired, lap_start_us, lap_end_us, round(lap_time, 6) AS lap_time, round(avg_speed, 6) AS avg_speed, max_speed, min_speed, round(throttle_pct_time, 6) AS throttle_pct_time,
round(full_throttle_pct_time, 6) AS full_throttle_pct_time, gear_changes, round(distance_covered, 6) AS distance_covered, frame_count, round(nan_pct, 6) AS nan_pct FROM lf"""
)
def lap_features(spark, sf_dir):
    return tidy(_features(spark, sf_dir).drop("brake_pct_time", "avg_rpm", "max_rpm"))


@query(
    f"""WITH {_F} SELECT chassis_id, count(*) AS total_laps, round(sum(distance_covered), 6) AS total_distance, round(sum(lap_time), 6) AS total_time, round(min(CASE WHEN lap_time > 0 THEN lap_time END), 6) AS best_lap_time,
arg_min(lap_repaired, lap_time * 1000 + lap_repaired) FILTER (lap_time > 0) AS best_lap_number, round(avg(CASE WHEN lap_time > 0 THEN lap_time END), 6) AS avg_lap_time, round(avg(avg_speed), 6) AS avg_speed_overall,
round(stddev_samp(CASE WHEN lap_time > 0 THEN lap_time END), 6) AS lap_time_std, round(100.0 * count(*) FILTER (nan_pct = 0) / count(*), 6) AS valid_lap_pct FROM lf GROUP BY 1"""
)
def lap_summary(spark, sf_dir):
    return tidy(features.lap_summary(_features(spark, sf_dir)))


@query(f"WITH {R} SELECT chassis_id, car_no, min(us) AS first_seen_us, max(us) AS last_seen_us, count(*) AS n_rows FROM r GROUP BY 1, 2")
def chassis_mapping(spark, sf_dir):
    return features.pairings(readings(spark, sf_dir))


@query(
    f"""WITH {R} SELECT chassis_id, count(*) AS n_rows, count(DISTINCT name) AS signals, count(DISTINCT lap) AS laps, CAST(min(lap) AS BIGINT) AS min_lap, CAST(max(lap) AS BIGINT) AS max_lap, round((max(us) - min(us)) / 1e6, 6) AS span_sec,
round(count(*) / ((max(us) - min(us)) / 1e6), 6) AS hz, round(100.0 * count(*) / (SELECT count(*) FROM r), 6) AS share_pct FROM r GROUP BY 1"""
)
def profile_counts(spark, sf_dir):
    return tidy(features.profile(readings(spark, sf_dir)))


@query(
    f"""WITH {R}, n AS (SELECT chassis_id, name AS telemetry_name, count(*) AS n FROM r GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY chassis_id ORDER BY n DESC, telemetry_name) AS rank FROM n)
SELECT chassis_id, telemetry_name, n, rank FROM k WHERE rank <= 3"""
)
def topk_signals(spark, sf_dir):
    return features.top_signals(readings(spark, sf_dir), 3)


# Geometry


@query(f"WITH {L}, s AS (SELECT idx, sqrt(power(x - lag(x) OVER (ORDER BY idx), 2) + power(y - lag(y) OVER (ORDER BY idx), 2)) AS d FROM l) SELECT CAST(idx AS BIGINT) AS idx, round(sum(coalesce(d, 0)) OVER (ORDER BY idx), 6) AS cum FROM s")
def arc_length(spark, sf_dir):
    return tidy(geometry.with_arc_length(line(spark)).select("idx", "cum"))


@query(f"WITH {L}, s AS (SELECT x, y, coalesce(lead(x) OVER (ORDER BY idx), 500.0) AS nx, coalesce(lead(y) OVER (ORDER BY idx), 0.0) AS ny FROM l) SELECT round(sum(x * ny - nx * y) / 2, 6) AS area, 'counter-clockwise' AS direction FROM s")
def signed_area(spark, sf_dir):
    return tidy(geometry.signed_area(line(spark)).select("area", "direction"))


_LX = f"""{L}, sg AS (SELECT idx, x, y, lead(x) OVER (ORDER BY idx) AS x1, lead(y) OVER (ORDER BY idx) AS y1 FROM l),
cu AS (SELECT *, sum(coalesce(d, 0)) OVER (ORDER BY idx) AS c0 FROM (SELECT *, sqrt(power(x - lag(x) OVER (ORDER BY idx), 2) + power(y - lag(y) OVER (ORDER BY idx), 2)) AS d FROM sg)),
cs AS (SELECT *, lead(c0) OVER (ORDER BY idx) AS c1 FROM cu)"""


@query(
    f"""WITH {R}, {_LX}, q AS (SELECT row_id, (m - 3700 * floor(m / 3700)) / 3700 * 199 AS place FROM (SELECT row_id, value * 30 - 500 AS m FROM r))
SELECT row_id, round(x + coalesce((x1 - x) * (place - idx), 0), 6) AS x, round(y + coalesce((y1 - y) * (place - idx), 0), 6) AS y FROM q JOIN sg ON idx = floor(place)"""
)
def ribbon_xy(spark, sf_dir):
    rows = readings(spark, sf_dir).select("row_id", (F.col("telemetry_value") * 30 - 500).alias("m"), F.lit("center").alias("line"))
    return tidy(geometry.on_line_by_index(rows, line(spark), F.col("m"), 3700.0).select("row_id", "x", "y"))


@query(
    f"""WITH {R}, {_LX}, t AS (SELECT max(c1) AS len FROM cs), q AS (SELECT row_id, m - len * floor(m / len) AS dd FROM (SELECT row_id, value * 30 - 500 AS m FROM r), t)
SELECT row_id, round(x + (x1 - x) * (dd - c0) / (c1 - c0), 6) AS x, round(y + (y1 - y) * (dd - c0) / (c1 - c0), 6) AS y FROM q JOIN cs ON dd >= c0 AND dd < c1"""
)
def distance_to_xy(spark, sf_dir):
    rows = readings(spark, sf_dir).select("row_id", (F.col("telemetry_value") * 30 - 500).alias("m"), F.lit("center").alias("line"))
    return tidy(geometry.on_line_by_length(rows, line(spark), F.col("m")).select("row_id", "x", "y"))


@query(
    f"""WITH {R}, {L}, q AS (SELECT row_id, value * 2 - 300 AS px, (row_id % 700) - 350.5 AS py FROM r), d AS (SELECT row_id, idx, sqrt(power(x - px, 2) + power(y - py, 2)) AS distance FROM q, l)
SELECT row_id, CAST(arg_min(idx, distance) AS BIGINT) AS idx, round(min(distance), 6) AS distance FROM d GROUP BY 1"""
)
def nearest_point(spark, sf_dir):
    rows = readings(spark, sf_dir).select("row_id", (F.col("telemetry_value") * 2 - 300).alias("x"), ((F.col("row_id") % 700) - 350.5).alias("y"), F.lit("center").alias("line"))
    return tidy(geometry.nearest_point(rows, line(spark)).select("row_id", "idx", "distance"))


@query(f"WITH {W} SELECT chassis_id, t_us, round((gps_lon + 86.619) * 111320.0 * cos(radians(33.533)), 6) AS x, round((gps_lat - 33.533) * 111320.0, 6) AS y FROM w")
def gps_to_xy(spark, sf_dir):
    x, y = local_xy(F.col("gps_lat"), F.col("gps_lon"), F.lit(33.533), F.lit(-86.619))
    return tidy(wide(spark, sf_dir).select("chassis_id", "t_us", x.alias("x"), y.alias("y")))


@query(
    f"""WITH {W}, {_LX}, fr AS (SELECT t_us, row_number() OVER (ORDER BY t_us) - 1 AS frame FROM (SELECT DISTINCT t_us FROM w)),
q AS (SELECT chassis_id, t_us, (m - 3700 * floor(m / 3700)) / 3700 * 199 AS place FROM (SELECT chassis_id, t_us, track_distance_m AS m FROM w WHERE track_distance_m IS NOT NULL)),
p AS (SELECT chassis_id, frame, x + coalesce((x1 - x) * (place - idx), 0) AS px, y + coalesce((y1 - y) * (place - idx), 0) AS py FROM q JOIN sg ON idx = floor(place) JOIN fr USING (t_us))
SELECT chassis_id, count(*) AS n_frames, min(frame) AS first_frame, max(frame) AS last_frame, round(arg_min(px, frame), 6) AS first_x, round(arg_max(py, frame), 6) AS last_y FROM p GROUP BY 1"""
)
def trajectory_ends(spark, sf_dir):
    t = trajectories.trajectories(wide(spark, sf_dir), line(spark), 3700.0)
    at = lambda k: F.element_at("path", k)
    return tidy(t.select("chassis_id", "n_frames", at(1)["frame"].alias("first_frame"), at(-1)["frame"].alias("last_frame"), at(1)["x"].alias("first_x"), at(-1)["y"].alias("last_y")))


@query(f"WITH {_LX}, t AS (SELECT 1000.0 / max(c0) AS s, (min(x) + max(x)) / 2 AS mx, (min(y) + max(y)) / 2 AS my FROM cs) SELECT CAST(idx AS BIGINT) AS idx, round((x - mx) * s, 6) + 0.0 AS x, round((y - my) * s, 6) + 0.0 AS y FROM cs, t")
def line_scaled(spark, sf_dir):
    scaled = geometry.scaled_to_length(line(spark), 1000.0)
    return tidy(scaled.select("idx", "x", "y"))


@query(f"WITH {L}, s AS (SELECT x, y, coalesce(lead(x) OVER (ORDER BY idx DESC), last_value(x) OVER (ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS nx, coalesce(lead(y) OVER (ORDER BY idx DESC), last_value(y) OVER (ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS ny FROM l) SELECT round(sum(x * ny - nx * y) / 2, 6) AS area, CASE WHEN sum(x * ny - nx * y) > 0 THEN 'counter-clockwise' ELSE 'clockwise' END AS direction FROM s")
def line_reversed(spark, sf_dir):
    return tidy(geometry.signed_area(geometry.reversed_line(line(spark))).select("area", "direction"))


@query(
    f"""WITH {R}, b AS (SELECT min(value) AS lo, max(value) AS hi FROM r), q AS (SELECT row_id, value, lo, hi, least(1000 * 0.9 / (hi - lo), 600 * 0.9 / 700.0) AS s FROM r, b)
SELECT row_id, round(500 + (value - (lo + hi) / 2) * s, 6) AS px, round(600 - (300 + (row_id % 700 - 350) * s), 6) AS py, round(value, 6) AS x FROM q"""
)
def pixel_round_trip(spark, sf_dir):
    r = readings(spark, sf_dir).select("row_id", "telemetry_value")
    low, high = F.col("lo"), F.col("hi")
    bounds = r.agg(F.min("telemetry_value").alias("lo"), F.max("telemetry_value").alias("hi")).withColumn("__one", F.lit(1))
    r = r.withColumn("__one", F.lit(1)).join(F.broadcast(bounds), "__one")  # a single row
    scale = pixel_scale(high - low, F.lit(700.0), 1000.0, 600.0)
    px = to_pixels(F.col("telemetry_value"), low, high, 1000.0, scale)
    py = to_pixels(F.col("row_id") % 700, F.lit(0.0), F.lit(700.0), 600.0, scale, flipped=True)
    return tidy(r.select("row_id", px.alias("px"), py.alias("py"), from_pixels(px, low, high, 1000.0, scale).alias("x")))


@query(
    f"""WITH {R}, q AS (SELECT row_id, CAST(car_no AS BIGINT) % 5 AS slot, row_id % 5000 AS sec FROM r)
SELECT row_id, CASE WHEN slot = 0 THEN 'center' WHEN slot <= 2 THEN 'left_' || slot ELSE 'right_' || (slot - 2) END AS ribbon, CAST(floor(7 + sec * 1.5) AS BIGINT) % 1000 AS frame, lpad(CAST(sec // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(sec % 60 AS VARCHAR), 2, '0') AS label FROM q"""
)
def replay_frames(spark, sf_dir):
    sec = F.col("row_id") % 5000
    r = readings(spark, sf_dir)
    return tidy(r.select("row_id", ribbon_of(F.col("car_no"), 2).alias("ribbon"), frame_after(F.lit(7), sec, F.lit(1.5), F.lit(1000)).alias("frame"), clock_label(sec).alias("label")))


# Relations


@query(
    """SELECT r_name, l_returnflag, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE l_shipdate >= TIMESTAMP '1995-01-01' GROUP BY 1, 2"""
)
def star_join_agg(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") >= F.lit("1995-01-01").cast("timestamp"))
    j = li.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    j = j.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name", "l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)")
def semi_join(spark, sf_dir):
    big = table(spark, sf_dir, "orders").where("o_totalprice > 200000")
    return table(spark, sf_dir, "customer").join(big, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_mktsegment")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def anti_join(spark, sf_dir):
    return table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders").where("o_totalprice > 300000"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query(
    """WITH h AS (SELECT i AS h, TIMESTAMP '2024-01-01' + INTERVAL (i * 36) HOUR AS lo, TIMESTAMP '2024-01-01' + INTERVAL (i * 36 + 36) HOUR AS hi FROM generate_series(0, 19) AS s(i))
SELECT h, count(*) AS n, round(sum(value), 6) AS total FROM events JOIN h ON ts >= lo AND ts < hi GROUP BY 1"""
)
def range_join(spark, sf_dir):
    """Intervals of one length: their number is computed from a row's time, and the join is an equi-join."""
    e = readings(spark, sf_dir).withColumn("h", F.expr("(unix_micros(timestamp) - 1704067200000000) div 129600000000"))
    return tidy(e.join(F.broadcast(spark.range(20).withColumnRenamed("id", "h")), "h").groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.sum("telemetry_value").alias("total")))


@query(
    """SELECT 'union' AS op, count(*) AS n FROM (SELECT o_custkey AS k FROM orders UNION SELECT c_custkey FROM customer)
UNION ALL SELECT 'except', count(*) FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders)
UNION ALL SELECT 'intersect', count(*) FROM (SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders)"""
)
def setops(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    parts = {"union": o.union(c).distinct(), "except": c.subtract(o), "intersect": c.intersect(o)}
    out = None
    for name, df in parts.items():
        one = df.agg(F.lit(name).alias("op"), F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT event_id, CAST(regexp_extract(props, '\"k\": ([0-9]+)', 1) AS BIGINT) AS k FROM events")
def json_extract_props(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("SELECT user_id, event_type, grouping(user_id) * 2 + grouping(event_type) AS level, count(*) AS n FROM (SELECT CAST(user_id % 20 AS VARCHAR) AS user_id, event_type FROM events) GROUP BY CUBE (user_id, event_type)")
def cube_counts(spark, sf_dir):
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 20).cast("string").alias("user_id"), "event_type")
    return e.cube("user_id", "event_type").agg(F.grouping_id().cast("long").alias("level"), F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN value END AS value FROM events")
def nan_to_null(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, float("nan")).otherwise(F.col("value")).alias("value"))
    return normalise(e)
