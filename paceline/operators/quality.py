"""Baselines, declared expectations and policies, each checked in one aggregation over the data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paceline.config import Policy
from paceline.functions.scalar import delta_pct, has_position, micros
from paceline.schema import LAP_SENTINEL

KEY = "chassis_id"


class ValidationError(Exception):
    """A strict validation that failed."""


# Baselines


def signal_baseline(df: DataFrame, key: str = KEY, signal: str = "telemetry_name", value: str = "telemetry_value", ts: str = "timestamp") -> DataFrame:
    """key, signal, sample_count, non_null, coverage_pct, start_us, end_us, span_sec, hz_avg."""
    n, there = F.count(F.lit(1)), F.count(value)
    first, last = F.min(micros(F.col(ts))), F.max(micros(F.col(ts)))
    span = (last - first) / 1e6
    return df.groupBy(key, signal).agg(n.alias("sample_count"), there.alias("non_null"), (100.0 * there / n).alias("coverage_pct"), first.alias("start_us"), last.alias("end_us"), span.alias("span_sec"), F.when(span > 0, F.round(n / span, 2)).otherwise(0.0).alias("hz_avg"))


def entity_baseline(df: DataFrame, key: str = KEY, signal: str = "telemetry_name", ts: str = "timestamp") -> DataFrame:
    """One row for each (entity, signal), each entity and all: level 0, 1 or 3, n_rows, signals, span_sec."""
    span = (F.max(micros(F.col(ts))) - F.min(micros(F.col(ts)))) / 1e6
    return df.rollup(key, signal).agg(F.grouping_id().cast("long").alias("level"), F.count(F.lit(1)).alias("n_rows"), span.alias("span_sec"))


def expected_coverage(baseline: DataFrame, key: str = KEY) -> DataFrame:
    """baseline with expected_pct: the signal's rate as a share of its entity's highest."""
    top = F.max("hz_avg").over(Window.partitionBy(key))
    return baseline.withColumn("expected_pct", F.when(top > 0, 100.0 * F.col("hz_avg") / top).otherwise(0.0))


def _status(delta: Column, limit: float, gain: str) -> Column:
    """PASS within the limit; a loss beyond it fails, a gain beyond it gives `gain`."""
    return F.when(F.abs(delta) <= limit, "PASS").when(delta < 0, "FAIL").otherwise(gain)


def against_baseline(baseline: DataFrame, actual: DataFrame, key: str = KEY, signal: str = "telemetry_name", count_pct: float = 10.0, span_pct: float = 1.0, coverage_points: float = 5.0, rate_pct: float = 10.0) -> DataFrame:
    """key, signal, check, expected, actual, delta, status for samples, span, coverage (in points) and rate. Signals that
    either side lacks are skipped."""
    b, a = baseline.alias("b"), actual.alias("a")
    both = b.join(a, [key, signal]).select(key, signal, *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "ba" for c in ("sample_count", "span_sec", "coverage_pct", "hz_avg")])

    def check(name: str, column: str, delta: Column, limit: float, gain: str) -> Column:
        return F.struct(F.lit(name).alias("check"), F.col(f"b_{column}").cast("double").alias("expected"), F.col(f"a_{column}").cast("double").alias("actual"), delta.alias("delta"), _status(delta, limit, gain).alias("status"))

    pct = lambda c: delta_pct(F.col(f"b_{c}").cast("double"), F.col(f"a_{c}").cast("double"))
    checks = F.array(
        check("sample_count", "sample_count", pct("sample_count"), count_pct, "WARN"),
        check("time_coverage", "span_sec", pct("span_sec"), span_pct, "WARN"),
        check("signal_presence", "coverage_pct", F.col("a_coverage_pct") - F.col("b_coverage_pct"), coverage_points, "PASS"),
        check("sampling_rate", "hz_avg", pct("hz_avg"), rate_pct, "WARN"),
    )
    return both.select(key, signal, F.inline(checks))


def rolled_up(checks: DataFrame, key: str = KEY) -> DataFrame:
    """key, status: the worst, and how many checks passed."""
    rank = F.when(F.col("status") == "FAIL", 2).when(F.col("status") == "WARN", 1).otherwise(0)
    worst = F.max(rank)
    return checks.groupBy(key).agg(F.when(worst == 2, "FAIL").when(worst == 1, "WARN").otherwise("PASS").alias("status"), F.count(F.lit(1)).alias("checks"), F.count_if(F.col("status") == "PASS").alias("passed"))


def require(checks: DataFrame, strict: bool = True) -> DataFrame:
    """checks; with strict, ValidationError if any failed."""
    if strict:
        failed = checks.where(F.col("status") == "FAIL").limit(10).collect()
        if failed:
            raise ValidationError("; ".join(str(r.asDict()) for r in failed))
    return checks


# Expectations


@dataclass(frozen=True)
class Expectation:
    """measure: an aggregate; it holds if the measure is within low and high. A missing column fails."""

    name: str
    measure: Column
    low: float | None = None
    high: float | None = None
    columns: tuple[str, ...] = ()


def exists(column: str) -> Expectation:
    return Expectation(f"{column} exists", F.lit(1.0), 1.0, 1.0, (column,))


def has_type(df: DataFrame, column: str, kind: str) -> Expectation:
    return Expectation(f"{column} is {kind}", F.lit(float(dict(df.dtypes).get(column) == kind)), 1.0, 1.0, (column,))


def not_null(column: str, mostly: float = 1.0) -> Expectation:
    return Expectation(f"{column} not null", F.count(F.col(column)) / F.nullif(F.count(F.lit(1)), F.lit(0)), mostly, None, (column,))


def between(column: str, low: float | None, high: float | None) -> Expectation:
    inside = F.lit(True) if low is None else F.col(column) >= low
    inside = inside if high is None else inside & (F.col(column) <= high)
    return Expectation(f"{column} in range", F.count_if(F.coalesce(~inside, F.lit(False))).cast("double"), 0.0, 0.0, (column,))


def at_least_distinct(column: str, least: int) -> Expectation:
    return Expectation(f"distinct {column}", F.countDistinct(column).cast("double"), float(least), None, (column,))


def raw_suite(df: DataFrame) -> list[Expectation]:
    names = ("timestamp", "meta_time", "vehicle_id", "chassis_id", "car_no", "lap", "telemetry_name", "telemetry_value")
    return [*map(exists, names), has_type(df, "telemetry_value", "double"), not_null("chassis_id"), not_null("telemetry_name")]


def refined_suite(strict_parity: bool = False) -> list[Expectation]:
    """strict_parity: the least speed is asked of all signals' values, as the source does."""
    names = ("time_corrected", "chassis_id", "car_no", "lap_repaired", "segment_id", "telemetry_name", "telemetry_value")
    speed = F.col("telemetry_value") if strict_parity else F.when(F.col("telemetry_name") == "speed", F.col("telemetry_value"))
    least = Expectation("least speed", F.coalesce(F.min(speed), F.lit(0.0)), 0.0, None, ("telemetry_value",))
    return [*map(exists, names), not_null("chassis_id"), not_null("time_corrected"), least]


def simulation_suite(policy: Policy) -> list[Expectation]:
    names = ("time_global", "chassis_id", "car_no", "speed_final", "gear", "aps", "gps_lat", "gps_lon")
    return [
        *map(exists, names), *[not_null(c, 0.95) for c in ("time_global", "chassis_id", "speed_final", "gear")],
        between("speed_final", 0.0, 100.0), between("gear", -1.0, 10.0), between("aps", 0.0, 1.0), at_least_distinct("chassis_id", policy.min_cars),
    ]


SUITES = {"raw_curated": raw_suite, "refined": lambda df: refined_suite(), "simulation_ready": lambda df: simulation_suite(Policy())}


def suite(level: str, df: DataFrame) -> list[Expectation]:
    if level not in SUITES:
        raise ValueError(f"unknown level: {level}")
    return SUITES[level](df)


def report(df: DataFrame, expectations: list[Expectation]) -> DataFrame:
    """expectation, measured, passed for each; all are measured in one aggregation over df."""
    known = [(k, e) for k, e in enumerate(expectations) if all(c in df.columns for c in e.columns)]
    one = df.agg(F.count(F.lit(1)).alias("__n"), *[e.measure.cast("double").alias(f"m{k}") for k, e in known])
    there = {k for k, _ in known}

    def row(k: int, e: Expectation) -> Column:
        m = F.col(f"m{k}") if k in there else F.lit(None).cast("double")
        ok = F.lit(k in there)
        ok = ok if e.low is None else ok & (m >= e.low)
        ok = ok if e.high is None else ok & (m <= e.high)
        return F.struct(F.lit(e.name).alias("expectation"), m.alias("measured"), F.coalesce(ok, F.lit(False)).alias("passed"))

    return one.select(F.inline(F.array(*[row(k, e) for k, e in enumerate(expectations)])))


def pass_rate(found: DataFrame) -> DataFrame:
    return found.agg(F.count(F.lit(1)).alias("checks"), F.count_if("passed").alias("passed"), (100.0 * F.count_if("passed") / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("pass_rate"))


def entity_expectations(df: DataFrame, key: str = KEY, t_us: str = "t_us", columns: tuple[str, ...] = ("speed_final",), min_coverage_pct: float = 10.0, min_duration_sec: float = 1800.0) -> DataFrame:
    """key, coverage_pct (frames with any of the columns of all frames), duration_sec, and whether each is enough."""
    there = F.coalesce(*[F.col(c).cast("string") for c in columns]).isNotNull()
    frames = df.agg(F.countDistinct(t_us).alias("frames")).withColumn("__one", F.lit(1))
    per = df.groupBy(key).agg(F.countDistinct(F.when(there, F.col(t_us))).alias("present"), ((F.max(F.when(there, F.col(t_us))) - F.min(F.when(there, F.col(t_us)))) / 1e6).alias("duration_sec"))
    out = per.withColumn("__one", F.lit(1)).join(F.broadcast(frames), "__one").withColumn("coverage_pct", 100.0 * F.col("present") / F.col("frames"))
    out = out.withColumn("duration_sec", F.coalesce("duration_sec", F.lit(0.0)))
    return out.select(key, "coverage_pct", "duration_sec", (F.col("coverage_pct") >= min_coverage_pct).alias("coverage_ok"), (F.col("duration_sec") >= min_duration_sec).alias("duration_ok"))


# Policy


def range_checks(df: DataFrame, policy: Policy, signal: str = "telemetry_name", value: str = "telemetry_value") -> DataFrame:
    """signal, below, above, status for each signal with a range, from long readings in one pass."""
    v = F.col(value)
    limits = F.create_map(*[x for s, (lo, sl, hi, sh) in policy.ranges.items() for x in (F.lit(s), F.struct(F.lit(lo).cast("double").alias("lo"), F.lit(sl).alias("sl"), F.lit(hi).cast("double").alias("hi"), F.lit(sh).alias("sh")))])
    rows = df.withColumn("__l", limits[F.col(signal)]).where(F.col("__l").isNotNull())
    out = rows.groupBy(signal).agg(F.count_if(v < F.col("__l.lo")).alias("below"), F.count_if(v > F.col("__l.hi")).alias("above"), F.first("__l").alias("l"))
    worst = F.when(((F.col("below") > 0) & (F.col("l.sl") == "FAIL")) | ((F.col("above") > 0) & (F.col("l.sh") == "FAIL")), "FAIL").when((F.col("below") > 0) | (F.col("above") > 0), "WARN").otherwise("PASS")
    return out.select(signal, "below", "above", worst.alias("status"))


def nan_checks(df: DataFrame, policy: Policy, key: str = KEY) -> DataFrame:
    """key, signal, null_pct, status for the critical columns that df has."""
    columns = [c for c in policy.critical if c in df.columns]
    per = df.groupBy(key).agg(*[(100.0 * F.count_if(F.col(c).isNull()) / F.count(F.lit(1))).alias(c) for c in columns])
    rows = per.unpivot([key], columns, "signal", "null_pct")
    return rows.withColumn("status", F.when(F.col("null_pct") > policy.nan_fail_pct, "FAIL").when(F.col("null_pct") > policy.nan_warn_pct, "WARN").otherwise("PASS"))


def drift_checks(calibration: DataFrame, policy: Policy, key: str = KEY) -> DataFrame:
    std = F.max("drift_std")
    return calibration.groupBy(key).agg(std.alias("worst_std"), F.when(std > policy.drift_fail_std, "FAIL").when(std > policy.drift_warn_std, "WARN").otherwise("PASS").alias("status"))


def _graded(share: Column, fail: float) -> Column:
    return F.when(share > fail, "FAIL").when(share > 0, "WARN").otherwise("PASS")


def position_checks(df: DataFrame, policy: Policy, key: str = KEY, lat: str = "gps_lat", lon: str = "gps_lon", track: str = "track_distance_m") -> DataFrame:
    """key, missing_pct (rows with neither both coordinates nor a distance), status."""
    missing = 100.0 * F.count_if(~has_position(F.col(lat), F.col(lon), F.col(track))) / F.count(F.lit(1))
    return df.groupBy(key).agg(missing.alias("missing_pct")).withColumn("status", _graded(F.col("missing_pct"), policy.position_missing_fail_pct))


def lap_checks(df: DataFrame, policy: Policy, key: str = KEY, lap: str = "lap") -> DataFrame:
    """key, sentinel_pct (rows whose cycle number is the sentinel), laps (distinct others), status: FAIL for too many
    sentinels, WARN for any or for too few cycles."""
    sentinel = F.col(lap) == LAP_SENTINEL
    out = df.groupBy(key).agg((100.0 * F.count_if(sentinel) / F.count(F.lit(1))).alias("sentinel_pct"), F.countDistinct(F.when(~sentinel, F.col(lap))).alias("laps"))
    graded = _graded(F.col("sentinel_pct"), policy.lap_sentinel_fail_pct)
    return out.withColumn("status", F.when((graded == "PASS") & (F.col("laps") < policy.min_lap_count), "WARN").otherwise(graded))


def missing_signals(df: DataFrame, required: list[str], any_of: list[list[str]], key: str = KEY, signal: str = "telemetry_name") -> DataFrame:
    """key, missing (required signals that an entity lacks), ready (nothing missing and one of each alternative there)."""
    per = df.groupBy(key).agg(F.collect_set(F.when(F.col(signal).isin(required + sum(any_of, [])), F.col(signal))).alias("there"))
    missing = F.array_sort(F.array_except(F.array(*map(F.lit, required)), F.col("there")))
    ready = F.size(missing) == 0
    for group in any_of:
        ready = ready & F.arrays_overlap("there", F.array(*map(F.lit, group)))
    return per.select(key, F.concat_ws(",", missing).alias("missing"), ready.alias("ready"))
