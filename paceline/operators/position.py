"""Positions: bounds, jumps, interpolation, quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.config import Circuit
from paceline.functions.blocks import bridged, rows_only, time_block, window
from paceline.functions.scalar import micros, position_quality, quality_rating, true_or_false, within
from paceline.functions.windows import between, jump_m, up_to_here


def cleaned(df: DataFrame, circuit: Circuit, key: str = "chassis_id", ts: str = "time_corrected", order: str = "row_id", max_jump_m: float = 500.0, interpolate: bool = True, max_gap_sec: float | None = None, strict_parity: bool = False) -> DataFrame:
    """gps_lat and gps_lon without values out of bounds (each on its own) and jumps (both), then interpolated, with the flags
    lat_ok, lon_ok and is_outlier. Interpolation: linear in time and not across max_gap_sec if that is given, else linear in
    the row's place, edges filled. strict_parity measures jumps as the source does."""
    at, block = [ts, order], time_block(F.col(ts))
    w, lat, lon = window(key, *at), F.col("gps_lat"), F.col("gps_lon")
    out = df.withColumns({"lat_ok": within(lat, circuit.lat_min, circuit.lat_max), "lon_ok": within(lon, circuit.lon_min, circuit.lon_max)})
    out = out.withColumns({"gps_lat": F.when(F.col("lat_ok"), lat), "gps_lon": F.when(F.col("lon_ok"), lon)})
    out = bridged(out, key, at, block, last=("gps_lat", "gps_lon"))
    out = rows_only(out.withColumn("is_outlier", true_or_false(jump_m(lat, lon, w, strict_parity) > max_jump_m)))
    out = out.withColumns({c: F.when(~F.col("is_outlier"), F.col(c)) for c in ("gps_lat", "gps_lon")})
    if not interpolate:
        return out
    if max_gap_sec is None:
        out = bridged(out.withColumn("__i", F.lit(1).cast("long")), key, at, block, sums=("__i",))
        out = rows_only(out.withColumn("__i", F.sum("__i").over(up_to_here(w))))
    else:
        out = out.withColumn("__i", micros(F.col(ts)))
    out = out.withColumns({f"__{c}": F.when(F.col(c).isNotNull(), F.struct(F.col("__i").alias("i"), F.col(c).alias("v"))) for c in ("gps_lat", "gps_lon")})
    out = bridged(out, key, at, block, known=("__gps_lat", "__gps_lon"))
    gap = None if max_gap_sec is None else F.lit(max_gap_sec * 1e6)
    filled = {c: between(F.col(c), F.col("__i"), F.col(f"__{c}"), w, max_gap_sec is None, gap) for c in ("gps_lat", "gps_lon")}
    return rows_only(out.withColumns(filled)).drop("__i", "__gps_lat", "__gps_lon")


def quality(raw: DataFrame, clean: DataFrame, key: str = "chassis_id") -> DataFrame:
    """key, coverage of GPS and track distance, outliers, out of bounds, interpolated, score, rating."""
    n = F.count(F.lit(1))
    before = raw.groupBy(key).agg(n.alias("n_rows"), F.count("gps_lat").alias("gps_before"), F.count("track_distance_m").alias("lapdist"))
    there = F.col("gps_lat").isNotNull() & F.col("gps_lon").isNotNull()
    after = clean.groupBy(key).agg(F.count_if(there).alias("gps_after"), F.count_if("is_outlier").alias("outliers"), F.count_if(~F.col("lat_ok") | ~F.col("lon_ok")).alias("out_of_bounds"))
    pct = lambda c: 100.0 * F.col(c) / F.col("n_rows")
    score = position_quality(*map(F.col, ("gps_after", "lapdist", "outliers", "out_of_bounds")), of=F.col("n_rows"))
    out = before.join(after, key).withColumns({"gps_pct": pct("gps_after"), "lapdist_pct": pct("lapdist"), "interpolated": F.greatest(F.col("gps_after") - F.col("gps_before"), F.lit(0)), "score": score})
    return out.withColumn("rating", quality_rating(F.col("score")))
