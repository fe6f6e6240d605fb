"""Views of the test tables as sensor readings, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline.operators.reshape import pivoted

HOUR_US, GRID_HZ, GRID_US = 3_600_000_000, 1 / 21600, 21_600_000_000
DAY_MIN = 1440

R = """r AS (
  SELECT event_id AS row_id, epoch_us(ts) AS us, user_id, lpad(CAST(user_id % 20 AS VARCHAR), 6, '0') AS chassis_id,
         CAST(user_id % 100 AS VARCHAR) AS car_no,
         'GR86-' || lpad(CAST(user_id % 20 AS VARCHAR), 6, '0') || '-' || CAST(user_id % 100 AS VARCHAR) AS vehicle_id,
         event_type AS name, value, epoch_us(ts) + CAST(round(value * 100000) AS BIGINT) AS meta_us,
         CASE WHEN CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) % 10 = 0 THEN 32768 ELSE day(ts) END AS lap
  FROM events)"""
W = (
    R
    + """, w AS (
  SELECT chassis_id, us // 3600000000 * 3600000000 AS t_us,
         arg_min(value, row_id) FILTER (name = 'click') AS speed, arg_min(value, row_id) FILTER (name = 'view') AS aps,
         least(arg_min(value, row_id) FILTER (name = 'purchase') * 30, 3700.0) AS track_distance_m,
         33.49 + arg_min(value, row_id) FILTER (name = 'signup') / 1000 AS gps_lat,
         -86.66 + arg_min(value, row_id) FILTER (name = 'error') / 1000 AS gps_lon,
         min(lap) AS lap, min(row_id) AS row_id
  FROM r GROUP BY 1, 2)"""
)
G = (
    W
    + """, b AS (SELECT chassis_id, min(t_us) AS lo, max(t_us) AS hi FROM w GROUP BY 1),
 ticks AS (SELECT chassis_id, unnest(generate_series(0, (hi - lo) // 21600000000)) AS tick, lo FROM b),
 placed AS (SELECT w.*, CAST(round((t_us - lo) / 21600000000.0) AS BIGINT) AS tick FROM w JOIN b USING (chassis_id)),
 firsts AS (SELECT chassis_id, tick, arg_min(row_id, t_us) AS row_id FROM placed GROUP BY 1, 2),
 g AS (
  SELECT t.chassis_id, t.tick, t.lo + t.tick * 21600000000 AS t_us, w.speed, w.aps, w.track_distance_m, w.gps_lat, w.gps_lon, w.lap
  FROM ticks t LEFT JOIN firsts f USING (chassis_id, tick) LEFT JOIN w ON w.chassis_id = f.chassis_id AND w.row_id = f.row_id)"""
)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    ts = F.col("ts").cast("timestamp")
    chassis = F.lpad((F.col("user_id") % 20).cast("string"), 6, "0")
    car = (F.col("user_id") % 100).cast("string")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("long")
    return e.select(
        F.col("event_id").alias("row_id"), ts.alias("timestamp"), "user_id", chassis.alias("chassis_id"), car.alias("car_no"),
        F.concat(F.lit("GR86-"), chassis, F.lit("-"), car).alias("vehicle_id"), F.col("event_type").alias("telemetry_name"), F.col("value").alias("telemetry_value"),
        F.timestamp_micros(F.unix_micros(ts) + F.round(F.col("value") * 100000).cast("long")).alias("meta_time"),
        F.when(k % 10 == 0, 32768).otherwise(F.dayofmonth(ts)).alias("lap"),
    )


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each chassis and hour."""
    r = readings(spark, sf_dir).withColumn("t_us", F.expr(f"unix_micros(timestamp) div {HOUR_US} * {HOUR_US}"))
    names = ("click", "view", "purchase", "signup", "error")
    p = pivoted(r, ["chassis_id", "t_us"], names)
    counters = r.groupBy("chassis_id", "t_us").agg(F.min("lap").alias("lap"), F.min("row_id").alias("row_id"))
    p = p.join(counters, ["chassis_id", "t_us"])
    return p.select(
        "chassis_id", "t_us", F.timestamp_micros("t_us").alias("time_corrected"), F.col("click").alias("speed"), F.col("view").alias("aps"),
        F.least(F.col("purchase") * 30, F.lit(3700.0)).alias("track_distance_m"), (33.49 + F.col("signup") / 1000).alias("gps_lat"), (-86.66 + F.col("error") / 1000).alias("gps_lon"), "lap", "row_id",
    )


def line(spark: SparkSession, n: int = 200) -> DataFrame:
    """An oval of n points, line center."""
    a = F.col("id") * (2 * 3.141592653589793 / n)
    return spark.range(n).select(F.lit("center").alias("line"), F.col("id").cast("int").alias("idx"), (F.cos(a) * 500).alias("x"), (F.sin(a) * 300).alias("y"))


L = """l AS (SELECT CAST(i AS INTEGER) AS idx, cos(i * (2 * 3.141592653589793 / 200)) * 500 AS x, sin(i * (2 * 3.141592653589793 / 200)) * 300 AS y FROM generate_series(0, 199) AS s(i))"""
