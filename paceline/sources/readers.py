"""Readers of every layer. All are lazy scans: filters and columns reach the files."""

from __future__ import annotations

import fnmatch
import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paceline.operators.reshape import pivoted
from paceline.schema import RAW, REQUIRED, require_columns

#: Partition values are texts: 004 must not become 4.
PARTITION_TYPES = "spark.sql.sources.partitionColumnTypeInference.enabled"


def read_csv(spark: SparkSession, path: str, schema: T.StructType = RAW, strict: bool = True) -> DataFrame:
    """Long readings from CSV files. Columns are matched by the header's names; missing required ones raise ValueError; with
    strict, broken rows fail the read instead of becoming NULLs."""
    header = spark.read.option("header", True).csv(path).columns
    require_columns(type("Header", (), {"columns": header})(), REQUIRED)
    known = {f.name: f for f in schema.fields}
    given = T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in header])
    return spark.read.schema(given).option("header", True).option("mode", "FAILFAST" if strict else "PERMISSIVE").csv(path)


def _partitioned(spark: SparkSession, root: str) -> DataFrame:
    was = spark.conf.get(PARTITION_TYPES)
    spark.conf.set(PARTITION_TYPES, "false")
    try:
        return spark.read.parquet(root)
    finally:
        spark.conf.set(PARTITION_TYPES, was)


def read_curated(spark: SparkSession, root: str, event: str | None = None, chassis: list[str] | None = None, signals: list[str] | None = None) -> DataFrame:
    """Readings partitioned by event, chassis_id and telemetry_name; each argument prunes partitions."""
    df = _partitioned(spark, root)
    df = df if event is None else df.where(F.col("event") == event)
    df = df if chassis is None else df.where(F.col("chassis_id").isin(chassis))
    return df if signals is None else df.where(F.col("telemetry_name").isin(signals))


def read_refined(spark: SparkSession, root: str, chassis: list[str] | None = None) -> DataFrame:
    """Readings with columns of later layers: time_corrected, lap_repaired and segment_id stand in where they are missing."""
    df = read_curated(spark, root, chassis=chassis)
    stand_in = {"time_corrected": F.col("timestamp"), "lap_repaired": F.col("lap"), "segment_id": F.lit(0)}
    return df.withColumns({c: x for c, x in stand_in.items() if c not in df.columns})


def read_wide(spark: SparkSession, root: str, event: str | None = None, chassis: list[str] | None = None) -> DataFrame:
    """A row for each chassis and time, a column for each signal, and the cycle number of any of its readings."""
    df = read_curated(spark, root, event, chassis)
    index = ["chassis_id", "timestamp", "meta_time"]
    laps = df.groupBy(*index).agg(F.min("lap").alias("lap"))
    ordered = df.withColumn("row_id", F.monotonically_increasing_id()) if "row_id" not in df.columns else df
    return pivoted(ordered, index).join(laps, index)


def read_entities(spark: SparkSession, path: str, entities: list[str] | None = None, required: tuple[str, ...] = (), column: str = "chassis_id") -> DataFrame:
    """A synchronised table, of some entities; ValueError if it has none of them or lacks a column."""
    df = require_columns(spark.read.parquet(path), required)
    df = df if entities is None else df.where(F.col(column).isin(entities))
    if not df.limit(1).count():
        raise ValueError("no rows of these entities")
    return df


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_document(spark: SparkSession, path: str) -> dict:
    """A small JSON document as a dictionary, through Spark's file systems."""
    rows = spark.read.option("wholetext", True).text(path).limit(1).collect()
    if not rows:
        raise FileNotFoundError(path)
    return json.loads(rows[0].value)


def read_baseline(spark: SparkSession, path: str) -> DataFrame:
    """chassis_id, telemetry_name and the numbers of a stored baseline, a row for each signal of cars{}.signals{}."""
    signal = T.StructType([T.StructField(c, T.DoubleType()) for c in ("sample_count", "coverage_pct", "time_span_sec", "hz_avg")])
    cars = T.MapType(T.StringType(), T.StructType([T.StructField("time_span_sec", T.DoubleType()), T.StructField("signals", T.MapType(T.StringType(), signal))]))
    df = read_json(spark, path, T.StructType([T.StructField("cars", cars)]))
    per = df.select(F.explode("cars").alias("chassis_id", "car")).select("chassis_id", F.explode("car.signals").alias("telemetry_name", "s"))
    return per.select("chassis_id", "telemetry_name", "s.sample_count", "s.coverage_pct", F.col("s.time_span_sec").alias("span_sec"), "s.hz_avg")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """line, idx, x, y from a JSON document of lists of points."""
    df = read_json(spark, path, T.StructType([T.StructField("ribbons", T.MapType(T.StringType(), T.ArrayType(T.ArrayType(T.DoubleType()))))]))
    return df.select(F.explode("ribbons").alias("line", "points")).select("line", F.posexplode("points").alias("idx", "p")).select("line", "idx", F.col("p")[0].alias("x"), F.col("p")[1].alias("y"))


def files(spark: SparkSession, root: str, pattern: str = "*", max_depth: int | None = None) -> DataFrame:
    """path, size_mb, sha256 of the files under a folder: contents are hashed by the executors."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    base = root.split(":", 1)[-1].strip("/")
    deep = F.size(F.split(F.element_at(F.split("path", re.escape(base), 2), -1), "/")) - 2
    df = df if max_depth is None else df.where(deep <= max_depth)
    return df.select("path", (F.col("length") / (1 << 20)).alias("size_mb"), F.sha2("content", 256).alias("sha256"))


def position_columns(columns: list[str]) -> list[str]:
    """Columns whose names speak of positions."""
    return [c for c in columns if any(fnmatch.fnmatch(c.lower(), f"*{k}*") for k in ("gps", "lat", "lon", "vbox"))]
