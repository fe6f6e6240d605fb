"""Writers of every layer. Appends never overwrite: Spark's file names are unique."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_FILE = 1_000_000


def write_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "append", compression: str = "snappy", rows_per_file: int = ROWS_PER_FILE) -> None:
    """Parquet by partitions. Rows of a partition are brought together first, by a rebalance that splits large ones, so each
    gets few files and none waits for one task."""
    if by:
        df = df.hint("rebalance", *[F.col(c) for c in by])
    writer = df.write.mode(mode).option("compression", compression).option("maxRecordsPerFile", rows_per_file)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_curated(df: DataFrame, path: str, event: str, **options) -> None:
    write_partitioned(df.withColumn("event", F.lit(event)), path, ["event", "chassis_id", "telemetry_name"], **options)


def write_refined(df: DataFrame, path: str, event: str, by_segment: bool = False, **options) -> None:
    write_partitioned(df.withColumn("event", F.lit(event)), path, ["event", "chassis_id", *["segment_id"] * by_segment, "telemetry_name"], **options)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", skip_empty: bool = False) -> bool:
    """A report or a layer without partitions; skip_empty writes nothing for no rows. Whether it was written."""
    if skip_empty and not df.limit(1).count():
        return False
    df.write.mode(mode).parquet(path)
    return True


def write_synchronised(df: DataFrame, path: str, partitioned: bool = False, key: str = "chassis_id") -> None:
    write_partitioned(df, path, [key] if partitioned else [], mode="overwrite")


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines; timestamps as ISO text, numbers as numbers."""
    df.write.mode(mode).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").json(path)


def joined_lists(df: DataFrame, columns: list[str]) -> DataFrame:
    """Lists as text, for reports: a, b, c joined by commas."""
    return df.withColumns({c: F.concat_ws(",", F.col(c)) for c in columns})
