"""Schemas of the layers, the signals and the enumerations."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and signal names of the source format.
REQUIRED = ("timestamp", "meta_time", "vehicle_id", "lap", "telemetry_name", "telemetry_value")
OPTIONAL = ("meta_event", "meta_session", "meta_source", "outing", "vehicle_number", "original_vehicle_id", "expire_at")
SIGNALS = ("speed", "Steering_Angle", "aps", "pbrake_f", "pbrake_r", "gear", "nmot", "accx_can", "accy_can", "VBOX_Long_Minutes", "VBOX_Lat_Min", "Laptrigger_lapdist_dls")
RENAMES = {"VBOX_Lat_Min": "gps_lat", "VBOX_Long_Minutes": "gps_lon", "Laptrigger_lapdist_dls": "track_distance_m"}
DISCRETE = ("gear", "lap_repaired", "segment_id", "chassis_id", "car_no")
LAP_SENTINEL = 32768
BOUNDARY_REASONS = ("lapdist_reset", "lap_increment", "unknown")
SEVERITIES = ("PASS", "WARN", "FAIL")

RAW = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("meta_time", T.TimestampType()),
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("lap", T.IntegerType()),
        T.StructField("telemetry_name", T.StringType()),
        T.StructField("telemetry_value", T.DoubleType()),
        *[T.StructField(c, T.StringType()) for c in OPTIONAL],
    ]
)


def require_columns(df, required=REQUIRED):
    """df, if it has all required columns; else ValueError that names the missing ones."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df
