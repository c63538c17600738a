"""Declared schemas of the inputs (no inference anywhere)."""

from pyspark.sql import types as T

# Column order of a position record (CSV files carry no header).
POSITION_COLUMNS = [
    "fetch_time", "vehicle_number", "line", "brigade",
    "vehicle_type", "lat", "lon", "vehicle_time",
]

# Typed Parquet batches written by the collector.
POSITION_SCHEMA = T.StructType([
    T.StructField("fetch_time", T.TimestampNTZType()),
    T.StructField("vehicle_number", T.StringType()),
    T.StructField("line", T.StringType()),
    T.StructField("brigade", T.StringType()),
    T.StructField("vehicle_type", T.ByteType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("vehicle_time", T.TimestampNTZType()),
])

# Legacy CSV drops: the same columns, all text.
POSITION_TEXT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in POSITION_COLUMNS])

# Timetable files: only the columns the models read (all text).
GTFS_COLUMNS = {
    "stops": ["stop_id", "stop_name", "stop_lat", "stop_lon", "town_name"],
    "routes": ["route_id", "route_short_name", "route_long_name", "route_type"],
    "trips": ["trip_id", "route_id", "service_id", "block_short_name", "trip_headsign", "direction_id"],
    "stop_times": ["trip_id", "stop_sequence", "stop_id", "arrival_time"],
}

# Cleaned positions (output of clean_positions).
CLEAN_POSITION_COLUMNS = [
    "fetch_time", "vehicle_time", "vehicle_number", "line", "brigade",
    "vehicle_type", "lat", "lon",
]
