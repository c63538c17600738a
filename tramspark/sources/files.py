"""File scans and sinks for positions and timetable feeds.

Scans declare their schema (nothing is inferred) so Catalyst can prune
columns and push filters into the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramspark.sources.schemas import GTFS_COLUMNS, POSITION_SCHEMA, POSITION_TEXT_SCHEMA


def read_positions_csv(spark: SparkSession, paths) -> DataFrame:
    """Headerless CSV drops, all columns text, names declared by position."""
    return (spark.read.schema(POSITION_TEXT_SCHEMA)
            .option("header", False)
            .option("escape", '"')
            .option("mode", "PERMISSIVE")
            .csv(paths))


def read_positions_parquet(spark: SparkSession, paths) -> DataFrame:
    """Typed Parquet batches (one file per collector flush)."""
    return spark.read.schema(POSITION_SCHEMA).parquet(*([paths] if isinstance(paths, str) else paths))


def read_gtfs(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """Headered timetable text file, every column text, bound by name.

    No schema is passed (it would bind by position) and inference stays off
    because ids such as 'R-1300' or 'M1' would break it.
    """
    df = (spark.read.option("header", True)
          .option("inferSchema", False)
          .option("escape", '"')
          .csv(path))
    if table:
        df = df.select(*GTFS_COLUMNS[table])
    return df


def drop_header_rows(df: DataFrame, column: str = "fetch_time") -> DataFrame:
    """Remove header lines that ended up inside data files (and NULL keys)."""
    return df.filter(F.col(column) != F.lit(column))


def coerce_position_types(df: DataFrame) -> DataFrame:
    """Ingest coercion: ids to text, type to integer or NULL, lat/lon to double.

    Text timestamps go through the lenient parser (a bad cell becomes NULL
    instead of failing the job under ANSI casts)."""
    from tramspark.functions.scalar import try_timestamp
    types = dict(df.dtypes)

    def ts(c):
        return try_timestamp(c) if types.get(c) == "string" else F.col(c).cast("timestamp_ntz")

    return df.select(
        ts("fetch_time").alias("fetch_time"),
        F.col("vehicle_number").cast("string").alias("vehicle_number"),
        F.col("line").cast("string").alias("line"),
        F.col("brigade").cast("string").alias("brigade"),
        F.col("vehicle_type").try_cast("tinyint").alias("vehicle_type"),
        F.col("lat").try_cast("double").alias("lat"),
        F.col("lon").try_cast("double").alias("lon"),
        ts("vehicle_time").alias("vehicle_time"),
    )


def write_positions_batch(df: DataFrame, path: str, partition_by: str | None = "vehicle_date") -> None:
    """Append a typed batch as zstd Parquet, partitioned by the ping's date.

    Date partitions let later date filters and semi-joins prune whole folders.
    """
    out = coerce_position_types(df)
    if partition_by:
        out = out.withColumn(partition_by, F.to_date("vehicle_time")).hint("rebalance", partition_by)
        out.write.mode("append").option("compression", "zstd").partitionBy(partition_by).parquet(path)
    else:
        out.write.mode("append").option("compression", "zstd").parquet(path)


def landing_stats(df: DataFrame) -> DataFrame:
    """File-level landing statistics from the hidden ``_metadata`` column.

    One row: files, total bytes, newest modification time, rows.  Input is a
    file-based DataFrame (``spark.read.parquet(dir)``).
    """
    files = (df.select(F.col("_metadata.file_path").alias("p"),
                       F.col("_metadata.file_size").alias("sz"),
                       F.col("_metadata.file_modification_time").alias("mt"))
             .groupBy("p").agg(F.max("sz").alias("sz"), F.max("mt").alias("mt"), F.count(F.lit(1)).alias("n")))
    return files.agg(F.count(F.lit(1)).alias("files"),
                     F.coalesce(F.sum("sz"), F.lit(0)).cast("bigint").alias("total_bytes"),
                     F.max("mt").alias("newest_modified"),
                     F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"))


def check_freshness(df: DataFrame, now, max_age_seconds: int = 3600,
                    min_bytes: int = 10_000, min_rows: int | None = None) -> dict:
    """Landing gate: raise if nothing landed recently or the drop is too small.

    Collects a single aggregate row (the only driver-side read here).
    """
    row = landing_stats(df).first()
    stats = row.asDict()
    newest = stats["newest_modified"]
    problems = []
    if newest is None or (now - newest.replace(tzinfo=None)).total_seconds() > max_age_seconds:
        problems.append(f"no file modified in the last {max_age_seconds} s")
    if stats["total_bytes"] < min_bytes:
        problems.append(f"only {stats['total_bytes']} bytes landed (< {min_bytes})")
    if min_rows is not None and stats["rows"] < min_rows:
        problems.append(f"only {stats['rows']} rows landed (< {min_rows})")
    if problems:
        raise RuntimeError("landing check failed: " + "; ".join(problems))
    return stats
