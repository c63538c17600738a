"""Summary tables per line, hour, stop, segment and grid cell.

All are single-pass aggregates with a map-side partial step, so a
hot line or stop is pre-reduced before the shuffle.  Averages and medians of
rounded inputs use exact integer grids (see ``functions.scalar``).  Table
materialisations do not sort (row order of a stored table is not a Spark
guarantee); the top-k reports in ``reports`` sort explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramspark.functions.scalar import (
    avg_of_scaled, code_label, duck_round, median_of_scaled, pct_where, time_bucket,
)

# Vehicle type codes and their labels.
MODE_LABELS = {1: "Bus", 2: "Tram"}


def line_speed(moves: DataFrame, min_n: int = 5) -> DataFrame:
    """Per line: measurements, average, minimum and maximum speed."""
    g = moves.groupBy("line").agg(
        F.count(F.lit(1)).alias("num_measurements"),
        duck_round(avg_of_scaled("speed_kmh", 1), 1).alias("avg_speed_kmh"),
        duck_round(F.min("speed_kmh"), 1).alias("min_speed_kmh"),
        duck_round(F.max("speed_kmh"), 1).alias("max_speed_kmh"))
    return g.filter(F.col("num_measurements") >= F.lit(min_n))


def speed_by_hour(moves: DataFrame, min_n: int = 10) -> DataFrame:
    """Per line and hour: measurements, average and median speed, % below 5 km/h."""
    g = moves.groupBy("line", F.hour("vehicle_time").cast("bigint").alias("hour_of_day")).agg(
        F.count(F.lit(1)).alias("measurements"),
        duck_round(avg_of_scaled("speed_kmh", 1), 1).alias("avg_speed_kmh"),
        duck_round(median_of_scaled("speed_kmh", 1), 1).alias("median_speed_kmh"),
        duck_round(pct_where(F.col("speed_kmh") < F.lit(5.0)), 1).alias("pct_crawling"))
    return g.filter(F.col("measurements") >= F.lit(min_n))


def speed_grid(moves: DataFrame, lat_step: float = 0.0027, lon_step: float = 0.0044, min_n: int = 20,
               max_crawl_pct: float = 80.0) -> DataFrame:
    """Speeds snapped to a ~300 m grid; cells with enough passes that are not
    mostly stationary (depots, terminals)."""
    binned = moves.select(
        (duck_round(F.col("lat") / F.lit(lat_step), 0) * F.lit(lat_step)).alias("cell_lat"),
        (duck_round(F.col("lon") / F.lit(lon_step), 0) * F.lit(lon_step)).alias("cell_lon"),
        "speed_kmh", "vehicle_type")
    g = binned.groupBy("cell_lat", "cell_lon").agg(
        F.count(F.lit(1)).alias("observations"),
        duck_round(avg_of_scaled("speed_kmh", 1), 1).alias("avg_speed_kmh"),
        duck_round(median_of_scaled("speed_kmh", 1), 1).alias("median_speed_kmh"),
        pct_where(F.col("speed_kmh") < F.lit(5.0)).alias("_crawl"),
        F.count_distinct("vehicle_type").alias("modes"))
    g = g.filter((F.col("observations") >= F.lit(min_n)) & (F.col("_crawl") <= F.lit(float(max_crawl_pct))))
    return g.select("cell_lat", "cell_lon", "observations", "avg_speed_kmh", "median_speed_kmh",
                    duck_round("_crawl", 1).alias("pct_crawling"), "modes")


def line_punctuality(matches: DataFrame, min_n: int = 10, on_time_min: float = 1.0,
                     late_min: float = 3.0) -> DataFrame:
    """Per line: average and median delay; % on time (|d| <= 1), late (> 3), early (< -3)."""
    d = F.col("delay_minutes")
    g = matches.groupBy("line").agg(
        F.count(F.lit(1)).alias("measurements"),
        duck_round(avg_of_scaled(d, 1), 2).alias("avg_delay_min"),
        duck_round(median_of_scaled(d, 1), 2).alias("median_delay_min"),
        duck_round(pct_where((d <= F.lit(on_time_min)) & (d >= F.lit(-on_time_min))), 1).alias("pct_on_time"),
        duck_round(pct_where(d > F.lit(late_min)), 1).alias("pct_late"),
        duck_round(pct_where(d < F.lit(-late_min)), 1).alias("pct_early"))
    return g.filter(F.col("measurements") >= F.lit(min_n))


def punctuality_by_hour(matches: DataFrame, min_n: int = 30, late_min: float = 3.0) -> DataFrame:
    """Per hour of day: average and median delay, % late, mean absolute deviation."""
    d = F.col("delay_minutes")
    g = matches.groupBy(F.hour("actual_time").cast("bigint").alias("hour_of_day")).agg(
        F.count(F.lit(1)).alias("measurements"),
        duck_round(avg_of_scaled(d, 1), 2).alias("avg_delay_min"),
        duck_round(median_of_scaled(d, 1), 2).alias("median_delay_min"),
        duck_round(pct_where(d > F.lit(late_min)), 1).alias("pct_late"),
        duck_round(avg_of_scaled(F.abs(d), 1), 2).alias("avg_abs_deviation_min"))
    return g.filter(F.col("measurements") >= F.lit(min_n))


def worst_stops(matches: DataFrame, stops: DataFrame, min_n: int = 15, late_min: float = 3.0) -> DataFrame:
    """Per stop: measurements, lines served, average and maximum delay, % late.

    Matches are aggregated per stop *before* the join with the stops
    dimension (same result as join-then-group, far fewer rows joined).
    """
    d = F.col("delay_minutes")
    g = matches.groupBy("stop_id", "stop_name").agg(
        F.count(F.lit(1)).alias("measurements"),
        F.count_distinct("line").alias("lines_served"),
        duck_round(avg_of_scaled(d, 1), 2).alias("avg_delay_min"),
        duck_round(F.max(d), 2).alias("max_delay_min"),
        duck_round(pct_where(d > F.lit(late_min)), 1).alias("pct_late"))
    g = g.filter(F.col("measurements") >= F.lit(min_n))
    s = stops.select("stop_id", "stop_lat", "stop_lon")
    return g.join(s, "stop_id").select("stop_id", "stop_name", "stop_lat", "stop_lon", "measurements",
                                       "lines_served", "avg_delay_min", "max_delay_min", "pct_late")


def line_regularity(headway: DataFrame, min_n: int = 20, max_avg_minutes: float = 20.0) -> DataFrame:
    """Per line: headway average, median, standard deviation, % bunched and the
    coefficient of variation; frequent services only."""
    h = F.col("headway_minutes")
    avg_h = avg_of_scaled(h, 2)
    sd = F.stddev_samp(h)
    g = headway.groupBy("line").agg(
        F.count(F.lit(1)).alias("observations"),
        avg_h.alias("_avg"),
        duck_round(median_of_scaled(h, 2), 2).alias("median_headway_min"),
        sd.alias("_sd"),
        duck_round(pct_where(F.col("is_bunched")), 1).alias("pct_bunched"))
    g = g.filter((F.col("observations") >= F.lit(min_n)) & (F.col("_avg") <= F.lit(float(max_avg_minutes))))
    return g.select(
        "line", "observations",
        duck_round("_avg", 2).alias("avg_headway_min"),
        "median_headway_min",
        duck_round("_sd", 2).alias("headway_stddev"),
        "pct_bunched",
        duck_round(F.col("_sd") / F.when(F.col("_avg") != F.lit(0.0), F.col("_avg")), 2).alias("irregularity_index"))


def slowest_segments(segments: DataFrame, min_n: int = 5, over_min: float = 1.0) -> DataFrame:
    """Per (line, from, to): average actual, scheduled and lost minutes, worst
    loss, % of runs more than ``over_min`` minutes over schedule."""
    g = segments.groupBy("line", "from_stop", "to_stop").agg(
        F.count(F.lit(1)).alias("observations"),
        duck_round(avg_of_scaled("actual_minutes", scale=60), 2).alias("avg_actual_min"),
        duck_round(avg_of_scaled("scheduled_minutes", scale=60), 2).alias("avg_scheduled_min"),
        duck_round(avg_of_scaled("lost_minutes", 2), 2).alias("avg_lost_min"),
        duck_round(F.max("lost_minutes"), 2).alias("worst_lost_min"),
        duck_round(pct_where(F.col("lost_minutes") > F.lit(over_min)), 1).alias("pct_runs_over_schedule"))
    return g.filter(F.col("observations") >= F.lit(min_n))


def latest_day(positions: DataFrame) -> DataFrame:
    """Positions of the most recent collected date.

    The date is a 1-row aggregate: a scalar subquery on a date-partitioned
    table (partition pruning), otherwise a broadcast 1-row join."""
    if "vehicle_date" in positions.columns:
        # date-partitioned input: a scalar subquery on the partition column is
        # evaluated first and prunes the scan to the latest partition
        last = positions.agg(F.max("vehicle_date")).scalar()
        return positions.filter(F.col("vehicle_date") == last)
    last = positions.agg(F.max(F.to_date("vehicle_time")).alias("__d"))
    return positions.join(F.broadcast(last), F.to_date(positions["vehicle_time"]) == F.col("__d")).drop("__d")


def animation_frames(positions: DataFrame, frame_minutes: int = 15, latest_only: bool = True) -> DataFrame:
    """One position per vehicle per ``frame_minutes`` frame (its earliest ping)."""
    p = latest_day(positions) if latest_only else positions
    p = p.withColumn("frame_time", time_bucket("vehicle_time", frame_minutes))
    g = p.groupBy("vehicle_number", "frame_time").agg(
        F.min(F.struct("vehicle_time", "line", "vehicle_type", "lat", "lon")).alias("f"))
    return g.select(
        "frame_time",
        F.date_format("frame_time", "HH:mm").alias("frame_label"),
        F.hour("frame_time").cast("bigint").alias("hour_of_day"),
        "vehicle_number",
        F.col("f.line").alias("line"),
        code_label(F.col("f.vehicle_type"), MODE_LABELS, "Other").alias("mode"),
        F.col("f.lat").alias("lat"), F.col("f.lon").alias("lon"))
