"""Visits and headway between consecutive vehicles at a stop."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramspark.functions.scalar import duck_round, seconds_between
from tramspark.operators.windows import (
    KIND,
    OLD,
    kept_rows,
    ordered_lag,
    ordered_running_sum,
    piece_columns,
    repeated_rows,
    touched_lag,
    with_old,
)

VISIT_KEYS = ["line", "stop_id", "vehicle_number"]
HEADWAY_KEYS = ["line", "stop_id"]


def stop_visits(matches: DataFrame, gap_s: int = 600, only: DataFrame | None = None) -> DataFrame:
    """Collapse repeated pings of a vehicle at a stop into visits.

    A ping starts a new visit when it is the vehicle's first at that
    (line, stop) or comes more than ``gap_s`` seconds (strict) after the
    previous one.  A visit's arrival is its earliest ping, which is exactly
    the ping that starts it, so visits are the starting pings.  (Visits are
    grouped by stop_name too; a stop id carries one name - the stops
    dimension is unique on stop_id, a declared quality check.)  ``only`` limits
    the result to touched pieces of history (``windows.touched_buckets``).
    """
    pings = matches.select("line", "stop_id", "stop_name", "vehicle_number", "actual_time")
    lagged = ordered_lag(pings, keys=VISIT_KEYS, order=["actual_time"],
                         values={"prev_ping": "actual_time"}, limit_seconds=gap_s, only=only)
    new_visit = F.col("prev_ping").isNull() | (seconds_between("prev_ping", "actual_time") > F.lit(int(gap_s)))
    # No DISTINCT (and its shuffle) is needed first: of two identical pings
    # only one can start a visit, the other sees a 0 s gap to its twin.
    return lagged.filter(new_visit).select(
        "line", "stop_id", "stop_name", "vehicle_number", F.col("actual_time").alias("arrival_time"))


def visit_numbers(matches: DataFrame, gap_s: int = 600) -> DataFrame:
    """Every matched ping with its new-visit flag (first ping, or more than
    ``gap_s`` seconds after the previous one at the same line and stop) and
    its visit number: the running count of flags (the island id)."""
    pings = matches.select("line", "stop_id", "stop_name", "vehicle_number", "actual_time").distinct()
    lagged = ordered_lag(pings, keys=["line", "stop_id", "vehicle_number"], order=["actual_time"],
                         values={"prev_ping": "actual_time"}, limit_seconds=gap_s)
    flagged = lagged.withColumn(
        "is_new_visit",
        F.when(F.col("prev_ping").isNull()
               | (seconds_between("prev_ping", "actual_time") > F.lit(int(gap_s))), F.lit(1)).otherwise(F.lit(0)))
    numbered = ordered_running_sum(flagged, ["line", "stop_id", "vehicle_number"], ["actual_time"],
                                   "is_new_visit", "visit_id")
    return numbered.select("line", "stop_id", "stop_name", "vehicle_number", "actual_time", "is_new_visit",
                           F.col("visit_id").cast("bigint").alias("visit_id"))


def headway_from_visits(visits: DataFrame, min_minutes: float = 0.1, max_minutes: float = 120.0,
                        bunched_below: float = 2.0, only: DataFrame | None = None) -> DataFrame:
    """Gap to the previous visit at the same (line, stop) by a different vehicle.

    The filter runs after the look-back, so a same-vehicle predecessor hides
    the pair.  Order within a stop: arrival time, then vehicle number.
    ``is_bunched`` uses the unrounded minutes.  ``only`` as in :func:`stop_visits`.
    """
    lagged = ordered_lag(visits, keys=HEADWAY_KEYS, order=["arrival_time", "vehicle_number"],
                         values={"prev_vehicle": "vehicle_number", "prev_arrival": "arrival_time"},
                         limit_seconds=math.ceil(max_minutes * 60), only=only)
    return _headways(lagged, min_minutes, max_minutes, bunched_below)


def headway_of_touched(matches: DataFrame, changed: Column, gone: DataFrame, old: DataFrame, gap_s: int = 600, min_minutes: float = 0.1,
                       max_minutes: float = 120.0, bunched_below: float = 2.0) -> DataFrame:
    """Headways of the (line, stop) pieces that ``changed`` or ``gone`` matches touch, and the ``old`` ones of the others, dealt by day.

    The pings of a (line, stop, day) meet once, with those up to a visit's gap and the longest headway before: both
    look-backs, over the pings of a vehicle and over the visits, read them where they are.
    """
    reach = math.ceil(max_minutes * 60)
    pings = matches.select("line", "stop_id", "stop_name", "vehicle_number", "actual_time", changed.alias("__new"))
    # visits that begin before the reach may be no real ones, but are too far back for any headway
    lagged = touched_lag(pings, F.col("__new"), old, HEADWAY_KEYS, "actual_time", "arrival_time", {"prev_ping": "actual_time"},
                         gap_s + reach, within="vehicle_number", gone=gone)
    new_visit = F.col("prev_ping").isNull() | (seconds_between("prev_ping", "actual_time") > F.lit(int(gap_s)))
    visits = lagged.filter(kept_rows() | new_visit).withColumnRenamed("actual_time", "arrival_time")
    w = Window.partitionBy(*piece_columns(HEADWAY_KEYS)).orderBy(KIND, "arrival_time", "vehicle_number")
    after = visits.select("*", F.lag("vehicle_number").over(w).alias("prev_vehicle"), F.lag("arrival_time").over(w).alias("prev_arrival"))
    return with_old(_headways(after.filter(kept_rows() | ~repeated_rows()), min_minutes, max_minutes, bunched_below, kept_rows()), old, HEADWAY_KEYS)


def _headways(lagged: DataFrame, min_minutes: float, max_minutes: float, bunched_below: float, kept: Column | None = None) -> DataFrame:
    """Headways of visits with the previous one at the stop; ``kept`` rows pass as they are."""
    also = [] if kept is None else [OLD, KIND]
    minutes = seconds_between("prev_arrival", "arrival_time").cast("double") / F.lit(60.0)
    g = lagged.select("line", "stop_id", "stop_name", "vehicle_number", "prev_vehicle", "prev_arrival",
                      "arrival_time", minutes.alias("_hm"), *also)
    passes = (F.col("prev_arrival").isNotNull() & (F.col("vehicle_number") != F.col("prev_vehicle"))
              & F.col("_hm").between(float(min_minutes), float(max_minutes)))
    g = g.filter(passes if kept is None else kept | passes)
    return g.select("line", "stop_id", "stop_name", "vehicle_number", "prev_vehicle", "prev_arrival",
                    "arrival_time", duck_round("_hm", 2).alias("headway_minutes"),
                    (F.col("_hm") < F.lit(float(bunched_below))).alias("is_bunched"), *also)


def headway(matches: DataFrame, gap_s: int = 600, min_minutes: float = 0.1, max_minutes: float = 120.0,
            bunched_below: float = 2.0) -> DataFrame:
    """Headway rows from stop matches (visits first, then gaps)."""
    return headway_from_visits(stop_visits(matches, gap_s), min_minutes, max_minutes, bunched_below)
