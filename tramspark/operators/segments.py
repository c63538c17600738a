"""Observed vs scheduled travel time between successive matched stops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramspark.functions.scalar import duck_round, seconds_between
from tramspark.operators.windows import DAY_OF, KIND, OLD, PLACE, deal_by_day, kept_rows, touched_lag, window_lag, with_old


SEGMENT_KEYS = ["trip_id", "vehicle_number"]
_INPUT = ["trip_id", "line", "brigade", "vehicle_number", "stop_id", "stop_name", "actual_time", "scheduled_arrival"]
_BEFORE = {"prev_stop_id": "stop_id", "prev_stop_name": "stop_name", "prev_actual": "actual_time", "prev_scheduled": "scheduled_arrival"}


def route_segments(matches: DataFrame, min_minutes: float = 0.2, max_minutes: float = 30.0,
                   max_abs_diff: float = 15.0, keep_trip: bool = False, by_day: bool = False) -> DataFrame:
    """Segments between consecutive matched stops of one trip run by one vehicle.

    An unmatched stop is skipped, so a segment may span several stops.  Drops
    repeats of the same stop id or stop name (platforms of one station), and
    keeps actual and scheduled minutes in ``[min, max]`` differing by at most
    ``max_abs_diff``.  Within (trip, vehicle) the matches are unique per time.
    ``keep_trip`` adds the trip id, by which a load finds the segments to replace.
    ``by_day``, where a trip's pings are all of one calendar day, deals them by it, for a table written by date.
    """
    m = matches.select(*_INPUT)
    # one vehicle on one dated trip: bounded by the trip's stops and the matching window
    if by_day:
        dealt = deal_by_day(m, F.to_date("actual_time"), SEGMENT_KEYS)
        lagged = window_lag(dealt, [DAY_OF, PLACE, *SEGMENT_KEYS], ["actual_time"], _BEFORE)
    else:
        lagged = window_lag(m, SEGMENT_KEYS, ["actual_time"], _BEFORE)
    return _segments(lagged, min_minutes, max_minutes, max_abs_diff, keep_trip)


def segments_of_touched(matches: DataFrame, changed: Column, gone: DataFrame, old: DataFrame, min_minutes: float = 0.2,
                        max_minutes: float = 30.0, max_abs_diff: float = 15.0) -> DataFrame:
    """Segments of the (trip, vehicle) that ``changed`` or ``gone`` matches touch, and the ``old`` ones of the others, dealt
    by day; a trip's pings must all be of one calendar day."""
    m = matches.select(*_INPUT, changed.alias("__new"))
    lagged = touched_lag(m, F.col("__new"), old, SEGMENT_KEYS, "actual_time", "arrived_at", _BEFORE, 0, gone=gone)
    return with_old(_segments(lagged, min_minutes, max_minutes, max_abs_diff, True, kept_rows()), old, SEGMENT_KEYS)


def _segments(lagged: DataFrame, min_minutes: float, max_minutes: float, max_abs_diff: float, keep_trip: bool, kept: Column | None = None) -> DataFrame:
    """Segments of matches with the previous one of the trip; ``kept`` rows pass as they are."""
    also = [] if kept is None else [OLD, KIND]

    def passing(df, condition):
        return df.filter(condition if kept is None else kept | condition)

    seg = passing(lagged, F.col("prev_stop_id").isNotNull()
                  & (F.col("prev_stop_id") != F.col("stop_id"))
                  & (F.col("prev_stop_name") != F.col("stop_name")))
    actual = seconds_between("prev_actual", "actual_time").cast("double") / F.lit(60.0)
    sched = seconds_between("prev_scheduled", "scheduled_arrival").cast("double") / F.lit(60.0)
    seg = seg.select(
        *(["trip_id"] if keep_trip else []), "line",
        F.col("prev_stop_id").alias("from_stop_id"), F.col("prev_stop_name").alias("from_stop"),
        F.col("stop_id").alias("to_stop_id"), F.col("stop_name").alias("to_stop"),
        "vehicle_number",
        F.col("prev_actual").alias("departed_at"), F.col("actual_time").alias("arrived_at"),
        actual.alias("actual_minutes"), sched.alias("scheduled_minutes"), *also)
    seg = passing(seg, F.col("actual_minutes").between(float(min_minutes), float(max_minutes))
                  & F.col("scheduled_minutes").between(float(min_minutes), float(max_minutes))
                  & (F.abs(F.col("actual_minutes") - F.col("scheduled_minutes")) <= F.lit(float(max_abs_diff))))
    return seg.withColumn("lost_minutes", duck_round(F.col("actual_minutes") - F.col("scheduled_minutes"), 2))
