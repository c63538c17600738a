"""Matching live positions to scheduled stop times (I9, the central operator).

For every position of the retention window, candidates are the scheduled
stops of the trips its (line, brigade) runs on its calendar date.  Keep
candidates within ``radius_m`` metres and ``window_s`` seconds (both
inclusive), then one winner per (vehicle, time): smallest time gap, then
smallest distance, then trip id and stop id.

Physical plan.  A naive equi-join on (line, brigade, date) multiplies every
position by every stop of every trip of the day.  ``bucketed=True`` (the
default) adds place and time to the key: time buckets ``BUCKET`` windows wide
and grid cells ``CELL`` radii wide.  The rows of one side (by choice the
smaller) are repeated into the at most two buckets and four cells in which a
partner within both gates can lie (a stop's cells are found once, in the
dimension), so the join becomes an equi-join on (line, brigade, date,
bucket, cell) whose candidates are mostly near.  The exact filters still
apply, so the result is identical.  A hot key is split by the adaptive skew
join.  The winner is a ``min(struct)`` aggregate (sort-based) per (vehicle,
time) with a map-side partial step instead of a ranking window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramspark.functions.scalar import METERS_PER_DEGREE, duck_round, planar_distance_m, seconds_between
from tramspark.operators import staging
from tramspark.operators.windows import DAY_OF, PLACE, deal_by_day


def trips_with_line(trips: DataFrame, routes: DataFrame) -> DataFrame:
    """trip_id, service_date, brigade, line (trips joined to routes)."""
    r = routes.select("route_id", "line")
    return trips.select("trip_id", "route_id", "service_date", "brigade").join(r, "route_id").drop("route_id")


def retained_positions(positions: DataFrame, as_of: str, retention_days: int,
                       previous_service_day_until: int | None = None) -> DataFrame:
    """Positions at or after ``as_of - retention_days`` with their service date.

    With ``previous_service_day_until=h`` a ping before hour ``h`` is also
    offered to the previous day's trips (whose arrivals run past 24:00); by
    default a ping only meets trips of its own calendar date.
    """
    cutoff = F.lit(as_of).cast("date").cast("timestamp_ntz") - F.make_dt_interval(F.lit(retention_days))
    day = F.to_date("vehicle_time")
    if previous_service_day_until is None:
        service = day
    else:
        service = F.explode(F.when(F.hour("vehicle_time") < F.lit(previous_service_day_until),
                                   F.array(day, F.date_sub(day, 1))).otherwise(F.array(day)))
    keep = F.col("vehicle_time") >= cutoff
    if "vehicle_date" in positions.columns:
        # the cut-off is a midnight, so this is the same condition on the
        # date-partition column: only the retained partitions are read
        keep = keep & (F.col("vehicle_date") >= F.date_sub(F.lit(as_of).cast("date"), retention_days))
    return (positions.filter(keep)
            .select("vehicle_number", "line", "brigade", "vehicle_time", "lat", "lon",
                    service.alias("service_date")))


def schedule_points(stop_times: DataFrame, trips: DataFrame, routes: DataFrame, stops: DataFrame) -> DataFrame:
    """Every scheduled stop with its trip's line/brigade/date and coordinates."""
    s = stops.select("stop_id", "stop_name", "stop_lat", "stop_lon", *[c for c in ("__cy", "__cx") if c in stops.columns])
    if set(staging.OF_TRIP) <= set(stop_times.columns):     # the trip's columns came with the stop times
        st = stop_times.select("trip_id", "stop_id", "scheduled_arrival", "service_date", *staging.OF_TRIP)
        return st.join(routes.select("route_id", "line"), "route_id").drop("route_id").join(s, "stop_id")
    st = stop_times.select("trip_id", "stop_id", "scheduled_arrival")
    return (st.join(trips_with_line(trips, routes), "trip_id")
            .join(s, "stop_id"))


# Width of a time bucket in windows: a scheduled stop reaches 1 + 2 / BUCKET buckets on average, two at most.  Wide
# buckets and cells repeat little (1.6 times in all on average), which is shuffled; the more candidates are gated where they meet.
BUCKET = 12
# Width of a grid cell in radii: a stop reaches (1 + 2 / CELL)^2 cells on average, four at most.
CELL = 12.0
# Poleward of this latitude a band of cells is one cell (longitude degrees shrink to nothing).
POLAR = 89.0


def _bands(lat: Column, radius_m: float) -> Column:
    return lat / F.lit(CELL * radius_m / METERS_PER_DEGREE)


def _lon_reach(band: Column, radius_m: float) -> Column:
    """Degrees of longitude that ``radius_m`` metres span at most anywhere in a band of cells; null in the polar ones.

    Distances are measured with the cosine at the position's latitude, so the
    band is the position's.  A thousandth more covers rounding.
    """
    height = F.lit(CELL * radius_m / METERS_PER_DEGREE)
    widest = F.greatest(F.abs(band * height), F.abs((band + F.lit(1)) * height))
    return F.when(widest < F.lit(POLAR), F.lit(1.001 * radius_m / METERS_PER_DEGREE) / F.cos(F.radians(widest)))


def _cell(lat: Column, lon: Column, radius_m: float) -> tuple[Column, Column]:
    """Band and cell of a place."""
    band = F.floor(_bands(lat, radius_m))
    return band, F.coalesce(F.floor(lon / (F.lit(CELL) * _lon_reach(band, radius_m))), F.lit(0))


def _around(rows: DataFrame, lat: str, lon: str, radius_m: float, own_band: bool) -> DataFrame:
    """``rows`` repeated for every (__cy, __cx) in which a partner within ``radius_m`` metres can lie.

    The longitudes within reach follow from the position's band: the rows' own
    (``own_band``, rows being positions) or that of each cell (rows being stops).
    """
    reach = F.lit(1.001 / CELL)
    at = _bands(F.col(lat), radius_m)
    rows = rows.withColumn("__cy", F.explode(F.sequence(F.floor(at - reach), F.floor(at + reach))))
    width = F.lit(CELL) * _lon_reach(F.col("__cy"), radius_m)
    span = _lon_reach(F.floor(at), radius_m) if own_band else _lon_reach(F.col("__cy"), radius_m)
    # in a polar band all lies in cell 0; a position there reaches every cell of the next band: cells on the whole circle
    span = F.coalesce(span, F.lit(720.0))
    first, last = (F.coalesce(F.floor((F.col(lon) + s * span) / width), F.lit(0)) for s in (-1, 1))
    return rows.withColumn("__cx", F.explode(F.sequence(first, last)))


def stop_cells(stops: DataFrame, radius_m: float) -> DataFrame:
    """Stops repeated for the cells of the positions that can match them (once per stop, before the timetable is joined)."""
    return _around(stops, "stop_lat", "stop_lon", radius_m, own_band=False)


PAIR_KEYS = ["line", "brigade", "service_date"]
STOP_COLUMNS = ["stop_name", "stop_lat", "stop_lon"]


def _pair_key(seconds: Column, cells: tuple[Column, Column], window_s: int) -> Column:
    # one number stands for the whole key: it is shuffled and sorted faster than six columns, and those that
    # the gates do not imply are compared after it
    return F.xxhash64(*PAIR_KEYS, F.floor(seconds / F.lit(BUCKET * int(window_s))), *cells)


def schedule_keys(sched: DataFrame, radius_m: float, window_s: int) -> DataFrame:
    """Scheduled stops with the ``__key`` they are joined by where the positions are repeated."""
    cell = _cell(F.col("stop_lat"), F.col("stop_lon"), radius_m)
    return sched.withColumn("__key", _pair_key(F.unix_timestamp("scheduled_arrival"), cell, window_s))


def candidate_pairs(positions: DataFrame, sched: DataFrame, radius_m: float = 100.0, window_s: int = 900,
                    bucketed: bool = True, repeat: str = "schedule", stops: DataFrame | None = None) -> DataFrame:
    """(position, scheduled stop) pairs that the equi-join lets meet, before the exact gates.

    ``repeat`` names the side that goes to all buckets and cells within reach:
    the smaller one of ``schedule`` and ``positions``.  With ``stops`` the name and
    place of a stop are taken from there once a pair has met, and are not shuffled
    with every scheduled stop.
    """
    keys = PAIR_KEYS
    if not bucketed:
        return positions.join(sched, on=keys, how="inner")
    w = F.lit(int(window_s))

    def key(seconds, cells):
        return _pair_key(seconds, cells, window_s)

    def everywhere(rows, seconds):      # rows with cells; BUCKET >= 2, so a window reaches two buckets at most
        cells = (F.col("__cy"), F.col("__cx"))
        return rows.withColumn("__key", F.explode(F.array_distinct(F.array(key(seconds - w, cells), key(seconds + w, cells))))).drop("__cy", "__cx")

    seen, due = F.unix_timestamp("vehicle_time"), F.unix_timestamp("scheduled_arrival")
    if repeat == "positions":
        p = everywhere(_around(positions, "lat", "lon", radius_m, own_band=True), seen)
        s = sched if "__key" in sched.columns else schedule_keys(sched, radius_m, window_s)
    else:
        p = positions.withColumn("__key", key(seen, _cell(F.col("lat"), F.col("lon"), radius_m)))
        s = everywhere(sched if "__cy" in sched.columns else stop_cells(sched, radius_m), due)
    left = [*keys, *(STOP_COLUMNS if stops is not None else [])]
    s = s.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in s.columns if c not in left])
    same = [F.col(k) == F.col(f"__{k}") for k in keys]
    met = p.join(s, "__key").filter(same[0] & same[1] & same[2]).drop("__key", *[f"__{k}" for k in keys])
    return met if stops is None else met.join(stops.select("stop_id", *STOP_COLUMNS), "stop_id")


def stop_match_candidates(positions: DataFrame, sched: DataFrame, radius_m: float = 100.0,
                          window_s: int = 900, bucketed: bool = True, repeat: str = "schedule",
                          stops: DataFrame | None = None) -> DataFrame:
    """All (position, scheduled stop) pairs that pass both gates."""
    cand = candidate_pairs(positions, sched, radius_m, window_s, bucketed, repeat, stops).select(
        "service_date", "trip_id", "vehicle_number", "line", "brigade", "vehicle_time", "lat", "lon",
        "stop_id", "stop_name", "stop_lat", "stop_lon", "scheduled_arrival",
        planar_distance_m("lat", "lon", "stop_lat", "stop_lon").alias("meters_to_stop"),
        F.abs(seconds_between("scheduled_arrival", "vehicle_time")).alias("abs_time_gap"))
    return cand.filter((F.col("meters_to_stop") <= F.lit(float(radius_m)))
                       & (F.col("abs_time_gap") <= F.lit(int(window_s))))


def best_match(cand: DataFrame) -> DataFrame:
    """One candidate per (vehicle_number, vehicle_time): min (gap, metres, trip, stop).

    The winner is grouped apart from the join keys on purpose: an aggregate
    that relied on the join's partitioning would forbid the adaptive split of
    a skewed join partition.  Only candidates that passed both gates are
    shuffled, dealt by day, so the matches can be written by date as they come.
    """
    best = F.min(F.struct("abs_time_gap", "meters_to_stop", "trip_id", "stop_id",
                          "line", "brigade", "stop_name", "scheduled_arrival")).alias("b")
    keys = ["vehicle_number", "vehicle_time"]
    if cand.isStreaming:        # the state of a stream is dealt by the grouping itself
        g = cand.groupBy(*keys).agg(best)
    else:
        # a vehicle's hour stays together: its trips are few values to a file
        hour = ["vehicle_number", F.hour("vehicle_time")]
        g = deal_by_day(cand, F.to_date("vehicle_time"), hour).groupBy(DAY_OF, PLACE, *keys).agg(best)
    return g.select(
        F.col("b.trip_id").alias("trip_id"), "vehicle_number",
        F.col("b.line").alias("line"), F.col("b.brigade").alias("brigade"),
        F.col("b.stop_id").alias("stop_id"), F.col("b.stop_name").alias("stop_name"),
        F.col("vehicle_time").alias("actual_time"),
        F.col("b.scheduled_arrival").alias("scheduled_arrival"),
        F.col("b.meters_to_stop").alias("_m"))


def stop_matches(positions: DataFrame, stop_times: DataFrame, trips: DataFrame, routes: DataFrame,
                 stops: DataFrame, as_of: str, retention_days: int = 2, radius_m: float = 100.0,
                 window_s: int = 900, bucketed: bool = True,
                 previous_service_day_until: int | None = None, repeat: str = "schedule") -> DataFrame:
    """Matched stop arrivals with signed delay (late positive).

    Output: trip_id, vehicle_number, line, brigade, stop_id, stop_name,
    actual_time, scheduled_arrival, meters_to_stop (whole metres),
    delay_seconds, delay_minutes (0.1 min).
    """
    pos = retained_positions(positions, as_of, retention_days, previous_service_day_until)
    # the cells of a stop are found in the dimension, before the timetable repeats it
    sched = schedule_points(stop_times, trips, routes, stop_cells(stops, radius_m) if bucketed and repeat == "schedule" else stops)
    cand = stop_match_candidates(pos, sched, radius_m, window_s, bucketed, repeat, stops if bucketed else None)
    return with_delay(best_match(cand))


def with_delay(best: DataFrame) -> DataFrame:
    """The columns of :func:`stop_matches` from its winners."""
    delay = seconds_between("scheduled_arrival", "actual_time")
    return best.select(
        "trip_id", "vehicle_number", "line", "brigade", "stop_id", "stop_name", "actual_time",
        "scheduled_arrival",
        duck_round(F.col("_m"), 0).alias("meters_to_stop"),
        delay.alias("delay_seconds"),
        duck_round(delay.cast("double") / F.lit(60.0), 1).alias("delay_minutes"))
