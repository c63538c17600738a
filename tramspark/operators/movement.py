"""Vehicle movement between consecutive positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramspark.functions.scalar import duck_round, planar_distance_m, seconds_between
from tramspark.operators.windows import KIND, OLD, kept_rows, ordered_lag, repeated_rows, touched_lag, with_old


def vehicle_moves(positions: DataFrame, min_gap_s: int = 1, max_gap_s: int = 600,
                  max_speed_kmh: float = 100.0, bucket_seconds: int = 3600, only: DataFrame | None = None) -> DataFrame:
    """Seconds, metres and km/h from each vehicle's previous position.

    Keeps gaps in ``[min_gap_s, max_gap_s]`` and speeds (rounded to 0.1 km/h
    before the test) up to ``max_speed_kmh``.  The previous position is found
    with the hot-key-safe ``ordered_lag`` (vehicle history cut into
    ``bucket_seconds`` pieces, an hour by default; a predecessor beyond
    ``max_gap_s`` gives no move, so the look-back ends there).
    Input: cleaned positions, unique per (vehicle_number, vehicle_time).  ``only``
    limits the result to touched pieces of history (``windows.touched_buckets``).
    """
    p = positions.select("vehicle_number", "line", "brigade", "vehicle_type", "vehicle_time", "lat", "lon")
    # A vehicle pings every few seconds and one id (say an empty one) can
    # carry a large share of a day's rows, so histories are cut by hour.
    lagged = ordered_lag(p, keys=["vehicle_number"], order=["vehicle_time"],
                         values={"prev_lat": "lat", "prev_lon": "lon", "prev_time": "vehicle_time"},
                         limit_seconds=max_gap_s, bucket_seconds=bucket_seconds, only=only)
    return _moves(lagged, min_gap_s, max_gap_s, max_speed_kmh)


def moves_of_touched(positions: DataFrame, changed: Column, old: DataFrame, min_gap_s: int = 1, max_gap_s: int = 600,
                     max_speed_kmh: float = 100.0, bucket_seconds: int = 3600) -> DataFrame:
    """Moves of the pieces of history that ``changed`` positions touch, and the ``old`` moves of the others, dealt by day."""
    p = positions.select("vehicle_number", "line", "brigade", "vehicle_type", "vehicle_time", "lat", "lon", changed.alias("__new"))
    lagged = touched_lag(p, F.col("__new"), old, ["vehicle_number"], "vehicle_time", "vehicle_time",
                         {"prev_lat": "lat", "prev_lon": "lon", "prev_time": "vehicle_time"}, max_gap_s, bucket_seconds)
    return with_old(_moves(lagged, min_gap_s, max_gap_s, max_speed_kmh, kept_rows(), ~repeated_rows()), old, ["vehicle_number"])


def _moves(lagged: DataFrame, min_gap_s: int, max_gap_s: int, max_speed_kmh: float, kept: Column | None = None, own: Column | None = None) -> DataFrame:
    """Moves of positions with the previous one; ``kept`` rows pass as they are, of the others ``own`` alone."""
    seconds, metres = seconds_between("prev_time", "vehicle_time"), planar_distance_m("lat", "lon", "prev_lat", "prev_lon")
    also = [] if kept is None else [OLD, KIND]

    def passing(df, condition):
        return df.filter(condition if kept is None else kept | condition)

    found = F.col("prev_time").isNotNull()
    moves = passing(lagged, found if own is None else own & found).select(
        "vehicle_number", "line", "brigade", "vehicle_type", "prev_time", "vehicle_time", "lat", "lon",
        seconds.alias("seconds_diff"), metres.alias("meters_diff"), *also)
    moves = passing(moves, F.col("seconds_diff").between(min_gap_s, max_gap_s))
    speed = F.when(F.col("seconds_diff") > 0,
                   duck_round(F.col("meters_diff") / F.col("seconds_diff").cast("double") * F.lit(3.6), 1))
    out = moves.withColumn("speed_kmh", speed)
    out = passing(out, F.col("speed_kmh").isNotNull() & (F.col("speed_kmh") <= F.lit(float(max_speed_kmh))))
    return out.select(*[c for c in out.columns if c not in also], *also)
