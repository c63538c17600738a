"""Staging: typed, cleaned positions and timetable dimensions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramspark.functions.scalar import add_hms, day_of_week_sun0, generated, hms_parts, try_date, try_double, try_int, try_timestamp
from tramspark.operators.windows import DAY_OF, PLACE, deal_by_day
from tramspark.sources.files import drop_header_rows


@dataclass(frozen=True)
class BBox:
    """Inclusive geographic box (defaults: the reference's service area)."""
    lat_min: float = 51.9
    lat_max: float = 52.5
    lon_min: float = 20.7
    lon_max: float = 21.3


def type_csv_positions(text: DataFrame) -> DataFrame:
    """Legacy text rows -> typed rows; header lines dropped, bad cells NULL.

    The cells are parsed into a generated row: a later filter on them then reads the
    parsed values, where on a plain projection it would be pushed below it and parse
    every cell anew for each of its comparisons.
    """
    t = drop_header_rows(text, "fetch_time")
    return t.select(generated(
        try_timestamp("fetch_time").alias("fetch_time"),
        try_timestamp("vehicle_time").alias("vehicle_time"),
        F.col("vehicle_number"), F.col("line"), F.col("brigade"),
        try_int("vehicle_type").alias("vehicle_type"),
        try_double("lat").alias("lat"),
        try_double("lon").alias("lon")))


def type_parquet_positions(typed: DataFrame) -> DataFrame:
    """Collector batches in the staging column order."""
    return typed.select(
        F.col("fetch_time").cast("timestamp_ntz").alias("fetch_time"),
        F.col("vehicle_time").cast("timestamp_ntz").alias("vehicle_time"),
        "vehicle_number", "line", "brigade",
        F.col("vehicle_type").cast("int").alias("vehicle_type"),
        "lat", "lon",
    )


def union_sources(csv_text: DataFrame | None, parquet_typed: DataFrame | None) -> DataFrame:
    """UNION ALL of the typed legacy text feed and the typed batch feed."""
    parts = []
    if csv_text is not None:
        parts.append(type_csv_positions(csv_text))
    if parquet_typed is not None:
        parts.append(type_parquet_positions(parquet_typed))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def filter_valid(df: DataFrame, bbox: BBox = BBox()) -> DataFrame:
    """Non-NULL coordinates and time, inside the inclusive box."""
    return df.filter(
        F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("vehicle_time").isNotNull()
        & F.col("lat").between(bbox.lat_min, bbox.lat_max)
        & F.col("lon").between(bbox.lon_min, bbox.lon_max))


def dedup_first(df: DataFrame, keys=("vehicle_number", "vehicle_time"),
                order=("fetch_time", "lat", "lon")) -> DataFrame:
    """Keep the first observation per key: earliest ``fetch_time`` (NULLs last),
    then ``lat``, ``lon`` and the remaining columns as tie-breaks.

    Expressed as ``min(struct)`` per key, an aggregate (sort-based, since the
    struct carries strings) with a map-side partial step: a key repeated by
    many polls shrinks to one row per task before the shuffle, whereas a
    ``row_number`` window shuffles and sorts every copy.
    """
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    flag = [F.col(c).isNull().alias(f"__null_{c}") for c in order]
    pick = F.min(F.struct(*[x for pair in zip(flag, [F.col(c) for c in order]) for x in pair],
                          *[F.col(c) for c in rest])).alias("__first")
    agg = df.groupBy(*keys).agg(pick)
    return agg.select(*[F.col(c) for c in df.columns if c in keys],
                      *[F.col(f"__first.{c}").alias(c) for c in df.columns if c not in keys]).select(*df.columns)


def dedup_by_day(df: DataFrame) -> DataFrame:
    """:func:`dedup_first` of pings dealt by day, for a table written by date: its rows are shuffled once, not once more
    to be laid by date, and are sorted in the bounded pieces after the shuffle instead of in the scan's."""
    keys = ["vehicle_number", "vehicle_time"]
    dealt = deal_by_day(df, F.to_date("vehicle_time"), ["vehicle_number", F.hour("vehicle_time")])
    return dedup_first(dealt, [DAY_OF, PLACE, *keys]).drop(DAY_OF, PLACE)


def clean_positions(csv_text: DataFrame | None, parquet_typed: DataFrame | None,
                    bbox: BBox = BBox(), by_day: bool = False) -> DataFrame:
    """Typed, unioned, filtered and de-duplicated positions (first fetch wins); ``by_day`` for a table written by date."""
    valid = filter_valid(union_sources(csv_text, parquet_typed), bbox)
    return dedup_by_day(valid) if by_day else dedup_first(valid)


def gtfs_stops(stops_txt: DataFrame) -> DataFrame:
    """Stops dimension: coordinates typed, rows without coordinates dropped."""
    out = stops_txt.select(
        "stop_id", "stop_name",
        try_double("stop_lat").alias("stop_lat"),
        try_double("stop_lon").alias("stop_lon"),
        "town_name")
    return out.filter(F.col("stop_lat").isNotNull() & F.col("stop_lon").isNotNull())


def gtfs_routes(routes_txt: DataFrame) -> DataFrame:
    """Routes dimension: short name becomes ``line``; type typed when it parses."""
    return routes_txt.select(
        "route_id",
        F.col("route_short_name").alias("line"),
        "route_long_name",
        try_int("route_type").alias("route_type"))


def gtfs_trips(trips_txt: DataFrame) -> DataFrame:
    """Trips: brigade from the block name, service date from the trip id prefix
    (NULL when the prefix is not a full date)."""
    return trips_txt.select(
        "trip_id", "route_id", "service_id",
        F.col("block_short_name").alias("brigade"),
        "trip_headsign",
        try_int("direction_id").alias("direction_id"),
        try_date(F.split_part(F.col("trip_id"), F.lit(":"), F.lit(1))).alias("service_date"))


def collected_dates(positions: DataFrame) -> DataFrame:
    """Distinct calendar dates of the positions (one row per date)."""
    return positions.select(F.to_date("vehicle_time").alias("service_date")).distinct()


OF_TRIP = ["route_id", "brigade"]       # of a trip, by which its stop times meet the pings


def gtfs_stop_times(stop_times_txt: DataFrame, trips: DataFrame, positions: DataFrame, with_trip: bool = False) -> DataFrame:
    """Scheduled arrivals, only for service dates that have positions.

    The date set is a tiny aggregate; the semi-join prunes trips before the
    large stop_times join.  Arrival = service date + H:M:S past 24 h.
    ``with_trip`` adds the trip's columns ``OF_TRIP``, so that the matching need not join the trips again.
    """
    own = OF_TRIP if with_trip else []
    relevant = (trips.select("trip_id", "service_date", *own)
                .join(collected_dates(positions), on="service_date", how="left_semi"))
    raw = stop_times_txt.select(
        "trip_id",
        try_int("stop_sequence").alias("stop_sequence"),
        "stop_id",
        F.col("arrival_time").alias("arrival_time_raw"))
    j = raw.join(relevant, on="trip_id", how="inner")
    # the parts of the text, then the time: each found once a row, not again for every column and filter that reads the time
    parts = [x.alias(n) for x, n in zip(hms_parts("arrival_time_raw"), ("__h", "__m", "__s"), strict=True)]
    return j.select("*", generated(*parts)).select(
        "trip_id", "stop_sequence", "stop_id", "service_date", "arrival_time_raw",
        generated(add_hms("service_date", "__h", "__m", "__s").alias("scheduled_arrival")), *own)


def calendar(positions: DataFrame, floor_date: str | None = None) -> DataFrame:
    """Date spine from the first to the last collected day, with attributes.

    ``floor_date`` optionally ignores stale pings that would stretch the spine.
    """
    p = positions
    if floor_date:
        p = p.filter(F.col("vehicle_time") >= F.lit(floor_date).cast("timestamp_ntz"))
    bounds = p.agg(F.min("vehicle_time").cast("date").alias("a"), F.max("vehicle_time").cast("date").alias("b"))
    spine = bounds.filter(F.col("a").isNotNull()).select(
        F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("date_day"))
    dow = day_of_week_sun0("date_day")
    return spine.select(
        "date_day",
        F.year("date_day").cast("bigint").alias("year"),
        F.month("date_day").cast("bigint").alias("month"),
        F.dayofmonth("date_day").cast("bigint").alias("day"),
        dow.alias("day_of_week"),
        F.date_format("date_day", "EEEE").alias("day_name"),
        dow.isin(0, 6).alias("is_weekend"),
        F.month("date_day").isin(7, 8).alias("is_school_holiday"))
