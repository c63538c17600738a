"""Adapters: transit-shaped inputs derived from the driver's tables.

They only give rows in the schemas the jobs expect (raw positions as text and
as typed batches, timetable files as text); they do none of the jobs' work.
The jobs must be right on any data of these schemas and take nothing from how
the rows are made.  Every adapter reads the given tables, so the work of the
downstream jobs grows with them.

* pings     <- events (each event is a short run of one vehicle: PINGS pings,
               PING_STEP_S apart, each at the next stop of the run)
* raw feed  <- pings + a later re-poll of every third event + an out-of-area copy
* stops     <- nation (one stop per nation key)
* timetable <- one trip per (date, line, brigade, quarter of an hour) in which a
               run starts, N_STOPS_PER_TRIP stops, arrival text past 24:00 late
               at night

Vehicles are the users, a line has USERS_PER_LINE of them, so vehicles, lines,
brigades, trips and stop times all grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramspark.functions.scalar import to_second

# The adapter layout.
PINGS = 3               # pings of a run
PING_STEP_S = 360       # seconds between them
USERS_PER_LINE = 10     # vehicle = user, line = user // 10, brigade = user % 10
N_STOPS = 25            # keys of nation
N_STOPS_PER_TRIP = 4
TRIP_STEP_MIN = 15
STOP_STEP_MIN = 6

TS_TEXT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


# Declared schemas of the driver tables the adapters read (no footer inference).
DRIVER_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Driver table scan."""
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One vehicle run per event: start time, vehicle, line, brigade, first stop and stops per step."""
    user = F.col("user_id")
    return _table(spark, sf_dir, "events").select(
        "event_id", to_second("ts").alias("start"),
        user.cast("string").alias("vehicle_number"),
        F.floor(user / F.lit(USERS_PER_LINE)).cast("string").alias("line"),
        (user % F.lit(USERS_PER_LINE)).cast("string").alias("brigade"),
        (F.lit(1) + user % F.lit(2)).cast("tinyint").alias("vehicle_type"),
        ((F.col("event_id") * F.lit(7919)) % F.lit(N_STOPS)).alias("stop0"),
        (F.lit(1) + user % F.lit(5)).alias("hop"))


def _stop_at(k: Column) -> Column:
    """Stop key of step ``k`` of a run."""
    return (F.col("stop0") + F.col("hop") * k) % F.lit(N_STOPS)


def raw_feed(spark: SparkSession, sf_dir: str, parity: int | None = None) -> DataFrame:
    """Raw polls, in one scan of events: every ping fetched 20 s after its time,
    those of every third event polled again 80 s after, those of every fiftieth
    also seen 5 degrees north (out of area).  ``parity`` keeps the events of one
    collector (even or odd ids)."""
    runs = _runs(spark, sf_dir)
    if parity is not None:
        runs = runs.filter(F.col("event_id") % F.lit(2) == F.lit(parity))
    event = F.col("event_id")
    poll = lambda late, north: F.struct(F.lit(late).alias("late"), F.lit(north).alias("north"))
    polls = F.concat(F.array(poll(20, 0.0)),
                     F.when(event % F.lit(3) == F.lit(0), F.array(poll(80, 0.0))).otherwise(F.array().cast("array<struct<late:int,north:double>>")),
                     F.when(event % F.lit(50) == F.lit(0), F.array(poll(20, 5.0))).otherwise(F.array().cast("array<struct<late:int,north:double>>")))
    steps = runs.select("*", F.explode(F.sequence(F.lit(0), F.lit(PINGS - 1))).alias("k"), polls.alias("polls"))
    stop = _stop_at(F.col("k"))
    lat_off = (event * F.lit(13)) % F.lit(19) - F.lit(9)
    lon_off = (event * F.lit(17)) % F.lit(19) - F.lit(9)
    seconds = lambda n: F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n)
    seen = steps.select(
        "event_id", "vehicle_number", "line", "brigade", "vehicle_type",
        (F.col("start") + seconds(F.col("k") * F.lit(PING_STEP_S))).alias("vehicle_time"),
        (F.lit(52.20) + stop * F.lit(0.002) + lat_off * F.lit(0.00002)).alias("lat"),
        (F.lit(21.00) + stop * F.lit(0.001) + lon_off * F.lit(0.00002)).alias("lon"),
        F.explode("polls").alias("poll"))
    return seen.select(
        "event_id", (F.col("vehicle_time") + seconds(F.col("poll.late"))).alias("fetch_time"), "vehicle_number", "line",
        "brigade", "vehicle_type", (F.col("lat") + F.col("poll.north")).alias("lat"), "lon", "vehicle_time")


def raw_feed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even events as legacy CSV text (every column a string, ISO 'T' times)."""
    r = raw_feed(spark, sf_dir, 0)
    return r.select(
        F.date_format("fetch_time", TS_TEXT_FORMAT).alias("fetch_time"),
        "vehicle_number", "line", "brigade",
        F.col("vehicle_type").cast("string").alias("vehicle_type"),
        F.col("lat").cast("string").alias("lat"),
        F.col("lon").cast("string").alias("lon"),
        F.date_format("vehicle_time", TS_TEXT_FORMAT).alias("vehicle_time"),
    )


def raw_feed_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd events as typed collector batches."""
    return raw_feed(spark, sf_dir, 1).select("fetch_time", "vehicle_number", "line", "brigade",
                                             "vehicle_type", "lat", "lon", "vehicle_time")


def stops_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stops.txt rows from nation."""
    n = _table(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    return n.select(
        key.cast("string").alias("stop_id"),
        F.col("n_name").alias("stop_name"),
        (F.lit(52.20) + key * F.lit(0.002)).cast("string").alias("stop_lat"),
        (F.lit(21.00) + key * F.lit(0.001)).cast("string").alias("stop_lon"),
        F.concat(F.lit("Region "), F.col("n_regionkey").cast("string")).alias("town_name"),
    )


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated trips; of several runs that start in one quarter the lowest stop and hop give the trip's stops."""
    quarter = F.floor((F.hour("start") * F.lit(60) + F.minute("start")) / F.lit(TRIP_STEP_MIN)).alias("j")
    return (_runs(spark, sf_dir)
            .groupBy(F.to_date("start").alias("d"), "line", "brigade", quarter)
            .agg(F.min("stop0").alias("stop0"), F.min("hop").alias("hop"))
            .withColumn("trip_id", F.concat(F.date_format("d", "yyyy-MM-dd"), F.lit(":"), F.col("line"),
                                            F.lit("-"), F.col("brigade"), F.lit("-"),
                                            F.col("j").cast("string"))))


def routes_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """routes.txt rows: one route per line seen in the runs."""
    lines = _runs(spark, sf_dir).select("line").distinct()
    return lines.select(
        F.concat(F.lit("R"), F.col("line")).alias("route_id"),
        F.col("line").alias("route_short_name"),
        F.concat(F.lit("Line "), F.col("line")).alias("route_long_name"),
        F.lit("3").alias("route_type"),
    )


def trips_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """trips.txt rows (trip ids carry the service date before the first ':')."""
    return _trips(spark, sf_dir).select(
        "trip_id",
        F.concat(F.lit("R"), F.col("line")).alias("route_id"),
        F.date_format("d", "yyyy-MM-dd").alias("service_id"),
        F.col("brigade").alias("block_short_name"),
        F.lit("Terminus").alias("trip_headsign"),
        F.lit("0").alias("direction_id"),
    )


def stop_times_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stop_times.txt rows, arrival as H:M:S text (hours pass 24 late at night)."""
    st = _trips(spark, sf_dir).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(N_STOPS_PER_TRIP - 1))))
    minutes = F.col("j") * F.lit(TRIP_STEP_MIN) + F.col("k") * F.lit(STOP_STEP_MIN)
    return st.select(
        "trip_id",
        F.col("k").cast("string").alias("stop_sequence"),
        _stop_at(F.col("k")).cast("string").alias("stop_id"),
        F.concat(F.lpad(F.floor(minutes / F.lit(60)).cast("string"), 2, "0"), F.lit(":"),
                 F.lpad((minutes % F.lit(60)).cast("string"), 2, "0"), F.lit(":00")).alias("arrival_time"),
    )


def transit_inputs(spark: SparkSession, sf_dir: str) -> dict:
    """All raw inputs of the model graph, keyed like the feed files."""
    return {
        "positions_csv": raw_feed_text(spark, sf_dir),
        "positions_parquet": raw_feed_typed(spark, sf_dir),
        "stops": stops_text(spark, sf_dir),
        "routes": routes_text(spark, sf_dir),
        "trips": trips_text(spark, sf_dir),
        "stop_times": stop_times_text(spark, sf_dir),
    }


def stops_text_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two published versions of stops.txt (for dimension history).

    Version 1 lacks the name of every sixth stop.  Version 2 renames some
    stops, moves others, drops some and adds new ones.
    """
    n = _table(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    lat = F.lit(52.20) + key * F.lit(0.002)
    lon = F.lit(21.00) + key * F.lit(0.001)
    town = F.concat(F.lit("Region "), F.col("n_regionkey").cast("string"))
    v1 = n.select(key.cast("string").alias("stop_id"),
                  F.when(key % 6 != 5, F.col("n_name")).alias("stop_name"),
                  lat.cast("string").alias("stop_lat"), lon.cast("string").alias("stop_lon"),
                  town.alias("town_name"))
    kept = n.filter(key % 5 != 3)
    v2_old = kept.select(
        key.cast("string").alias("stop_id"),
        F.when(key % 5 == 1, F.concat(F.col("n_name"), F.lit(" II"))).otherwise(F.col("n_name")).alias("stop_name"),
        F.when(key % 5 == 2, lat + F.lit(0.0005)).otherwise(lat).cast("string").alias("stop_lat"),
        lon.cast("string").alias("stop_lon"), town.alias("town_name"))
    v2_new = n.filter(key % 5 == 4).select(
        (key + F.lit(100)).cast("string").alias("stop_id"),
        F.concat(F.col("n_name"), F.lit(" NEW")).alias("stop_name"),
        (lat + F.lit(0.001)).cast("string").alias("stop_lat"), lon.cast("string").alias("stop_lon"),
        town.alias("town_name"))
    return v1, v2_old.unionByName(v2_new)


def routes_text_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two published versions of routes.txt: line '1' renamed, a night route
    added per line."""
    v1 = routes_text(spark, sf_dir)
    changed = v1.select("route_id", "route_short_name",
                        F.when(F.col("route_short_name") == F.lit("1"), F.lit("Line 1 via Centre"))
                        .otherwise(F.col("route_long_name")).alias("route_long_name"), "route_type")
    night = v1.select(F.concat(F.lit("N"), F.col("route_short_name")).alias("route_id"),
                      F.concat(F.lit("N"), F.col("route_short_name")).alias("route_short_name"),
                      F.concat(F.lit("Night "), F.col("route_short_name")).alias("route_long_name"),
                      "route_type")
    return v1, changed.unionByName(night)
