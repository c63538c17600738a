"""Structured Streaming path for continuous ingestion (K1-K7).

* K1 ``position_stream``: file-stream source of typed position batches.
* K2 ``dedup_stream``: first fetch per (vehicle, time) as an event-time
  aggregation with a watermark; each key is emitted once, when the watermark
  passes it, and its state is then dropped (state bounded by the delay).
* K3 late data: rows older than the watermark a micro-batch starts with are
  dropped by the stateful operator and counted (``run_to_completion``
  returns the count) instead of the batch model's single global high-water
  mark, which also drops a slower feed's rows.
* K4 ``frames_stream``: tumbling frames, earliest ping per vehicle and frame.
  ``late_aware_sink`` keeps them: rows older than the mark go to a side table,
  which ``load_late`` merges into the main one, so nothing is lost and the hot
  path rewrites recent days only.
* I9 on the stream, ``matches_stream``: pings join the written timetable within
  each micro-batch, and the best match per (vehicle, time) is a stateful minimum
  that the watermark closes.  A ping's state is one struct, dropped when emitted.
* K5 ``visits_stream``: visits as session windows over the matched pings (a gap
  of exactly ``gap`` merges, like the batch rule's strict '>'); fed by a table of
  matches or, in one query, by ``best_match_stream``.
* K6 ``moves_stream``: previous ping kept in state (``applyInPandasWithState``)
  per vehicle and time bucket, with the batch look-back's halo: a ping within
  the gap limit of its bucket's end is repeated into the next bucket, where it
  only serves as predecessor.  Vehicles are dealt into ``MOVE_GROUPS`` groups, so
  one Python call takes a bucket's rows of many vehicles.  A group's rows and
  state are bounded by one bucket of its vehicles, and state expires when the
  watermark has passed the bucket.  Rows not newer than the stored ping are flagged, and
  ``run_to_completion`` reports watermark drops.  Plain window functions are
  not allowed on streams.
* K7 ``upsert_sink``: ``foreachBatch`` that cleans each micro-batch and merges
  it into a date-partitioned Parquet table (first fetch wins).

``withWatermark`` needs TIMESTAMP, so event times are cast from
TIMESTAMP_NTZ under the session's UTC zone and cast back on output.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import TimestampType

from tramspark.functions.scalar import code_label, planar_distance_m
from tramspark.operators import incremental, matching, staging
from tramspark.session import ONE_BY_ONE, path_exists, remove_path, settings, shared_dir
from tramspark.sources.schemas import POSITION_SCHEMA

LTZ = "timestamp"
NTZ = "timestamp_ntz"


def position_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                    schema=POSITION_SCHEMA) -> DataFrame:
    """K1: typed Parquet batches landing in ``path`` (processed oldest first)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def dedup_stream(stream: DataFrame, delay: str = "10 minutes", bbox: staging.BBox = staging.BBox()) -> DataFrame:
    """K2: cleaned positions, first fetch per (vehicle_number, vehicle_time)."""
    s = staging.filter_valid(staging.type_parquet_positions(stream), bbox)
    s = s.withColumn("vehicle_time", F.col("vehicle_time").cast(LTZ)).withWatermark("vehicle_time", delay)
    first = F.min(F.struct(F.col("fetch_time").isNull().alias("_n"), "fetch_time", "lat", "lon",
                           "line", "brigade", "vehicle_type")).alias("f")
    g = s.groupBy("vehicle_number", "vehicle_time").agg(first)
    return g.select(F.col("f.fetch_time").alias("fetch_time"), F.col("vehicle_time").cast(NTZ).alias("vehicle_time"),
                    "vehicle_number", F.col("f.line").alias("line"), F.col("f.brigade").alias("brigade"),
                    F.col("f.vehicle_type").alias("vehicle_type"), F.col("f.lat").alias("lat"),
                    F.col("f.lon").alias("lon"))


def frames_stream(positions: DataFrame, frame_minutes: int = 15, delay: str = "10 minutes") -> DataFrame:
    """K4: one ping per vehicle per tumbling frame (the earliest)."""
    s = positions.withColumn("__t", F.col("vehicle_time").cast(LTZ)).withWatermark("__t", delay)
    g = s.groupBy("vehicle_number", F.window("__t", f"{frame_minutes} minutes").alias("w")).agg(
        F.min(F.struct("vehicle_time", "line", "vehicle_type", "lat", "lon")).alias("f"))
    frame = F.col("w.start").cast(NTZ)
    return g.select(frame.alias("frame_time"), F.date_format(frame, "HH:mm").alias("frame_label"),
                    F.hour(frame).cast("bigint").alias("hour_of_day"), "vehicle_number",
                    F.col("f.line").alias("line"),
                    code_label(F.col("f.vehicle_type"), {1: "Bus", 2: "Tram"}, "Other").alias("mode"),
                    F.col("f.lat").alias("lat"), F.col("f.lon").alias("lon"))


def best_match_stream(positions: DataFrame, sched: DataFrame, as_of: str, retention_days: int = 2, radius_m: float = 100.0,
                      window_s: int = 900, previous_service_day_until: int | None = None,
                      delay: str = "10 minutes", stops: DataFrame | None = None) -> DataFrame:
    """The best match of each ping of the stream, ``actual_time`` being the watermarked TIMESTAMP.

    ``sched`` is a written table of ``matching.schedule_points`` that every
    micro-batch scans, so the pings go to the cells and buckets within reach;
    with ``matching.schedule_keys``, bucketed by them, it is not shuffled either.
    With ``stops`` it needs no names and places of stops, which every scan would read.
    """
    # of the date column a filter would be moved before the watermark, which must see every row
    s = (positions.drop("vehicle_date").withColumn("vehicle_time", F.col("vehicle_time").cast(LTZ))
         .withWatermark("vehicle_time", delay))
    kept = matching.retained_positions(s, as_of, retention_days, previous_service_day_until)
    return matching.best_match(matching.stop_match_candidates(kept, sched, radius_m, window_s, repeat="positions", stops=stops))


def matches_stream(positions: DataFrame, sched: DataFrame, *args, **kwargs) -> DataFrame:
    """Stop matches with their delay (the columns of the batch model); parameters as ``best_match_stream``."""
    m = matching.with_delay(best_match_stream(positions, sched, *args, **kwargs))
    return m.withColumn("actual_time", F.col("actual_time").cast(NTZ))


def visits_stream(matched: DataFrame, gap_s: int = 600, delay: str = "30 minutes") -> DataFrame:
    """K5: visits (arrival = first ping) as session windows of matched pings."""
    if matched.schema["actual_time"].dataType == TimestampType():
        s = matched.withColumnRenamed("actual_time", "__t")     # keeps the watermark that the matching set
    else:
        s = matched.withColumn("__t", F.col("actual_time").cast(LTZ)).withWatermark("__t", delay)
    g = s.groupBy("line", "stop_id", "stop_name", "vehicle_number",
                  F.session_window("__t", f"{gap_s} seconds").alias("sw")).agg(F.count(F.lit(1)).alias("pings"))
    return g.select("line", "stop_id", "stop_name", "vehicle_number",
                    F.col("sw.start").cast(NTZ).alias("arrival_time"), "pings")


_MOVE_OUT = ("vehicle_number string, line string, brigade string, vehicle_type int, prev_time timestamp_ntz, "
             "vehicle_time timestamp_ntz, lat double, lon double, prev_lat double, prev_lon double, stale boolean")
# the last ping of every vehicle of the group; times in nanoseconds since the epoch
_MOVE_STATE = "vehicles array<string>, times array<bigint>, lats array<double>, lons array<double>"
# Vehicles are dealt into this many groups a bucket, each one Python call over all its rows of a micro-batch.
MOVE_GROUPS = 8


def _previous_ping(expires_after_s: int):
    """Attach each ping's predecessor, carrying every vehicle's last ping in the bucket in state; ``stale`` marks rows
    that came too late."""
    def run(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        names, times, lats, lons = state.get if state.exists else ((), (), (), ())
        # the rows of one bucket of a group of vehicles in one micro-batch, numbered by vehicle
        pdf = pd.concat(list(pdfs), ignore_index=True)
        code, known = pd.factorize(np.concatenate([np.array(names, dtype=object), pdf["vehicle_number"].to_numpy(dtype=object)]),
                                   use_na_sentinel=False)
        held = code[:len(names)]
        last_time = np.full(len(known), np.iinfo(np.int64).min)
        last_lat, last_lon = np.full(len(known), np.nan), np.full(len(known), np.nan)
        last_time[held], last_lat[held], last_lon[held] = times, lats, lons
        own, at = code[len(names):], pdf["vehicle_time"].to_numpy().astype("datetime64[ns]").astype("int64")
        order = np.lexsort((at, own))       # stable: rows alike in vehicle and time stay in their order
        own, at, pdf = own[order], at[order], pdf.iloc[order].reset_index(drop=True)
        pdf["stale"] = at <= last_time[own]
        late = pdf["stale"].to_numpy()
        stale = pdf[late].assign(prev_time=pd.NaT, prev_lat=np.nan, prev_lon=np.nan)
        own, at, pdf = own[~late], at[~late], pdf[~late].reset_index(drop=True)
        if len(pdf):
            lat, lon = pdf["lat"].to_numpy(dtype=float), pdf["lon"].to_numpy(dtype=float)
            first = np.r_[True, own[1:] != own[:-1]]
            prev = np.where(first, last_time[own], np.r_[0, at[:-1]])
            pdf["prev_time"] = pd.Series(np.where(prev == np.iinfo(np.int64).min, np.datetime64("NaT", "ns"), prev.astype("datetime64[ns]")))
            pdf["prev_lat"] = np.where(first, last_lat[own], np.r_[np.nan, lat[:-1]])
            pdf["prev_lon"] = np.where(first, last_lon[own], np.r_[np.nan, lon[:-1]])
            tail = np.r_[own[1:] != own[:-1], True]
            last_time[own[tail]], last_lat[own[tail]], last_lon[own[tail]] = at[tail], lat[tail], lon[tail]
        if len(known):
            state.update(([None if pd.isna(v) else v for v in known], last_time.tolist(), last_lat.tolist(), last_lon.tolist()))
            state.setTimeoutTimestamp(max(int(key[1] + 1) * 1000 * expires_after_s, state.getCurrentWatermarkMs() + 1))
        for x in (pdf, stale):
            x = x[~x["halo"].astype(bool)] if len(x) else x
            if len(x):
                yield x[["vehicle_number", "line", "brigade", "vehicle_type", "prev_time", "vehicle_time", "lat", "lon",
                         "prev_lat", "prev_lon", "stale"]]
    return run


def moves_stream(positions: DataFrame, min_gap_s: int = 1, max_gap_s: int = 600, max_speed_kmh: float = 100.0,
                 bucket_s: int = 3600, delay: str = "30 minutes", groups: int = MOVE_GROUPS) -> DataFrame:
    """K6: vehicle moves on a stream (same filters and rounding as the batch)."""
    from tramspark.functions.scalar import duck_round, seconds_between
    seconds = F.unix_timestamp("vehicle_time")
    own = F.floor(seconds / F.lit(bucket_s))
    p = positions.select("vehicle_number", "line", "brigade", F.col("vehicle_type").cast("int").alias("vehicle_type"),
                         "vehicle_time", "lat", "lon", F.col("vehicle_time").cast(LTZ).alias("__t"))
    p = (p.withWatermark("__t", delay).withColumn("own", own)
         .withColumn("bucket", F.explode(F.sequence(own, F.floor((seconds + F.lit(max_gap_s)) / F.lit(bucket_s)))))
         .withColumn("halo", F.col("bucket") > F.col("own")).drop("own"))
    dealt = p.withColumn("slot", F.pmod(F.xxhash64("vehicle_number"), F.lit(groups)))
    lagged = dealt.groupBy("slot", "bucket").applyInPandasWithState(
        _previous_ping(bucket_s), _MOVE_OUT, _MOVE_STATE, "append", GroupStateTimeout.EventTimeTimeout)
    m = lagged.filter(F.col("prev_time").isNotNull()).select(
        "vehicle_number", "line", "brigade", "vehicle_type", "prev_time", "vehicle_time", "lat", "lon",
        seconds_between("prev_time", "vehicle_time").alias("seconds_diff"),
        planar_distance_m("lat", "lon", "prev_lat", "prev_lon").alias("meters_diff"))
    m = m.filter(F.col("seconds_diff").between(min_gap_s, max_gap_s))
    speed = F.when(F.col("seconds_diff") > 0,
                   duck_round(F.col("meters_diff") / F.col("seconds_diff").cast("double") * F.lit(3.6), 1))
    m = m.withColumn("speed_kmh", speed)
    return m.filter(F.col("speed_kmh").isNotNull() & (F.col("speed_kmh") <= F.lit(float(max_speed_kmh))))


def upsert_sink(target_path: str, bbox: staging.BBox = staging.BBox()):
    """K7: ``foreachBatch`` function merging each cleaned micro-batch into the
    date-partitioned table at ``target_path`` (first fetch wins)."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        _merge(batch.sparkSession, target_path, staging.clean_positions(None, batch, bbox))
    return run


def _merge(spark: SparkSession, target_path: str, clean: DataFrame) -> DataFrame:
    """Merge valid typed positions into the date-partitioned table (first fetch wins, within them as well)."""
    return incremental.write_upsert(spark, target_path, clean.withColumn("vehicle_date", F.to_date("vehicle_time")),
                                    ["vehicle_number", "vehicle_time"], ["fetch_time", "lat", "lon"], "vehicle_date")


def late_aware_sink(target_path: str, side_path: str, delay: str = "10 minutes", bbox: staging.BBox = staging.BBox()):
    """K3 + K7: like ``upsert_sink``, but rows that come too late go to a side table.

    A row is late if its time is at or before the mark: the newest time of all
    earlier micro-batches less ``delay``.  Rows without a time are never kept
    (as in the batch model).  Late rows of a micro-batch are written to a folder
    of their own under ``side_path``, as is the newest time so far, both replaced
    when the micro-batch is replayed: the mark only looks at earlier ones, so a
    replay splits the rows alike.
    """
    rows, marks = f"{side_path}/rows", f"{side_path}/marks"

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        newest = None
        if path_exists(spark, marks):
            before = spark.read.schema(f"newest {NTZ}, epoch long").parquet(marks).filter(F.col("epoch") < epoch_id)
            newest = before.agg(F.max("newest")).first()[0]
        typed = staging.filter_valid(staging.type_parquet_positions(batch), bbox)
        if newest is not None:
            mark = F.lit(newest).cast(NTZ) - F.expr(f"INTERVAL {delay}")
            late = F.col("vehicle_time") <= mark
            typed.filter(late).write.mode("overwrite").parquet(f"{rows}/epoch={epoch_id}")
            batch_rows = typed.filter(~late)
        else:
            batch_rows = typed
        _merge(spark, target_path, batch_rows)
        seen = typed.agg(F.greatest(F.max("vehicle_time"), F.lit(newest).cast(NTZ)).alias("newest"))
        seen.write.mode("overwrite").parquet(f"{marks}/epoch={epoch_id}")
        # the next micro-batch needs this mark, a replay of this one the mark before
        remove_path(spark, f"{marks}/epoch={epoch_id - 2}")
    return run


def late_rows(spark: SparkSession, side_path: str) -> DataFrame | None:
    """The side table of late rows, with the micro-batch (``epoch``) that brought each; None if there is none yet."""
    rows = f"{side_path}/rows"
    if not path_exists(spark, rows):
        return None
    schema = f"fetch_time {NTZ}, vehicle_time {NTZ}, vehicle_number string, line string, brigade string, vehicle_type int, lat double, lon double, epoch long"
    return spark.read.schema(schema).parquet(rows)


def load_late(spark: SparkSession, target_path: str, side_path: str) -> DataFrame:
    """Merge the side table into the main one and return that.  Loading twice, or rows already there, changes nothing."""
    late = late_rows(spark, side_path)
    if late is None:
        return incremental.read_upserted(spark, target_path)
    return _merge(spark, target_path, late.drop("epoch"))


def run_to_completion(df: DataFrame, out_path: str, checkpoint: str, mode: str = "append") -> dict:
    """Run a streaming query over everything available now into Parquet files.

    Returns the totals from the query progress: input rows, batches and rows
    dropped as late by the watermark (K3: late data is counted, not silent).
    """
    with settings(df.sparkSession, STREAM_CONF):    # a query keeps the settings it starts with
        q = (df.writeStream.format("parquet").outputMode(mode).option("path", out_path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return progress_totals(q)


# State is written by every micro-batch; only the newest versions are read again, by a run that goes on after a failure.
STREAM_CONF = {**ONE_BY_ONE, "spark.sql.streaming.minBatchesToRetain": "2", "spark.sql.streaming.maxBatchesToRetainInMemory": "1",
               "spark.sql.streaming.stateStore.compression.codec": "zstd"}


def progress_totals(q) -> dict:
    """Sum input rows and watermark drops over a finished query's progress."""
    rows = dropped = batches = 0
    for pr in q.recentProgress:
        batches += 1
        rows += int(pr.get("numInputRows", 0) or 0)
        for op in pr.get("stateOperators", []) or []:
            dropped += int(op.get("numRowsDroppedByWatermark", 0) or 0)
    return {"batches": batches, "input_rows": rows, "dropped_late_rows": dropped}


CLOSING = "(closing)"


def land_in_order(df: DataFrame, path: str, order_col: str, rows_per_file: int = 50_000, min_files: int = 12,
                  close: dict | None = None, written: bool = False) -> int:
    """Write ``df`` as Parquet files covering consecutive ranges of ``order_col`` and stamp their modification times
    in that order, so a file-stream source reads them in arrival order (fixture helper).

    The number of files follows the rows.  ``close`` adds a last file with one
    row: these values, the name ``CLOSING`` as vehicle and a time a day after
    the last row; it moves the watermark past everything else, so that no
    earlier row stays open, and is itself never emitted.  A table already ``written``
    is read as it is.  Returns the number of files.
    """
    spark = df.sparkSession
    staged = None if written else shared_dir(spark, "landing-rows")
    if staged:                                      # counted, sampled for the ranges and dealt: computed once
        df.write.parquet(staged)
        df = spark.read.schema(df.schema).parquet(staged)
    total = df.agg(F.count(F.lit(1)).alias("n"), F.max(order_col).alias("last")).first()
    files = max(min_files, -(-total["n"] // rows_per_file))
    df.repartitionByRange(files, order_col).sortWithinPartitions(order_col).write.parquet(path)
    if staged:
        remove_path(spark, staged)
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())

    def landed() -> list[str]:
        return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().endswith(".parquet"))

    order = landed()
    if close is not None and total["last"] is not None:
        last = F.lit(total["last"]).cast(NTZ) + F.make_dt_interval(F.lit(1))
        values = {"vehicle_number": F.lit(CLOSING), order_col: last, **{k: F.lit(v) for k, v in close.items()}}
        row = spark.range(1).select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in df.schema.fields])
        row.write.mode("append").parquet(path)
        order += [n for n in landed() if n not in set(order)]
    base = 1_000_000_000_000
    for i, name in enumerate(order):
        fs.setTimes(jvm.org.apache.hadoop.fs.Path(p, name), base + i * 1000, -1)
    return len(order)


# Micro-batches that a landed backlog is read in at most.  Each costs tasks, state files and progress reports however few
# rows it has, so their number must not follow the rows; its state, the rows of one or two micro-batches, is spread over
# the executors.
MAX_BATCHES = 16


def files_per_trigger(files: int, least: int) -> int:
    """Files of a micro-batch: ``least``, or as many as read ``files`` in ``MAX_BATCHES`` micro-batches."""
    return max(least, -(-files // MAX_BATCHES))
