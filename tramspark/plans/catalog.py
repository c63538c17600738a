"""Registered queries: key -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver tables through the adapters (or data Spark
derives from them) and runs the library's operators over the whole input.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from tramspark.functions import scalar as S
from tramspark.operators import history, incremental, ledger, matching, quality, reports, staging
from tramspark.plans.incremental import POSITION_FEEDS, build_incremental, run_load, tables
from tramspark.plans.pipeline import FIXTURE_PARAMS, Models, Params, bucketed, build_graph
from tramspark.plans.statements import Statements
from tramspark.session import ONE_BY_ONE, settings, shared_dir
from tramspark.sources import files, fixtures
from tramspark.sources.schemas import POSITION_COLUMNS
from tramspark.sources.store import Store
from tramspark.streaming import positions as streams

QueryFn = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn
    return deco


def models(spark: SparkSession, sf_dir: str, params: Params = FIXTURE_PARAMS,
           materialize_shared: bool = False) -> Models:
    """Model graph over the adapter inputs of ``sf_dir``.

    Lazy by default; with ``materialize_shared`` the models read by several
    others are written once to the shared checkpoint folder and read back, so
    a query touching many models does not recompute the graph per branch.
    """
    return Models(fixtures.transit_inputs(spark, sf_dir), params, materialize_shared)


def _model_query(name: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return models(spark, sf_dir)[name]
    run.__name__ = f"model_{name}"
    run.__doc__ = f"The ``{name}`` model over the adapter inputs."
    return run


# Keys that return a whole model.
MODEL_KEYS = {
    "clean_positions": "positions",
    "gtfs_stops": "stops",
    "gtfs_routes": "routes",
    "gtfs_trips": "trips",
    "gtfs_stop_times": "stop_times",
    "calendar": "calendar",
    "vehicle_moves": "moves",
    "stop_matches": "matches",
    "stop_visits": "visits",
    "headway": "headway",
    "route_segments": "segments",
    "line_speed": "line_speed",
    "speed_by_hour": "speed_by_hour",
    "speed_grid": "speed_grid",
    "line_punctuality": "line_punctuality",
    "punctuality_by_hour": "punctuality_by_hour",
    "worst_stops": "worst_stops",
    "line_regularity": "line_regularity",
    "slowest_segments": "slowest_segments",
    "animation_frames": "animation_frames",
}

for _key, _model in MODEL_KEYS.items():
    REGISTRY[_key] = _model_query(_model)


# ---------------------------------------------------------------------------
# sources, filters, joins
# ---------------------------------------------------------------------------



REPORT_DAY = "2024-01-15"
HEADER_PARTS = 8        # files of the text feed, each with a header line


@register("scan_csv_positions")
def scan_csv_positions(spark, sf_dir):
    """Legacy text feed written as CSV parts (each part starts with a header
    line), read back headerless with declared names; header lines dropped."""
    path = shared_dir(spark, "positions-csv")
    fixtures.raw_feed_text(spark, sf_dir).write.option("header", True).csv(path)
    return files.drop_header_rows(files.read_positions_csv(spark, path))


@register("filter_header_rows")
def filter_header_rows(spark, sf_dir):
    """The header lines alone that the headerless reader meets in the parts of the text feed: rows of the feed and
    header rows are counted apart (A4)."""
    path = shared_dir(spark, "positions-csv")
    (fixtures.raw_feed_text(spark, sf_dir).repartition(HEADER_PARTS, "vehicle_number").write.option("header", True).csv(path))
    raw = files.read_positions_csv(spark, path)
    kept = files.drop_header_rows(raw)
    return kept.groupBy("line").agg(F.count(F.lit(1)).alias("n"),
                                    F.count(F.when(F.col("fetch_time") == "fetch_time", 1)).alias("header_rows"))


@register("scan_parquet")
def scan_parquet(spark, sf_dir):
    """Typed batches written as zstd Parquet partitioned by date, read back."""
    path = shared_dir(spark, "positions-parquet")
    files.write_positions_batch(fixtures.raw_feed_typed(spark, sf_dir), path)
    return files.read_positions_parquet(spark, path).select(*POSITION_COLUMNS)


@register("scan_two_feeds")
def scan_two_feeds(spark, sf_dir):
    """Two collectors' batches in folders of their own, read by one glob."""
    path, feed = shared_dir(spark, "feeds"), fixtures.raw_feed_typed(spark, sf_dir)
    early = F.hour("fetch_time") < 12
    files.write_positions_batch(feed.filter(early), f"{path}/collector_a", None)
    files.write_positions_batch(feed.filter(~early), f"{path}/collector_b", None)
    return files.read_positions_parquet(spark, f"{path}/collector_*").select(*POSITION_COLUMNS)


@register("landing_gate")
def landing_gate(spark, sf_dir):
    """Landing statistics of a written drop: its rows, and whether files and bytes arrived."""
    path = shared_dir(spark, "landing")
    files.write_positions_batch(fixtures.raw_feed_typed(spark, sf_dir), path, None)
    return files.landing_stats(files.read_positions_parquet(spark, path)).select(
        "rows", (F.col("files") > 0).alias("has_files"), (F.col("total_bytes") >= 1000).alias("has_bytes"),
        F.col("newest_modified").isNotNull().alias("has_time"))


@register("scan_gtfs")
def scan_gtfs(spark, sf_dir):
    """stops.txt written with a header and read back as all-text columns by name."""
    path = shared_dir(spark, "stops-txt")
    fixtures.stops_text(spark, sf_dir).write.option("header", True).csv(path)
    return files.read_gtfs(spark, path, "stops")


@register("coerce_types")
def coerce_types(spark, sf_dir):
    """Ingest coercion of the text feed: ids text, type tinyint, lat/lon double."""
    return files.coerce_position_types(fixtures.raw_feed_text(spark, sf_dir))


def _union(spark, sf_dir):
    i = fixtures.transit_inputs(spark, sf_dir)
    return staging.union_sources(i["positions_csv"], i["positions_parquet"])


@register("union_sources")
def union_sources(spark, sf_dir):
    return _union(spark, sf_dir)


@register("filter_not_null")
def filter_not_null(spark, sf_dir):
    return _union(spark, sf_dir).filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()
                                        & F.col("vehicle_time").isNotNull())


@register("filter_bbox")
def filter_bbox(spark, sf_dir):
    b = staging.BBox()
    return _union(spark, sf_dir).filter(F.col("lat").between(b.lat_min, b.lat_max)
                                        & F.col("lon").between(b.lon_min, b.lon_max))


@register("dedup_first")
def dedup_first(spark, sf_dir):
    return staging.dedup_first(_union(spark, sf_dir))


@register("filter_recent")
def filter_recent(spark, sf_dir):
    return reports.recent(models(spark, sf_dir)["positions"], FIXTURE_PARAMS.as_of, 2)


@register("project_rename")
def project_rename(spark, sf_dir):
    r = fixtures.routes_text(spark, sf_dir)
    return r.select("route_id", F.col("route_short_name").alias("line"), "route_long_name")


@register("join_trips_routes")
def join_trips_routes(spark, sf_dir):
    m = models(spark, sf_dir)
    return matching.trips_with_line(m["trips"], m["routes"])


@register("semi_join_dates")
def semi_join_dates(spark, sf_dir):
    m = models(spark, sf_dir)
    return m["trips"].select("trip_id", "service_date").join(staging.collected_dates(m["positions"]),
                                                              "service_date", "left_semi")


@register("distinct_modes")
def distinct_modes(spark, sf_dir):
    return reports.distinct_modes(models(spark, sf_dir)["positions"])


# ---------------------------------------------------------------------------
# reports
# ---------------------------------------------------------------------------

@register("overview")
def overview(spark, sf_dir):
    m = models(spark, sf_dir)
    return reports.overview(m["positions"], m["moves"], m["matches"])


@register("speed_by_hour_rollup")
def speed_by_hour_rollup(spark, sf_dir):
    return reports.speed_by_hour_rollup(models(spark, sf_dir)["speed_by_hour"], 10, 0, 23)


@register("least_punctual")
def least_punctual(spark, sf_dir):
    return reports.least_punctual(models(spark, sf_dir)["line_punctuality"], 10, 10)


@register("most_bunched")
def most_bunched(spark, sf_dir):
    return reports.most_bunched(models(spark, sf_dir)["line_regularity"], 10, 15)


@register("least_regular")
def least_regular(spark, sf_dir):
    return reports.least_regular(models(spark, sf_dir)["line_regularity"], 12)


@register("most_regular")
def most_regular(spark, sf_dir):
    return reports.most_regular(models(spark, sf_dir)["line_regularity"], 5)


@register("top_bottlenecks")
def top_bottlenecks(spark, sf_dir):
    return reports.top_bottlenecks(models(spark, sf_dir)["slowest_segments"], 10, 10)


@register("segment_labels")
def segment_labels(spark, sf_dir):
    s = models(spark, sf_dir)["slowest_segments"].select("line", "from_stop", "to_stop", "avg_lost_min")
    return reports.with_segment_labels(s)


@register("fastest_segments")
def fastest_segments(spark, sf_dir):
    return reports.fastest_segments(models(spark, sf_dir)["slowest_segments"], 5)


@register("slowest_segments_top")
def slowest_segments_top(spark, sf_dir):
    return reports.slowest_segments_top(models(spark, sf_dir)["slowest_segments"], 15)


@register("segment_counts")
def segment_counts(spark, sf_dir):
    m = models(spark, sf_dir)
    return reports.segment_counts(m["segments"], m["slowest_segments"])


@register("grid_summary")
def grid_summary(spark, sf_dir):
    return reports.grid_summary(models(spark, sf_dir)["speed_grid"])


@register("slowest_cells")
def slowest_cells(spark, sf_dir):
    return reports.slowest_cells(models(spark, sf_dir)["speed_grid"], 50, 8)


@register("table_counts")
def table_counts(spark, sf_dir):
    m = models(spark, sf_dir)
    return reports.table_counts(m["positions"], m["stops"], m["routes"], m["trips"], m["stop_times"])


@register("match_rate")
def match_rate(spark, sf_dir):
    m = models(spark, sf_dir)
    return reports.match_rate(m["positions"], matching.trips_with_line(m["trips"], m["routes"]), REPORT_DAY)


@register("top_line_brigade")
def top_line_brigade(spark, sf_dir):
    return reports.top_line_brigade(models(spark, sf_dir)["positions"], REPORT_DAY, 5)


@register("top_line_brigade_gtfs")
def top_line_brigade_gtfs(spark, sf_dir):
    m = models(spark, sf_dir)
    return reports.top_line_brigade_gtfs(matching.trips_with_line(m["trips"], m["routes"]), REPORT_DAY, 5)


@register("delay_summary")
def delay_summary(spark, sf_dir):
    return reports.delay_summary(models(spark, sf_dir)["matches"])


@register("largest_delays")
def largest_delays(spark, sf_dir):
    return reports.largest_delays(models(spark, sf_dir)["matches"], 10)


@register("delay_buckets")
def delay_buckets(spark, sf_dir):
    return reports.delay_buckets(models(spark, sf_dir)["matches"])


@register("bunching_rate")
def bunching_rate(spark, sf_dir):
    return reports.bunching_rate(models(spark, sf_dir)["headway"])


@register("animation_stats")
def animation_stats(spark, sf_dir):
    return reports.animation_stats(models(spark, sf_dir)["animation_frames"])


@register("frame_histogram")
def frame_histogram(spark, sf_dir):
    return reports.frame_histogram(models(spark, sf_dir)["animation_frames"], 10)


@register("coverage_by_hour")
def coverage_by_hour(spark, sf_dir):
    return reports.coverage_by_hour(models(spark, sf_dir)["positions"], FIXTURE_PARAMS.as_of, 2)


@register("coverage_range")
def coverage_range(spark, sf_dir):
    return reports.coverage_range(models(spark, sf_dir)["positions"], FIXTURE_PARAMS.as_of, 7)


@register("punctuality_window")
def punctuality_window(spark, sf_dir):
    return reports.punctuality_window(models(spark, sf_dir)["punctuality_by_hour"], 50, 6, 22)


@register("segment_details")
def segment_details(spark, sf_dir):
    return reports.segment_details(models(spark, sf_dir)["slowest_segments"], 10, 20)


@register("fetch_histogram")
def fetch_histogram(spark, sf_dir):
    """Polls per fetch time from the raw CSV file itself, the ten newest."""
    path = shared_dir(spark, "positions-csv")
    fixtures.raw_feed_text(spark, sf_dir).write.option("header", True).csv(path)
    return reports.fetch_histogram(files.read_positions_csv(spark, path), 10)


@register("load_watermark")
def load_watermark(spark, sf_dir):
    return reports.load_watermark(models(spark, sf_dir)["positions"])


# ---------------------------------------------------------------------------
# scalar functions over whole tables
# ---------------------------------------------------------------------------

@register("scalar_casts")
def scalar_casts(spark, sf_dir):
    """Lenient text parsing of every raw text row (H1, H2)."""
    t = fixtures.raw_feed_text(spark, sf_dir)
    return t.select(
        S.try_timestamp("fetch_time").alias("fetch_ts"),
        S.try_timestamp("vehicle_time").cast("date").alias("vehicle_date"),
        S.try_int("vehicle_type").alias("vehicle_type"),
        S.try_double("lat").alias("lat"),
        S.try_int(F.concat(F.col("line"), F.lit(".5"))).alias("line_half_up"),
        S.try_date("vehicle_number").alias("not_a_date"),
        S.try_timestamp(F.substring("vehicle_time", 1, 7)).alias("month_only"),
        S.try_date(F.substring("vehicle_time", 1, 10)).alias("date_text"),
        S.try_timestamp(F.concat("vehicle_time", F.lit("Z"))).alias("utc_mark"),
        S.try_timestamp(F.concat("vehicle_time", F.lit("+02"))).alias("zone_hours"),
        S.try_timestamp(F.concat("vehicle_time", F.lit(".25 -03:30 "))).alias("zone_minutes"),
        S.try_timestamp(F.regexp_replace("vehicle_time", "-", "/")).alias("slashes"),
        S.try_timestamp(F.concat("vehicle_time", F.lit("  "))).alias("trailing_blanks"),
        S.try_timestamp(F.concat(F.substring("vehicle_time", 1, 10), F.lit("Z"))).alias("date_with_zone"),
        S.try_date(F.concat(F.regexp_replace("vehicle_time", "-", "/"), F.lit(" UTC"))).alias("date_of_slashes"))


@register("scalar_text")
def scalar_text(spark, sf_dir):
    """split_part, substring and concatenation over trips."""
    t = fixtures.trips_text(spark, sf_dir)
    return t.select(
        "trip_id",
        F.split_part("trip_id", F.lit(":"), F.lit(1)).alias("date_part"),
        F.split_part("trip_id", F.lit(":"), F.lit(2)).alias("run_part"),
        F.split_part("trip_id", F.lit(":"), F.lit(3)).alias("missing_part"),
        F.substring("trip_id", 1, 18).alias("prefix18"),
        F.concat(F.col("route_id"), F.lit(":  "), F.col("block_short_name")).alias("label"))


@register("scalar_time")
def scalar_time(spark, sf_dir):
    """Interval arithmetic past 24 h, extraction, formatting, buckets."""
    m = models(spark, sf_dir)
    st = m["stop_times"]
    return st.select(
        "trip_id", "stop_sequence", "scheduled_arrival",
        S.seconds_between(F.col("service_date").cast("timestamp_ntz"), "scheduled_arrival").alias("secs_from_day"),
        F.hour("scheduled_arrival").cast("bigint").alias("hour_of_day"),
        S.day_of_week_sun0("scheduled_arrival").alias("dow"),
        F.date_format("scheduled_arrival", "EEEE").alias("day_name"),
        F.date_format("scheduled_arrival", "HH:mm").alias("hhmm"),
        S.time_bucket("scheduled_arrival", 15).alias("bucket15"),
        F.year("scheduled_arrival").cast("bigint").alias("year"),
        F.month("scheduled_arrival").cast("bigint").alias("month"),
        F.dayofmonth("scheduled_arrival").cast("bigint").alias("day"))


@register("scalar_math")
def scalar_math(spark, sf_dir):
    """sqrt/pow/cos/radians/abs, rounding, coalesce/nullif, grid snap."""
    p = models(spark, sf_dir)["positions"]
    return p.select(
        "vehicle_number", "vehicle_time",
        F.sqrt(F.abs(F.col("lat") - F.lit(52.2))).alias("sqrt_dlat"),
        F.pow(F.col("lon") - F.lit(21.0), F.lit(2.0)).alias("pow_dlon"),
        F.cos(F.radians("lat")).alias("cos_lat"),
        S.duck_round("lat", 3).alias("lat3"),
        S.duck_round(F.col("lon") * F.lit(1000.0), 0).alias("lon_milli"),
        F.coalesce(F.col("vehicle_type"), F.lit(-1)).alias("vt_or_minus1"),
        F.when(F.col("vehicle_type") != F.lit(1), F.col("vehicle_type")).alias("vt_nullif_1"),
        (S.duck_round(F.col("lat") / F.lit(0.0027), 0) * F.lit(0.0027)).alias("cell_lat"))


# ---------------------------------------------------------------------------
# data quality
# ---------------------------------------------------------------------------

def extra_checks() -> list:
    """Checks on the raw feed before cleaning (these do find failures)."""
    C = quality.Check
    return [
        C("unique_combination", "raw_positions", ("vehicle_number", "vehicle_time")),
        C("accepted_range", "raw_positions", ("lat",), min_value=51.9, max_value=52.5),
        C("not_null", "raw_positions", ("fetch_time",)),
    ]


def _dq(spark, sf_dir, tests: set | None):
    """All declared checks of the given kinds, on models written once for the query."""
    m = models(spark, sf_dir, materialize_shared=True)
    numbered = [(i, c) for i, c in enumerate(quality.declared_checks() + extra_checks())
                if tests is None or c.test in tests]
    checks = [c for _, c in numbered]
    names = {c.model for c in checks} | {c.to_model for c in checks if c.to_model}
    frames = {n: (_union(spark, sf_dir) if n == "raw_positions" else m[n]) for n in names}
    return quality.run_checks(frames, checks, [i for i, _ in numbered])


@register("dq_not_null")
def dq_not_null(spark, sf_dir):
    return _dq(spark, sf_dir, {"not_null"})


@register("dq_unique")
def dq_unique(spark, sf_dir):
    return _dq(spark, sf_dir, {"unique"})


@register("dq_accepted_values")
def dq_accepted_values(spark, sf_dir):
    return _dq(spark, sf_dir, {"accepted_values"})


@register("dq_accepted_range")
def dq_accepted_range(spark, sf_dir):
    return _dq(spark, sf_dir, {"accepted_range"})


@register("dq_relationships")
def dq_relationships(spark, sf_dir):
    return _dq(spark, sf_dir, {"relationships"})


@register("dq_unique_combination")
def dq_unique_combination(spark, sf_dir):
    return _dq(spark, sf_dir, {"unique_combination"})


# ---------------------------------------------------------------------------
# history and incremental loads
# ---------------------------------------------------------------------------

SNAP_T1 = "2024-01-01 00:00:00"
SNAP_T2 = "2024-01-15 00:00:00"


def _stops_history(spark, sf_dir):
    v1, v2 = fixtures.stops_text_versions(spark, sf_dir)
    cols = ["stop_name", "stop_lat", "stop_lon"]
    h1 = history.snapshot(staging.gtfs_stops(v1), None, "stop_id", cols, SNAP_T1)
    return history.snapshot(staging.gtfs_stops(v2), h1, "stop_id", cols, SNAP_T2)


@register("scd2_stops")
def scd2_stops(spark, sf_dir):
    """Stops history after two published versions (check strategy)."""
    return _stops_history(spark, sf_dir)


@register("scd2_routes")
def scd2_routes(spark, sf_dir):
    """Routes history after two published versions (check strategy)."""
    v1, v2 = fixtures.routes_text_versions(spark, sf_dir)
    cols = ["line", "route_long_name", "route_type"]
    h1 = history.snapshot(staging.gtfs_routes(v1), None, "route_id", cols, SNAP_T1)
    return history.snapshot(staging.gtfs_routes(v2), h1, "route_id", cols, SNAP_T2)


@register("scd2_asof_lookup")
def scd2_asof_lookup(spark, sf_dir):
    """Stop matches with the stop name and position valid at the arrival time."""
    mt = models(spark, sf_dir)["matches"].select("vehicle_number", "actual_time", "stop_id")
    return history.asof_lookup(mt, _stops_history(spark, sf_dir), "stop_id", "actual_time",
                               ["stop_name", "stop_lat"], prefix="hist_")


SLICE_AT = "2024-01-16 00:00:00"
BATCH_FROM = "2024-01-15 00:00:00"


@register("incremental_upsert")
def incremental_upsert(spark, sf_dir):
    """Load positions before 16 Jan, then upsert a batch cleaned from the raw
    feed from 15 Jan on (overlapping day): equals the full load."""
    m = models(spark, sf_dir)
    cut = F.lit(SLICE_AT).cast("timestamp_ntz")
    start = F.lit(BATCH_FROM).cast("timestamp_ntz")
    target = m["positions"].filter(F.col("vehicle_time") < cut)
    i = m.inputs
    batch = staging.clean_positions(i["positions_csv"].filter(S.try_timestamp("vehicle_time") >= start),
                                    i["positions_parquet"].filter(F.col("vehicle_time") >= start))
    day = F.to_date("vehicle_time")
    out = incremental.upsert(target.withColumn("vehicle_date", day), batch.withColumn("vehicle_date", day),
                             ["vehicle_number", "vehicle_time"], ["fetch_time", "lat", "lon"],
                             partition_col="vehicle_date")
    return out.drop("vehicle_date")


def _late_polls(i):
    """Raw rows from the slice on that were polled again (fetched over a minute after their time)."""
    start = F.lit(BATCH_FROM).cast("timestamp_ntz")

    def late(seen, fetched):
        return (seen >= start) & (S.seconds_between(seen, fetched) > F.lit(60))
    text, typed = i["positions_csv"], i["positions_parquet"]
    return staging.clean_positions(text.filter(late(S.try_timestamp("vehicle_time"), S.try_timestamp("fetch_time"))),
                                   typed.filter(late(F.col("vehicle_time"), F.col("fetch_time"))))


@register("incremental_delete_insert")
def incremental_delete_insert(spark, sf_dir):
    """The full load written by date, then the later polls from 15 Jan on merged by delete+insert: the batch wins."""
    m = models(spark, sf_dir)
    path, day = shared_dir(spark, "delete-insert"), F.to_date("vehicle_time")
    keys, order = ["vehicle_number", "vehicle_time"], ["fetch_time", "lat", "lon"]
    incremental.write_upsert(spark, path, m["positions"].withColumn("vehicle_date", day), keys, order, "vehicle_date")
    out = incremental.write_upsert(spark, path, _late_polls(m.inputs).withColumn("vehicle_date", day), keys, order,
                                   "vehicle_date", "delete_insert")
    return out.select(*m["positions"].columns)


@register("incremental_matches")
def incremental_matches(spark, sf_dir):
    """Matches up to 16 Jan written by date; then only positions newer than the newest matched ping are matched and
    merged by (vehicle, time): equals the full model."""
    m = models(spark, sf_dir)
    path, day = shared_dir(spark, "matches-table"), F.to_date("actual_time")
    keys = ["vehicle_number", "actual_time"]
    early = m["matches"].filter(F.col("actual_time") < F.lit(SLICE_AT).cast("timestamp_ntz")).withColumn("match_date", day)
    loaded = incremental.write_upsert(spark, path, early, keys, [], "match_date", "delete_insert")
    fresh = models(spark, sf_dir)
    fresh.put("positions", incremental.newer_than_target(m["positions"], loaded, "vehicle_time", "actual_time"))
    fresh.put("stop_times", m["stop_times"])
    out = incremental.write_upsert(spark, path, fresh["matches"].withColumn("match_date", day), keys, [], "match_date",
                                   "delete_insert")
    return out.select(*m["matches"].columns)


@register("full_refresh_rebuild")
def full_refresh_rebuild(spark, sf_dir):
    """A10: the graph built into a folder, then built again into it from a feed without the days from 16 Jan on:
    rows per table and day of the second build."""
    out = shared_dir(spark, "rebuild")
    i = fixtures.transit_inputs(spark, sf_dir)
    cut = F.lit(SLICE_AT).cast("timestamp_ntz")
    shrunk = {**i, "positions_csv": i["positions_csv"].filter(S.try_timestamp("vehicle_time") < cut),
              "positions_parquet": i["positions_parquet"].filter(F.col("vehicle_time") < cut)}
    names = ["positions", "matches"]
    build_graph(i, FIXTURE_PARAMS, out, names=names)
    tables = build_graph(shrunk, FIXTURE_PARAMS, out, names=names)
    parts = [tables[n].groupBy(F.to_date(t).alias("day")).agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit(n).alias("table_name"), "day", "n") for n, t in (("positions", "vehicle_time"), ("matches", "actual_time"))]
    return parts[0].unionByName(parts[1])


@register("incremental_run")
def incremental_run(spark, sf_dir):
    """Three incremental runs of the whole graph (feeds up to 10 Jan, up to 16 Jan, all): the last run's line
    punctuality, equal to a full build."""
    out = shared_dir(spark, "incremental-run")
    i = _published(spark, fixtures.transit_inputs(spark, sf_dir))
    built = None
    for until in ("2024-01-10 00:00:00", SLICE_AT, None):
        feed = dict(i)
        if until:
            cut = F.lit(until).cast("timestamp_ntz")
            feed["positions_csv"] = i["positions_csv"].filter(S.try_timestamp("fetch_time") < cut)
            feed["positions_parquet"] = i["positions_parquet"].filter(F.col("fetch_time") < cut)
        built = build_incremental(feed, FIXTURE_PARAMS, out)
    return built["line_punctuality"]


def _published(spark, inputs: dict) -> dict:
    """``inputs`` with the timetable's tables written once, as the files that several loads read."""
    path, names = shared_dir(spark, "timetable"), [n for n in inputs if n not in POSITION_FEEDS]
    for n in names:
        inputs[n].write.parquet(f"{path}/{n}")
    return {**inputs, **{n: spark.read.schema(inputs[n].schema).parquet(f"{path}/{n}") for n in names}}


def _landed(spark, sf_dir) -> tuple[dict, dict]:
    """Two collectors' files in two drops: in the first, the typed feed is a day behind the text feed and a seventh of
    all earlier pings of both is missing; the second brings the rest.  (Feeds by drop, timetable.)"""
    i, path = fixtures.transit_inputs(spark, sf_dir), shared_dir(spark, "drops")
    feeds = {}
    for kind, name, until in (("csv", "positions_csv", "2024-01-16 00:00:00"), ("parquet", "positions_parquet", "2024-01-15 00:00:00")):
        rows, fetched = i.pop(name), S.try_timestamp("fetch_time") if kind == "csv" else F.col("fetch_time")
        first = (fetched < F.lit(until).cast("timestamp_ntz")) & (F.pmod(F.xxhash64("vehicle_number", "vehicle_time"), F.lit(7)) != 0)
        for drop, part in (("a", rows.filter(first)), ("b", rows.filter(~first))):
            writer = part.write.option("header", True)
            getattr(writer, kind)(f"{path}/{name}/{drop}")
        feeds[name] = [ledger.FileFeed(kind, f"{path}/{name}/{d}") for d in ("a", "[ab]")]
    return feeds, i


def _two_drops(spark, sf_dir):
    """Both drops loaded one after the other, and the second once more (which loads nothing): the store and the timetable."""
    feeds, timetable = _landed(spark, sf_dir)
    out = shared_dir(spark, "two-drops")
    timetable = _published(spark, timetable)
    for drop in (0, 1, 1):
        store = run_load(spark, out, {n: f[drop] for n, f in feeds.items()}, timetable, FIXTURE_PARAMS)
    return store, timetable


@register("load_ledger")
def load_ledger(spark, sf_dir):
    """How far each feed has been loaded after two drops of files, the slower feed's late ones included."""
    store, _ = _two_drops(spark, sf_dir)
    return ledger.marks(store.read("load_ledger")).select("feed", "loads", "rows", "mark")


@register("incremental_headway")
def incremental_headway(spark, sf_dir):
    """Headway after a second drop with late pings of every day, by the touched pieces alone: equals a full build."""
    store, timetable = _two_drops(spark, sf_dir)
    return tables(store, timetable)["headway"]


@register("incremental_segments")
def incremental_segments(spark, sf_dir):
    """Segments after a second drop with late pings of every day, by the touched trips alone: equals a full build."""
    store, timetable = _two_drops(spark, sf_dir)
    return tables(store, timetable)["segments"]


# Marts in one long form: their key columns as one text, and their measures.
MART_FORMS = {
    "line_speed": (["line"], ["num_measurements", "avg_speed_kmh", "min_speed_kmh", "max_speed_kmh"]),
    "speed_by_hour": (["line", "hour_of_day"], ["measurements", "avg_speed_kmh", "median_speed_kmh", "pct_crawling"]),
    "speed_grid": (["CAST(round(cell_lat * 1e6) AS BIGINT)", "CAST(round(cell_lon * 1e6) AS BIGINT)"],
                   ["observations", "avg_speed_kmh", "median_speed_kmh", "pct_crawling", "modes"]),
    "line_punctuality": (["line"], ["measurements", "avg_delay_min", "median_delay_min", "pct_on_time", "pct_late", "pct_early"]),
    "punctuality_by_hour": (["hour_of_day"], ["measurements", "avg_delay_min", "median_delay_min", "pct_late", "avg_abs_deviation_min"]),
    "worst_stops": (["stop_id", "stop_name"], ["measurements", "lines_served", "avg_delay_min", "max_delay_min", "pct_late"]),
    "line_regularity": (["line"], ["observations", "avg_headway_min", "median_headway_min", "headway_stddev", "pct_bunched", "irregularity_index"]),
    "slowest_segments": (["line", "from_stop", "to_stop"], ["observations", "avg_actual_min", "avg_scheduled_min", "avg_lost_min",
                                                            "worst_lost_min", "pct_runs_over_schedule"]),
}


@register("incremental_marts")
def incremental_marts(spark, sf_dir):
    """Everything up to the last day loaded, then that day alone: every measure of every mart, from merged
    states of days, equal to a full build."""
    out, i = shared_dir(spark, "incremental-marts"), _published(spark, fixtures.transit_inputs(spark, sf_dir))
    cut = F.lit("2024-01-30 00:00:00").cast("timestamp_ntz")
    early = {**i, "positions_csv": i["positions_csv"].filter(S.try_timestamp("fetch_time") < cut),
             "positions_parquet": i["positions_parquet"].filter(F.col("fetch_time") < cut)}
    build_incremental(early, FIXTURE_PARAMS, out)
    found = build_incremental(i, FIXTURE_PARAMS, out)
    parts = []
    for mart, (keys, measures) in MART_FORMS.items():
        text = F.concat_ws("|", *[F.expr(k).cast("string") for k in keys])
        each = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures]))
        parts.append(found[mart].select(F.lit(mart).alias("mart"), text.alias("key"), each.alias("x")).select("mart", "key", "x.measure", "x.value"))
    return reduce(DataFrame.unionByName, parts)


@register("high_water_mark")
def high_water_mark(spark, sf_dir):
    """Raw typed rows fetched after the newest fetch already loaded."""
    m = models(spark, sf_dir)
    loaded = m["positions"].filter(F.col("fetch_time") < F.lit(SLICE_AT).cast("timestamp_ntz"))
    return incremental.newer_than_target(_union(spark, sf_dir), loaded, "fetch_time")


# ---------------------------------------------------------------------------
# streaming (each runs to completion, then returns its sink as a DataFrame)
# ---------------------------------------------------------------------------


STREAM_FILES_PER_TRIGGER = 3
IN_AREA = {"lat": 52.2, "lon": 21.0}    # the closing row must pass the cleaning rules


def _arrival(mixed: bool):
    """Arrival order of raw rows: by time, or (``mixed``) out of order by up to five minutes within the watermark's delay."""
    late = F.when(F.pmod(F.xxhash64("vehicle_number", "vehicle_time"), F.lit(3)) == 0, F.lit(300)).otherwise(F.lit(0))
    return F.col("vehicle_time") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), late if mixed else F.lit(0))


def _land_raw(spark, sf_dir, mixed: bool = False) -> DataFrame:
    """The raw feed as typed collector batches landing in time order (or out of order), closed by a marker: a stream."""
    src = shared_dir(spark, "stream-raw")
    raw = _union(spark, sf_dir).select(
        "fetch_time", "vehicle_number", "line", "brigade",
        F.col("vehicle_type").cast("tinyint").alias("vehicle_type"), "lat", "lon", "vehicle_time")
    if mixed:
        raw = raw.withColumn("arrival", _arrival(True))
    landed = streams.land_in_order(raw, src, "arrival" if mixed else "vehicle_time",
                                   close={**IN_AREA, **({"vehicle_time": "2030-01-01 00:00:00"} if mixed else {})})
    return streams.position_stream(spark, src, _per_trigger(landed))


def _per_trigger(landed: int) -> int:
    return streams.files_per_trigger(landed, STREAM_FILES_PER_TRIGGER)


def _stream(spark, df, name, order_col, close=None, written=False):
    """``df`` landed in time order with a closing marker, as a stream."""
    src = shared_dir(spark, name)
    landed = streams.land_in_order(df, src, order_col, close=close or {}, written=written)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", _per_trigger(landed)).parquet(src)


def _drain(spark, df, name, mode="append"):
    sink, ckpt = shared_dir(spark, f"{name}-sink"), shared_dir(spark, f"{name}-ckpt")
    streams.run_to_completion(df, sink, ckpt, mode)
    return spark.read.parquet(sink).filter(F.col("vehicle_number") != streams.CLOSING)


@register("stream_dedup")
def stream_dedup(spark, sf_dir):
    """K1+K2: file-stream of raw batches, first fetch per (vehicle, time) by
    event-time aggregation with a 10-minute watermark: equals the batch model."""
    s = _land_raw(spark, sf_dir)
    return _drain(spark, streams.dedup_stream(s, "10 minutes"), "stream-dedup")


@register("stream_dedup_mixed")
def stream_dedup_mixed(spark, sf_dir):
    """K2+K3: as ``stream_dedup`` with a third of the pings arriving five minutes late, within the watermark's delay
    (a micro-batch spans days, so lateness beyond it is tested on hand-made batches)."""
    s = _land_raw(spark, sf_dir, True)
    return _drain(spark, streams.dedup_stream(s, "10 minutes"), "stream-dedup-mixed")


@register("stream_frames")
def stream_frames(spark, sf_dir):
    """K4: 15-minute frames over the cleaned-position stream, all days."""
    s = _stream(spark, models(spark, sf_dir)["positions"], "stream-positions", "vehicle_time")
    return _drain(spark, streams.frames_stream(s, 15, "10 minutes"), "stream-frames")


def _matching_inputs(spark, sf_dir) -> dict:
    """The position stream, the written timetable and the matching parameters."""
    with settings(spark, ONE_BY_ONE):
        return _written_matching_inputs(spark, sf_dir)


def _written_matching_inputs(spark, sf_dir) -> dict:
    m, p = models(spark, sf_dir, materialize_shared=True), FIXTURE_PARAMS
    m.put("stop_times", staging.gtfs_stop_times(m.inputs["stop_times"], m["trips"], m["positions"], True))
    sched = matching.schedule_points(m["stop_times"], m["trips"], m["routes"], m["stops"])
    # the stops are joined where pings and timetable have met, not scanned with the timetable by every micro-batch
    sched = matching.schedule_keys(sched, p.radius_m, p.window_s).drop(*matching.STOP_COLUMNS)
    # a join key that is null would be filtered before the watermark sees the row
    marker = {**IN_AREA, "line": streams.CLOSING, "brigade": streams.CLOSING}
    s = _stream(spark, m["positions"], "stream-positions", "vehicle_time", marker, written=True)
    given = {"positions": s, "sched": bucketed(sched, "stream-timetable", "__key"), "as_of": p.as_of, "retention_days": p.retention_days,
             "radius_m": p.radius_m, "window_s": p.window_s, "stops": m["stops"]}
    m.forget()      # the stream reads the landed files and the timetable
    return given


@register("stream_matches")
def stream_matches(spark, sf_dir):
    """I9 on the stream: pings joined with the written timetable, best match per ping kept by a stateful minimum."""
    return _drain(spark, streams.matches_stream(**_matching_inputs(spark, sf_dir)), "stream-matches")


@register("stream_visits")
def stream_visits(spark, sf_dir):
    """K5: visits as 10-minute session windows, fed in one query by the matching on the stream."""
    best = streams.best_match_stream(**_matching_inputs(spark, sf_dir))
    return _drain(spark, streams.visits_stream(best, FIXTURE_PARAMS.visit_gap_s), "stream-visits")


@register("stream_moves")
def stream_moves(spark, sf_dir):
    """K6: vehicle moves with the previous ping per vehicle and hour kept in expiring state."""
    s = _stream(spark, models(spark, sf_dir)["positions"], "stream-positions", "vehicle_time")
    return _drain(spark, streams.moves_stream(s), "stream-moves")


@register("stream_upsert")
def stream_upsert(spark, sf_dir):
    """K1+K7: raw batches cleaned per micro-batch and merged into a
    date-partitioned table by foreachBatch (first fetch wins)."""
    s = _land_raw(spark, sf_dir)
    target = shared_dir(spark, "stream-upsert-target")
    ckpt = shared_dir(spark, "stream-upsert-ckpt")
    q = (s.writeStream.foreachBatch(streams.upsert_sink(target)).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return incremental.read_upserted(spark, target).filter(F.col("vehicle_number") != streams.CLOSING).select(*[c for c in ["fetch_time", "vehicle_time", "vehicle_number", "line",
                                                            "brigade", "vehicle_type", "lat", "lon"]])


@register("stream_late")
def stream_late(spark, sf_dir):
    """K3: a tenth of the raw rows arrives four days late, past the watermark; they land in the side table and are
    loaded from it at the end, so the table equals the batch model."""
    raw = _union(spark, sf_dir).select(
        "fetch_time", "vehicle_number", "line", "brigade",
        F.col("vehicle_type").cast("tinyint").alias("vehicle_type"), "lat", "lon", "vehicle_time")
    late = F.pmod(F.xxhash64("vehicle_number", "vehicle_time", "fetch_time"), F.lit(10)) == 0
    raw = raw.withColumn("arrival", F.col("vehicle_time") + F.when(late, F.expr("INTERVAL 4 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS")))
    src, target, side, ckpt = (shared_dir(spark, f"stream-late-{n}") for n in ("raw", "target", "side", "ckpt"))
    s = streams.position_stream(spark, src, _per_trigger(streams.land_in_order(raw, src, "arrival")))
    q = (s.writeStream.foreachBatch(streams.late_aware_sink(target, side)).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return streams.load_late(spark, target, side).select(*POSITION_COLUMNS)


# ---------------------------------------------------------------------------
# ad-hoc SQL over the models, and the previous-service-day matching option
# ---------------------------------------------------------------------------

ADHOC_SQL = """
SELECT hour_of_day,
       count(*) AS line_rows,
       sum(measurements) AS moves,
       round(sum(CAST(round(avg_speed_kmh * 10) AS BIGINT) * measurements) / CAST(sum(measurements) AS DOUBLE) / 10D, 1)
         AS mean_speed_kmh
FROM {speeds}
WHERE hour_of_day BETWEEN 6 AND 22 AND measurements >= 10
GROUP BY hour_of_day
"""


@register("adhoc_sql")
def adhoc_sql(spark, sf_dir):
    """A statement over a model, as a dashboard sends it (the model is a parameter, no view is left behind)."""
    return spark.sql(ADHOC_SQL, speeds=models(spark, sf_dir)["speed_by_hour"])


@register("dashboard_statement")
def dashboard_statement(spark, sf_dir):
    """The same statement through the read-only, cached path over a loaded store."""
    out, inputs = shared_dir(spark, "dashboard"), fixtures.transit_inputs(spark, sf_dir)
    build_incremental(inputs, FIXTURE_PARAMS, out)
    statements = Statements(Store(spark, out), {n: inputs[n] for n in ("stops", "routes")})
    return spark.createDataFrame(statements.run(ADHOC_SQL.format(speeds="speed_by_hour")))


@register("stop_matches_prev_day")
def stop_matches_prev_day(spark, sf_dir):
    """Stop matching where pings before 04:00 may also match the previous
    service day's trips (arrivals past 24:00)."""
    return models(spark, sf_dir, FIXTURE_PARAMS.with_(previous_service_day_until=4))["matches"]


@register("dq_suite")
def dq_suite(spark, sf_dir):
    """Every declared check over every model (staging, intermediate, marts)
    plus the raw-feed checks; shared models are written once first."""
    return _dq(spark, sf_dir, None)


@register("visit_numbers")
def visit_numbers(spark, sf_dir):
    """E5 + E6: each matched ping flagged as a new visit or not, numbered by
    the running count of flags per (line, stop, vehicle)."""
    from tramspark.operators import headway as hw_ops
    return hw_ops.visit_numbers(models(spark, sf_dir)["matches"], FIXTURE_PARAMS.visit_gap_s)
