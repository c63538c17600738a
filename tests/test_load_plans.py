"""What the timetable, the loads and the streams parse, shuffle and read: once each (findings of round 4)."""

import datetime as dt
import random
import re

import pyspark.sql.functions as F

from tramspark.functions import scalar as S
from tramspark.operators import headway, matching, movement, segments, staging
from tramspark.operators import windows as win
from tramspark.plans import catalog, pipeline
from tramspark.session import path_exists, shared_dir
from tramspark.streaming import positions


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def timetable(spark):
    trips = spark.createDataFrame([("2024-01-01:a", "R1", dt.date(2024, 1, 1)), ("2024-01-02:b", "R1", dt.date(2024, 1, 2)), ("x:c", "R1", None)],
                                  "trip_id string, route_id string, service_date date")
    times = [("2024-01-01:a", "1", "s", "25:30:00"), ("2024-01-01:a", "2.5", "s", "1: 2 :3"), ("2024-01-01:a", "0x10", "s", "1:75:99"),
             ("2024-01-01:a", None, "s", "1:2"), ("2024-01-01:a", "5", None, None), ("2024-01-01:a", "5", "s", "a:b:c"), ("2024-01-02:b", "1", "s", "08:00:00")]
    positions = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10),)], "vehicle_time timestamp_ntz")
    return spark.createDataFrame(times, "trip_id string, stop_sequence string, stop_id string, arrival_time string"), trips, positions


def test_arrival_times_are_parsed_once(spark):
    st = staging.gtfs_stop_times(*timetable(spark))
    # many columns and a filter read the parsed time
    df = st.select("trip_id", "stop_sequence", "scheduled_arrival", F.hour("scheduled_arrival").alias("h"), S.time_bucket("scheduled_arrival", 15).alias("b"),
                   F.date_format("scheduled_arrival", "HH:mm").alias("t")).filter(F.col("scheduled_arrival") > dt.datetime(2024, 1, 1))
    lines = [x for x in plan(df).splitlines() if "stringsplitsql" in x.lower() or "split_part" in x.lower()]
    assert len(lines) == 1 and "Generate" in lines[0]
    assert len(plan(df)) < 20_000       # was 57,000: code of that length is not compiled
    got = sorted((r["stop_sequence"], r["scheduled_arrival"]) for r in st.collect() if r["scheduled_arrival"])
    assert got == [(1, dt.datetime(2024, 1, 2, 1, 30)), (3, dt.datetime(2024, 1, 1, 1, 2, 3)), (16, dt.datetime(2024, 1, 1, 2, 16, 39))]
    assert st.count() == 6 and not re.search("__[hms]", " ".join(st.columns))


def exchanges(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning|Exchange RoundRobin|Exchange Rebalance|Exchange REBALANCE", df._jdf.queryExecution().executedPlan().toString()))


def stored(spark, df, name):
    df.write.parquet(path := shared_dir(spark, name))
    return spark.read.parquet(path)


def alike(a, b):
    assert sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect()))


def test_touched_pieces_are_rebuilt_in_one_shuffle(spark):
    """Pings over midnight in two loads: new moves, headways and segments where a changed ping reaches, the old rows elsewhere."""
    rng = random.Random(4)
    t0 = dt.datetime(2024, 1, 1, 21, 0)
    rows = {(v, t0 + dt.timedelta(seconds=rng.randrange(6 * 3600))) for v in "abcdef" for _ in range(60)}
    rows = [(f"{t:%Y-%m-%d}:{'12'[v in 'abc']}", "12"[v in "abc"], "b", v, str(rng.randrange(3)), t, rng.randrange(12) == 0) for v, t in sorted(rows)]
    m = stored(spark, spark.createDataFrame(rows, "trip_id string, line string, brigade string, vehicle_number string, stop_id string, actual_time timestamp_ntz, new boolean")
               .select("*", F.concat(F.lit("S"), "stop_id").alias("stop_name"), F.col("actual_time").alias("scheduled_arrival"),
                       F.col("actual_time").alias("vehicle_time"), F.lit(1).alias("vehicle_type"), (F.lit(52.2) + F.col("stop_id").cast("int") * 0.001).alias("lat"), F.lit(21.0).alias("lon")), "m")
    went = [("2024-01-01:1", "1", "a", "0", t0 + dt.timedelta(seconds=rng.randrange(3 * 3600))) for _ in range(2)]
    gone = stored(spark, spark.createDataFrame(went, "trip_id string, line string, vehicle_number string, stop_id string, actual_time timestamp_ntz"), "gone")
    before = m.filter(~F.col("new")).unionByName(gone.withColumn("new", F.lit(False)), allowMissingColumns=True)
    changed, none = F.col("new"), gone.limit(0)
    odd = "kept as it was"      # an old row's value that no computation gives: seen wherever a piece is not touched

    old = stored(spark, movement.vehicle_moves(before.filter("lat is not null")).withColumn("brigade", F.lit(odd)), "old")
    got = movement.moves_of_touched(m, changed, old)
    touched = win.touched_buckets(m.filter(changed), ["vehicle_number"], "vehicle_time", 600, 3600)
    assert exchanges(got) == 1 and 0 < got.filter(F.col("brigade") == odd).count() < got.count()
    alike(got, win.outside_buckets(old, touched, ["vehicle_number"], "vehicle_time", 3600).unionByName(
        movement.vehicle_moves(m, only=touched).select(*old.columns)))
    alike(got.drop("brigade"), movement.vehicle_moves(m).drop("brigade"))

    old = stored(spark, headway.headway_from_visits(headway.stop_visits(before)).withColumn("stop_name", F.lit(odd)), "old")
    got = headway.headway_of_touched(m, changed, gone, old)
    assert exchanges(got) == 1
    alike(got.drop("stop_name"), headway.headway_from_visits(headway.stop_visits(m)).drop("stop_name"))
    delta = m.filter(changed).select("line", "stop_id", "actual_time").unionByName(gone.select("line", "stop_id", "actual_time"))
    touched = win.touched_buckets(delta, ["line", "stop_id"], "actual_time", 600 + 7200)
    alike(got.filter(F.col("stop_name") == odd), win.outside_buckets(old, touched, ["line", "stop_id"], "arrival_time"))
    alike(headway.headway_of_touched(m, F.lit(False), none, old), old)

    old = stored(spark, segments.route_segments(before, keep_trip=True, by_day=True).withColumn("to_stop", F.lit(odd)), "old")
    got = segments.segments_of_touched(m, changed & (F.col("vehicle_number") < "c"), gone, old)
    assert exchanges(got) == 1
    full = segments.route_segments(m, keep_trip=True)
    alike(got.filter("vehicle_number < 'c'").drop("to_stop"), full.filter("vehicle_number < 'c'").drop("to_stop"))
    alike(got.filter("vehicle_number >= 'c'"), old.filter("vehicle_number >= 'c'"))
    alike(segments.route_segments(m, keep_trip=True, by_day=True), full)

    kept = win.not_marked(m, gone.select("vehicle_number", "actual_time").unionByName(m.filter(changed).select("vehicle_number", "actual_time")), ["vehicle_number"], "actual_time")
    assert exchanges(kept) == 1
    alike(kept, m.filter(~changed))


def test_rows_without_a_key_stay(spark):
    rows = spark.createDataFrame([(None, dt.datetime(2024, 1, 1, 10), 1), ("a", dt.datetime(2024, 1, 1, 10), 2)], "k string, t timestamp_ntz, n int")
    assert [r["n"] for r in win.not_marked(rows, rows.select("k", "t"), ["k"], "t").collect()] == [1]


def test_stop_times_bring_their_trip(spark):
    texts, trips, positions = timetable(spark)
    trips = trips.withColumn("brigade", F.lit("7"))
    routes = spark.createDataFrame([("R1", "9")], "route_id string, line string")
    stops = spark.createDataFrame([("s", "S", 52.2, 21.0)], "stop_id string, stop_name string, stop_lat double, stop_lon double")
    plain, own = (matching.schedule_points(staging.gtfs_stop_times(texts, trips, positions, x), trips, routes, stops) for x in (False, True))
    alike(own, plain.select(*own.columns))
    assert set(own.columns) == set(plain.columns) and own.count() == 5


def matching_tables(spark):
    t = dt.datetime(2024, 1, 1, 10)
    pings = [("v", "1", "2", dt.date(2024, 1, 1), t + dt.timedelta(seconds=60 * k), 52.2 + 0.0004 * k, 21.0) for k in range(9)] + [("w", "1", "3", dt.date(2024, 1, 1), t, 52.2, 21.0)]
    p = spark.createDataFrame(pings, "vehicle_number string, line string, brigade string, service_date date, vehicle_time timestamp_ntz, lat double, lon double")
    # a stop that comes twice, with two names and places, and one without an id
    stops = spark.createDataFrame([("s", "S", 52.2, 21.0), ("s", "S2", 52.2008, 21.0), ("z", "Z", 52.2024, 21.0), (None, "N", 52.2, 21.0)],
                                  "stop_id string, stop_name string, stop_lat double, stop_lon double")
    times = [("1", "2", dt.date(2024, 1, 1), f"t{k}", "sz"[k % 2], t + dt.timedelta(seconds=200 * k)) for k in range(6)]
    times = spark.createDataFrame(times, "line string, brigade string, service_date date, trip_id string, stop_id string, scheduled_arrival timestamp_ntz")
    return p, stops, times


def test_stops_are_joined_after_pings_and_timetable_have_met(spark):
    p, stops, times = matching_tables(spark)
    for repeat in ("schedule", "positions"):
        cells = matching.stop_cells(stops, 100.0) if repeat == "schedule" else stops
        sched = times.join(cells, "stop_id")
        found = [matching.stop_match_candidates(p, sched, repeat=repeat, stops=x).distinct() for x in (None, stops)]
        alike(found[1], found[0])
        assert found[0].count() > 9
        alike(matching.best_match(found[1]), matching.best_match(found[0]))
        # the names come from the stops alone, not with the timetable
        met = matching.candidate_pairs(p, sched, repeat=repeat, stops=stops.withColumnRenamed("stop_name", "x").withColumn("stop_name", F.lit("y")))
        assert {r["stop_name"] for r in met.select("stop_name").distinct().collect()} == {"y"}


def test_streamed_matching_reads_a_narrow_timetable_and_leaves_no_copies(spark, monkeypatch):
    written = []

    def folder(session, name):
        written.append(shared_dir(session, name))
        return written[-1]
    for module in (catalog, pipeline, positions):
        monkeypatch.setattr(module, "shared_dir", folder)
    given = catalog._matching_inputs(spark, "/root/testdata/sf0.001")
    assert not set(matching.STOP_COLUMNS) & set(given["sched"].columns)
    left = {p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in written if path_exists(spark, p)}
    assert left == {"stream-positions", "stream-timetable"}     # not the models they were made of, nor a second copy to land
    seen = []
    run = streams_start(spark, monkeypatch, seen)
    run(given)
    assert seen == [positions.STREAM_CONF] and all(spark.conf.get(k, None) != v for k, v in positions.STREAM_CONF.items())


def streams_start(spark, monkeypatch, seen):
    """Run a stream, noting the state's settings that it starts with."""
    class Written:
        def __init__(self, *_):
            pass

        def __getattr__(self, name):
            return lambda *a, **k: self

        def start(self):
            seen.append({k: spark.conf.get(k) for k in positions.STREAM_CONF})
            return type("Q", (), {"awaitTermination": lambda _: None, "recentProgress": []})()

    def run(given):
        df = positions.matches_stream(**given)
        monkeypatch.setattr(type(df), "writeStream", property(Written))
        positions.run_to_completion(df, "out", "checkpoint")
    return run
