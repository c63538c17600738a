"""Loads into a store: ledger, change propagation, states, and the pointer that switches all tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tramspark.operators import fingerprint, incremental, ledger, marts, staging, states
from tramspark.operators import windows as win
from tramspark.plans import incremental as plan
from tramspark.plans.catalog import _landed, models
from tramspark.plans.pipeline import FIXTURE_PARAMS, MODEL_ORDER, build_graph
from tramspark.sources import fixtures
from tramspark.sources.store import LoadConflict, Store

SF = "/root/testdata/sf0.001"
SCHEMA = "fetch_time timestamp_ntz, vehicle_number string, line string, brigade string, vehicle_type tinyint, lat double, lon double, vehicle_time timestamp_ntz"
T0 = dt.datetime(2024, 1, 10, 23, 40)


def rows_of(df, columns=None):
    return sorted(map(str, df.select(*(columns or df.columns)).collect()))


def same(tables, other, names=MODEL_ORDER):
    for n in names:
        columns = [c for c in other[n].columns if c in tables[n].columns]
        assert set(tables[n].columns) == set(other[n].columns), n
        assert rows_of(tables[n], columns) == rows_of(other[n], columns), n


def folders(store, table):
    return set(store.snapshot().tables[table].folders)


# --- store ---------------------------------------------------------------

def days(spark, rows):
    return spark.createDataFrame(rows, "day date, x int")


def test_a_load_is_seen_only_when_committed(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    load = store.begin()
    load.put("a", days(spark, [(d1, 1), (d2, 2)]), "day")
    load.put("b", days(spark, [(d1, 5)]))
    assert store.versions() == []
    load.commit()
    before = folders(store, "a")
    # stopped between the writes: one table written, the other not, no commit
    stopped = store.begin()
    stopped.put("a", days(spark, [(d2, 9)]), "day", [d2])
    assert rows_of(store.read("a"), ["x"]) == ["Row(x=1)", "Row(x=2)"] and folders(store, "a") == before
    load = store.begin()
    load.put("a", days(spark, [(d2, 3), (d2, 4)]), "day", [d2])
    load.put("b", days(spark, []))
    old = store.read("a")
    load.commit()
    assert rows_of(store.read("a"), ["x"]) == ["Row(x=1)", "Row(x=3)", "Row(x=4)"] and store.read("b").count() == 0
    assert rows_of(old, ["x"]) == ["Row(x=1)", "Row(x=2)"]           # a reader of the snapshot before goes on
    assert len(folders(store, "a") & before) == 1                    # the untouched day keeps its files
    with pytest.raises(LoadConflict):
        stopped.commit()
    assert store.vacuum(1) == 3 and rows_of(store.read("a"), ["x"]) == ["Row(x=1)", "Row(x=3)", "Row(x=4)"]
    assert store.versions() == [2]


def test_partitions_go_and_wrong_ones_are_refused(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    load = store.begin()
    load.put("a", days(spark, [(d1, 1), (d2, 2)]), "day")
    load.put("a", days(spark, []), "day", [d1])
    assert rows_of(load.read("a"), ["x"]) == ["Row(x=2)"] and load.values("a") == ["2024-01-02"]
    with pytest.raises(ValueError):
        load.put("a", days(spark, [(d2, 1)]), "day", [d1])
    with pytest.raises(ValueError):
        load.put("a", days(spark, [(None, 1)]), "day")


def test_a_failed_upsert_leaves_the_old_table(spark, tmp_path, monkeypatch):
    path, keys = str(tmp_path / "t"), ["k"]
    rows = lambda *r: spark.createDataFrame(list(r), "k int, v int, day date")
    d = dt.date(2024, 1, 1)
    incremental.write_upsert(spark, path, rows((1, 1, d)), keys, ["v"], "day", "delete_insert")
    from tramspark.sources import store as module
    with monkeypatch.context() as m:
        m.setattr(module.Load, "commit", lambda self: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            incremental.write_upsert(spark, path, rows((1, 2, d), (2, 2, d)), keys, ["v"], "day", "delete_insert")
    assert rows_of(incremental.read_upserted(spark, path), ["k", "v"]) == ["Row(k=1, v=1)"]
    out = incremental.write_upsert(spark, path, rows((1, 2, d), (2, 2, d)), keys, ["v"], "day", "delete_insert")
    assert rows_of(out, ["k", "v"]) == ["Row(k=1, v=2)", "Row(k=2, v=2)"]


def test_a_failed_rebuild_leaves_the_old_tables(spark, tmp_path, monkeypatch):
    out, inputs = str(tmp_path / "models"), fixtures.transit_inputs(spark, SF)
    build_graph(inputs, FIXTURE_PARAMS, out, names=["positions", "moves"])
    before = Store(spark, out).read("moves").count()
    monkeypatch.setattr(marts, "line_speed", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        build_graph(inputs, FIXTURE_PARAMS.with_(max_speed_kmh=0.0), out, names=["positions", "moves", "line_speed"])
    assert Store(spark, out).versions() == [1] and Store(spark, out).read("moves").count() == before > 0


# --- ledger --------------------------------------------------------------

def test_ledger_takes_each_file_once_and_a_late_feed_fully(spark, tmp_path):
    def drop(collector, name, minutes):
        rows = [(T0 + dt.timedelta(minutes=m), "v1", "1", "1", 1, 52.2, 21.0, T0 + dt.timedelta(minutes=m)) for m in minutes]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/{collector}/{name}")

    feeds = {c: ledger.FileFeed("parquet", f"{tmp_path}/{c}/*") for c in ("a", "b")}
    known = None

    def load(name):
        nonlocal known
        parts = [u for u in (ledger.unread(spark, f, s, known) for f, s in feeds.items() if (tmp_path / f).exists()) if u]
        entries = [r for u in parts for r in ledger.entries(u, name).collect()]
        known = spark.createDataFrame((known.collect() if known else []) + entries, ledger.SCHEMA)
        return {u.feed: sorted(r.vehicle_time.minute for r in u.rows.collect()) for u in parts}

    drop("a", "1", [0, 1])
    assert load("l1") == {"a": [40, 41]}
    drop("a", "2", [5])
    drop("b", "1", [2, 3])         # older than what feed a has brought
    assert load("l2") == {"a": [45], "b": [42, 43]}
    assert load("l3") == {}
    marks = {r.feed: (r.loads, r.files, r.rows, r.mark) for r in ledger.marks(known).collect()}
    assert marks == {"a": (2, 2, 3, T0 + dt.timedelta(minutes=5)), "b": (1, 1, 2, T0 + dt.timedelta(minutes=3))}


def test_feeds_that_are_tables_have_marks_of_their_own(spark):
    rows = spark.createDataFrame([(T0 + dt.timedelta(minutes=m), "v", "1", "1", 1, 52.2, 21.0, T0) for m in range(4)], SCHEMA)
    known = spark.createDataFrame([("a", None, None, None, 1, T0 + dt.timedelta(minutes=2), "l"),
                                   ("b", None, None, None, 1, T0 + dt.timedelta(minutes=0), "l")], ledger.SCHEMA)
    counts = {f: ledger.unread(spark, f, rows, known).rows.count() for f in ("a", "b", "c")}
    assert counts == {"a": 1, "b": 3, "c": 4}


# --- states --------------------------------------------------------------

def test_marts_from_states_equal_the_marts(spark):
    m, p = models(spark, SF, materialize_shared=True), FIXTURE_PARAMS
    speed, delay = states.speed_state(m["moves"]), states.delay_state(m["matches"])
    got = {"line_speed": states.line_speed(speed), "speed_by_hour": states.speed_by_hour(speed, 3),
           "speed_grid": states.speed_grid(states.grid_state(m["moves"]), 2, 80.0),
           "line_punctuality": states.line_punctuality(delay), "punctuality_by_hour": states.punctuality_by_hour(delay, 3),
           "worst_stops": states.worst_stops(states.stop_state(m["matches"]), m["stops"], 2),
           "line_regularity": states.line_regularity(states.headway_state(m["headway"]), 2, 120.0),
           "slowest_segments": states.slowest_segments(states.segment_state(m["segments"]), 2)}
    want = {"line_speed": marts.line_speed(m["moves"]), "speed_by_hour": marts.speed_by_hour(m["moves"], 3),
            "speed_grid": marts.speed_grid(m["moves"], min_n=2), "line_punctuality": marts.line_punctuality(m["matches"]),
            "punctuality_by_hour": marts.punctuality_by_hour(m["matches"], 3), "worst_stops": marts.worst_stops(m["matches"], m["stops"], 2),
            "line_regularity": marts.line_regularity(m["headway"], 2, 120.0), "slowest_segments": marts.slowest_segments(m["segments"], 2)}
    same(got, want, list(want))
    assert all(df.count() for df in want.values()) and p


# --- touched pieces ------------------------------------------------------

def test_touched_pieces_reach_the_next_bucket(spark):
    at = lambda *hms: dt.datetime(2024, 1, 10, *hms)
    changes = spark.createDataFrame([("a", at(0, 30, 0)), ("b", at(0, 50, 0)), ("b", at(0, 49, 59)), ("c", at(23, 55, 0))], "k string, t timestamp_ntz")
    touched = win.touched_buckets(changes, ["k"], "t", 600, 3600)
    base = int((dt.datetime(2024, 1, 10) - dt.datetime(1970, 1, 1)).total_seconds()) // 3600
    assert sorted((r[0], r[1] - base) for r in touched.collect()) == [("a", 0), ("b", 0), ("b", 1), ("c", 23), ("c", 24)]
    assert rows_of(win.touched_days(touched, 3600)) == rows_of(spark.createDataFrame([(dt.date(2024, 1, 10),), (dt.date(2024, 1, 11),)], "day date"))


# --- whole loads ---------------------------------------------------------

def test_two_drops_with_late_pings_equal_a_full_build(spark, tmp_path):
    feeds, timetable = _landed(spark, SF)
    out = str(tmp_path / "m")
    for drop in (0, 1):
        store = plan.run_load(spark, out, {n: f[drop] for n, f in feeds.items()}, timetable)
    full = build_graph(fixtures.transit_inputs(spark, SF), FIXTURE_PARAMS, str(tmp_path / "full"))
    same(plan.tables(store, timetable), full)
    version = store.snapshot().version
    plan.run_load(spark, out, {n: f[1] for n, f in feeds.items()}, timetable)
    assert store.snapshot().version == version == 2      # nothing new: no new snapshot


def test_one_late_ping_rewrites_its_days_alone(spark, tmp_path):
    inputs = fixtures.transit_inputs(spark, SF)
    feeds = {"positions_csv": inputs.pop("positions_csv"), "positions_parquet": inputs.pop("positions_parquet")}
    store = plan.run_load(spark, str(tmp_path / "m"), feeds, inputs)
    before = {n: folders(store, n) for n in [*plan.DATES, *plan.STATES]}
    ping = feeds["positions_parquet"].filter(F.to_date("vehicle_time") == F.lit("2024-01-12").cast("date")).orderBy("vehicle_time").first()
    late = {**ping.asDict(), "vehicle_time": ping.vehicle_time + dt.timedelta(seconds=200), "fetch_time": dt.datetime(2024, 2, 1)}
    extra = spark.createDataFrame([tuple(late[c] for c in feeds["positions_parquet"].columns)], SCHEMA)
    store = plan.run_load(spark, str(tmp_path / "m"), feeds | {"late": extra}, inputs)
    for n, old in before.items():
        rewritten = {f.split("/")[0][-10:] for f in folders(store, n) ^ old}
        assert rewritten <= {"2024-01-12"}, n
    assert {f.split("/")[0][-10:] for f in folders(store, "moves") ^ before["moves"]} == {"2024-01-12"}
    whole = {**inputs, "positions_csv": feeds["positions_csv"], "positions_parquet": feeds["positions_parquet"].unionByName(extra)}
    same(plan.tables(store, inputs), build_graph(whole, FIXTURE_PARAMS, str(tmp_path / "full")))


@pytest.mark.parametrize("strategy", ["first_wins", "delete_insert"])
def test_random_loads_over_midnight_equal_one_load(spark, tmp_path, strategy):
    """Pings around midnight that come late, twice or in any order; with ``delete_insert`` a later poll moves the ping."""
    rng = random.Random(11)
    timetable = {
        "stops": spark.createDataFrame([(str(k), f"S{k}", str(52.2 + k * 0.002), "21.0", "T") for k in range(4)],
                                       "stop_id string, stop_name string, stop_lat string, stop_lon string, town_name string"),
        "routes": spark.createDataFrame([("R1", "1", "L", "3")], "route_id string, route_short_name string, route_long_name string, route_type string"),
        "trips": spark.createDataFrame([(f"2024-01-{d}:{b}-{j}", "R1", "s", str(b), "h", "0") for d in (10, 11) for b in (0, 1) for j in range(3)],
                                       "trip_id string, route_id string, service_id string, block_short_name string, trip_headsign string, direction_id string"),
        "stop_times": spark.createDataFrame(
            [(f"2024-01-{d}:{b}-{j}", str(k), str(k), f"{(23 if d == 10 else 0) + (k * 6 + j * 15 + 30) // 60}:{(k * 6 + j * 15 + 30) % 60:02}:00")
             for d in (10, 11) for b in (0, 1) for j in range(3) for k in range(4)], "trip_id string, stop_sequence string, stop_id string, arrival_time string")}
    pings = []
    for _ in range(160):
        v, t, k = rng.randrange(4), T0 + dt.timedelta(seconds=rng.randrange(-3000, 6000, 120)), rng.randrange(4)
        pings.append((f"v{v}", str(v % 2), t, 52.2 + k * 0.002 + rng.choice([0, 0.0001]), rng.randrange(3)))
    loads = []
    for n in range(3):
        rows = [(dt.datetime(2024, 1, 12) + dt.timedelta(hours=n, seconds=i), v, "1", b, 1, lat, 21.0, t)
                for i, (v, b, t, lat, part) in enumerate(pings) if part == n]
        loads.append(spark.createDataFrame(rows, SCHEMA))
    p = FIXTURE_PARAMS.with_(line_speed_min_n=1, speed_by_hour_min_n=1, grid_min_n=1, punctuality_min_n=1, punctuality_hour_min_n=1,
                             worst_stops_min_n=1, regularity_min_n=1, segments_min_n=1)
    for n, rows in enumerate(loads):
        store = plan.run_load(spark, str(tmp_path / "m"), {f"f{n}": rows}, timetable, p, strategy=strategy)
    merged = staging.clean_positions(None, loads[0].unionByName(loads[1]).unionByName(loads[2]))
    if strategy == "delete_insert":
        merged = None
        for rows in loads:
            batch = staging.clean_positions(None, rows)
            merged = batch if merged is None else incremental.upsert(merged, batch, ["vehicle_number", "vehicle_time"], strategy=strategy)
    full = build_graph({"positions_parquet": merged, **timetable}, p, str(tmp_path / "full"))
    got = plan.tables(store, timetable)
    same(got, full)
    assert all(got[n].count() for n in ("moves", "matches", "headway", "segments", "line_regularity"))


# --- changed dimensions ---------------------------------------------------

def test_fingerprints(spark):
    one = fingerprint.fingerprint
    rows = [("a", None), (None, "a"), ("a", "b"), ("a", "b")]

    def of(rows, columns=None):
        return one(spark.createDataFrame(rows, "x string, y string"), "t", columns).collect()[0]
    assert of(rows) == of(rows[::-1])
    assert len({of(r) for r in (rows, rows[:3], rows[1:], [*rows[:2], ("b", "a"), ("b", "a")], [], [(None, None)])}) == 6
    assert of(rows, ["x"]) == of([(x, "other") for x, _ in rows], ["x"])


def test_a_changed_stop_rebuilds_its_readers(spark, tmp_path):
    """An unchanged timetable rebuilds nothing; another stop place rebuilds what reads it, with and without new pings."""
    out, inputs = str(tmp_path / "s"), fixtures.transit_inputs(spark, SF)
    cut = F.lit("2024-01-28 00:00:00").cast("timestamp_ntz")
    typed = inputs["positions_parquet"]
    early = {**inputs, "positions_csv": None, "positions_parquet": typed.filter(F.col("fetch_time") < cut)}
    plan.build_incremental(early, FIXTURE_PARAMS, out)
    store = Store(spark, out)
    before = {t: folders(store, t) for t in store.snapshot().tables}
    shuffled = {**early, "stops": early["stops"].orderBy(F.rand(3))}
    plan.build_incremental(shuffled, FIXTURE_PARAMS, out)
    assert all(folders(store, t) == f for t, f in before.items() if t != "load_ledger")
    moved = inputs["stops"].withColumn("stop_lat", F.when(F.col("stop_id") == "3", F.lit("52.9")).otherwise(F.col("stop_lat")))
    found = plan.build_incremental({**early, "stops": moved}, FIXTURE_PARAMS, out)
    for t in ("positions", "moves", "state_speed", "state_grid", "line_speed", "speed_grid", "calendar", "animation_frames"):
        assert folders(store, t) == before[t], t
    assert folders(store, "matches") != before["matches"]
    same(found, plan.build_incremental({**early, "stops": moved}, FIXTURE_PARAMS, str(tmp_path / "whole")))
    # new pings and another timetable in one load
    late = {**inputs, "positions_csv": None}
    found = plan.build_incremental(late, FIXTURE_PARAMS, out)
    same(found, plan.build_incremental(late, FIXTURE_PARAMS, str(tmp_path / "all")))
