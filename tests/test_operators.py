"""Hand-made boundary cases for the transit operators."""

import datetime as dt

from pyspark.sql import functions as F

from tramspark.operators import headway as hw
from tramspark.operators import history, marts, matching, movement, segments, staging

T0 = dt.datetime(2024, 1, 10, 8, 0, 0)


def ts(sec):
    return T0 + dt.timedelta(seconds=sec)


POS = "fetch_time timestamp_ntz, vehicle_time timestamp_ntz, vehicle_number string, line string, " \
      "brigade string, vehicle_type int, lat double, lon double"


def positions(spark, rows):
    return spark.createDataFrame([(ts(t + 20), ts(t), v, "1", "1", 2, lat, 21.0) for v, t, lat in rows], POS)


def test_move_gap_bounds_inclusive(spark):
    p = positions(spark, [("a", 0, 52.2), ("a", 600, 52.2001), ("a", 1201, 52.2002), ("a", 1201 + 0, 52.2002)])
    m = movement.vehicle_moves(staging.dedup_first(p)).collect()
    gaps = sorted(r["seconds_diff"] for r in m)
    assert gaps == [600]          # 600 kept, 601 dropped


def test_speed_rounded_before_cap(spark):
    # 27.79 m in 1 s = 100.04 km/h -> rounds to 100.0 and is kept
    dlat = 27.79 / 111320.0
    p = positions(spark, [("a", 0, 52.2), ("a", 1, 52.2 + dlat)])
    m = movement.vehicle_moves(p).collect()
    assert len(m) == 1 and m[0]["speed_kmh"] == 100.0


def test_dedup_first_fetch_wins_header_and_null(spark):
    text = spark.createDataFrame([
        ("fetch_time", "vehicle_number", "line", "brigade", "vehicle_type", "lat", "lon", "vehicle_time"),
        ("2024-01-10T08:00:30", "a", "1", "1", "2", "52.2", "21.0", "2024-01-10T08:00:00"),
        ("2024-01-10T08:00:20", "a", "1", "1", "2", "52.3", "21.0", "2024-01-10T08:00:00"),
        (None, "a", "1", "1", "2", "52.1", "21.0", "2024-01-10T08:00:00"),
        ("2024-01-10T08:00:20", "b", "1", "1", "1.5", "52.25", "21.0", "2024-01-10T08:00:00"),
        ("2024-01-10T08:00:20", "b", "1", "1", "2", "52.24", "21.0", "2024-01-10T08:00:00"),
        ("2024-01-10T08:00:20", "c", "1", "1", "2", "55.0", "21.0", "2024-01-10T08:00:00"),
    ], ",".join(f"{c} string" for c in ["fetch_time", "vehicle_number", "line", "brigade", "vehicle_type",
                                         "lat", "lon", "vehicle_time"]))
    out = {r["vehicle_number"]: r for r in staging.clean_positions(text, None).collect()}
    assert set(out) == {"a", "b"}                     # header dropped, c out of the box
    assert out["a"]["lat"] == 52.3                     # earliest fetch wins, NULL fetch last
    assert out["b"]["lat"] == 52.24                    # tie on fetch broken by lat
    assert out["b"]["vehicle_type"] == 2


def test_trip_service_date_parse(spark):
    t = spark.createDataFrame([("M1-abc", "R1", "s", "1", "h", "0"), ("2026", "R1", "s", "1", "h", "0"),
                               ("2026-07:x", "R1", "s", "1", "h", "0"), ("2026-07-22:1-2", "R1", "s", "1", "h", "x")],
                              "trip_id string, route_id string, service_id string, block_short_name string, "
                              "trip_headsign string, direction_id string")
    d = {r["trip_id"]: (r["service_date"], r["direction_id"]) for r in staging.gtfs_trips(t).collect()}
    assert d["M1-abc"][0] is None and d["2026"][0] is None and d["2026-07:x"][0] is None
    assert d["2026-07-22:1-2"] == (dt.date(2026, 7, 22), None)


def _sched(spark, rows):
    stop_times = spark.createDataFrame(rows, "trip_id string, stop_id string, scheduled_arrival timestamp_ntz")
    trips = spark.createDataFrame([("T1", "R1", dt.date(2024, 1, 10), "1")],
                                  "trip_id string, route_id string, service_date date, brigade string")
    routes = spark.createDataFrame([("R1", "1")], "route_id string, line string")
    stops = spark.createDataFrame([("S1", "Alpha", 52.2, 21.0), ("S2", "Beta", 52.21, 21.0)],
                                  "stop_id string, stop_name string, stop_lat double, stop_lon double")
    return stop_times, trips, routes, stops


def test_match_time_gate_inclusive_and_best_by_gap(spark):
    st, trips, routes, stops = _sched(spark, [("T1", "S1", ts(900)), ("T1", "S2", ts(0))])
    p = positions(spark, [("a", 0, 52.2), ("b", 1801, 52.2)])
    for bucketed in (True, False):
        m = matching.stop_matches(p, st, trips, routes, stops, "2024-01-11", 5, bucketed=bucketed).collect()
        assert [(r["vehicle_number"], r["stop_id"], r["delay_seconds"]) for r in m] == [("a", "S1", -900)]


def test_visit_gap_strict(spark):
    rows = [("1", "S1", "Alpha", "a", ts(0)), ("1", "S1", "Alpha", "a", ts(600)), ("1", "S1", "Alpha", "a", ts(1201))]
    m = spark.createDataFrame(rows, "line string, stop_id string, stop_name string, vehicle_number string, "
                                    "actual_time timestamp_ntz")
    v = sorted(r["arrival_time"] for r in hw.stop_visits(m).collect())
    assert v == [ts(0), ts(1201)]


def test_headway_hides_same_vehicle_predecessor(spark):
    rows = [("1", "S1", "Alpha", "a", ts(0)), ("1", "S1", "Alpha", "a", ts(1000)), ("1", "S1", "Alpha", "b", ts(1060))]
    v = spark.createDataFrame(rows, "line string, stop_id string, stop_name string, vehicle_number string, "
                                    "arrival_time timestamp_ntz")
    h = hw.headway_from_visits(v).collect()
    assert [(r["prev_vehicle"], r["vehicle_number"], r["headway_minutes"], r["is_bunched"]) for r in h] == \
        [("a", "b", 1.0, True)]


def test_segment_platforms_of_one_station_dropped(spark):
    rows = [("T1", "1", "1", "a", "S1", "Alpha", ts(0), ts(0)), ("T1", "1", "1", "a", "S1b", "Alpha", ts(60), ts(60)),
            ("T1", "1", "1", "a", "S2", "Beta", ts(300), ts(240))]
    m = spark.createDataFrame(rows, "trip_id string, line string, brigade string, vehicle_number string, "
                                    "stop_id string, stop_name string, actual_time timestamp_ntz, "
                                    "scheduled_arrival timestamp_ntz")
    s = segments.route_segments(m).collect()
    assert [(r["from_stop_id"], r["to_stop_id"], r["actual_minutes"], r["lost_minutes"]) for r in s] == \
        [("S1b", "S2", 4.0, 1.0)]


def test_single_row_stddev_is_null(spark):
    h = spark.createDataFrame([("1", 5.0, False)], "line string, headway_minutes double, is_bunched boolean")
    r = marts.line_regularity(h, min_n=1).first()
    assert r["headway_stddev"] is None and r["irregularity_index"] is None and r["avg_headway_min"] == 5.0


def test_snapshot_check_strategy(spark):
    schema = "stop_id string, stop_name string, stop_lat double, stop_lon double, town_name string"
    v1 = spark.createDataFrame([("1", "A", 52.0, 21.0, "x"), ("2", "B", 52.1, 21.0, "x"), ("3", None, 52.2, 21.0, "x"),
                                ("4", "D", 52.3, 21.0, "x")], schema)
    v2 = spark.createDataFrame([("1", "A", 52.0, 21.0, "y"), ("2", "B2", 52.1, 21.0, "x"), ("3", "C", 52.2, 21.0, "x"),
                                ("5", "E", 52.4, 21.0, "x")], schema)
    cols = ["stop_name", "stop_lat", "stop_lon"]
    h1 = history.snapshot(v1, None, "stop_id", cols, "2024-01-01 00:00:00")
    h2 = history.snapshot(v2, h1, "stop_id", cols, "2024-01-02 00:00:00")
    rows = sorted(((r["stop_id"], r["stop_name"] or "", r["valid_to"] is None) for r in h2.collect()))
    assert rows == [("1", "A", True), ("2", "B", False), ("2", "B2", True), ("3", "", False), ("3", "C", True),
                    ("4", "D", True), ("5", "E", True)]
    h3 = history.snapshot(v2, h2, "stop_id", cols, "2024-01-03 00:00:00")
    assert h3.count() == h2.count()                  # idempotent


def test_asof_lookup_picks_valid_version(spark):
    h = spark.createDataFrame([("1", "A", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 5)),
                               ("1", "A2", dt.datetime(2024, 1, 5), None)],
                              "stop_id string, stop_name string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    f = spark.createDataFrame([("1", dt.datetime(2024, 1, 4, 23)), ("1", dt.datetime(2024, 1, 5))],
                              "stop_id string, t timestamp_ntz")
    out = sorted((r["t"], r["h_stop_name"]) for r in history.asof_lookup(f, h, "stop_id", "t", ["stop_name"], "h_")
                 .collect())
    assert [n for _, n in out] == ["A", "A2"]


def test_landing_gate(spark, tmp_path):
    import pytest
    from tramspark.sources import files
    df = spark.createDataFrame([("2024-01-10T08:00:20", "a", "1", "1", "2", "52.2", "21.0", "2024-01-10T08:00:00"),
                                ("bad", "b", "1", "1", "x", "52.2", "21.0", "2024-01-10T08:00:00")],
                               ",".join(f"{c} string" for c in ["fetch_time", "vehicle_number", "line", "brigade",
                                                                 "vehicle_type", "lat", "lon", "vehicle_time"]))
    typed = files.coerce_position_types(df)
    rows = {r["vehicle_number"]: r for r in typed.collect()}
    assert rows["b"]["fetch_time"] is None and rows["b"]["vehicle_type"] is None
    path = str(tmp_path / "landing")
    files.write_positions_batch(df, path)
    landed = spark.read.parquet(path)
    stats = files.landing_stats(landed).first()
    assert stats["rows"] == 2 and stats["files"] >= 1 and stats["total_bytes"] > 0
    now = dt.datetime.now()
    assert files.check_freshness(landed, now, min_bytes=1)["rows"] == 2
    with pytest.raises(RuntimeError):
        files.check_freshness(landed, now, min_bytes=10 ** 9)
    with pytest.raises(RuntimeError):
        files.check_freshness(landed, now + dt.timedelta(hours=2), min_bytes=1)


def test_visits_ignore_duplicate_pings(spark):
    rows = [("1", "S1", "Alpha", "a", ts(0)), ("1", "S1", "Alpha", "a", ts(0)), ("1", "S1", "Alpha", "a", ts(300)),
            ("1", "S1", "Alpha", "a", ts(2000)), ("1", "S1", "Alpha", "a", ts(2000))]
    m = spark.createDataFrame(rows, "line string, stop_id string, stop_name string, vehicle_number string, "
                                    "actual_time timestamp_ntz")
    v = sorted(r["arrival_time"] for r in hw.stop_visits(m).collect())
    assert v == [ts(0), ts(2000)]
