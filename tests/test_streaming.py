"""Streaming behaviour beyond the oracle sweep: late data is dropped and
counted; the stateful previous-ping function flags stale pings and expires."""

import datetime as dt

from tramspark.operators import incremental, staging
from tramspark.session import shared_dir
from tramspark.streaming import positions as streams

SCHEMA = ("fetch_time timestamp_ntz, vehicle_number string, line string, brigade string, vehicle_type tinyint, "
          "lat double, lon double, vehicle_time timestamp_ntz")


def _rows(start, n, step_s, vehicle="a"):
    t0 = dt.datetime(2024, 1, 10, start)
    return [(t0 + dt.timedelta(seconds=i * step_s + 20), vehicle, "1", "1", 2, 52.2 + i * 1e-4, 21.0,
             t0 + dt.timedelta(seconds=i * step_s)) for i in range(n)]


def _land(spark, parts, order):
    """Each part as one file, arriving in this order."""
    src = shared_dir(spark, "late-src")
    jvm = spark._jvm
    P = jvm.org.apache.hadoop.fs.Path
    fs = P(src).getFileSystem(spark._jsc.hadoopConfiguration())
    for i, name in enumerate(order):
        spark.createDataFrame(parts[name], SCHEMA).coalesce(1).write.parquet(f"{src}/tmp-{name}")
        for st in fs.listStatus(P(f"{src}/tmp-{name}")):
            if st.getPath().getName().endswith(".parquet"):
                fs.rename(st.getPath(), P(f"{src}/in/{name}.parquet"))
        fs.setTimes(P(f"{src}/in/{name}.parquet"), 2_000_000_000_000 + i * 1000, -1)
    return src


def test_late_rows_are_dropped_and_counted(spark):
    """Rows older than the watermark a batch starts with are dropped and
    counted (Spark filters late rows with the previous batch's watermark)."""
    src = _land(spark, {"a": _rows(10, 30, 60), "c": _rows(11, 30, 60), "b": _rows(8, 5, 60, vehicle="b")}, ["a", "c", "b"])
    s = streams.position_stream(spark, f"{src}/in", max_files_per_trigger=1)
    sink, ckpt = shared_dir(spark, "late-sink"), shared_dir(spark, "late-ckpt")
    totals = streams.run_to_completion(streams.dedup_stream(s, "10 minutes"), sink, ckpt)
    out = spark.read.parquet(sink)
    assert out.filter("vehicle_number = 'b'").count() == 0
    assert totals["dropped_late_rows"] == 5
    assert totals["input_rows"] == 65


def test_late_rows_are_kept_beside_and_loaded(spark):
    """Late rows miss the main table, are kept whole (replays included) and give the batch result once loaded."""
    repoll = [(r[0] - dt.timedelta(seconds=10), *r[1:5], 52.25, *r[6:]) for r in _rows(10, 3, 60)]   # earlier fetches, late
    invalid = [(r[0], "x", *r[2:5], None, *r[6:]) for r in _rows(8, 2, 60)]
    parts = {"a": _rows(10, 30, 60), "c": _rows(12, 30, 60), "b": _rows(8, 5, 60, vehicle="b") + repoll + invalid,
             "d": _rows(13, 2, 60) + _rows(12, 1, 60, vehicle="d")}
    src = _land(spark, parts, ["a", "c", "b", "d"])
    target, side, ckpt = (shared_dir(spark, f"side-{n}") for n in ("target", "rows", "ckpt"))
    sink = streams.late_aware_sink(target, side, "10 minutes")
    s = streams.position_stream(spark, f"{src}/in", max_files_per_trigger=1)
    q = s.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    late = streams.late_rows(spark, side)
    # row d at 12:00 is late only against 12:29 less ten minutes
    assert sorted((r["vehicle_number"], r["epoch"]) for r in late.collect()) == [("a", 2)] * 3 + [("b", 2)] * 5 + [("d", 3)]
    kept = incremental.read_upserted(spark, target)
    assert kept.filter("vehicle_number IN ('b', 'd')").count() == 0 and kept.count() == 62
    # a replay of the last micro-batch changes nothing
    sink(spark.createDataFrame(parts["d"], SCHEMA), 3)
    assert streams.late_rows(spark, side).count() == 9 and incremental.read_upserted(spark, target).count() == 62
    raw = spark.createDataFrame([r for p in parts.values() for r in p], SCHEMA)
    want = sorted(map(str, staging.clean_positions(None, raw).collect()))
    for _ in range(2):                                  # loading twice changes nothing
        got = streams.load_late(spark, target, side).drop("vehicle_date").select(*staging.clean_positions(None, raw).columns)
        assert sorted(map(str, got.collect())) == want


def test_no_late_rows(spark):
    src = _land(spark, {"a": _rows(10, 5, 60), "c": _rows(11, 5, 60)}, ["a", "c"])
    target, side, ckpt = (shared_dir(spark, f"side-{n}") for n in ("target", "rows", "ckpt"))
    s = streams.position_stream(spark, f"{src}/in")
    q = (s.writeStream.foreachBatch(streams.late_aware_sink(target, side)).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert streams.late_rows(spark, side) is None
    assert streams.load_late(spark, target, side).count() == 10


def test_previous_ping_state_flags_stale_rows_and_expires():
    import pandas as pd

    class State:
        exists, value, hasTimedOut, timeout = False, None, False, None

        @property
        def get(self):
            return self.value

        def update(self, v):
            self.exists, self.value = True, v

        def remove(self):
            self.exists, self.value = False, None

        def setTimeoutTimestamp(self, ms):
            self.timeout = ms

        def getCurrentWatermarkMs(self):
            return 0

    st = State()
    t = pd.Timestamp("2024-01-10 10:00:00")
    key = ("a", int(t.timestamp()) // 3600)
    previous = streams._previous_ping(3600)

    def frame(secs, halo=()):
        return pd.DataFrame({"vehicle_number": "a", "line": "1", "brigade": "1", "vehicle_type": 2,
                             "vehicle_time": [t + pd.Timedelta(seconds=x) for x in secs],
                             "lat": [52.2] * len(secs), "lon": [21.0] * len(secs), "halo": [x in halo for x in secs]})

    # a halo row is a predecessor and not emitted
    out1 = pd.concat(list(previous(key, iter([frame([60, -30]), frame([0], halo=(0,))]), st)))
    assert list(out1["vehicle_time"]) == [t - pd.Timedelta(seconds=30), t + pd.Timedelta(seconds=60)]
    assert out1.iloc[1]["prev_time"] == t
    out2 = pd.concat(list(previous(key, iter([frame([30, 120])]), st)))
    assert list(out2["stale"]) == [False, True] and out2.iloc[0]["prev_time"] == t + pd.Timedelta(seconds=60)
    assert st.timeout == (key[1] + 1) * 3600 * 1000
    st.hasTimedOut = True
    assert not list(previous(key, iter([]), st)) and not st.exists


def test_previous_ping_of_many_vehicles_in_one_group():
    import pandas as pd

    class State:
        exists, hasTimedOut, value = False, False, None

        @property
        def get(self):
            return self.value

        def update(self, v):
            self.exists, self.value = True, v

        def setTimeoutTimestamp(self, ms):
            pass

        def getCurrentWatermarkMs(self):
            return 0

    t = pd.Timestamp("2024-01-10 10:00:00")
    previous, st = streams._previous_ping(3600), State()

    def run(rows):
        frame = pd.DataFrame([{"vehicle_number": v, "line": "1", "brigade": "1", "vehicle_type": 2, "vehicle_time": t + pd.Timedelta(seconds=s),
                               "lat": 52.0 + s / 1000, "lon": 21.0, "halo": False} for v, s in rows])
        out = pd.concat(list(previous((3, int(t.timestamp()) // 3600), iter([frame]), st)))
        back = lambda x: None if pd.isna(x) else int((x - t).total_seconds())
        return sorted(((r.vehicle_number or "", back(r.vehicle_time), back(r.prev_time), bool(r.stale)) for r in out.itertuples()), key=str)

    assert run([("b", 20), ("a", 10), ("a", 0), ("b", 5), (None, 7)]) == [
        ("", 7, None, False), ("a", 0, None, False), ("a", 10, 0, False), ("b", 20, 5, False), ("b", 5, None, False)]
    # each vehicle goes on from its own last ping, what lies before that is stale, a new vehicle begins
    assert run([("a", 15), ("b", 15), ("b", 30), ("c", 1), (None, 9)]) == [
        ("", 9, 7, False), ("a", 15, 10, False), ("b", 15, None, True), ("b", 30, 20, False), ("c", 1, None, False)]


def test_number_of_micro_batches_does_not_follow_the_rows(spark):
    rows = spark.createDataFrame(_rows(0, 800, 60), SCHEMA)
    src, sink, ckpt = (shared_dir(spark, f"many-{n}") for n in ("src", "sink", "ckpt"))
    landed = streams.land_in_order(rows, src, "vehicle_time", rows_per_file=20)
    assert landed > 2 * streams.MAX_BATCHES
    s = streams.position_stream(spark, src, streams.files_per_trigger(landed, 3))
    totals = streams.run_to_completion(s, sink, ckpt)
    assert totals["input_rows"] == 800 and totals["batches"] <= streams.MAX_BATCHES + 1
    assert streams.files_per_trigger(12, 3) == 3


def test_timetable_of_the_matching_stream_is_not_shuffled(spark):
    from pyspark.sql import functions as F
    from tramspark.operators import matching
    from tramspark.plans.pipeline import bucketed
    at = F.lit("2024-01-10 10:00:00").cast("timestamp_ntz")
    base = spark.range(50).select(F.col("id").cast("string").alias("id"), F.lit("1").alias("line"), F.lit("1").alias("brigade"),
                                  F.to_date(at).alias("service_date"), (F.lit(52.2) + F.col("id") * 0.0001).alias("lat"), F.lit(21.0).alias("lon"))
    sched = base.select(F.col("id").alias("trip_id"), F.col("id").alias("stop_id"), F.col("id").alias("stop_name"), "line", "brigade", "service_date",
                        F.col("lat").alias("stop_lat"), F.col("lon").alias("stop_lon"), at.alias("scheduled_arrival"))
    pings = base.select(F.col("id").alias("vehicle_number"), "line", "brigade", "service_date", "lat", "lon", at.alias("vehicle_time"))
    table = bucketed(matching.schedule_keys(sched, 100.0, 900), "test-timetable", "__key")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = matching.stop_match_candidates(pings, table, repeat="positions")
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(__key") == 1
        want = matching.stop_match_candidates(pings, sched, repeat="positions")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32MB")
