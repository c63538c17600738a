"""One load: new files in, only what they touch rebuilt, everything visible at once.

* **What is new** comes from the load ledger: files not loaded yet, by feed
  (``operators.ledger``).
* **Positions** of the touched days are merged by (vehicle, time); every row
  carries the load that brought it, so the changed pings are the rows of this
  load.
* **Changes move down the graph** as sets of touched keys: a changed ping touches
  its vehicle's pieces of history up to the longest gap later; its match touches
  the headway of its (line, stop) as far as a visit reaches, and the segments of
  its (trip, vehicle).  Each model recomputes just the touched
  pieces (their halos included) and keeps its other rows; days that nothing
  touches are not read or written.
* **Marts** are merged from partial states per day (``operators.states``).
* All tables switch together (``sources.store``): readers see the run before or
  this one, and a run that fails is simply run again.

The first load of a folder builds everything by the same functions.  A changed
timetable is found by its tables' fingerprints, kept with each build
(``operators.fingerprint``): all pings are then matched anew and what reads the
matches is rebuilt; positions, moves and their marts only follow new pings.  Keys
(vehicle, line, stop, trip) must not be null.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramspark.operators import fingerprint, ledger, marts, matching, movement, segments, staging, states
from tramspark.operators import headway as hw
from tramspark.operators import windows as win
from tramspark.plans.pipeline import FIXTURE_PARAMS, MODEL_ORDER, Params
from tramspark.session import ONE_BY_ONE, remove_path, settings, shared_dir
from tramspark.sources.schemas import GTFS_COLUMNS
from tramspark.sources.store import Load, Store

HOUR = 3600
POSITION_FEEDS = ("positions_csv", "positions_parquet")
LEDGER = "load_ledger"
PRINTS = "timetable_prints"
BY = "load_id"                  # the load that brought a row
PING = ["vehicle_number", "vehicle_time"]
# Partition column of each table and the time it is the date of.
DATES = {"positions": ("vehicle_date", "vehicle_time"), "moves": ("move_date", "vehicle_time"), "matches": ("match_date", "actual_time"),
         "headway": ("headway_date", "arrival_time"), "segments": ("segment_date", "arrived_at")}
# State tables: the model they are counted from.
STATES = {"state_speed": "moves", "state_grid": "moves", "state_delay": "matches", "state_stops": "matches",
          "state_headway": "headway", "state_segments": "segments"}
INNER = {"positions": [BY], "matches": [BY], "segments": ["trip_id"], "stop_times": staging.OF_TRIP}   # columns only a load needs


def together(threads: int, *steps: Callable) -> list:
    """The results of independent steps, run side by side."""
    with ThreadPoolExecutor(max(1, threads)) as pool:
        return [f.result() for f in [pool.submit(s) for s in steps]]


def _dated(df: DataFrame, table: str) -> DataFrame:
    day, time = DATES[table]
    return df.withColumn(day, F.to_date(time))


def _days_of(df: DataFrame, time: str) -> list[dt.date]:
    """Calendar days of some rows: as many values as days."""
    return sorted(r["d"] for r in df.select(F.to_date(time).alias("d")).distinct().collect())


def _around(days: list[dt.date], before: int, after: int = 0) -> list[dt.date]:
    return sorted({d + dt.timedelta(k) for d in days for k in range(-before, after + 1)})


class Run:
    """The steps of one load into a store."""

    def __init__(self, load: Load, timetable: dict[str, DataFrame], params: Params):
        self.load, self.timetable, self.p = load, timetable, params
        self.stops, self.routes = staging.gtfs_stops(timetable["stops"]), staging.gtfs_routes(timetable["routes"])
        self.gone: str | None = None        # folder of the matches that went

    def _on(self, table: str, days: list[dt.date], before: bool = False) -> DataFrame:
        """The rows of a table on some days."""
        df = self.load.read_before(table) if before else self.load.read(table)
        return df.filter(F.col(DATES[table][0]).isin(days))

    def _present(self, table: str) -> set[dt.date]:
        return {dt.date.fromisoformat(v) for v in self.load.values(table)}

    def _reached(self, changes: DataFrame, days: list[dt.date], source: str, time: str, seconds: int, bucket: int = win.DAY) -> list[dt.date]:
        """The days a change on ``days`` can alter, ``seconds`` later at most: looked up only if there are later days."""
        later = set(_around(days, 0, -(-seconds // win.DAY))) - set(days)
        if not later & self._present(source):
            return sorted(days)
        # as many values as days
        return sorted(set(days) | {r["day"] for r in win.reached_days(changes, time, seconds, bucket).collect()})

    def _came(self) -> Column:
        return F.col(BY) == F.lit(self.load.id)

    def _replace(self, table: str, new: DataFrame, days: list[dt.date], dealt: bool = True) -> None:
        self.load.put(table, _dated(new, table), DATES[table][0], days, dealt)

    def positions(self, batch: DataFrame, strategy: str) -> list[dt.date] | None:
        """The batch merged; its days (None: the table is new)."""
        batch = _dated(batch.withColumn(BY, F.lit(self.load.id)), "positions")
        if not self.load.has("positions"):
            self.load.put("positions", batch, "vehicle_date", dealt=True)
            return None
        spark, path = batch.sparkSession, shared_dir(batch.sparkSession, "load-batch")
        batch.write.parquet(path)       # read for its days and for the merge
        batch = spark.read.schema(batch.schema).parquet(path)
        days = _days_of(batch, "vehicle_time")
        old = self._on("positions", days)
        if strategy == "delete_insert":
            merged = old.join(batch.select(*PING), PING, "left_anti").unionByName(batch)
        elif strategy == "first_wins":
            # of rows alike in everything the earlier load's stays, and is no change
            both = old.withColumn("__new", F.lit(False)).unionByName(batch.withColumn("__new", F.lit(True)))
            names = [c for c in both.columns if c not in ("__new", BY)]
            merged = staging.dedup_by_day(both.select(*names, "__new", BY)).drop("__new")
        else:
            raise ValueError(strategy)
        self.load.put("positions", merged, "vehicle_date", days, dealt=strategy == "first_wins")
        remove_path(spark, path)
        return days

    def changed_pings(self, days: list[dt.date]) -> DataFrame:
        return self._on("positions", days).filter(self._came())

    def moves(self, days: list[dt.date] | None) -> list[dt.date] | None:
        p = self.p
        if days is None:
            moves = movement.vehicle_moves(self.load.read("positions"), p.min_gap_s, p.max_gap_s, p.max_speed_kmh, HOUR)
            self.load.put("moves", _dated(moves, "moves"), "move_date", dealt=True)
            return None
        # the pieces that changed pings touch are rebuilt where they meet their old moves, the others' moves stay
        out = self._reached(self.changed_pings(days), days, "positions", "vehicle_time", p.max_gap_s, HOUR)
        near = self._on("positions", _around(out, -(-p.max_gap_s // win.DAY)))
        old = self._on("moves", out).drop(DATES["moves"][0])
        self._replace("moves", movement.moves_of_touched(near, self._came(), old, p.min_gap_s, p.max_gap_s, p.max_speed_kmh, HOUR), out)
        return out

    def stop_times(self, days: list[dt.date] | None) -> None:
        """Scheduled stops of service days that have positions; days known already stay as they are."""
        load, feed = self.load, self.timetable["stop_times"]
        if days is None or (load.has("stop_times") and not set(staging.OF_TRIP) <= set(load.read("stop_times").columns)):
            load.put("stop_times", staging.gtfs_stop_times(feed, load.read("trips"), load.read("positions"), True), "service_date")
        elif fresh := sorted(set(days) - self._present("stop_times")):
            load.put("stop_times", staging.gtfs_stop_times(feed, load.read("trips"), self._on("positions", fresh), True), "service_date", fresh)

    def matches(self, days: list[dt.date] | None) -> DataFrame | None:
        """Changed pings matched anew; returns the matches that went."""
        p, load = self.p, self.load
        routes, trips = self.routes, load.read("trips")
        self.stop_times(days)       # written before the matching reads them

        def compute(positions, stop_times, repeat="schedule"):
            return matching.stop_matches(positions, stop_times, trips, routes, self.stops, p.as_of, p.retention_days, p.radius_m, p.window_s,
                                         p.bucketed_match, p.previous_service_day_until, repeat).withColumn(BY, F.lit(load.id))

        if days is None:
            load.put("matches", _dated(compute(load.read("positions"), load.read("stop_times")), "matches"), "match_date", dealt=True)
            return None
        changed = self.changed_pings(days)
        keys = changed.select("vehicle_number", F.col("vehicle_time").alias("actual_time"))
        old = self._on("matches", days)
        service = days if p.previous_service_day_until is None else _around(days, 1)
        stop_times = load.read("stop_times").filter(F.col("service_date").isin(service))
        # the few changed pings go to the cells and buckets around them, not the day's timetable
        new = _dated(compute(changed, stop_times, "positions"), "matches")
        self._replace("matches", win.not_marked(old, keys, ["vehicle_number"], "actual_time").unionByName(new), days)
        # read by the headways and the segments, joined once
        self.gone = shared_dir(keys.sparkSession, "load-gone")
        gone = self._on("matches", days, before=True).select("trip_id", "line", "stop_id", *keys.columns)
        gone.join(keys, keys.columns, "left_semi").write.parquet(self.gone)
        return keys.sparkSession.read.schema(gone.schema).parquet(self.gone)

    def headway(self, gone: DataFrame | None, days: list[dt.date] | None) -> list[dt.date] | None:
        """Headway of the touched (line, stop), by way of the visits there; visits are no table of their own."""
        load, p = self.load, self.p
        if gone is None:
            visits = hw.stop_visits(load.read("matches"), p.visit_gap_s)
            load.put("headway", _dated(hw.headway_from_visits(visits, p.headway_min, p.headway_max, p.bunched_below), "headway"), "headway_date", dealt=True)
            return None
        # a ping starts or ends a visit up to the gap later, which is the predecessor of visits up to the longest headway later
        reach = p.visit_gap_s + int(-(-p.headway_max * 60 // 1))
        changes = self._on("matches", days).filter(self._came()).select("actual_time").unionByName(gone.select("actual_time"))
        out = self._reached(changes, days, "matches", "actual_time", reach)
        near, old = self._on("matches", _around(out, -(-reach // win.DAY))), self._on("headway", out).drop(DATES["headway"][0])
        self._replace("headway", hw.headway_of_touched(near, self._came(), gone, old, p.visit_gap_s, p.headway_min, p.headway_max, p.bunched_below), out)
        return out

    def segments(self, gone: DataFrame | None, days: list[dt.date] | None) -> list[dt.date] | None:
        """Segments of the touched (trip, vehicle)."""
        load, p = self.load, self.p
        keys = segments.SEGMENT_KEYS
        one_day = p.previous_service_day_until is None      # a dated trip meets pings of its own day only

        def compute(matches):
            return segments.route_segments(matches, p.seg_min, p.seg_max, p.seg_max_diff, True, one_day)

        if gone is None:
            load.put("segments", _dated(compute(load.read("matches")), "segments"), "segment_date", dealt=one_day)
            return None
        if one_day:
            old = self._on("segments", days).drop(DATES["segments"][0])
            self._replace("segments", segments.segments_of_touched(self._on("matches", days), self._came(), gone, old, p.seg_min, p.seg_max,
                                                                   p.seg_max_diff), days)
            return days
        # or pings of the next one
        delta = self._on("matches", days).filter(self._came()).select(*keys).unionByName(gone.select(*keys))
        touched, near = delta.distinct(), _around(days, 1, 1)
        new = compute(self._on("matches", near).join(touched, keys, "left_semi"))
        replaced = self._on("segments", near).join(touched, keys, "left_semi")
        out = _days_of(new.select("arrived_at").unionByName(replaced.select("arrived_at")), "arrived_at")
        kept = self._on("segments", out).join(touched, keys, "left_anti")
        self._replace("segments", kept.unionByName(_dated(new, "segments")), out, dealt=False)
        return out

    def state(self, name: str, days: list[dt.date] | None) -> None:
        """A state counted anew on the days its model was touched."""
        p, model = self.p, STATES[name]
        compute = {"state_speed": states.speed_state, "state_grid": lambda x: states.grid_state(x, p.grid_lat_step, p.grid_lon_step),
                   "state_delay": states.delay_state, "state_stops": states.stop_state,
                   "state_headway": states.headway_state, "state_segments": states.segment_state}[name]
        if days is None or not self.load.has(name):
            self.load.put(name, compute(self.load.read(model)), states.DAY)
        elif days:
            self.load.put(name, compute(self._on(model, days)), states.DAY, days)

    def mart(self, name: str) -> None:
        p, read = self.p, self.load.read
        self.load.put(name, {
            "line_speed": lambda: states.line_speed(read("state_speed"), p.line_speed_min_n),
            "speed_by_hour": lambda: states.speed_by_hour(read("state_speed"), p.speed_by_hour_min_n),
            "speed_grid": lambda: states.speed_grid(read("state_grid"), p.grid_min_n, p.grid_max_crawl_pct),
            "line_punctuality": lambda: states.line_punctuality(read("state_delay"), p.punctuality_min_n),
            "punctuality_by_hour": lambda: states.punctuality_by_hour(read("state_delay"), p.punctuality_hour_min_n),
            "worst_stops": lambda: states.worst_stops(read("state_stops"), self.stops, p.worst_stops_min_n),
            "line_regularity": lambda: states.line_regularity(read("state_headway"), p.regularity_min_n, p.regularity_max_avg),
            "slowest_segments": lambda: states.slowest_segments(read("state_segments"), p.segments_min_n),
        }[name]().coalesce(1))      # a mart has at most a row per line, cell, stop or segment

    def calendar_and_frames(self, days: list[dt.date] | None) -> None:
        """The date spine over the days that have positions, and the frames of the newest day if it was touched."""
        positions, present = self.load.read("positions"), sorted(self._present("positions"))
        pings = positions.sparkSession.createDataFrame([(dt.datetime.combine(d, dt.time()),) for d in present[:1] + present[-1:]],
                                                       "vehicle_time timestamp_ntz")
        self.load.put("calendar", staging.calendar(positions if self.p.calendar_floor else pings, self.p.calendar_floor).coalesce(1))
        if days is None or present[-1] in days:
            self.load.put("animation_frames", marts.animation_frames(positions, self.p.frame_minutes))


MARTS_OF = {"state_speed": ["line_speed", "speed_by_hour"], "state_grid": ["speed_grid"], "state_delay": ["line_punctuality", "punctuality_by_hour"],
            "state_stops": ["worst_stops"], "state_headway": ["line_regularity"], "state_segments": ["slowest_segments"]}


def run_load(spark: SparkSession, base: str, feeds: dict, timetable: dict[str, DataFrame], params: Params = FIXTURE_PARAMS,
             threads: int = 4, strategy: str = "first_wins", full_refresh: bool = False, keep: int = 2) -> Store:
    """Load what the feeds have that ``base`` does not hold yet; returns the store.

    ``feeds`` maps a feed's name to its files (``ledger.FileFeed``) or rows.  A
    later poll of a ping is dropped (``first_wins``) or replaces the earlier one
    (``delete_insert``).  The newest ``keep`` snapshots stay readable.
    """
    with settings(spark, ONE_BY_ONE):
        return _run_load(spark, base, feeds, timetable, params, threads, strategy, full_refresh, keep)


def _run_load(spark: SparkSession, base: str, feeds: dict, timetable: dict[str, DataFrame], params: Params, threads: int,
              strategy: str, full_refresh: bool, keep: int) -> Store:
    store = Store(spark, base)
    load = store.begin()
    if full_refresh:
        load.tables.clear()
    known = load.read(LEDGER) if load.has(LEDGER) else None
    given = [(n, s) for n, s in feeds.items() if s is not None]
    prints = fingerprint.fingerprints(timetable, GTFS_COLUMNS)
    other, *parts = together(threads, lambda: fingerprint.changed(prints, load.read(PRINTS) if load.has(PRINTS) else None),
                             *(lambda n=n, s=s: ledger.unread(spark, n, s, known) for n, s in given))
    parts = [u for u in parts if u is not None]
    if not parts and not other and load.has("positions"):
        return store
    run, days, steps = Run(load, timetable, params), [], []
    if other:                       # a first load too
        steps += [lambda: load.put("trips", staging.gtfs_trips(timetable["trips"])), lambda: load.put(PRINTS, prints.coalesce(1))]
    if parts or not load.has("positions"):
        text = [u.rows for u in parts if dict(u.rows.dtypes)["fetch_time"] == "string"]
        typed = [u.rows for u in parts if dict(u.rows.dtypes)["fetch_time"] != "string"]
        batch = staging.clean_positions(_union(text), _union(typed), params.bbox, by_day=True)
        steps.append(lambda: load.put(LEDGER, _union([*([known] if known is not None else []), *(ledger.entries(u, load.id) for u in parts)]).coalesce(1)))
        days = together(threads, lambda: run.positions(batch, strategy), *steps)[0]
    else:
        together(threads, *steps)
    if days == [] and not other:    # nothing but rows out of the area or without a time
        load.commit()
        return store
    # under another timetable every ping is matched anew
    matched = None if other else days

    def moves():
        return run.moves(days) if days != [] else []

    def calendar_and_frames():
        if days != []:
            run.calendar_and_frames(days)

    gone, move_days, _ = together(threads, lambda: run.matches(matched), moves, calendar_and_frames)

    def states_and_marts(model, changed):
        names = [s for s, m in STATES.items() if m == model]
        if changed is not None and not changed:
            return
        together(threads, *(lambda s=s: run.state(s, changed) for s in names))
        together(threads, *(lambda m=m: run.mart(m) for s in names for m in MARTS_OF[s]))

    def headways():
        states_and_marts("headway", run.headway(gone, matched))

    together(threads, headways, lambda: states_and_marts("segments", run.segments(gone, matched)),
             lambda: states_and_marts("matches", matched), lambda: states_and_marts("moves", move_days))
    load.commit()
    if run.gone:
        remove_path(spark, run.gone)
    store.vacuum(keep)
    return store


def _union(parts: list[DataFrame]) -> DataFrame | None:
    out = None
    for part in parts:
        out = part if out is None else out.unionByName(part)
    return out


def tables(store: Store, timetable: dict[str, DataFrame], params: Params = FIXTURE_PARAMS) -> dict[str, DataFrame]:
    """The models of the newest snapshot, as the graph returns them."""
    snapshot = store.snapshot()
    out = {"stops": staging.gtfs_stops(timetable["stops"]), "routes": staging.gtfs_routes(timetable["routes"])}
    for name in MODEL_ORDER:
        if name == "visits":
            out[name] = hw.stop_visits(out["matches"], params.visit_gap_s)
        elif name not in out:
            helpers = [*INNER.get(name, []), *([DATES[name][0]] if name in DATES and name not in ("positions", "matches") else [])]
            out[name] = store.read(name, snapshot).drop(*helpers)
    return out


def build_incremental(inputs: dict, params: Params = FIXTURE_PARAMS, out_dir: str = "", threads: int = 4,
                      strategy: str = "first_wins", full_refresh: bool = False) -> dict[str, DataFrame]:
    """One load of the position feeds among ``inputs`` into ``out_dir``; returns all models."""
    feeds = {n: inputs.get(n) for n in POSITION_FEEDS}
    timetable = {n: df for n, df in inputs.items() if n not in POSITION_FEEDS}
    spark = timetable["stops"].sparkSession
    return tables(run_load(spark, out_dir, feeds, timetable, params, threads, strategy, full_refresh), timetable, params)
