"""Stop matching by buckets and cells against the plain join, on any place of the globe and gate boundaries."""

import datetime as dt
import math
import random

import pytest

from tramspark.operators import matching as mt
from tramspark.plans.catalog import models
from tramspark.plans.pipeline import FIXTURE_PARAMS as P

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 1, 10, 12)
POS = "vehicle_number string, line string, brigade string, vehicle_time timestamp_ntz, lat double, lon double, service_date date"
STOP = ("trip_id string, stop_id string, scheduled_arrival timestamp_ntz, line string, brigade string, service_date date, "
        "stop_name string, stop_lat double, stop_lon double")


@pytest.mark.parametrize("seed,lat0", [(1, 52.2), (2, 0.0), (3, -33.9), (4, 88.999), (5, 89.5), (6, -89.999)])
def test_cells_lose_and_add_nothing(spark, seed, lat0):
    rng = random.Random(seed)
    lon0 = rng.uniform(-180, 180)
    metre = 1 / 111_320.0
    east = metre / max(0.0005, math.cos(math.radians(lat0)))
    positions, stops = [], []
    for k in range(250):
        lat, lon = lat0 + rng.uniform(-900, 900) * metre, lon0 + rng.uniform(-900, 900) * east
        t = T0 + dt.timedelta(seconds=rng.randrange(-5000, 5000))
        positions.append((f"v{k}", rng.choice(["1", "2", None]), "1", t, lat, lon, T0.date()))
        # partners on either side of both gates
        far, turn = rng.choice([0, 50, 99.9, 100.0, 100.1, 130]), rng.uniform(0, 2 * math.pi)
        at = t + dt.timedelta(seconds=rng.choice([-901, -900, -899, 0, 450, 899, 900, 901]))
        lon2 = lon + far * math.sin(turn) * metre / math.cos(math.radians(min(89.9999, abs(lat))))
        stops.append((f"t{k}", f"s{k}", at, rng.choice(["1", "2"]), "1", T0.date(), "S", lat + far * math.cos(turn) * metre, lon2))
    p, s = spark.createDataFrame(positions, POS), spark.createDataFrame(stops, STOP)
    columns = ["vehicle_number", "trip_id", "stop_id"]
    rows = lambda df: sorted(map(tuple, df.select(*columns).collect()))
    want = rows(mt.stop_match_candidates(p, s, bucketed=False))
    assert want
    for repeat in ("schedule", "positions"):
        assert rows(mt.stop_match_candidates(p, s, repeat=repeat)) == want


def test_five_times_fewer_candidates(spark):
    m = models(spark, SF)
    pos = mt.retained_positions(m["positions"], P.as_of, P.retention_days)
    sched = mt.schedule_points(m["stop_times"], m["trips"], m["routes"], m["stops"])
    plain = mt.candidate_pairs(pos, sched, bucketed=False).count()
    assert all(mt.candidate_pairs(pos, sched, repeat=r).count() * 5 < plain for r in ("schedule", "positions"))
