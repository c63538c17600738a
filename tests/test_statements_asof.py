"""Read-only cached statements, and the as-of lookup in one sorted pass."""

import datetime as dt
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tramspark.operators import history
from tramspark.plans import incremental as plan
from tramspark.plans.statements import NotReadOnly, Statements
from tramspark.sources import fixtures

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 1, 1)


def plain_asof(facts, versions, attrs):
    """The join on key and validity range."""
    out = []
    for k, t, n in facts:
        hit = [v for v in versions if k is not None and t is not None and v[0] == k and v[1] <= t and (v[2] is None or t < v[2])]
        out.append((k, t, n, *(hit[0][3:] if hit else (None,) * attrs)))
    return sorted(out, key=str)


@pytest.mark.parametrize("bucket", [3600, 86400, 7 * 86400])
def test_asof_equals_the_range_join(spark, bucket):
    rng = random.Random(bucket)
    versions, facts = [], []
    for k in ("hot", "a", "b", "never"):
        at = T0 + dt.timedelta(hours=rng.randrange(100))
        for i in range(400 if k == "hot" else rng.randrange(1, 5)):
            end = at + dt.timedelta(seconds=rng.randrange(1, 9000) if k == "hot" else rng.randrange(90000, 900000))
            gap = dt.timedelta(seconds=rng.choice([0, 0, 50]))
            versions.append((k, at, end, f"{k}{i}", i))
            at = end + gap
        versions[-1] = (*versions[-1][:2], None, *versions[-1][3:])
    for n in range(600):
        k = rng.choice(["hot", "hot", "a", "b", "new", None])
        t = rng.choice(versions)[1] if n % 5 == 0 else T0 + dt.timedelta(seconds=rng.randrange(0, 40 * 86400))
        facts.append((k, None if n % 97 == 0 else t, n))
    h = spark.createDataFrame(versions, "stop_id string, valid_from timestamp_ntz, valid_to timestamp_ntz, name string, x int")
    f = spark.createDataFrame(facts, "stop_id string, t timestamp_ntz, kind int")
    got = history.asof_lookup(f, h, "stop_id", "t", ["name", "x"], "h_", bucket)
    assert got.columns == ["stop_id", "t", "kind", "h_name", "h_x"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_asof(facts, versions, 2)


def test_a_key_with_ten_thousand_versions_does_not_fan_out(spark):
    versions = [("s", T0 + dt.timedelta(minutes=i), T0 + dt.timedelta(minutes=i + 1), str(i)) for i in range(10_000)]
    h = spark.createDataFrame(versions, "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, name string")
    f = spark.range(20_000).select(F.lit("s").alias("k"), (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.col("id") * 30)).alias("t"), "id")
    got = history.asof_lookup(f, h, "k", "t", ["name"])
    assert got.filter(F.col("name").cast("long") != F.floor(F.col("id") / 2)).count() == 0 and got.filter("name IS NULL").count() == 0


def test_statements_are_read_only_cached_and_see_new_loads(spark, tmp_path):
    inputs = fixtures.transit_inputs(spark, SF)
    timetable = {n: inputs[n] for n in ("stops", "routes", "trips", "stop_times")}
    feeds = {"a": inputs["positions_csv"]}
    store = plan.run_load(spark, str(tmp_path / "m"), feeds, timetable)
    now = [0.0]
    s = Statements(store, timetable, clock=lambda: now[0])
    sql = "SELECT count(*) AS n FROM positions"
    first = s.run(sql)

    def jobs(statement):
        ids = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None) or [])
        out = s.run(statement)
        return out, len(set(spark.sparkContext.statusTracker().getJobIdsForGroup(None) or []) - ids)

    again, started = jobs("select  COUNT(*) as n\nfrom positions ;")
    assert again is first and started == 0
    now[0] = 61.0
    assert s.run(sql) is not first
    for bad in ("DROP TABLE positions", "INSERT INTO positions SELECT * FROM positions", "SET x = 1", "SELECT 1; DROP TABLE positions",
                "CREATE TABLE t AS SELECT 1", "CACHE TABLE positions", "SELECT 1) AS a; DROP VIEW positions --"):
        with pytest.raises(NotReadOnly):
            s.run(bad)
    with pytest.raises(AnalysisException):
        s.run("SELECT no_such_column FROM positions")
    assert s.run("WITH x AS (SELECT line FROM line_speed) SELECT count(*) AS n FROM x -- all lines").num_rows == 1
    before = s.run(sql).column("n")[0].as_py()
    plan.run_load(spark, str(tmp_path / "m"), {**feeds, "b": inputs["positions_parquet"]}, timetable)
    assert s.run(sql).column("n")[0].as_py() > before
    with pytest.raises(ValueError):
        Statements(store, timetable, max_rows=3).run("SELECT * FROM positions")
