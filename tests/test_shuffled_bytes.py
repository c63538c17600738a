"""What the models shuffle and parse: cells of text once, few repeats in the matching join, no second shuffle to write by date."""

import datetime as dt
import re

import pyspark.sql.functions as F
import pytest

from tramspark.operators import headway, history, matching, movement, staging
from tramspark.operators import windows as win
from tramspark.session import shared_dir
from tramspark.sources.store import Store

T0 = dt.datetime(2024, 1, 1, 23, 0)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_text_cells_are_parsed_once(spark):
    names = ["fetch_time", "vehicle_number", "line", "brigade", "vehicle_type", "lat", "lon", "vehicle_time"]
    rows = [("fetch_time", *names[1:]), ("2024-01-01T10:00:20", "7", "1", "2", "1", "52.2", "21.0", "2024-01-01T10:00:00"),
            ("2024-01-01T10:00:20", None, None, None, None, "52.2", "21.0", "2024-01-01 10:01"), ("2024-01-01T10:00:20", "8", "1", "2", "x", "bad", "21.0", "2024-01-01T10:00:00"),
            ("2024-01-01T10:00:20", "9", "1", "2", "1", "57.2", "21.0", "2024-01-01T10:00:00")]
    text = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    valid = staging.filter_valid(staging.type_csv_positions(text.repartition(2)))
    assert all("RLIKE" not in x for x in plan(valid).splitlines() if re.match(r"[\s:+*()\d-]*Filter", x))
    got = sorted((r["vehicle_number"] or "", r["vehicle_time"], r["vehicle_type"], r["lat"]) for r in valid.collect())
    assert got == [("", dt.datetime(2024, 1, 1, 10, 1), None, 52.2), ("7", dt.datetime(2024, 1, 1, 10), 1, 52.2)]


def test_repeats_of_the_matching_join_are_few(spark):
    stops = spark.range(10_000).select(F.col("id").cast("string").alias("stop_id"), (F.lit(52.0) + F.rand(1) / 2).alias("stop_lat"),
                                       (F.lit(21.0) + F.rand(2) / 2).alias("stop_lon"))
    assert matching.stop_cells(stops, 100.0).count() < 1.45 * 10_000
    assert 1 + 2 / matching.BUCKET < 1.2


def pings(spark, n=4000):
    return spark.range(n).select((F.col("id") % 7).cast("string").alias("vehicle_number"), F.lit("1").alias("line"), F.lit("2").alias("brigade"),
                                 F.lit(1).alias("vehicle_type"), (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * 40)).alias("vehicle_time"),
                                 (F.lit(52.2) + F.col("id") % 5 * 0.0001).alias("lat"), F.lit(21.0).alias("lon")).repartition(5)


def candidates(p):
    return p.select("*", F.lit(3).alias("abs_time_gap"), F.lit(1.5).alias("meters_to_stop"), F.lit("t").alias("trip_id"),
                                                      F.lit("s").alias("stop_id"), F.lit("S").alias("stop_name"), F.col("vehicle_time").alias("scheduled_arrival"))


@pytest.mark.parametrize("model", ["positions", "moves", "matches", "headway"])
def test_models_lie_by_day_after_one_shuffle(spark, model):
    p = pings(spark)
    p.write.parquet(path := shared_dir(spark, "pings"))
    p = spark.read.parquet(path)
    if model == "positions":
        df, time = staging.clean_positions(None, p.withColumn("fetch_time", F.col("vehicle_time")), by_day=True), "vehicle_time"
    elif model == "moves":
        df, time = movement.vehicle_moves(p), "vehicle_time"
    elif model == "matches":
        df, time = matching.best_match(candidates(p)), "actual_time"
    else:
        visits = p.select("line", F.lit("s").alias("stop_id"), F.lit("S").alias("stop_name"), "vehicle_number", F.col("vehicle_time").alias("arrival_time"))
        df, time = headway.headway_from_visits(visits), "arrival_time"
    assert len(re.findall(r"Exchange hashpartitioning", plan(df))) == 1
    df = df.withColumn("day", F.to_date(time))
    store = Store(spark, shared_dir(spark, "dealt"))
    load = store.begin()
    load.put(model, df, "day", dealt=True)
    load.commit()
    kept = store.read(model)
    assert kept.count() == df.count() > 0
    assert kept.exceptAll(df.select(*kept.columns)).isEmpty() and df.select(*kept.columns).exceptAll(kept).isEmpty()
    files = kept.select("day", F.col("_metadata.file_path").alias("f")).distinct().groupBy("day").count().collect()
    assert files and all(r["count"] <= win.PLACES for r in files)


def test_facts_of_the_lookup_carry_key_and_time_once(spark, monkeypatch):
    path = shared_dir(spark, "as-of")
    monkeypatch.setattr(history, "shared_dir", lambda *_: path)
    facts = spark.createDataFrame([("v", T0, "a", 1), ("w", None, "a", 2), ("x", T0, None, 3)], "`a.b` string, t timestamp_ntz, k string, n int")
    hist = spark.createDataFrame([("a", "A", dt.datetime(2024, 1, 1), None)], "k string, name string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    out = history.asof_lookup(facts, hist, "k", "t", ["name"])
    assert out.columns == ["a.b", "t", "k", "n", "name"]
    assert sorted(map(tuple, out.collect()), key=lambda r: r[3]) == [("v", T0, "a", 1, "A"), ("w", None, "a", 2, None), ("x", T0, None, 3, None)]
    assert spark.read.parquet(path).schema["fact"].dataType.names == ["__is", "a.b", "n"]
