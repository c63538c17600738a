"""The graph run from feed files equals the in-memory run."""

from tramspark.plans.pipeline import FIXTURE_PARAMS, build_graph
from tramspark.plans.run import inputs_from_files
from tramspark.sources import files, fixtures

SF = "/root/testdata/sf0.001"


def test_file_inputs_equal_memory_inputs(spark, tmp_path):
    d = str(tmp_path)
    fixtures.raw_feed_text(spark, SF).write.csv(f"{d}/positions_legacy.csv")
    files.write_positions_batch(fixtures.raw_feed_typed(spark, SF), f"{d}/positions_batches", partition_by=None)
    for name, df in [("stops", fixtures.stops_text(spark, SF)), ("routes", fixtures.routes_text(spark, SF)),
                     ("trips", fixtures.trips_text(spark, SF)), ("stop_times", fixtures.stop_times_text(spark, SF))]:
        df.coalesce(1).write.option("header", True).csv(f"{d}/gtfs_parts/{name}")
        part = [p for p in (tmp_path / "gtfs_parts" / name).iterdir() if p.name.endswith(".csv")][0]
        (tmp_path / "gtfs").mkdir(exist_ok=True)
        part.rename(tmp_path / "gtfs" / f"{name}.txt")
    inputs = inputs_from_files(spark, f"{d}/positions_legacy.csv", f"{d}/positions_batches", f"{d}/gtfs")
    names = ["positions", "matches", "headway", "line_punctuality"]
    a = build_graph(inputs, FIXTURE_PARAMS, f"{d}/out_files", names=names)
    b = build_graph(fixtures.transit_inputs(spark, SF), FIXTURE_PARAMS, f"{d}/out_mem", names=names)
    for n in names:
        cols = [c for c in b[n].columns if c != "vehicle_date"]
        assert sorted(map(tuple, a[n].select(*cols).collect())) == sorted(map(tuple, b[n].select(*cols).collect())), n
    assert a["matches"].count() > 0


def test_full_refresh_cascade_rebuilds_only_downstream(spark, tmp_path):
    from tramspark.plans.pipeline import downstream
    assert downstream({"stops"}) == ["stops", "matches", "visits", "headway", "segments", "line_punctuality",
                                     "punctuality_by_hour", "worst_stops", "line_regularity", "slowest_segments"]
    inputs = fixtures.transit_inputs(spark, SF)
    first = build_graph(inputs, FIXTURE_PARAMS, str(tmp_path / "v1"))
    keep = {n: first[n] for n in ["positions", "trips", "stop_times", "routes"]}
    again = build_graph(inputs, FIXTURE_PARAMS, str(tmp_path / "v2"), names=downstream({"stops"}), existing=keep)
    assert set(again) >= set(downstream({"stops"}))
    assert again["positions"] is keep["positions"]
    assert sorted(map(tuple, again["worst_stops"].collect())) == sorted(map(tuple, first["worst_stops"].collect()))
