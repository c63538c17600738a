"""Summarise the executed (adaptive, final) physical plan of each model step.

Usage: python tools/explain.py [sf_dir] [step ...]

Every step reads materialised upstream tables (as in the pipeline) and is
run once; the summary lists shuffles with their keys, join strategies,
aggregate and window operators, and what reached the Parquet scans.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(plan: str) -> dict:
    final = plan.split("== Initial Plan ==")[0]
    out = {
        "shuffles": re.findall(r"Exchange (hashpartitioning\([^)]*\)|rangepartitioning\([^)]*\)|SinglePartition|"
                               r"RoundRobinPartitioning\(\d+\))", final),
        "joins": re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
                            r"CartesianProduct)[^\n]*?(Inner|LeftOuter|LeftSemi|LeftAnti|FullOuter|RightOuter)?",
                            final),
        "aggregates": re.findall(r"(HashAggregate|SortAggregate|ObjectHashAggregate)\(", final),
        "windows": len(re.findall(r"\bWindow \[", final)),
        "codegen_stages": len(set(re.findall(r"\*\((\d+)\)", final))),
    }
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.1"
    wanted = [a for a in argv[1:] if not a.startswith("/")]
    from tramspark.operators import headway as hw
    from tramspark.operators import marts, matching, movement, segments
    from tramspark.plans.pipeline import FIXTURE_PARAMS as p
    from tramspark.plans.pipeline import build_graph
    from tramspark.session import get_session
    from tramspark.sources import fixtures

    spark = get_session("local[8]", 8)
    t = build_graph(fixtures.transit_inputs(spark, sf_dir), p, tempfile.mkdtemp(prefix="explain-"), threads=4)
    steps = {
        "positions": lambda: fixtures_clean(spark, sf_dir),
        "vehicle_moves": lambda: movement.vehicle_moves(t["positions"]),
        "stop_matches": lambda: matching.stop_matches(t["positions"], t["stop_times"], t["trips"], t["routes"],
                                                      t["stops"], p.as_of, p.retention_days),
        "stop_visits": lambda: hw.stop_visits(t["matches"]),
        "headway": lambda: hw.headway_from_visits(t["visits"]),
        "route_segments": lambda: segments.route_segments(t["matches"]),
        "line_speed": lambda: marts.line_speed(t["moves"]),
        "speed_by_hour": lambda: marts.speed_by_hour(t["moves"]),
        "speed_grid": lambda: marts.speed_grid(t["moves"]),
        "worst_stops": lambda: marts.worst_stops(t["matches"], t["stops"]),
        "line_regularity": lambda: marts.line_regularity(t["headway"]),
        "animation_frames": lambda: marts.animation_frames(t["positions"]),
    }
    for name, fn in steps.items():
        if wanted and name not in wanted:
            continue
        df = fn()
        df.collect()
        s = summarize(df._jdf.queryExecution().executedPlan().toString())
        fplan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        pushed = sorted(set(re.findall(r"(PartitionFilters: \[[^\]]*\]|PushedFilters: \[[^\]]*\])", fplan)))
        print(f"== {name}")
        print(f"   shuffles ({len(s['shuffles'])}): {s['shuffles']}")
        print(f"   joins: {[j[0] + (' ' + j[1] if j[1] else '') for j in s['joins']]}")
        print(f"   aggregates: {s['aggregates']}  windows: {s['windows']}  codegen stages: {s['codegen_stages']}")
        for x in pushed:
            print(f"   {x[:160]}")


def fixtures_clean(spark, sf_dir):
    from tramspark.operators import staging
    from tramspark.sources import fixtures
    i = fixtures.transit_inputs(spark, sf_dir)
    return staging.clean_positions(i["positions_csv"], i["positions_parquet"])


if __name__ == "__main__":
    main(sys.argv)
