"""Declarative data-quality checks (L1-L6) and the model test suite.

A check returns its offending rows; a suite returns one row per check:
(check_no, test, model, column, failures).  ``failures`` counts offending
rows, except for the key checks (unique, unique_combination) where it counts
duplicated key values.  Row-level checks on one table
(not_null, accepted_range, accepted_values) are evaluated together as
conditional counts in a single aggregate over that table; key checks are
grouped counts (map-side combined); relationships are anti-joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    test: str                    # not_null | unique | accepted_values | accepted_range
                                 # | relationships | unique_combination
    model: str
    columns: tuple[str, ...]
    values: tuple = ()           # accepted_values
    min_value: float | None = None
    max_value: float | None = None
    to_model: str | None = None  # relationships
    to_column: str | None = None

    @property
    def column(self) -> str:
        return ",".join(self.columns)


# ---- offending rows, one check at a time ----------------------------------

def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique_failures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values (non-NULL) that occur more than once, with their count."""
    cols = list(columns)
    nn = None
    for c in cols:
        cond = F.col(c).isNotNull()
        nn = cond if nn is None else nn & cond
    g = df.filter(nn).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
    return g.filter(F.col("n_records") > F.lit(1))


def unique_combination_failures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key tuples that occur more than once (NULLs form their own group)."""
    g = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
    return g.filter(F.col("n_records") > F.lit(1))


def _range_bad(c: Column, lo, hi) -> Column:
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (c < F.lit(lo))
    if hi is not None:
        bad = bad | (c > F.lit(hi))
    return c.isNotNull() & bad


def accepted_range_failures(df: DataFrame, column: str, min_value=None, max_value=None) -> DataFrame:
    return df.filter(_range_bad(F.col(column), min_value, max_value))


def accepted_values_failures(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def relationships_failures(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-NULL child values without a parent row (anti-join)."""
    p = parent.select(F.col(parent_column).alias("__parent_key")).distinct()
    c = child.filter(F.col(column).isNotNull())
    return c.join(p, c[column] == p["__parent_key"], "left_anti")


# ---- suite ----------------------------------------------------------------

_ROW_TESTS = {"not_null", "accepted_range", "accepted_values"}


def _row_condition(chk: Check) -> Column:
    c = F.col(chk.columns[0])
    if chk.test == "not_null":
        return c.isNull()
    if chk.test == "accepted_range":
        return _range_bad(c, chk.min_value, chk.max_value)
    return c.isNotNull() & ~c.isin(*chk.values)


def run_checks(models: dict[str, DataFrame], checks: Sequence[Check],
               numbers: Sequence[int] | None = None) -> DataFrame:
    """(check_no, test, model, column, failures) for every check.

    ``numbers`` gives each check its number (default: position in ``checks``).
    """
    numbered = list(zip(numbers if numbers is not None else range(len(checks)), checks))
    parts = []
    by_model: dict[str, list[tuple[int, Check]]] = {}
    for i, chk in numbered:
        if chk.test in _ROW_TESTS:
            by_model.setdefault(chk.model, []).append((i, chk))
    # one pass per table for all row-level checks
    for model, items in by_model.items():
        aggs = [F.sum(F.when(_row_condition(chk), F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias(f"c{i}")
                for i, chk in items]
        row = models[model].agg(*aggs)
        stacked = F.explode(F.array(*[
            F.struct(F.lit(i).alias("i"), F.lit(chk.test).alias("test"), F.lit(chk.model).alias("model"),
                     F.lit(chk.column).alias("column"), F.coalesce(F.col(f"c{i}"), F.lit(0)).alias("failures"))
            for i, chk in items]))
        parts.append(row.select(stacked.alias("r")).select("r.*"))
    for i, chk in numbered:
        if chk.test in _ROW_TESTS:
            continue
        df = models[chk.model]
        if chk.test == "unique":
            bad = unique_failures(df, chk.columns).agg(F.count(F.lit(1)).alias("f"))
        elif chk.test == "unique_combination":
            bad = unique_combination_failures(df, chk.columns).agg(F.count(F.lit(1)).alias("f"))
        elif chk.test == "relationships":
            bad = relationships_failures(df, chk.columns[0], models[chk.to_model], chk.to_column) \
                .agg(F.count(F.lit(1)).alias("f"))
        else:
            raise ValueError(f"unknown test {chk.test}")
        parts.append(bad.select(F.lit(i).alias("i"), F.lit(chk.test).alias("test"), F.lit(chk.model).alias("model"),
                                F.lit(chk.column).alias("column"), F.col("f").cast("bigint").alias("failures")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.col("i").cast("bigint").alias("check_no"), "test", "model", "column", "failures")


def assert_clean(results: DataFrame) -> None:
    """Raise if any check failed (collects only the failing summary rows)."""
    bad = results.filter(F.col("failures") > F.lit(0)).collect()
    if bad:
        raise AssertionError("data-quality failures: " + "; ".join(
            f"{r['test']}({r['model']}.{r['column']})={r['failures']}" for r in bad))


# The declared tests of the model graph (60 in total).
def declared_checks() -> list[Check]:
    C = Check
    return [
        C("unique_combination", "positions", ("vehicle_number", "vehicle_time")),
        C("not_null", "positions", ("vehicle_number",)),
        C("not_null", "positions", ("lat",)),
        C("accepted_range", "positions", ("lat",), min_value=51.9, max_value=52.5),
        C("not_null", "positions", ("lon",)),
        C("accepted_range", "positions", ("lon",), min_value=20.7, max_value=21.3),
        C("accepted_values", "positions", ("vehicle_type",), values=(1, 2)),
        C("not_null", "stops", ("stop_id",)),
        C("unique", "stops", ("stop_id",)),
        C("not_null", "stops", ("stop_lat",)),
        C("accepted_range", "stops", ("stop_lat",), min_value=51.5, max_value=53.0),
        C("not_null", "routes", ("route_id",)),
        C("unique", "routes", ("route_id",)),
        C("not_null", "routes", ("line",)),
        C("not_null", "trips", ("trip_id",)),
        C("unique", "trips", ("trip_id",)),
        C("relationships", "trips", ("route_id",), to_model="routes", to_column="route_id"),
        C("unique_combination", "stop_times", ("trip_id", "stop_sequence")),
        C("not_null", "stop_times", ("trip_id",)),
        C("relationships", "stop_times", ("trip_id",), to_model="trips", to_column="trip_id"),
        C("relationships", "stop_times", ("stop_id",), to_model="stops", to_column="stop_id"),
        C("not_null", "stop_times", ("scheduled_arrival",)),
        C("not_null", "calendar", ("date_day",)),
        C("unique", "calendar", ("date_day",)),
        C("accepted_range", "calendar", ("day_of_week",), min_value=0, max_value=6),
        C("not_null", "moves", ("speed_kmh",)),
        C("accepted_range", "moves", ("speed_kmh",), min_value=0, max_value=100),
        C("accepted_range", "moves", ("seconds_diff",), min_value=1, max_value=600),
        C("not_null", "matches", ("delay_seconds",)),
        C("accepted_range", "matches", ("delay_seconds",), min_value=-900, max_value=900),
        C("not_null", "matches", ("meters_to_stop",)),
        C("accepted_range", "matches", ("meters_to_stop",), min_value=0, max_value=100),
        C("relationships", "matches", ("stop_id",), to_model="stops", to_column="stop_id"),
        C("not_null", "headway", ("headway_minutes",)),
        C("accepted_range", "headway", ("headway_minutes",), min_value=0.1, max_value=120),
        C("not_null", "line_speed", ("line",)),
        C("unique", "line_speed", ("line",)),
        C("not_null", "line_speed", ("avg_speed_kmh",)),
        C("accepted_range", "line_speed", ("avg_speed_kmh",), min_value=0, max_value=100),
        C("not_null", "line_punctuality", ("line",)),
        C("unique", "line_punctuality", ("line",)),
        C("not_null", "line_punctuality", ("avg_delay_min",)),
        C("accepted_range", "line_punctuality", ("pct_on_time",), min_value=0, max_value=100),
        C("not_null", "line_regularity", ("line",)),
        C("unique", "line_regularity", ("line",)),
        C("not_null", "line_regularity", ("irregularity_index",)),
        C("accepted_range", "line_regularity", ("irregularity_index",), min_value=0, max_value=5),
        C("accepted_range", "line_regularity", ("pct_bunched",), min_value=0, max_value=100),
        C("not_null", "punctuality_by_hour", ("hour_of_day",)),
        C("unique", "punctuality_by_hour", ("hour_of_day",)),
        C("accepted_range", "punctuality_by_hour", ("hour_of_day",), min_value=0, max_value=23),
        C("unique_combination", "speed_by_hour", ("line", "hour_of_day")),
        C("not_null", "worst_stops", ("stop_id",)),
        C("unique", "worst_stops", ("stop_id",)),
        C("not_null", "segments", ("actual_minutes",)),
        C("accepted_range", "segments", ("actual_minutes",), min_value=0.2, max_value=30),
        C("accepted_range", "segments", ("scheduled_minutes",), min_value=0.2, max_value=30),
        C("unique_combination", "slowest_segments", ("line", "from_stop", "to_stop")),
        C("not_null", "slowest_segments", ("avg_lost_min",)),
        C("accepted_range", "slowest_segments", ("observations",), min_value=5),
    ]
