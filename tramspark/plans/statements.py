"""Ad-hoc statements over the models, as a dashboard sends them (A15): read-only and cached.

A statement runs as a subquery, so whatever is no query (INSERT, DROP, SET, a
second statement) is refused when it is parsed, before anything runs.  Results
are kept for ``ttl`` seconds by the analysed plan and the snapshot of the store
they were read from: the same question in other words of spacing or case starts
no job, and a new load is seen at once.
"""

from __future__ import annotations

import time
from collections.abc import Callable

import pyarrow as pa
from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession

from tramspark.plans.incremental import tables
from tramspark.plans.pipeline import FIXTURE_PARAMS, Params
from tramspark.sources.store import Store

TTL_SECONDS = 60.0
MAX_ROWS = 10_000       # a dashboard's answer; a larger one is an error, not cut


class NotReadOnly(ValueError):
    """The statement is no query."""


class Statements:
    """Statements over the newest snapshot of a store; each instance has a session of its own for the models' names."""

    def __init__(self, store: Store, timetable: dict[str, DataFrame], params: Params = FIXTURE_PARAMS, ttl: float = TTL_SECONDS,
                 max_rows: int = MAX_ROWS, clock: Callable[[], float] = time.monotonic):
        self.store, self.timetable, self.params = store, timetable, params
        self.ttl, self.max_rows, self.clock = ttl, max_rows, clock
        self.session: SparkSession = store.spark.newSession()
        self.session.conf.set("spark.sql.session.timeZone", "UTC")
        self.version = None
        self.kept: dict[tuple[int, int], tuple[float, DataFrame, pa.Table]] = {}

    def _refresh(self) -> None:
        newest = max(self.store.versions(), default=0)
        if newest != self.version:
            store = Store(self.session, self.store.base)
            for name, df in tables(store, self.timetable, self.params).items():
                if df.sparkSession is not self.session:     # a view over a feed belongs to its own session
                    continue
                df.createOrReplaceTempView(name)
            self.version, self.kept = newest, {}

    def run(self, sql: str) -> pa.Table:
        """The statement's rows."""
        self._refresh()
        try:
            df = self.session.sql(f"SELECT * FROM (\n{sql.strip().rstrip(';')}\n) AS statement")
        except ParseException as e:
            raise NotReadOnly(f"not a query: {sql.strip()[:200]}") from e
        now, key = self.clock(), (df.semanticHash(), self.version)
        hit = self.kept.get(key)
        if hit and now - hit[0] < self.ttl and hit[1].sameSemantics(df):
            return hit[2]
        rows = df.limit(self.max_rows + 1).toArrow()
        if rows.num_rows > self.max_rows:
            raise ValueError(f"more than {self.max_rows} rows")
        self.kept = {k: v for k, v in self.kept.items() if now - v[0] < self.ttl}
        self.kept[key] = (now, df, rows)
        return rows
