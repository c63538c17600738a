"""Incremental loading: high-water marks and keyed upserts.

The target of an upsert is a date-partitioned table in a store
(``sources.store``): only the date partitions the batch touches are written,
beside the old ones, and become visible by switching one pointer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramspark.operators.staging import dedup_first
from tramspark.session import remove_path, shared_dir
from tramspark.sources.store import Store

EPOCH = "1970-01-01 00:00:00"


def high_water_mark(target: DataFrame | None, column: str) -> DataFrame:
    """One row, one column ``hwm``: max(column) of the target, or the epoch."""
    if target is None:
        raise ValueError("target is required; pass full_refresh to skip pruning")
    return target.agg(F.coalesce(F.max(column), F.lit(EPOCH).cast("timestamp_ntz")).alias("hwm"))


def newer_than_target(source: DataFrame, target: DataFrame | None, column: str,
                      target_column: str | None = None, full_refresh: bool = False) -> DataFrame:
    """Rows of ``source`` strictly above the target's high-water mark.

    The mark is a 1-row aggregate used as a scalar subquery.  ``target`` can
    be the table itself (one-column scan) or its load log (see
    ``append_load_log``), which answers the same question from one row per
    load instead of a scan of the whole table.
    """
    if full_refresh or target is None:
        return source
    hwm = high_water_mark(target, target_column or column).scalar()
    return source.filter(F.col(column) > hwm)


def append_load_log(loaded: DataFrame, log_path: str, column: str, load_id: str) -> None:
    """Record one row per load: its id, row count and max(``column``).

    The max over the log equals the max over everything loaded, so the next
    run's high-water mark reads a handful of rows.
    """
    (loaded.agg(F.lit(load_id).alias("load_id"), F.count(F.lit(1)).alias("rows"), F.max(column).alias(column))
     .coalesce(1).write.mode("append").parquet(log_path))


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None,
           partition_col: str | None = None, strategy: str = "first_wins") -> DataFrame:
    """Merge ``batch`` into ``target`` on ``keys``.

    * ``first_wins``: per key keep the first row by ``order`` across target and
      batch (the same rule as the in-batch de-duplication, so loading in
      slices equals loading at once).
    * ``delete_insert``: target rows whose key is in the batch are replaced by
      the batch rows (the batch wins).

    With ``partition_col`` only target rows in partitions the batch touches
    take part in the merge; untouched partitions pass through unchanged.
    """
    keys = list(keys)
    if partition_col:
        touched = batch.select(partition_col).distinct()
        t_in = target.join(touched, partition_col, "left_semi")
        t_out = target.join(touched, partition_col, "left_anti")
    else:
        t_in, t_out = target, None
    if strategy == "first_wins":
        merged = dedup_first(t_in.unionByName(batch), keys, order or ())
    elif strategy == "delete_insert":
        merged = t_in.join(batch.select(*keys).distinct(), keys, "left_anti").unionByName(batch)
    else:
        raise ValueError(strategy)
    return merged if t_out is None else t_out.unionByName(merged)


ROWS = "rows"       # the one table of an upserted store


def read_upserted(spark, path: str) -> DataFrame:
    """The table kept by :func:`write_upsert` at ``path``, as last committed."""
    return Store(spark, path).read(ROWS)


def write_upsert(spark, path: str, batch: DataFrame, keys: Sequence[str], order: Sequence[str],
                 partition_col: str, strategy: str = "first_wins") -> DataFrame:
    """Apply ``upsert`` to the store at ``path`` (created if missing).

    The batch is computed once, into the shared checkpoint folder.  Only the
    partitions it touches are read and written, beside the old ones; then one
    pointer is switched, so a reader or a failed run never sees half a table.
    Re-applying the same batch (a replay after a failure) gives the same table.
    A NULL partition value is an error.  Returns the table as read after the
    write; the version before stays readable until the next one.
    """
    staged = shared_dir(spark, "upsert-batch")
    batch.write.parquet(staged)
    batch = spark.read.schema(batch.schema).parquet(staged)
    # as many values as touched partitions (days)
    touched = [r[0] for r in batch.select(partition_col).distinct().collect()]
    if None in touched:
        raise ValueError(f"rows of the batch have no {partition_col}")
    store = Store(spark, path)
    load = store.begin()
    if not load.has(ROWS):
        load.put(ROWS, dedup_first(batch, keys, order) if strategy == "first_wins" else batch, partition_col)
    elif touched:
        target = load.read(ROWS)
        t_in = target.filter(F.col(partition_col).isin(touched))
        load.put(ROWS, upsert(t_in, batch.select(*target.columns), keys, order, None, strategy), partition_col, touched)
    load.commit()
    store.vacuum(2)
    remove_path(spark, staged)
    return store.read(ROWS)
