"""Ordered look-back ("previous row") that survives hot keys.

``F.lag(c).over(Window.partitionBy(key).orderBy(t))`` sends every row of a
key to one task.  One vehicle, stop or line can hold a large share of all
rows, so the history of a key is cut into time buckets.  Every model ignores
a predecessor that lies further back than a known limit, so a row within the
limit of its bucket's end is repeated into the buckets that the limit reaches;
``lag`` then runs inside ``(key, bucket)`` and the repeated rows are dropped.
That is one scan, one shuffle and no join.

A predecessor further back than the limit may or may not be seen (it is if it
lies in the same bucket); callers must treat both cases alike.  The result
equals the plain window up to the limit whenever the ordering is total within
a key; callers pass tie-break columns to make it so.  Partition keys and the
first ordering column must be non-NULL (callers filter them or derive them
from non-NULL join keys and times).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramspark.session import shared_dir

DAY = 86_400
_B = "__bucket"
_HALO = "__halo"
OLD, KIND = "__old", "__kind"
_ROW, _OLD_ROW, _MARK = 0, 1, 2
DAY_OF, PLACE = "__day", "__place"
PLACES = 16         # places a day's rows are dealt to: files and tasks a day at most


def deal_by_day(df: DataFrame, day: Column, keys: Sequence[str | Column]) -> DataFrame:
    """``df`` shuffled by its day and one of ``PLACES`` hashes of ``keys`` (columns ``DAY_OF``, ``PLACE``).

    Grouped or windowed by these and the keys, it is not shuffled again, and as a
    task holds few days the result can be written by date without another shuffle.
    """
    place = F.pmod(F.xxhash64(*keys), F.lit(PLACES))
    # the two columns follow from the others, so they are not shuffled themselves
    return df.repartition(day, place).withColumns({DAY_OF: day, PLACE: place})


def window_lag(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, str]) -> DataFrame:
    """The plain window, for keys whose size is bounded by construction (``values``: output name -> source column)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.select("*", *[F.lag(src).over(w).alias(out) for out, src in values.items()])


def bucket_of(time: str, bucket_seconds: int = DAY) -> Column:
    """Number of the piece of history a row lies in."""
    return F.floor(F.unix_timestamp(F.col(time)) / F.lit(int(bucket_seconds)))


def touched_buckets(changes: DataFrame, keys: Sequence[str], time: str, limit_seconds: int, bucket_seconds: int = DAY) -> DataFrame:
    """(keys, bucket) of every piece of history in which a changed row is a row or a possible predecessor.

    A row that came, went or changed can alter its own result and that of rows up
    to ``limit_seconds`` later, so the pieces that this reaches are touched.
    """
    last = F.floor((F.unix_timestamp(F.col(time)) + F.lit(int(limit_seconds))) / F.lit(int(bucket_seconds)))
    return changes.select(*keys, F.explode(F.sequence(bucket_of(time, bucket_seconds), last)).alias(_B)).distinct()


def touched_days(touched: DataFrame, bucket_seconds: int = DAY) -> DataFrame:
    """Calendar days of the touched pieces, one row a day (buckets are hours or days)."""
    day = F.date_from_unix_date((F.floor(F.col(_B) * F.lit(int(bucket_seconds)) / F.lit(DAY))).cast("int"))
    return touched.select(day.alias("day")).distinct()


def _in_buckets(rows, touched, keys, time, bucket_seconds, how) -> DataFrame:
    return (rows.withColumn(_B, bucket_of(time, bucket_seconds))
            .join(touched.select(*keys, _B), [*keys, _B], how).select(*rows.columns))


def outside_buckets(rows: DataFrame, touched: DataFrame, keys: Sequence[str], time: str, bucket_seconds: int = DAY) -> DataFrame:
    """``rows`` that lie in none of the touched pieces."""
    return _in_buckets(rows, touched, keys, time, bucket_seconds, "left_anti")


def inside_buckets(rows: DataFrame, touched: DataFrame, keys: Sequence[str], time: str, bucket_seconds: int = DAY) -> DataFrame:
    """``rows`` that lie in a touched piece."""
    return _in_buckets(rows, touched, keys, time, bucket_seconds, "left_semi")


def ordered_lag(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, str],
                limit_seconds: int, bucket_seconds: int = DAY, only: DataFrame | None = None) -> DataFrame:
    """Add ``values`` columns holding the previous row's values within ``keys``.

    ``values`` maps an output name to the source column.  ``order`` must be
    ascending and total within a key; its first column is the time that cuts
    the buckets.  Predecessors up to ``limit_seconds`` back (inclusive) are
    always found.  With ``only`` (see :func:`touched_buckets`) just the rows of these
    pieces of history come out, the repeated rows before each piece being read;
    else the rows come out dealt by the day of that time (see :func:`deal_by_day`).
    """
    seconds = F.unix_timestamp(F.col(order[0]))
    width = F.lit(int(bucket_seconds))
    own = F.floor(seconds / width)
    reach = F.floor((seconds + F.lit(int(limit_seconds))) / width)
    dealt = (df.select("*", own.alias("__own"), F.explode(F.sequence(own, reach)).alias(_B))
             .withColumn(_HALO, F.col(_B) > F.col("__own")).drop("__own"))
    if only is not None:
        dealt = dealt.join(only.select(*keys, _B), [*keys, _B], "left_semi")
        w = Window.partitionBy(*keys, _B).orderBy(*order)
    else:
        dealt = deal_by_day(dealt, F.floor(F.col(_B) * width / F.lit(DAY)), [*keys, _B])
        w = Window.partitionBy(DAY_OF, PLACE, *keys, _B).orderBy(*order)
    lagged = dealt.select("*", *[F.lag(src).over(w).alias(out) for out, src in values.items()])
    keep = [c for c in df.columns if c not in values]
    return lagged.filter(~F.col(_HALO)).select(*keep, *values)


def reached_days(changes: DataFrame, time: str, limit_seconds: int, bucket_seconds: int = DAY) -> DataFrame:
    """Calendar days (column ``day``) of the pieces that changed rows touch, as :func:`touched_days` of :func:`touched_buckets`."""
    last = F.floor((F.unix_timestamp(F.col(time)) + F.lit(int(limit_seconds))) / F.lit(int(bucket_seconds)))
    pieces = changes.select(F.explode(F.sequence(bucket_of(time, bucket_seconds), last)).alias(_B)).distinct()
    return touched_days(pieces, bucket_seconds)


def piece_columns(keys: Sequence[str]) -> list[str]:
    """The columns that name a piece of history after :func:`touched_lag`."""
    return [DAY_OF, PLACE, *keys, _B]


def touched_lag(rows: DataFrame, changed: Column, old: DataFrame, keys: Sequence[str], time: str, old_time: str,
                values: dict[str, str], limit_seconds: int, bucket_seconds: int = DAY, order: Sequence[str] = (),
                within: str | None = None, gone: DataFrame | None = None) -> DataFrame:
    """What a load needs of the pieces of history it touches and of the others, in one shuffle.

    ``rows`` are a model's input, ``changed`` those that came or changed, ``gone`` (keys, time) those that left, ``old``
    the model's rows before.  A piece is touched if a changed row is one of its rows or of those repeated into it
    (as in :func:`touched_buckets`), which is seen where the piece's rows meet: no join, no list of pieces.
    Out come, dealt by day (see :func:`deal_by_day`), the input rows of touched pieces with the previous row's
    ``values`` in the order of ``time`` (``order``; with ``within`` the previous row of the same value there), and the old
    rows of the others: their ``KIND`` (:func:`kept_rows`) and ``OLD`` columns, to be given back by :func:`with_old`.
    Repeated rows come out as well (:func:`repeated_rows`).  A piece without a key is never touched.
    """
    keys, width = list(keys), F.lit(int(bucket_seconds))
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])

    def pieces(df, at, reach):
        seconds = F.unix_timestamp(F.col(at))
        return F.sequence(F.floor(seconds / width), F.floor((seconds + F.lit(int(reach))) / width))

    dealt = (rows.select("*", (changed & whole).alias("__changed"), F.lit(_ROW).alias(KIND), bucket_of(time, bucket_seconds).alias("__own"),
                         F.explode(pieces(rows, time, limit_seconds)).alias(_B))
             .withColumn(_HALO, F.col(_B) > F.col("__own")).drop("__own"))
    others = [old.select(*keys, F.struct(*[c for c in old.columns if c not in keys]).alias(OLD), F.lit(False).alias("__changed"),
                         F.lit(_OLD_ROW).alias(KIND), bucket_of(old_time, bucket_seconds).alias(_B), F.lit(False).alias(_HALO))]
    if gone is not None:
        others.append(gone.select(*keys, whole.alias("__changed"), F.lit(_MARK).alias(KIND), F.explode(pieces(gone, time, limit_seconds)).alias(_B),
                                  F.lit(True).alias(_HALO)))
    for other in others:
        dealt = dealt.unionByName(other, allowMissingColumns=True)
    dealt = deal_by_day(dealt, F.floor(F.col(_B) * width / F.lit(DAY)), [*keys, _B])
    # the rows come first, so that their predecessors are rows; one sort serves the look-back and the piece's mark
    order = [KIND, *([within] if within else []), *(order or [time])]
    w = Window.partitionBy(*piece_columns(keys)).orderBy(*order)
    same = F.lag(within).over(w).eqNullSafe(F.col(within)) if within else F.lit(True)
    lagged = dealt.select("*", *[F.when(same, F.lag(src).over(w)).alias(out) for out, src in values.items()],
                          F.max("__changed").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("__touched"))
    row, touched = F.col(KIND) == F.lit(_ROW), F.col("__touched")
    return lagged.filter((row & touched) | (kept_rows() & ~touched)).drop("__changed", "__touched")


def kept_rows() -> Column:
    """Whether a row of :func:`touched_lag` is an old row that stays."""
    return F.col(KIND) == F.lit(_OLD_ROW)


def repeated_rows() -> Column:
    """Whether a row of :func:`touched_lag` is repeated from an earlier piece."""
    return F.col(_HALO)


def with_old(out: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The columns of ``old``, of the kept rows as they were, of the others from ``out``."""
    return out.select(*[F.col(c) if c in keys else F.when(kept_rows(), F.col(f"{OLD}.`{c}`")).otherwise(F.col(c)).alias(c) for c in old.columns])


def not_marked(old: DataFrame, marks: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """``old`` without the rows whose (keys, time) are in ``marks``, dealt by day: an anti-join whose rows are shuffled once,
    not once more to be laid by date.  A row without a key stays."""
    both = (old.withColumn("__mark", F.lit(False))
            .unionByName(marks.select(*keys, time, F.lit(True).alias("__mark")), allowMissingColumns=True))
    dealt = deal_by_day(both, F.to_date(time), [*keys, F.hour(time)])
    marked = F.max("__mark").over(Window.partitionBy(DAY_OF, PLACE, *keys, time))
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return dealt.withColumn("__marked", marked & whole).filter(~F.col("__mark") & ~F.col("__marked")).select(*old.columns)


def ordered_running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str,
                        bucket_seconds: int = DAY) -> DataFrame:
    """Running sum of ``value`` within ``keys`` in ``order`` (current row included).

    A running sum inside (key, bucket); per-bucket totals pre-aggregated
    map-side; a prefix sum over the *earlier* buckets of each key on that
    small table; the two added after a join on (key, bucket).  Both branches
    read one table written to the shared folder, so ``df`` is computed once.
    ``order`` must be total within a key (so the default RANGE frame and a
    ROWS frame agree).
    """
    keys, order = list(keys), list(order)
    spark = df.sparkSession
    path = shared_dir(spark, "running-sum")
    dealt = df.withColumn(_B, F.floor(F.unix_timestamp(F.col(order[0])) / F.lit(int(bucket_seconds))))
    dealt.write.parquet(path)
    dealt = spark.read.schema(dealt.schema).parquet(path)
    w = (Window.partitionBy(*keys, _B).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = dealt.withColumn("__inner_sum", F.sum(value).over(w))
    totals = dealt.groupBy(*keys, _B).agg(F.sum(value).alias("__bucket_sum"))
    wk = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*keys, _B, F.coalesce(F.sum("__bucket_sum").over(wk), F.lit(0)).alias("__carry"))
    joined = inner.join(carry, on=[*keys, _B], how="left")
    res = (F.col("__inner_sum") + F.coalesce(F.col("__carry"), F.lit(0))).alias(out)
    return joined.select(*[c for c in df.columns], res)
