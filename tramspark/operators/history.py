"""Dimension history: SCD type-2 snapshots (A11, A12) and as-of lookups.

``snapshot`` follows the "check" strategy: a key whose watched columns
changed (NULL-safe) gets its open version closed at ``ts`` and a new version
opened; new keys open a version; unchanged keys and keys that vanished from
the feed stay as they are (no hard deletes).  Running it twice with the same
input adds nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramspark.operators.windows import _B, DAY, bucket_of
from tramspark.session import shared_dir

VALID_FROM = "valid_from"
VALID_TO = "valid_to"


def _ts(ts):
    return F.lit(ts).cast("timestamp_ntz")


def snapshot(current: DataFrame, previous: DataFrame | None, key: str, check_cols: Sequence[str],
             ts: str) -> DataFrame:
    """Next state of the history table after observing ``current`` at ``ts``."""
    cols = current.columns
    if previous is None:
        return current.select(*cols, _ts(ts).alias(VALID_FROM), F.lit(None).cast("timestamp_ntz").alias(VALID_TO))
    closed = previous.filter(F.col(VALID_TO).isNotNull())
    open_ = previous.filter(F.col(VALID_TO).isNull())
    cur = current.select(*[F.col(c).alias(f"__n_{c}") for c in cols])
    j = open_.join(cur, open_[key] == cur[f"__n_{key}"], "full_outer")
    same = None
    for c in check_cols:
        eq = F.col(c).eqNullSafe(F.col(f"__n_{c}"))
        same = eq if same is None else same & eq
    has_old = F.col(key).isNotNull()
    has_new = F.col(f"__n_{key}").isNotNull()
    changed = has_old & has_new & ~same
    # one pass over the join: each row gives its old version (closed if it
    # changed; vanished keys stay) and, if new or changed, its new version
    old = F.struct(*[F.col(c).alias(c) for c in cols], F.col(VALID_FROM).alias(VALID_FROM),
                   F.when(changed, _ts(ts)).otherwise(F.col(VALID_TO)).alias(VALID_TO))
    new = F.struct(*[F.col(f"__n_{c}").alias(c) for c in cols], _ts(ts).alias(VALID_FROM),
                   F.lit(None).cast("timestamp_ntz").alias(VALID_TO))
    versions = F.array_compact(F.array(F.when(has_old, old), F.when(has_new & (~has_old | changed), new)))
    return closed.unionByName(j.select(F.explode(versions).alias("v")).select("v.*"))


def asof_lookup(facts: DataFrame, history: DataFrame, key: str, fact_ts: str,
                attrs: Sequence[str], prefix: str = "", bucket_seconds: int = DAY) -> DataFrame:
    """Attach the dimension version valid at each fact's time (the versions of a key do not overlap).

    Facts and versions are sorted together once: within each (key, bucket of
    time) the last version before a fact is carried to it, and the version that
    a bucket begins with comes from a table with one row per key and bucket,
    over which the last version of the buckets before is carried.  So a fact is
    one row however many versions its key has, and a key's history is spread
    over its buckets.  Facts without key or time have no version.
    """
    spark, path = facts.sparkSession, shared_dir(facts.sparkSession, "as-of")
    version = F.struct(F.col(VALID_TO).alias("until"), *[F.col(a).alias(f"a{i}") for i, a in enumerate(attrs)])
    # key and time travel once, unless the union would change their types
    own = {c: k for c, k in ((key, "k"), (fact_ts, "t")) if facts.schema[c].dataType == history.schema[key if k == "k" else VALID_FROM].dataType}
    fact = F.struct(F.lit(True).alias("__is"), *[F.col(f"`{c}`") for c in facts.columns if c not in own])
    placed = F.col(key).isNotNull() & F.col(fact_ts).isNotNull()
    v = history.filter(F.col(key).isNotNull() & F.col(VALID_FROM).isNotNull()).select(
        F.col(key).alias("k"), F.col(VALID_FROM).alias("t"), F.lit(0).alias("kind"), version.alias("version"))
    f = facts.select(F.col(key).alias("k"), F.col(fact_ts).alias("t"), F.lit(1).alias("kind"), fact.alias("fact"), placed.alias("placed"))
    events = v.unionByName(f.filter("placed").drop("placed"), allowMissingColumns=True).withColumn(_B, bucket_of("t", bucket_seconds))
    events.write.parquet(path)      # read by both branches
    events = spark.read.schema(events.schema).parquet(path)
    before = Window.partitionBy("k", _B).orderBy("t", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = events.withColumn("found", F.last("version", ignorenulls=True).over(before)).filter("kind = 1").select("k", _B, "t", "fact", "found")
    latest = events.groupBy("k", _B).agg(F.max_by("version", F.when(F.col("kind") == 0, F.col("t"))).alias("last"))
    earlier = Window.partitionBy("k").orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    carry = latest.select("k", _B, F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    joined = inside.join(carry, ["k", _B]).withColumn("found", F.coalesce("found", "carried"))
    valid = F.col("found.until").isNull() | (F.col("t") < F.col("found.until"))
    names = [f"{prefix}{a}" for a in attrs]
    out = joined.select(*[F.col(own[c]).alias(c) if c in own else F.col(f"fact.`{c}`") for c in facts.columns], *[F.when(valid, F.col(f"found.a{i}")).alias(n) for i, n in enumerate(names)])
    loose = facts.filter(~placed).select("*", *[F.lit(None).cast(history.schema[a].dataType).alias(n) for a, n in zip(attrs, names, strict=True)])
    return out.unionByName(loose)
