"""Mixing sources to target weights by hierarchical budgets.

The token budget goes down a domain - language - source tree.  A node's
children share its budget by their weights; a child that cannot use its share
(it has too few tokens for the allowed epochs) is filled up, and what it lacks
goes to its siblings first.  Only what no sibling can take goes to the
siblings of the parent, since a parent never gets more than its whole subtree
can use.  A leaf with budget T over L tokens is read floor(T / L) times in
full; the rest is a prefix, by tokens, of the next epoch's seeded order.

All of it is DataFrame work: windows over the (small) tree, and for the leaf's
prefix sums over hash ranges first, so that only one range of each leaf is
ordered row by row.

Rules: null keys form a node ``(none)``; a null text has no tokens; the prefix
goes on until the budget is reached, so its last row may exceed it; rows with
the same place in the order (one id) follow each other by their row's number,
and rows without an id have places by that number; a leaf without tokens or
budget gives no rows; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramspark.llm import common

WORDS = r"[^\x20\x09-\x0D]+"
LEVELS = ("domain", "lang", "source")
MIN_RANGES = 8          # hash ranges of the order; as many as the square root of the rows, if that is more


def place(seed: int, epoch: Column, key: Column) -> Column:
    """Seeded place of a key in an epoch's order: a whole number below 2**52."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def share_out(nodes: DataFrame, parent: list[str], budget: str, order: list[str], out: str) -> DataFrame:
    """``nodes`` (cap, weight, the parent's ``budget``) with what each child gets.

    Children in the order of cap / weight are full up to a point; from there
    on, what is left is shared by weight.
    """
    w = Window.partitionBy(*parent).orderBy("__fill", *order)
    ranked = nodes.withColumn("__fill", F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(F.lit(float("inf"))))
    ranked = (ranked.withColumn("__used", F.coalesce(F.sum("cap").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
              .withColumn("__weights", F.sum("weight").over(w.rowsBetween(0, Window.unboundedFollowing)))
              .withColumn("__level", F.when(F.col("__weights") > 0, (F.col(budget) - F.col("__used")) / F.col("__weights")))
              .withColumn("__full", F.coalesce(F.col("__fill") <= F.col("__level"), F.lit(False))))
    level = F.max(F.when(~F.col("__full"), F.col("__level"))).over(Window.partitionBy(*parent))
    return (ranked.withColumn(out, F.when(F.col("__full"), F.col("cap"))
                              .otherwise(F.coalesce(F.greatest(level, F.lit(0.0)) * F.col("weight"), F.lit(0.0))))
            .drop("__fill", "__used", "__weights", "__level", "__full"))


def _weighted(df: DataFrame, keys: list[str], weights: Mapping[tuple[str, ...], float]) -> DataFrame:
    """Weight of each node: given by its path, else the square root of its tokens (flattens large sources)."""
    w = F.sqrt("tokens")
    for path, value in weights.items():
        if len(path) == len(keys):
            same = F.lit(True)
            for k, v in zip(keys, path, strict=True):
                same = same & (F.col(k) == v)
            w = F.when(same, F.lit(float(value))).otherwise(w)
    return df.withColumn("weight", w)


def budgets(leaves: DataFrame, max_epochs: int, budget_share: float, weights: Mapping[tuple[str, ...], float]) -> DataFrame:
    """Leaves (domain, lang, source, docs, tokens as doubles) with their budget in whole tokens."""
    nodes = leaves.withColumn("cap", F.col("tokens") * F.lit(float(max_epochs)))
    top = nodes.agg(F.least(F.floor(F.sum("tokens") * F.lit(budget_share)).cast("double"), F.sum("cap")).alias("b0"))
    got = None
    for depth in range(1, len(LEVELS) + 1):
        keys = list(LEVELS[:depth])
        level = nodes.groupBy(*keys).agg(F.sum("tokens").alias("tokens"), F.sum("cap").alias("cap"))
        level = _weighted(level, keys, weights)
        parent = keys[:-1]
        # the root's budget is one number
        level = level.withColumn("b0", top.scalar()) if got is None else level.join(got, parent)
        got = share_out(level, parent, f"b{depth - 1}", [keys[-1]], f"b{depth}").select(*keys, f"b{depth}")
    return (leaves.join(got, list(LEVELS)).withColumn("budget", F.floor(f"b{len(LEVELS)}").cast("long")).drop(f"b{len(LEVELS)}"))


def mix(docs: DataFrame, domain: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        source_col: str = "source", seed: int = 17, max_epochs: int = 4, budget_share: float = 1.0,
        weights: Mapping[tuple[str, ...], float] | None = None) -> DataFrame:
    """(uid, id, domain, lang, source, n_tokens, budget, epochs) of every row; ``epochs`` is how often it is taken."""
    none = F.lit("(none)")
    named = docs.withColumns({c: F.coalesce(x.cast("string"), none) for c, x in
                              ((common.fresh("__d", docs.columns), domain),)})
    rows = common.numbered(named.select(
        F.col(id_col).alias("id"), F.col(named.columns[-1]).alias("domain"), F.coalesce(F.col(lang_col), none).alias("lang"),
        F.coalesce(F.col(source_col), none).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORDS)), F.lit(0)).cast("long").alias("n_tokens")), "uid")
    rows = common.stored(rows, "mix-rows")
    leaf = list(LEVELS)
    leaves = common.stored(rows.groupBy(*leaf).agg(F.count("*").alias("docs"), F.sum("n_tokens").cast("double").alias("tokens")),
                           "mix-leaves")
    total = rows.count()
    # a leaf's ranges are summed up in one task and one range's rows are ordered in one: neither outgrows the root
    ranges = max(MIN_RANGES, math.isqrt(total))
    planned = budgets(leaves, max_epochs, budget_share, weights or {})
    full = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("long")
    planned = common.stored(planned.withColumn("full", full).withColumn(
        "rest", (F.col("budget") - F.col("full") * F.col("tokens")).cast("long")), "mix-budgets")
    facts = planned.select(*leaf, "docs", "budget", "full", "rest")
    placed = common.with_facts(rows, facts, leaf, "docs", F.col("uid")).withColumn(
        "place", place(seed, F.col("full"), F.coalesce(F.col("id").cast("string"), F.concat(F.lit("row "), F.col("uid").cast("string")))))
    placed = common.stored(placed.withColumn("range", F.floor(F.col("place") * F.lit(float(ranges)) / F.lit(float(2 ** 52))).cast("int")),
                           "mix-placed")
    # tokens of whole ranges first; the range in which the rest runs out is ordered row by row
    sums = placed.groupBy(*leaf, "range").agg(F.sum("n_tokens").alias("t"), F.first("rest").alias("rest"))
    upto = Window.partitionBy(*leaf).orderBy("range")
    cut = (sums.withColumn("upto", F.sum("t").over(upto)).withColumn("before", F.col("upto") - F.col("t"))
           .filter("upto >= rest").groupBy(*leaf).agg(F.min(F.struct("range", "before")).alias("c"))
           .select(*leaf, F.col("c.range").alias("cut"), F.col("c.before").alias("before")))
    cut = common.stored(planned.select(*leaf, "docs").join(cut, leaf, "left").withColumn("cut", F.coalesce("cut", F.lit(ranges))), "mix-cuts")
    at = common.with_facts(placed, cut, leaf, "docs", F.col("uid"))
    inside = Window.partitionBy(*leaf).orderBy("place", "uid").rowsBetween(Window.unboundedPreceding, -1)
    edge = (at.filter("range = cut").withColumn("earlier", F.col("before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .filter("earlier < rest").groupBy(*leaf).agg(F.max(F.struct("place", "uid")).alias("edge")))
    limits = common.stored(cut.join(edge, leaf, "left").select(*leaf, "docs", "cut", "edge"), "mix-limits")
    done = common.with_facts(placed.drop("docs"), limits, leaf, "docs", F.col("uid"))
    taken = (F.col("range") < F.col("cut")) | ((F.col("range") == F.col("cut")) & (F.struct("place", "uid") <= F.col("edge")))
    return done.select("uid", "id", *leaf, "n_tokens", "budget",
                       (F.col("full") + F.coalesce(taken, F.lit(False)).cast("long")).cast("int").alias("epochs"))


def domain_of(source: Column) -> Column:
    """The documents have no domain: four domains by a hash of the source stand for them."""
    return F.concat(F.lit("domain"), F.floor(F.conv(F.substring(F.md5(F.coalesce(source, F.lit(""))), 1, 1), 16, 10).cast("int") / 4)
                    .cast("string"))


def remix(docs: DataFrame, domain: Column, max_epochs: int = 2, **options) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, all columns kept."""
    docs = common.scanned(docs)
    uid, times = common.fresh("__uid", docs.columns), common.fresh("__epochs", docs.columns)
    taken = mix(docs, domain, max_epochs=max_epochs, **options).filter("epochs > 0").select(
        F.col("uid").alias(uid), F.col("epochs").alias(times))
    kept = common.numbered(docs, uid).join(common.stored(taken, "mix-taken").hint("shuffle_hash"), uid)
    at = common.fresh("__epoch", docs.columns)
    return kept.withColumn(at, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*[F.col(f"`{c}`") for c in docs.columns])
