"""Rendezvous sharding of stable record keys over weighted shards.

Every shard scores every key, ``-weight / ln(u(key, shard))`` with u in (0, 1)
taken from a hash of both, and the highest score wins.  A score depends on the
key and one shard alone, so a further shard takes over only the rows it wins
itself, and no row moves between old shards.

Rules: a null key is a key of its own; a null text has no bytes; repeated rows
share a shard and get slots of their own; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramspark.llm import common

# Rows of one shard that are ordered together; a shard has as many blocks as it needs.
BLOCK_ROWS = 2000


def score(key: Column, shard: int, weight: float) -> Column:
    """Score of a shard for a key: 52 hash bits give u, exact as a double and never 0 or 1."""
    digest = F.md5(F.concat_ws("|", F.coalesce(key.cast("string"), F.lit("null")), F.lit(str(shard))))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double")
    return F.lit(-float(weight)) / F.log((bits + 0.5) / F.lit(float(2 ** 52)))


def assign(df: DataFrame, key: str, weights: Sequence[float], out: str = "shard", grown: str | None = None,
           grown_weight: float = 1.0) -> DataFrame:
    """``df`` with its shard (0-based) and, if ``grown`` names a column, the shard with one more shard."""
    scores = common.fresh("__scores", df.columns)
    n = len(weights)
    every = [score(F.col(key), i, w) for i, w in enumerate([*weights, *([grown_weight] if grown else [])])]
    scored = df.withColumn(scores, F.array(*every))
    at = [F.col(scores)[i] for i in range(len(every))]
    best = F.array_max(F.slice(F.col(scores), 1, n))
    scored = scored.withColumn(out, (F.array_position(F.slice(F.col(scores), 1, n), best) - 1).cast("int"))
    if grown:
        scored = scored.withColumn(grown, F.when(at[n] > best, F.lit(n)).otherwise(F.col(out)).cast("int"))
    return scored.drop(scores)


def slots(rows: DataFrame, shard: str, order: Sequence[str], out: str = "slot") -> DataFrame:
    """Gapless 0-based slots in each shard without putting a shard into one task.

    Rows are dealt into blocks by a hash of the ``order`` columns; a block's
    first slot is the number of rows in the shard's earlier blocks.  ``rows``
    must be a written table: it is read twice.
    """
    total = rows.count()
    shards = rows.agg(F.max(shard).alias("m")).first()["m"]
    blocks = max(8, -(-total // (BLOCK_ROWS * (int(shards or 0) + 1))))
    block, before = common.fresh("__block", rows.columns), common.fresh("__before", rows.columns)
    digest = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in order]))
    dealt = rows.withColumn(block, F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(blocks)).cast("int"))
    counts = dealt.groupBy(shard, block).agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(shard).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(shard, block, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias(before))
    inside = Window.partitionBy(shard, block).orderBy(*order)
    return (dealt.withColumn(out, F.row_number().over(inside)).join(firsts, [shard, block])
            .withColumn(out, (F.col(out) - 1 + F.col(before)).cast("long")).drop(block, before))


def shard_documents(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
                    weights: Sequence[float] | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row; ``grown_shard`` is with one more shard of weight 1."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = common.stored(assign(rows, "doc_id", list(weights or [1.0] * n_shards), "shard", "grown_shard"), "shards")
    out = slots(rows, "shard", ["doc_id", "text_crc32", "size"])
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
