"""Helpers shared by the operators: row ids, written tables, hot keys, components."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramspark.session import shared_dir

# A key that holds more than this share of all rows is split into salts; so
# there are never more than 1 / HOT_SHARE such keys, whatever the data.
HOT_SHARE = 1 / 1000
EMPTY_AUTHORITY = r"^([A-Za-z0-9+.-]+):///"
FILE_BITS = 40          # of a row id, for the place in a file


def session_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back (cuts lineage, survives lost executors)."""
    spark = session_of(df)
    path = shared_dir(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(name: str, taken: Sequence[str]) -> str:
    """``name``, lengthened until it clashes with none of ``taken`` (case-insensitively)."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


def scanned(df: DataFrame, name: str = "rows") -> DataFrame:
    """``df`` if its rows have a place in a Parquet file, else written once (then they have)."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias", "View"):
        node = node.children().head()
    if node.nodeName() == "LogicalRelation":
        try:
            df.select(df.metadataColumn("_metadata")["row_index"])
            return df
        except AnalysisException:       # not a Parquet table
            pass
    return stored(df, name)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a row id: number of the row's file (by sorted paths) and place in it.

    Two scans of one table give a row the same id however the files are split.
    Who numbers a frame twice passes it through :func:`scanned` first, so that
    both read the same files.
    """
    df = scanned(df)
    path, file, place = (fresh(c, [*df.columns, name]) for c in ("__path", "__file", "__place"))
    # of a local path, Spark's two lists write the empty authority differently
    paths = sorted(re.sub(EMPTY_AUTHORITY, r"\1:/", x) for x in df.inputFiles())
    files = session_of(df).createDataFrame(list(enumerate(paths)), f"{file} long, {path} string")
    meta = df.metadataColumn("_metadata")
    rows = df.select("*", F.regexp_replace(meta["file_path"], EMPTY_AUTHORITY, "$1:/").alias(path),
                     meta["row_index"].alias(place)).join(F.broadcast(files), path, "left")
    at = F.coalesce(F.col(file), F.raise_error(F.concat(F.lit("no number for the file "), F.col(path))).cast("long"))
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], (F.shiftleft(at, FILE_BITS) + F.col(place)).alias(name))


def hot_keys(counts: DataFrame, keys: Sequence[str], count: str, total: int, salts: str) -> DataFrame:
    """Keys above HOT_SHARE of ``total`` rows with their number of salts (at most 1 / HOT_SHARE rows)."""
    share = max(1.0, total * HOT_SHARE)
    return (counts.filter(F.col(count) > share)
            .select(*keys, F.ceil(F.col(count) / share).cast("int").alias(salts)))


def attach(rows: DataFrame, facts: DataFrame, keys: Sequence[str], hot: DataFrame, spread: Column,
           how: str = "inner") -> DataFrame:
    """Join ``facts`` (one row per key) to ``rows``, hot keys dealt over salts.

    ``hot`` comes from :func:`hot_keys` (column ``salts``): it is broadcast,
    its row count being bounded by 1 / HOT_SHARE.  ``spread`` is an expression
    over ``rows`` that varies within a key.  Keys must not be null.
    """
    keys = list(keys)
    salted = (rows.join(F.broadcast(hot), keys, "left")
              .withColumn("__salt", F.when(F.col("salts").isNull(), F.lit(0))
                          .otherwise(F.pmod(F.xxhash64(spread), F.col("salts")).cast("int")))
              .drop("salts"))
    repeated = (facts.join(F.broadcast(hot), keys, "left")
                .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
                .drop("salts"))
    return salted.join(repeated, [*keys, "__salt"], how).drop("__salt")


def without(docs: DataFrame, dropped: DataFrame, uid: str) -> DataFrame:
    """``docs`` (numbered by ``uid``) without the rows whose id is in ``dropped``; ids are unique, so no key is hot."""
    return docs.join(dropped.hint("shuffle_hash"), uid, "left_anti").drop(uid)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (u, v): rows (node, root), root being the smallest reachable node.

    Alternating large-star and small-star steps; every step's result is a
    written table, and hot centres are dealt over salts.  Nodes may be any
    orderable type without nulls.  Only nodes with an edge appear.
    """
    current = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                     .distinct(), "edges")
    if current.isEmpty():
        return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    mark = None
    for _ in range(max_rounds):
        # large star: every larger neighbour of a node is hung on the least of its neighbourhood
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(_star(both, 2 * current.count()).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .filter("u <> v").distinct(), "large-star")
        # small star: the smaller neighbours of a node (and itself) are hung on the least of them
        n = large.count()
        starred = _star(large, n)
        small = starred.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                 F.struct("u", F.col("m").alias("v")))).alias("e"))
        current = stored(small.select("e.u", "e.v").filter("u <> v").distinct(), "small-star")
        row = current.agg(F.count("*").alias("n"), F.sum(F.hash("u", "v").cast("long")).alias("h")).first()
        now = (row["n"], row["h"])
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _star(pairs: DataFrame, total: int) -> DataFrame:
    """(u, v, m): m is the least of u and all its partners."""
    least = pairs.groupBy("u").agg(F.min("v").alias("lv"), F.count("*").alias("n"))
    hot = hot_keys(least, ["u"], "n", total, "salts")
    facts = least.select("u", F.least("u", "lv").alias("m"))
    return attach(pairs, facts, ["u"], hot, F.col("v"))


# Facts with at most this many rows are sent to every executor; more are joined by shuffle, hot keys salted.
SMALL_FACTS = 20_000


def with_facts(rows: DataFrame, facts: DataFrame, keys: Sequence[str], count: str, spread: Column) -> DataFrame:
    """Inner join of ``facts`` (written table, one row per key, column ``count`` its rows) to ``rows``."""
    keys = list(keys)
    n = facts.agg(F.count("*").alias("k"), F.sum(count).alias("n")).first()
    if n["k"] <= SMALL_FACTS:
        return rows.join(F.broadcast(facts), keys)
    return attach(rows, facts, keys, hot_keys(facts, keys, count, n["n"], "salts"), spread)
