"""URL filter: a path-template tree per host, judged by the labels of its pages; DataFrame operations only.

The tree grows level by level from the distinct (host, path) pairs.  At a node
a segment that holds at least ``MIN_ROWS`` pages and a hundredth
(``1 / MAX_LITERALS``) of the node's stays a literal branch; all others are
variable and become the wildcard ``*``.  So a node has at most ``MAX_LITERALS``
+ 1 branches, however many values a segment takes.  Branches of one shape (the
rounded mean of the segments that follow) whose labels do not differ from those
of the other branches of the shape (two-proportion test, ``SIMILAR_Z``) are
merged, and the next level sees them as one node.  A page's template is its node
after the last segment.

A template's purity is its share of good labels, smoothed towards its host's,
which is smoothed towards that of all labels (``SMOOTHING`` labels' worth each).
Templates with a purity under ``MIN_PURITY`` are blocked.  Rules given by hand
(verdict, host, path) come first: a rule fits its host and all subdomains if
the path starts with the rule's; of several the longest wins (then the one with
the longer host, then block).

Nodes are counted by aggregation; what a level finds is joined back by key with
hot keys salted, so a host or path with a third of all pages is spread.  The
depth bounds the tree, not the urls: segments after the first ``DEPTH - 1`` form
one last segment.

Rules for odd input: a null url, or one without ``://``, has empty host and
path and is judged like any other; labels of a page are added up over repeated
ids and count for each of its rows, rows without id have none, and a null label
is none; empty segments (double or closing slashes) are skipped; repeated rows
count as often as they occur; an empty table gives an empty result, other
columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramspark.llm import common

DEPTH = 6               # levels of the tree
MIN_ROWS = 8            # pages of a literal branch
MAX_LITERALS = 100      # a literal branch holds at least this part of its node's pages
SIMILAR_Z = 2.0         # branches of one shape whose labels differ by fewer standard errors are merged
SMOOTHING = 4.0
MIN_PURITY = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
MARKS = {"%": "%25", "*": "%2A", "|": "%7C", "{": "%7B", "}": "%7D"}    # written otherwise in literals


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    found = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(found, URL, 1), UPPER, LOWER), F.regexp_extract(found, URL, 2)


def segments(path: Column, depth: int = DEPTH) -> Column:
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    rest = F.array(F.array_join(F.slice(parts, depth, F.greatest(F.size(parts) - (depth - 1), F.lit(0))), "/"))
    return F.when(F.size(parts) > depth, F.concat(F.slice(parts, 1, depth - 1), rest)).otherwise(parts)


def _literal(segment: Column) -> Column:
    for mark, written in MARKS.items():
        segment = F.replace(segment, F.lit(mark), F.lit(written))
    return segment


def labelled_paths(pages: DataFrame, labels: DataFrame, good: Column, id_col: str, label_id: str) -> DataFrame:
    """(host, path, n, good, bad) of every distinct pair of ``pages`` (id, host, path)."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))       # no id is written as an empty text
    urls = common.stored(pages.groupBy(key.alias("key"), "host", "path").agg(F.count("*").alias("n")), "urls")
    facts = (labels.filter(F.col(label_id).isNotNull()).groupBy(F.col(label_id).cast("string").alias("key"))
             .agg(F.count_if(good).alias("good"), F.count_if(~good).alias("bad")))
    size = urls.agg(F.count("*").alias("n")).first()["n"]
    hot = common.hot_keys(urls.groupBy("key").agg(F.count("*").alias("k")), ["key"], "k", size, "salts")
    known = common.attach(urls, facts, ["key"], hot, F.struct("host", "path"), "left")
    return known.groupBy("host", "path").agg(
        F.sum("n").alias("n"), *[F.coalesce(F.sum(F.col("n") * F.col(c)), F.lit(0)).alias(c) for c in ("good", "bad")])


def _merged(branches: DataFrame) -> DataFrame:
    """(host, node, name, next): the branches of a node, similar ones with one common next node."""
    n = F.col("n")
    shaped = branches.withColumn("shape", F.floor((2 * F.col("deeper") + n) / (2 * n)))
    # at most MAX_LITERALS + 1 branches a node
    w = Window.partitionBy("host", "node", "shape")
    g, b, all_g, all_b = (F.col(c).cast("double") for c in ("good", "bad", "all_good", "all_bad"))
    own, rest = g + b, all_g + all_b - (g + b)
    apart = F.pow(g * rest - (all_g - g) * own, F.lit(2.0)) * (all_g + all_b)
    scale = own * rest * all_g * all_b
    tested = (shaped.withColumns({"all_good": F.sum("good").over(w), "all_bad": F.sum("bad").over(w)})
              .withColumn("similar", (scale == 0) | (apart < F.lit(SIMILAR_Z ** 2) * scale)))
    group = F.when(F.col("similar"), F.lit("")).otherwise(F.col("name"))
    names = F.sort_array(F.collect_list("name").over(Window.partitionBy("host", "node", "shape", group)))
    label = (F.when(F.array_contains(names, "*"), F.lit("*")).when(F.size(names) == 1, F.get(names, 0))
             .otherwise(F.concat(F.lit("{"), F.array_join(names, "|"), F.lit("}"))))
    return tested.select("host", "node", "name", "kids", F.concat("node", F.lit("/"), label).alias("next"))


def _grow(active: DataFrame, level: int) -> DataFrame:
    """``active`` (rows with a segment at ``level``) moved to their nodes after it."""
    seg = F.get("segs", level)
    after = F.size("segs") - (level + 1)
    sums = [F.sum(c).alias(c) for c in ("n", "good", "bad")]
    kids = common.stored(active.groupBy("host", "node", seg.alias("seg")).agg(
        *sums, F.sum(F.col("n") * after).alias("deeper"), F.count("*").alias("paths")), "url-kids")
    nodes = common.stored(kids.groupBy("host", "node").agg(F.sum("n").alias("node_n"), F.count("*").alias("kids")), "url-nodes")
    literal = (F.col("n") >= MIN_ROWS) & (F.col("n") * MAX_LITERALS >= F.col("node_n"))
    named = common.stored(common.with_facts(kids, nodes, ["host", "node"], "kids", F.col("seg"))
                          .withColumn("name", F.when(literal, _literal(F.col("seg"))).otherwise(F.lit("*"))).drop("kids"), "url-names")
    branches = named.groupBy("host", "node", "name").agg(*sums, F.sum("deeper").alias("deeper"), F.count("*").alias("kids"))
    merged = common.stored(_merged(branches), "url-branches")
    moves = common.stored(common.with_facts(named, merged, ["host", "node", "name"], "kids", F.col("seg"))
                          .select("host", "node", "seg", "next", "paths"), "url-moves")
    moved = common.with_facts(active.withColumn("seg", seg), moves, ["host", "node", "seg"], "paths", F.col("path"))
    return common.stored(moved.select("host", "path", "n", "good", "bad", "segs", F.col("next").alias("node")), "url-level")


def templates(paths: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``paths`` with the template (node) of each."""
    rows = common.stored(paths.select("*", segments(F.col("path"), depth).alias("segs"), F.lit("").alias("node")), "url-level")
    done = []
    for level in range(depth):
        done.append(rows.filter(F.size("segs") <= level))
        active = rows.filter(F.size("segs") > level)
        if active.isEmpty():
            break
        rows = _grow(active, level)
    else:
        done.append(rows)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.drop("segs")


def _purities(found: DataFrame) -> DataFrame:
    """(host, node, purity, paths) of every template."""
    per = found.groupBy("host", "node").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.count("*").alias("paths"))
    per = common.stored(per, "url-templates")
    total = per.agg(F.coalesce(F.sum("good"), F.lit(0)).alias("g"), F.coalesce(F.sum("bad"), F.lit(0)).alias("b")).first()
    base = (total["g"] + 1.0) / (total["g"] + total["b"] + 2.0)
    hosts = common.stored(per.groupBy("host").agg(F.sum("good").alias("g"), F.sum("bad").alias("b"), F.count("*").alias("nodes")), "url-hosts")
    prior = (F.col("g") + F.lit(SMOOTHING * base)) / (F.col("g") + F.col("b") + F.lit(SMOOTHING))
    return common.with_facts(per, hosts, ["host"], "nodes", F.col("node")).select(
        "host", "node", "paths", ((F.col("good") + F.lit(SMOOTHING) * prior) / (F.col("good") + F.col("bad") + F.lit(SMOOTHING))).alias("purity"))


def host_rules(hosts: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(host, rules, paths) of ``hosts`` (host, paths): the rules that fit each host, as structs that order by precedence."""
    kind = "array<struct<len:int,host_len:int,block:boolean,rule:string,path:string>>"
    by_host: dict[str, list] = {}
    for verdict, host, path in rules:
        by_host.setdefault(host, []).append((len(host + path), len(host), verdict == "block", host + path, path))
    table = hosts.sparkSession.createDataFrame(
        [(h, r, len(by_host)) for h, r in by_host.items()], f"suffix string, fits {kind}, k long")
    # a host's endings of as many labels as some rule's host has
    labels = F.split("host", r"\.")
    sizes = sorted({h.count(".") + 1 for h in by_host})
    endings = F.array_distinct(F.filter(F.array(*[F.when(F.size(labels) >= k, F.array_join(F.slice(labels, -k, k), "."))
                                                  for k in sizes]).cast("array<string>"), lambda x: x.isNotNull()))
    spread = hosts.select("host", "paths", F.explode(endings).alias("suffix"))
    known = common.with_facts(spread, common.stored(table, "url-rules"), ["suffix"], "k", F.col("host"))
    found = known.groupBy("host").agg(F.flatten(F.collect_list("fits")).alias("rules"))
    return hosts.join(found, "host", "left").select(
        "host", "paths", F.coalesce("rules", F.array().cast(kind)).alias("rules"))


def judge(pages: DataFrame, labels: DataFrame, good: Column, rules: Sequence[tuple[str, str, str]] = (),
          id_col: str = "page_id", url_col: str = "url", label_id: str = "doc_id") -> DataFrame:
    """(id, host, path, rule, verdict, template, purity) of every row.

    ``good`` is a condition on a row of ``labels`` (null: no label), whose
    column ``label_id`` names the page; ``rules`` are (verdict, host, path).
    """
    host, path = split_url(F.col(url_col))
    rows = common.stored(pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path")), "url-rows")
    found = common.stored(templates(labelled_paths(rows, labels, good, "id", label_id)), "url-nodes-of-paths")
    known = common.with_facts(found, common.stored(_purities(found), "url-purities"), ["host", "node"], "paths", F.col("path")).drop("paths")
    hosts = common.stored(found.groupBy("host").agg(F.count("*").alias("paths")), "url-hosts")
    ruled = common.with_facts(known, common.stored(host_rules(hosts, rules), "url-host-rules"), ["host"], "paths", F.col("path"))
    best = F.array_max(F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"])))
    judged = common.stored(ruled.withColumn("best", best).select(
        "host", "path", "n", F.col("best.rule").alias("rule"),
        F.when(F.coalesce(F.col("best.block"), F.col("purity") < MIN_PURITY), F.lit("block")).otherwise(F.lit("allow")).alias("verdict"),
        F.when(F.col("node") == "", F.lit("/")).otherwise(F.col("node")).alias("template"), "purity"), "url-verdicts")
    spread = F.monotonically_increasing_id()
    return common.with_facts(rows, judged, ["host", "path"], "n", spread).select(
        "id", "host", "path", "rule", "verdict", "template", "purity")
