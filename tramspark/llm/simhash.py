"""SimHash near-duplicates by a binary-trie self-join.

Each text's word shingles vote on the 64 bits of its fingerprint; equal
fingerprints form one class, and two classes link if their fingerprints differ
in at most ``max_bits`` bits.

The join works on distinct fingerprints.  Two 64-bit values that differ in at
most k bits agree on at least one of k + 1 disjoint blocks, so each value goes
to one group per block (a shuffle of k + 1 short rows a class).  In a group a
binary trie over the sorted values is joined with itself: node pairs advance
together bit by bit, the differing bits so far add up, and a pair is dropped
as soon as they exceed the budget; only pairs of leaves are compared.  The
frontier is worked off in pieces of bounded size.  Only a group above
``GROUP_ROWS`` values, too much for one pass of a task, is first dealt into
chunks, whose tries are joined pair by pair in tasks of their own.  A group
gives a spanning forest of its links, not all pairs; connected components over
all groups give the result.

Rules: a null or blank text has fingerprint 0 and is linked like any other; a
text with fewer words than a shingle is hashed whole; component ids are the
smallest non-null ids; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramspark.llm import common
from tramspark.llm.exact_dedup import _bytes_of

SEED = 42
GROUP_ROWS = 1 << 16    # a larger group is dealt into chunks of about this many values, joined pairwise
PIECE = 1 << 16         # rows of whole groups that a task joins in one pass
FRONTIER = 1 << 18      # node pairs advanced at once


def fingerprint(words: list[bytes], shingle: int = 3) -> int:
    """Bits set in over half of the shingle hashes (XXH64, seed 42)."""
    if not words:
        return 0
    text = b" ".join(words)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lens + 1) - 1
    starts = ends - lens
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(text[s:e], SEED) for s, e in
                  zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True)], np.uint64)
    votes = np.zeros(64, np.int64)
    for s in range(0, len(h), 1 << 14):
        votes += np.unpackbits(h[s:s + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(h), bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # the five further bytes of [\\x09-\\x0D] and the blank are what bytes.split() cuts at
            buf, offsets = _bytes_of(batch.column("text"))
            bounds = offsets.tolist()
            prints = [fingerprint(buf[s:e].split(), shingle) for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), batch.column("id"), pa.array(np.array(prints, np.uint64).view(np.int64))],
                names=["uid", "id", "fp"])
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(uid, id, fp) of every row; ``fp`` holds the unsigned fingerprint's bits as a long."""
    rows = common.numbered(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "uid")
    return rows.select("uid", "id", "text").mapInArrow(_fingerprints(shingle), "uid long, id long, fp long")


def trie_links(values: np.ndarray, pairs: tuple[np.ndarray, ...], depth: int, max_bits: int, keep) -> None:
    """Calls ``keep(i, j)`` (index arrays, i < j) with the index pairs under ``pairs`` within ``max_bits`` bits.

    A node is an index range of ``values`` (uint64, ascending and distinct in
    the range) with a common prefix of ``depth`` bits; ``pairs`` are (lo1, hi1,
    lo2, hi2) arrays.  A node paired with itself stands for the pairs inside
    it.  The stack holds pieces of the frontier of bounded size.
    """
    stack = [(*pairs, np.zeros(len(pairs[0]), np.int64), depth)]
    while stack:
        lo1, hi1, lo2, hi2, err, depth = stack.pop()
        # two leaves: what is left of their paths is compared at once (a leaf paired with itself holds no pair)
        leaves = (hi1 - lo1 == 1) & (hi2 - lo2 == 1)
        if leaves.any():
            i, j = lo1[leaves], lo2[leaves]
            near = (i < j) & (np.bitwise_count(values[i] ^ values[j]) <= max_bits)
            keep(i[near], j[near])
            lo1, hi1, lo2, hi2, err = (x[~leaves] for x in (lo1, hi1, lo2, hi2, err))
        if not len(lo1):
            continue
        m1, m2 = _middle(values, lo1, hi1, depth), _middle(values, lo2, hi2, depth)
        cross = lo1 != lo2
        parts = [(lo1, m1, lo2, m2, err), (m1, hi1, m2, hi2, err), (lo1, m1, m2, hi2, err + 1),
                 (m1[cross], hi1[cross], lo2[cross], m2[cross], err[cross] + 1)]
        a, b, c, d, e = (np.concatenate(x) for x in zip(*parts, strict=True))
        live = (a < b) & (c < d) & (e <= max_bits)
        a, b, c, d, e = (x[live] for x in (a, b, c, d, e))
        for s in range(0, len(a), FRONTIER):
            stack.append((*(x[s:s + FRONTIER] for x in (a, b, c, d, e)), depth + 1))


def _middle(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
    """Per range, the first index whose bit at ``depth`` is set (binary search, all ranges at once)."""
    bit = np.uint64(1 << (63 - depth))
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        one = (values[np.minimum(mid, len(values) - 1)] & bit) != 0
        hi = np.where(open_ & one, mid, hi)
        lo = np.where(open_ & ~one, mid + 1, lo)
    return lo


class Forest:
    """Union-find over 0..n-1 that keeps the smaller index as root; ``links`` merges whole index arrays."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def links(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.root[i], self.root[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                jumped = self.root[self.root]
                if (jumped == self.root).all():
                    break
                self.root = jumped


def _paths(values: np.ndarray, forest: Forest) -> tuple[np.ndarray, np.ndarray]:
    """A path through each tree of the forest (not a star: no node collects many links)."""
    hung = np.flatnonzero(forest.root != np.arange(len(values)))
    hung = hung[np.argsort(forest.root[hung], kind="stable")]
    roots = forest.root[hung]
    first = np.r_[True, roots[1:] != roots[:-1]][:len(roots)]
    return values[hung], values[np.where(first, roots, np.r_[0, hung[:-1]][:len(hung)])]


def _join_groups(max_bits: int, parts: list[tuple[int, int, int]]):
    """Joins whole groups (sorted by block, part, n1, n2, side, rot), many in one pass, each piece in bounded memory."""
    def piece(cols: dict[str, np.ndarray]) -> pa.RecordBatch:
        rot = cols["rot"].view(np.uint64)
        a_out, b_out = [], []
        for k, _, w in parts:
            at = np.flatnonzero(cols["block"] == k)
            if not len(at):
                continue
            values, n1, n2, side = rot[at], cols["n1"][at], cols["n2"][at], cols["side"][at]
            part = values >> np.uint64(64 - w) if w < 64 else values * np.uint64(0)
            new = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (n1[1:] != n1[:-1]) | (n2[1:] != n2[:-1])])
            ends = np.r_[new[1:], len(values)]
            # rows of the second chunk follow those of the first
            second = np.r_[0, np.cumsum(side)]
            cut = ends - (second[ends] - second[new])
            own = n1[new] == n2[new]
            forest = Forest(len(values))
            trie_links(values, (new, np.where(own, ends, cut), np.where(own, new, cut), ends), w, max_bits, forest.links)
            a, b = _paths(values, forest)
            turn = (64 - parts[k][1] - w) % 64
            for out, x in ((a_out, a), (b_out, b)):
                out.append(x if not turn else (x >> np.uint64(turn)) | (x << np.uint64(64 - turn)))
        flat = [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (a_out, b_out)]
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in flat], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held = ["block", "n1", "n2", "side", "rot"], None
        for batch in batches:
            cols = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
            held = cols if held is None else {c: np.concatenate([held[c], cols[c]]) for c in names}
            if len(held["rot"]) < PIECE:
                continue
            # the last group may go on in the next batch
            width = np.array([p[2] for p in parts])[held["block"]]
            part = held["rot"].view(np.uint64) >> (64 - width).astype(np.uint64)
            last = np.flatnonzero((part != part[-1]) | np.any([held[c] != held[c][-1] for c in names[:3]], axis=0))
            if len(last):
                end = last[-1] + 1
                yield piece({c: v[:end] for c, v in held.items()})
                held = {c: v[end:] for c, v in held.items()}
        if held is not None and len(held["rot"]):
            yield piece(held)
    return run


def links(classes: DataFrame, max_bits: int = 3, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Spanning links (a, b) between distinct fingerprints ``fp`` (written table) that differ in at most ``max_bits`` bits."""
    blocks = max_bits + 1
    width = -(-64 // blocks)
    parts = [(k, k * width, min(width, 64 - k * width)) for k in range(blocks) if k * width < 64]

    def rotated(at: int, w: int):
        turn = (64 - at - w) % 64  # brings the block to the top
        return F.shiftleft("fp", turn).bitwiseOR(F.shiftrightunsigned("fp", 64 - turn)) if turn else F.col("fp")

    entries = classes.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(rotated(at, w), 64 - w).alias("part"),
                 rotated(at, w).alias("rot")) for k, at, w in parts])).alias("e")).select("e.*")
    sizes = common.stored(entries.groupBy("block", "part").agg(F.count("*").alias("n")).filter("n > 1"), "trie-groups")
    total = len(parts) * classes.count()
    facts = sizes.select("block", "part", F.ceil(F.col("n") / F.lit(group_rows)).cast("int").alias("chunks"))
    hot = common.hot_keys(sizes, ["block", "part"], "n", total, "salts")
    grouped = common.attach(entries, facts, ["block", "part"], hot, F.col("rot"))
    # a large group is dealt into chunks; every pair of chunks becomes a group of its own
    dealt = (grouped.withColumn("chunk", F.pmod(F.xxhash64("rot"), F.col("chunks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("block", "part", F.least("chunk", "other").alias("n1"), F.greatest("chunk", "other").alias("n2"),
                     (F.col("chunk") > F.col("other")).cast("int").alias("side"), "rot"))
    key = ["block", "part", "n1", "n2"]
    return (dealt.repartition(*key).sortWithinPartitions(*key, "side", "rot")
            .select("block", "n1", "n2", "side", "rot")
            .mapInArrow(_join_groups(max_bits, parts), "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 3) -> DataFrame:
    """(uid, id, fp, component_id, first) of every row; ``first`` marks one row of each component (its smallest id)."""
    prints = common.stored(fingerprints(docs, id_col, text_col, shingle), "simhashes")
    # no id (null) sorts after every id
    node = F.struct(F.col("id").isNull().alias("none"), F.coalesce("id", F.lit(0)).alias("id"), "uid")
    classes = common.stored(prints.groupBy("fp").agg(F.min(node).alias("least"), F.count("*").alias("n")), "classes")
    found = common.components(links(classes, max_bits).select(F.col("a").alias("u"), F.col("b").alias("v")))
    found = common.stored(found, "found")
    linked = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", "n", F.coalesce("root", "fp").alias("root"))
    total = prints.count()
    linked = common.stored(linked, "linked")
    tops = linked.groupBy("root").agg(F.min("least").alias("top"), F.count("*").alias("k"))
    tops = common.stored(tops, "tops")
    hot_roots = common.hot_keys(tops, ["root"], "k", total, "salts")
    facts = common.attach(linked.select("fp", "root", "n"), tops.select("root", "top"), ["root"], hot_roots, F.col("fp"))
    facts = common.stored(facts.select("fp", "n", "top"), "class-facts")
    rows = common.attach(prints, facts.select("fp", "top"), ["fp"], common.hot_keys(facts, ["fp"], "n", total, "salts"),
                         F.col("uid"))
    return rows.select("uid", "id", "fp", F.when(~F.col("top.none"), F.col("top.id")).alias("component_id"),
                       (F.col("uid") == F.col("top.uid")).alias("first"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
               max_bits: int = 3) -> DataFrame:
    """``docs`` with one row of each near-duplicate component, all columns kept."""
    docs = common.scanned(docs)
    uid = common.fresh("__uid", docs.columns)
    dropped = near_duplicates(docs, id_col, text_col, shingle, max_bits).filter("not first").select(F.col("uid").alias(uid))
    return common.without(common.numbered(docs, uid), dropped, uid)
