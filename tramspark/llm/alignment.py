"""Cross-tokenizer alignment: two tokenizers' tokens of one text, grouped at the byte offsets where both end a token.

Both token sequences cover the same bytes, so their ends are two ascending
lists.  The common ends are found by divide and conquer: of an interval between
two known cuts, the end of the middle token of the first tokenizer is looked
up by bisection in the second's ends; if it is no common end, ever wider
neighbourhoods of the middle are tried; the nearest common end cuts the
interval in two, both are treated alike, and an interval without any is a leaf
group.  All open intervals of many texts advance together in arrays.

Links join the two tokens that end together at a cut.  Their corpus-wide counts
are pre-aggregated per text and task.  Of two linked tokens one is a suffix of
the other (they end together in the same text), so there are never more linked
id pairs than the bytes of both vocabularies together, whatever the corpus:
with this proven bound (``Vocabularies.max_pairs``, checked) the count table is
broadcast.

Tokens come from a table of words: texts are cut before single spaces between
characters that are no white space, where neither tokenizer has tokens across
(the first splits there before merging; the second's pieces are checked when it
is loaded, and texts stay whole otherwise).  So the tokens are those of the
whole text, and each different word is tokenized once per process.

Rules: null and empty texts, and texts whose tokens' bytes are not a space and
the text (a vocabulary that normalises or lacks characters), have no tokens, no
groups and no links; ids may be null or repeated, every row counts as often as
it occurs; ties for a token's most frequent partner all count as best; an empty
table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from tramspark.llm import common

# Fixed value: how byte-level vocabularies of this kind split text before merging.
BYTE_LEVEL_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SAFE_CUT = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")
PASS_CHARS = 1 << 20        # texts aligned together (a longer one is a pass of its own)
CACHED_CHARS = 4 << 20


def byte_characters() -> dict[str, int]:
    """Characters by which byte-level vocabularies write bytes: printable ones are themselves, the rest follow from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteLevel:
    """Byte-level BPE from a tokenizer file, special tokens' strings being plain text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back, vocab = byte_characters(), spec["model"]["vocab"]
        special = {t["content"] for t in spec["added_tokens"]}
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
        split = spec["pre_tokenizer"] or {}
        if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or spec["normalizer"]:
            raise ValueError(f"{path} is no plain byte-level vocabulary")
        order = [vocab[a + b] for a, b in merges]
        if order != sorted(order):
            raise ValueError(f"{path}: ids do not follow the order of the merges")
        ranks = {bytes(back[c] for c in k): v for k, v in vocab.items() if k not in special}
        self.size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.pieces = [b""] * self.size
        for k, v in ranks.items():
            self.pieces[v] = k
        self.core = tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, words: list[str]) -> list[list[int]]:
        """Ids of a space and each word."""
        return [self.core.encode_ordinary(" " + w) for w in words]


class Pieces:
    """A SentencePiece model; ``splits`` if no piece reaches over a single space and nothing is normalised."""

    def __init__(self, path: str):
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        self.core = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.size = len(proto.pieces)
        self.pieces = [bytes([int(p.piece[3:-1], 16)]) if p.type == p.BYTE else p.piece.replace("▁", " ").encode()
                       for p in proto.pieces]
        rules = proto.normalizer_spec
        self.splits = (rules.add_dummy_prefix and not rules.remove_extra_whitespaces and not rules.precompiled_charsmap
                       and not any(" " in p.lstrip(b" ").decode(errors="replace") for p in self.pieces))

    def encode(self, words: list[str]) -> list[list[int]]:
        return self.core.encode(words, num_threads=1)


@dataclass(frozen=True)
class Vocabularies:
    """Places of the two vocabularies; loaded once per process."""
    a_path: str
    b_path: str

    def load(self) -> Loaded:
        return _load(self.a_path, self.b_path)


@dataclass(frozen=True)
class Loaded:
    a: ByteLevel
    b: Pieces

    @cached_property
    def words(self) -> Words:
        return Words(self.a, self.b)

    @cached_property
    def tables(self) -> tuple[np.ndarray, ...]:
        """Lengths of both vocabularies' pieces; decimal ids followed by each separator (a inner, a last, b inner, b last)."""
        sizes = [np.array([len(p) for p in x.pieces], np.int64) for x in (self.a, self.b)]
        decimals = np.array([f"{i}{c}" for x, pair in ((self.a, ",|"), (self.b, ",;")) for c in pair for i in range(x.size)], object)
        return *sizes, decimals

    @property
    def max_pairs(self) -> int:
        """Most id pairs that can end together: of each, one is a suffix of the other."""
        return sum(len(p) for x in (self.a, self.b) for p in x.pieces)


@lru_cache(maxsize=2)
def _load(a_path: str, b_path: str) -> Loaded:
    return Loaded(ByteLevel(a_path), Pieces(b_path))


class Words:
    """Token ids of words met before: a table per process, begun anew beyond ``CACHED_CHARS``."""

    def __init__(self, a: ByteLevel, b: Pieces):
        self.a, self.b = a, b
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.chars = 0
        self.good = np.zeros(0, bool)               # both tokenizers' bytes are a space and the word
        self.ids = [np.zeros(0, np.int64)] * 2
        self.first = [np.zeros(0, np.int64)] * 2
        self.count = [np.zeros(0, np.int64)] * 2

    def find(self, words: list[str]) -> np.ndarray:
        """The words' places in the table, new words tokenized first."""
        if self.chars > CACHED_CHARS:
            self.clear()
        new = list(set(words).difference(self.index))
        if new:
            found = self.a.encode(new), self.b.encode(new)
            whole = [(" " + w).encode() for w in new]
            good = [b"".join([x.pieces[i] for i in t]) == w for x, ids in zip((self.a, self.b), found, strict=True)
                    for t, w in zip(ids, whole, strict=True)]
            self.good = np.concatenate([self.good, np.logical_and(*np.array(good, bool).reshape(2, -1))])
            for k, ids in enumerate(found):
                flat = np.fromiter(chain.from_iterable(ids), np.int64)
                count = np.fromiter(map(len, ids), np.int64, len(ids))
                first = len(self.ids[k]) + np.cumsum(count) - count
                for table, more in ((self.ids, flat), (self.first, first), (self.count, count)):
                    table[k] = np.concatenate([table[k], more])
            self.index.update(zip(new, range(len(self.index), len(self.good)), strict=True))
            self.chars += sum(map(len, new))
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))

    def tokens(self, places: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after the other, and the bounds of each word in them (k: 0 for a, 1 for b)."""
        count = self.count[k][places]
        bounds = np.concatenate([[0], np.cumsum(count)])
        return self.ids[k][np.repeat(self.first[k][places] - bounds[:-1], count) + np.arange(bounds[-1])], bounds


def _nearest(ends_a, ends_b, a0, a1):
    """Of each interval's inner ends of a ([a0, a1 - 1)) the nearest to the middle that is an end of b: both tokens, or -1."""
    middle = (a0 + a1 - 2) // 2
    best, other = np.full(len(a0), -1, np.int64), np.full(len(a0), -1, np.int64)
    end = ends_a[middle]
    at = np.searchsorted(ends_b, end)
    hit = ends_b[at] == end
    best[hit], other[hit] = middle[hit], at[hit]
    live, near = np.flatnonzero(~hit), 1
    while len(live):        # the neighbourhood [near, 2 * near) on both sides of the middle
        m, lo, hi = middle[live], a0[live], a1[live] - 2
        rank = np.full(len(live), np.iinfo(np.int64).max)
        for side, first, last in ((0, np.maximum(lo, m - 2 * near + 1), m - near), (1, m + near, np.minimum(hi, m + 2 * near - 1))):
            count = np.maximum(last - first + 1, 0)
            owner = np.repeat(np.arange(len(live)), count)
            token = np.repeat(first - np.cumsum(count) + count, count) + np.arange(len(owner))
            end = ends_a[token]
            same = ends_b[np.searchsorted(ends_b, end)] == end
            owner, token = owner[same], token[same]
            np.minimum.at(rank, owner, np.abs(token - m[owner]) * 2 + side)
        found = rank < np.iinfo(np.int64).max
        away = rank[found] // 2
        token = m[found] + np.where(rank[found] % 2 == 1, away, -away)
        best[live[found]], other[live[found]] = token, np.searchsorted(ends_b, ends_a[token])
        near *= 2
        live = live[~found & ((m - near >= lo) | (m + near <= hi))]
    return best, other


def common_cuts(ends_a: np.ndarray, ends_b: np.ndarray, a0, a1, b0, b1) -> tuple[np.ndarray, np.ndarray]:
    """Last tokens (of a, of b) of every group of the texts with tokens [a0, a1) and [b0, b1), ascending."""
    cuts_a, cuts_b = [a1 - 1], [b1 - 1]
    while len(a0):
        more = (a1 - a0 > 1) & (b1 - b0 > 1)
        a0, a1, b0, b1 = a0[more], a1[more], b0[more], b1[more]
        cut, other = _nearest(ends_a, ends_b, a0, a1)
        split = cut >= 0                        # the others are leaf groups
        a0, a1, b0, b1, cut, other = (x[split] for x in (a0, a1, b0, b1, cut, other))
        cuts_a.append(cut)
        cuts_b.append(other)
        # left and right halves stay in the order of the text
        a0, a1, b0, b1 = (np.stack(x, axis=1).ravel() for x in ((a0, cut + 1), (cut + 1, a1), (b0, other + 1), (other + 1, b1)))
    return np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b))


@dataclass
class Aligned:
    """Alignment of some texts: ids one after the other, each text's bounds in them, last tokens of the groups."""
    a: np.ndarray
    b: np.ndarray
    a_bounds: np.ndarray
    b_bounds: np.ndarray
    cuts_a: np.ndarray
    cuts_b: np.ndarray

    @property
    def groups(self) -> np.ndarray:
        """Each text's bounds in the groups."""
        return np.searchsorted(self.cuts_a, self.a_bounds)


def align_texts(texts: list[str | None], v: Loaded) -> Aligned:
    words = [(SAFE_CUT.split(t) if v.b.splits else [t]) if t else [] for t in texts]
    places = v.words.find(list(chain.from_iterable(words)))
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in words])]).astype(np.int64)
    bad = np.concatenate([[0], np.cumsum(~v.words.good[places])])
    good = bad[bounds[1:]] == bad[bounds[:-1]]      # one word with other bytes takes the text's tokens away
    if not good.all():
        n = np.diff(bounds)
        places, bounds = places[np.repeat(good, n)], np.concatenate([[0], np.cumsum(np.where(good, n, 0))])
    (a, a_bounds), (b, b_bounds) = ((ids, at[bounds]) for ids, at in (v.words.tokens(places, k) for k in (0, 1)))
    some = a_bounds[1:] > a_bounds[:-1]
    size_a, size_b = v.tables[:2]
    cuts = common_cuts(np.cumsum(size_a[a]), np.cumsum(size_b[b]), a_bounds[:-1][some], a_bounds[1:][some],
                       b_bounds[:-1][some], b_bounds[1:][some]) if some.any() else (np.zeros(0, np.int64),) * 2
    return Aligned(a, b, a_bounds, b_bounds, *cuts)


def group_text(x: Aligned, v: Loaded) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each text."""
    decimals = v.tables[2]
    last_a, last_b = np.zeros(len(x.a), np.int64), np.zeros(len(x.b), np.int64)
    last_a[x.cuts_a] = 1
    last_b[x.cuts_b] = 1
    after_a, after_b = np.concatenate([[0], x.cuts_a + 1]), np.concatenate([[0], x.cuts_b + 1])
    index = np.empty(len(x.a) + len(x.b), np.int64)
    index[np.arange(len(x.a)) + after_b[np.cumsum(last_a) - last_a]] = x.a + v.a.size * last_a
    index[np.arange(len(x.b)) + after_a[np.cumsum(last_b) - last_b + 1]] = 2 * v.a.size + x.b + v.b.size * last_b
    texts, bounds = decimals[index], x.a_bounds + x.b_bounds
    return ["".join(texts[i:j])[:-1] for i, j in zip(bounds[:-1], bounds[1:], strict=True)]


def _passes(ids: pa.Array, texts: list[str | None]) -> Iterator[tuple[pa.Array, list[str | None]]]:
    first, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size >= PASS_CHARS or k == len(texts) - 1:
            yield ids.slice(first, k + 1 - first), texts[first:k + 1]
            first, size = k + 1, 0


def _lists(values: np.ndarray, bounds: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def _mapped(docs: DataFrame, id_col: str, text_col: str, vocabularies: Vocabularies, columns, schema: str) -> DataFrame:
    def work(batches):
        v = vocabularies.load()
        for batch in batches:
            for ids, texts in _passes(batch.column(0), batch.column(1).to_pylist()):
                yield pa.RecordBatch.from_pydict({"id": ids} | columns(align_texts(texts, v), v))

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, f"id {kind}, {schema}")


def align(docs: DataFrame, vocabularies: Vocabularies, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, a_ids, b_ids, groups) of every row; a group is (a_end, b_end, byte_end): how many tokens of each, and how many
    bytes of a space and the text, lie up to its end."""
    def columns(x: Aligned, v: Loaded) -> dict:
        groups, size = x.groups, v.tables[0]
        owner = np.repeat(np.arange(len(groups) - 1), np.diff(groups))
        ends, before = np.cumsum(size[x.a]), np.concatenate([[0], np.cumsum(size[x.a])])[x.a_bounds]
        spans = pa.StructArray.from_arrays([
            pa.array(x.cuts_a + 1 - x.a_bounds[owner], pa.int32()), pa.array(x.cuts_b + 1 - x.b_bounds[owner], pa.int32()),
            pa.array(ends[x.cuts_a] - before[owner], pa.int64())], ["a_end", "b_end", "byte_end"])
        return {"a_ids": _lists(x.a, x.a_bounds, pa.int32()), "b_ids": _lists(x.b, x.b_bounds, pa.int32()),
                "groups": pa.ListArray.from_arrays(pa.array(groups, pa.int32()), spans)}

    return _mapped(docs, id_col, text_col, vocabularies, columns,
                   "a_ids array<int>, b_ids array<int>, groups array<struct<a_end:int,b_end:int,byte_end:long>>")


def profile(docs: DataFrame, vocabularies: Vocabularies, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, groups_sha256, pairs, times) of every row: the digest of its groups, and the linked id pairs
    (a * size of b + b) with how often the text links them."""
    def columns(x: Aligned, v: Loaded) -> dict:
        groups = x.groups
        owner = np.repeat(np.arange(len(groups) - 1), np.diff(groups))
        all_pairs = v.a.size * v.b.size
        found, times = np.unique(owner * np.int64(all_pairs) + x.a[x.cuts_a] * v.b.size + x.b[x.cuts_b], return_counts=True)
        bounds = np.searchsorted(found, np.arange(len(groups)) * np.int64(all_pairs))
        return {"n_a": pa.array(np.diff(x.a_bounds)), "n_b": pa.array(np.diff(x.b_bounds)), "n_groups": pa.array(np.diff(groups)),
                "groups_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() if t else "" for t in group_text(x, v)]),
                "pairs": _lists(found % all_pairs, bounds, pa.int64()), "times": _lists(times, bounds, pa.int32())}

    return _mapped(docs, id_col, text_col, vocabularies, columns,
                   "n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<int>")


def link_scores(docs: DataFrame, vocabularies: Vocabularies, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row; counts are over all rows."""
    v = vocabularies.load()
    profiles = common.stored(profile(docs, vocabularies, id_col, text_col), "alignments")
    links = profiles.select(F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    counts = links.groupBy("x.pairs").agg(F.sum("x.times").alias("n")).orderBy("pairs").limit(v.max_pairs + 1).toArrow()
    if counts.num_rows > v.max_pairs:
        raise RuntimeError("more linked id pairs than the vocabularies allow")
    keys, n = (counts.column(c).to_numpy().astype(np.int64) for c in ("pairs", "n"))
    best = np.zeros(v.b.size, np.int64)
    np.maximum.at(best, keys % v.b.size, n)
    shared = docs.sparkSession.sparkContext.broadcast((keys, n, n == best[keys % v.b.size]))
    kept = ["n_a", "n_b", "n_groups", "groups_sha256"]

    def work(batches):
        keys, n, top = shared.value
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times")
            bounds = pairs.offsets.to_numpy() - pairs.offsets[0].as_py()
            at = np.searchsorted(keys, pairs.flatten().to_numpy())
            k = times.flatten().to_numpy().astype(np.int64)

            def total(x):
                return pa.array(np.diff(np.concatenate([[0], np.cumsum(x)])[bounds]))

            yield pa.RecordBatch.from_pydict({"id": batch.column("id")} | {c: batch.column(c) for c in kept} | {
                "n_links": total(k), "n_best": total(k * top[at]) if len(at) else total(k),
                "count_sum": total(k * n[at]) if len(at) else total(k)})

    kind = profiles.schema["id"].dataType.simpleString()
    return profiles.mapInArrow(work, f"id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, n_links long, n_best long, count_sum long")
