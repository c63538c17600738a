"""SentencePiece encoding and decoding by a batched Viterbi in numpy.

Words (a run of ``▁`` and what follows up to the next) never share a piece, so
each distinct word of a batch is segmented once.  Words of equal length
advance together: at every end position, hashes of all substrings that end
there probe the sorted piece keys of their length (hits are compared character
by character), each candidate gets the score of its best path, and the maximum
over the candidates stores the backpointer.

* unigram models: the score is the sum of the piece scores (single precision,
  the longer last piece wins a tie, as in the public library);
* BPE models: a path counts only if merging would really produce it, that is
  if each two neighbouring pieces are what merging their joined text gives.
  Exactly one candidate passes at each position; words holding pieces whose
  merge priority is tied (runs of blanks in the public vocabulary) are merged
  step by step instead, as a tie depends on the place in the word.

Characters outside the vocabulary become byte pieces, or the unknown piece
when the model has none.

Rules: a null or empty text has no pieces and decodes to the empty text; a
text that holds ``▁`` itself decodes with blanks there, as in the library;
extra columns are ignored.
"""

from __future__ import annotations

import heapq
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
SPACE = "▁"
MULT = np.uint64(0x9E3779B97F4A7C15)
CACHED_WORDS = 500_000      # distinct words kept between the batches of a Python worker
MARKS = 20                  # bits of a hash that the table of possible keys looks at
TEXT_BYTES = 4 << 20        # text of one pass (a longer text is a pass of its own)
GROUP_WORDS = 20_000        # words of one length advanced together


@dataclass
class Model:
    """Plain tables of a model (tens of thousands of pieces), cheap to ship to every task."""

    kind: int
    pieces: list[bytes]                 # by id; what the id decodes to
    byte_ids: np.ndarray | None         # ids of the 256 byte pieces
    unk: int
    dummy_prefix: bool
    split: re.Pattern | None            # finds words; None: the whole text is one
    chars: dict[int, np.ndarray] = field(default_factory=dict)    # length -> code points, sorted by hash
    keys: dict[int, np.ndarray] = field(default_factory=dict)     # length -> sorted hashes
    nodes: dict[int, np.ndarray] = field(default_factory=dict)    # length -> node of each key
    ids: np.ndarray | None = None       # node -> id (node 0: a character outside the vocabulary)
    score: np.ndarray | None = None     # node -> score
    left: np.ndarray | None = None      # node -> nodes that merge into it (itself for a character)
    right: np.ndarray | None = None
    pair_keys: np.ndarray | None = None     # left * nodes + right, sorted
    pair_nodes: np.ndarray | None = None
    pair_marks: np.ndarray | None = None    # as ``marks``, for the pairs
    tied: np.ndarray | None = None      # node -> its merge priority is not its own
    marks: np.ndarray | None = None     # top bits of a hash -> some key may have it
    unk_score: float = 0.0


def hashes(chars: np.ndarray) -> np.ndarray:
    h = np.zeros(len(chars), np.uint64)
    for j in range(chars.shape[1]):
        h = h * MULT + chars[:, j].astype(np.uint64)
    return h


def load(path: str) -> Model:
    """Tables of a model file; only identity normalisation with escaped, prefixed blanks is supported."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    return from_proto(proto)


def from_proto(proto) -> Model:
    spec, norm = proto.trainer_spec, proto.normalizer_spec
    if spec.model_type not in (UNIGRAM, BPE) or spec.treat_whitespace_as_suffix:
        raise ValueError("only unigram and BPE models with blanks before words are supported")
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
        raise ValueError("only models without text normalisation are supported")
    if any(p.type == USER for p in proto.pieces):
        raise ValueError("user-defined pieces are not supported")
    texts = [p.piece for p in proto.pieces]
    plain = [i for i, p in enumerate(proto.pieces) if p.type == NORMAL]
    unk = next((i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN), 0)
    byte_ids, decoded = None, []
    by_byte = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
    if len(by_byte) == 256:
        byte_ids = np.array([by_byte[b] for b in range(256)], np.int64)
    for i, p in enumerate(proto.pieces):
        if p.type == NORMAL:
            decoded.append(p.piece.replace(SPACE, " ").encode())
        elif p.type == BYTE:
            decoded.append(bytes([int(p.piece[3:5], 16)]))
        else:
            decoded.append(" ⁇ ".encode() if i == unk else b"")
    inner = any(SPACE in texts[i].lstrip(SPACE) for i in plain)
    # a line break outside every piece ends a word like a blank (unknown neighbours would be joined without byte pieces)
    breaks = "" if byte_ids is None or any("\n" in texts[i] for i in plain) else "\n"
    split = None if inner else re.compile(f"{SPACE}*[^{SPACE}{breaks}]+|{SPACE}+" + (f"|{breaks}" if breaks else ""))
    m = Model(spec.model_type, decoded, byte_ids, unk, norm.add_dummy_prefix, split)
    # characters first, then merged pieces in the order in which they merge
    singles = [i for i in plain if len(texts[i]) == 1]
    merged = sorted((i for i in plain if len(texts[i]) > 1), key=lambda i: (-proto.pieces[i].score, i))
    order = singles + merged
    m.ids = np.array([unk, *order], np.int64)
    scores = np.array([proto.pieces[i].score for i in order], np.float32)
    m.unk_score = float(scores.min() - 10) if len(order) else -10.0
    m.score = np.r_[np.float32(m.unk_score), scores].astype(np.float32)
    for n in sorted({len(texts[i]) for i in order}):
        nodes = np.array([k + 1 for k, i in enumerate(order) if len(texts[i]) == n])
        chars = np.array([[ord(c) for c in texts[order[k - 1]]] for k in nodes], np.uint32)
        h = hashes(chars)
        at = np.argsort(h)
        m.keys[n], m.chars[n], m.nodes[n] = h[at], chars[at], nodes[at]
    m.marks = np.zeros(1 << MARKS, bool)
    for h in m.keys.values():
        m.marks[h >> np.uint64(64 - MARKS)] = True
    if spec.model_type == BPE:
        _merges(m, [texts[i] for i in order], len(singles))
    return m


def _merges(m: Model, texts: list[str], singles: int) -> None:
    """How each piece comes about by merging."""
    node = {t: k + 1 for k, t in enumerate(texts)}
    n = len(texts) + 1
    m.left, m.right = np.arange(n), np.arange(n)
    pairs = {}
    for k in range(singles + 1, n):
        parts = list(texts[k - 1])
        while len(parts) > 2:
            best = min(((node.get(parts[i] + parts[i + 1], n), i) for i in range(len(parts) - 1)))
            if best[0] >= k:
                break
            parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        if len(parts) == 2 and parts[0] in node and parts[1] in node:
            m.left[k], m.right[k] = node[parts[0]], node[parts[1]]
            pairs[m.left[k] * n + m.right[k]] = k
    m.pair_keys = np.array(sorted(pairs), np.int64)
    m.pair_nodes = np.array([pairs[x] for x in sorted(pairs)], np.int64)
    m.pair_marks = np.zeros(1 << MARKS, bool)
    m.pair_marks[_mix(m.pair_keys)] = True
    s, at = np.unique(m.score[singles + 1:], return_inverse=True)
    m.tied = np.r_[np.zeros(singles + 1, bool), np.bincount(at, minlength=len(s))[at] > 1]


def _mix(key: np.ndarray) -> np.ndarray:
    return (key.astype(np.uint64) * MULT) >> np.uint64(64 - MARKS)


def _neighbours(m: Model, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether merging the joined text of two pieces gives these two pieces (all pairs at once).

    The later merge of the two is undone again and again; at each step, a pair
    across the border that would have merged earlier than what was undone
    proves that merging goes another way.
    """
    n = len(m.left)
    ok = np.ones(len(a), bool)
    at = np.arange(len(a))
    limit = np.full(len(a), n, np.int64)
    while len(at):
        key = a * n + b
        clash = np.zeros(len(key), bool)
        maybe = np.flatnonzero(m.pair_marks[_mix(key)])
        pos = np.minimum(np.searchsorted(m.pair_keys, key[maybe]), len(m.pair_keys) - 1)
        clash[maybe] = (m.pair_keys[pos] == key[maybe]) & (m.pair_nodes[pos] < limit[maybe])
        ok[at[clash]] = False
        left_first = a > b
        split = np.where(left_first, m.right[a] != a, m.left[b] != b)
        go = ~clash & split
        at, a, b, left_first = at[go], a[go], b[go], left_first[go]
        limit = np.where(left_first, a, b + 1)
        a, b = np.where(left_first, m.right[a], a), np.where(left_first, b, m.left[b])
    return ok


def segment(m: Model, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Last piece's node for every prefix of words of one length (rows of code points), and which words have a tie."""
    rows, n = chars.shape
    prefix = np.zeros((n + 1, rows), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            prefix[j + 1] = prefix[j] * MULT + chars[:, j].astype(np.uint64)
    power = [np.uint64(1)]
    for _ in range(max(m.keys, default=1)):
        power.append(np.uint64(int(power[-1]) * int(MULT) % 2**64))
    last = np.zeros((n + 1, rows), np.int32)        # node
    size = np.zeros((n + 1, rows), np.int32)        # its length: the backpointer
    best = np.zeros((n + 1, rows), np.float32)
    tie = np.zeros(rows, bool)
    for j in range(1, n + 1):
        words, nodes, lens = [], [], []
        for length, keys in m.keys.items():
            if length > j:
                continue
            with np.errstate(over="ignore"):
                h = prefix[j] - prefix[j - length] * power[length]
            hit = np.flatnonzero(m.marks[h >> np.uint64(64 - MARKS)])    # few get past the marks
            h = h[hit]
            pos = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            found = keys[pos] == h
            hit, pos = hit[found], pos[found]
            if len(hit):
                same = slice(None) if length == 1 else (m.chars[length][pos] == chars[hit, j - length:j]).all(axis=1)
                hit, pos = hit[same], pos[same]
                words.append(hit)
                nodes.append(m.nodes[length][pos])
                lens.append(np.full(len(hit), length, np.int32))
        known = np.zeros(rows, bool)
        for w, k in zip(words, lens, strict=True):
            if len(k) and k[0] == 1:
                known[w] = True
        alien = np.flatnonzero(~known)      # characters outside the vocabulary are candidates of their own
        word, node, length = (np.concatenate(x) for x in ((*words, alien), (*nodes, np.zeros(len(alien), np.int64)),
                                                          (*lens, np.ones(len(alien), np.int32))))
        before = j - length
        if m.kind == BPE:
            tie[word[m.tied[node]]] = True
            valid = before == 0
            inner = np.flatnonzero(~valid)
            valid[inner] = _neighbours(m, last[before[inner], word[inner]].astype(np.int64), node[inner])
            points = np.where(valid, length.astype(np.float32), np.float32(-1))
        else:
            points = best[before, word] + m.score[node]
        # running maximum over the candidate lengths; the longer piece wins among equals
        top = np.full(rows, -np.inf, np.float32)
        for k in np.unique(length):
            mine = length == k
            w, x, t = word[mine], points[mine], node[mine]
            better = x >= top[w]
            w = w[better]
            top[w], last[j, w], size[j, w] = x[better], t[better], k
        best[j] = top
    # walk the backpointers, all words together; 0 marks no piece end
    ends = np.zeros((rows, n + 1), np.int32)
    at, row = np.full(rows, n), np.arange(rows)
    while len(row):
        ends[row, at] = last[at, row] + 1
        at = at - size[at, row]
        row, at = row[at > 0], at[at > 0]
    return ends, tie


def _merge_by_steps(m: Model, word: str, node_of: dict[str, int]) -> list[int]:
    """Nodes of one word by merging the best-scored pair, the leftmost first among equals.

    Parts are a linked list by the place of their first character, pairs a heap; a pair whose parts have changed since is
    passed over.  So a run of n blanks takes n log n steps.
    """
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))     # of the part that begins at a place; end 0: no part begins there
    heap: list[tuple[float, int, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and end[i] < n and (k := node_of.get(word[i:end[end[i]]])) is not None:
            heapq.heappush(heap, (-float(m.score[k]), i, end[i], end[end[i]]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, middle, last = heapq.heappop(heap)
        if end[i] != middle or end[middle] != last:
            continue
        end[i], end[middle] = last, 0
        if last < n:
            before[last] = i
        offer(before[i])
        offer(i)
    out, i = [], 0
    while i < n:
        out.append(node_of.get(word[i:end[i]], 0))
        i = end[i]
    return out


class Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


class Encoder:
    """Segments distinct words; the first ``CACHED_WORDS`` of them are kept, later ones for one batch."""

    def __init__(self, model: Model):
        self.m = model
        self.node_of = None
        self.numbers, self.kept = Numbers(), 0
        self.starts, self.sizes, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _word_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, sizes and flat ids of the words."""
        m = self.m
        lens = np.fromiter(map(len, words), np.int64, len(words))
        starts, sizes, flats, done = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), [], 0
        for length in np.unique(lens).tolist():
            members = np.flatnonzero(lens == length)
            # bounds the tables of one pass, whatever the words' length
            step = max(1, min(GROUP_WORDS, 2_000_000 // length))
            for s in range(0, len(members), step):
                part = members[s:s + step]
                chars = np.frombuffer("".join([words[i] for i in part.tolist()]).encode("utf-32-le"), np.uint32).reshape(-1, length)
                ends, tie = segment(m, chars)
                for r in np.flatnonzero(tie):
                    ends[r], at = 0, 0
                    for k in self._by_steps(words[part[r]]):
                        at += len(self._text(k)) if k else 1
                        ends[r, at] = k + 1
                row, at = np.nonzero(ends)
                node = ends[row, at] - 1
                ids, count = m.ids[node].astype(np.int32), np.bincount(row, minlength=len(part))
                if (node == 0).any():
                    ids, count = self._with_bytes(chars, row, at, node, ids, len(part))
                sizes[part], starts[part] = count, done + np.cumsum(count) - count
                flats.append(ids)
                done += len(ids)
        return starts, sizes, np.concatenate([np.zeros(0, np.int32), *flats])

    def _by_steps(self, word: str) -> list[int]:
        if self.node_of is None:
            self.node_of = {"".join(map(chr, c)): int(k) for n in self.m.keys
                            for c, k in zip(self.m.chars[n].tolist(), self.m.nodes[n].tolist(), strict=True)}
        return _merge_by_steps(self.m, word, self.node_of)

    def _text(self, node: int) -> str:
        return self.m.pieces[self.m.ids[node]].decode()

    def _with_bytes(self, chars, row, at, node, ids, rows) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number a row, with characters outside the vocabulary as bytes or as the unknown piece."""
        if self.m.byte_ids is None:     # the library joins neighbouring unknown characters
            keep = (node != 0) | np.r_[True, (node[:-1] != 0) | (row[1:] != row[:-1])]
            return ids[keep], np.bincount(row[keep], minlength=rows)
        alien = np.flatnonzero(node == 0)
        raw = [chr(c).encode() for c in chars[row[alien], at[alien] - 1].tolist()]
        times = np.ones(len(ids), np.int64)
        times[alien] = [len(x) for x in raw]
        out = np.repeat(ids, times)
        out[np.repeat(node == 0, times)] = self.m.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        return out, np.bincount(np.repeat(row, times), minlength=rows)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row and the offsets (one more than texts) into them."""
        m = self.m
        numbers, counts = [], []
        for t in texts:
            t = t.replace(" ", SPACE)
            if t and m.dummy_prefix:
                t = SPACE + t
            words = (m.split.findall(t) if m.split else [t]) if t else []
            counts.append(len(words))
            numbers.extend(map(self.numbers.__getitem__, words))
        starts, sizes, flat = self.starts, self.sizes, self.flat
        if len(self.numbers) > self.kept:
            new = list(islice(reversed(self.numbers), len(self.numbers) - self.kept))[::-1]
            a, b, c = self._word_ids(new)
            starts, sizes, flat = np.r_[starts, a + len(flat)], np.r_[sizes, b], np.concatenate([flat, c])
            if len(self.numbers) <= CACHED_WORDS:
                self.starts, self.sizes, self.flat, self.kept = starts, sizes, flat, len(self.numbers)
            else:
                for w in new:
                    del self.numbers[w]
        at = np.array(numbers, np.int64)
        sizes = sizes[at]
        ends = np.cumsum(sizes)
        out = flat[np.repeat(starts[at] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]
        return out, np.r_[0, ends][np.r_[0, np.cumsum(counts)].astype(np.int64)]


class Decoder:
    def __init__(self, model: Model):
        self.dummy = model.dummy_prefix
        self.sizes = np.fromiter(map(len, model.pieces), np.int64, len(model.pieces))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(model.pieces), np.uint8)

    def decode(self, flat: np.ndarray, offsets: np.ndarray) -> list[str]:
        sizes = self.sizes[flat]
        ends = np.cumsum(sizes)
        data = self.data[np.repeat(self.starts[flat] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        out, bounds = [], np.r_[0, ends][offsets].tolist()
        for s, e in zip(bounds[:-1], bounds[1:], strict=True):
            if self.dummy and data[s:min(s + 1, e)] == b" ":
                s += 1
            out.append(data[s:e].decode("utf-8", "replace"))
        return out


def _passes(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about TEXT_BYTES."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= TEXT_BYTES:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _list(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.astype(np.int32)))


_encoders: dict[str, Encoder] = {}      # of this Python worker: its tasks share the words seen


def _encoder(name: str, shared) -> Encoder:
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = Encoder(shared.value)
    return _encoders[name]


def _encoded(name: str, shared, check: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(name, shared)
        decoder = Decoder(encoder.m)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for s, e in _passes(texts):
                flat, offsets = encoder.encode(texts[s:e])
                cols = [batch.column("id").slice(s, e - s), pa.array(np.diff(offsets)), _list(flat, offsets)]
                names = ["id", "n_tokens", "ids"]
                if check:
                    back = decoder.decode(flat, offsets)
                    cols.append(pa.array([a == b.replace(SPACE, " ") for a, b in zip(back, texts[s:e], strict=True)]))
                    names.append("round_trip")
                yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def _decoded(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for batch in batches:
            ids = batch.column("ids")
            lists = ids.fill_null([]) if ids.null_count else ids
            offsets = np.r_[0, np.cumsum(np.fromiter(lists.value_lengths().to_pylist(), np.int64, len(lists)))]
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(decoder.decode(flat, offsets))], names=["id", "text"])
    return run


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", check: bool = False) -> DataFrame:
    """(id, n_tokens, ids) of every row; with ``check`` also whether decoding the ids gives the text back."""
    shared = docs.sparkSession.sparkContext.broadcast(load(model))      # size: the vocabulary's
    schema = "id long, n_tokens long, ids array<int>" + (", round_trip boolean" if check else "")
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(_encoded(uuid.uuid4().hex, shared, check), schema))


def decode(rows: DataFrame, model: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of rows of ids; ids outside the vocabulary fail."""
    shared = rows.sparkSession.sparkContext.broadcast(load(model))
    return rows.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(_decoded(shared), "id long, text string")
