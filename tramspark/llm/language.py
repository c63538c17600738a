"""Language identification by a linear-chain conditional random field over words.

Each word is scored per label from hashed features: its prefixes and suffixes,
its character n-grams with borders, and itself if it is in the lexicon of the
training sample.  Transitions between the labels of neighbouring words are
learned with the feature weights, so a text may switch languages; forward-
backward gives every word its label probabilities, and a text's label is the
one with the most expected words.

Training is on a bounded sample of every label: about ``per_label`` texts each,
chosen by a hash of id and text, of longer texts a window of ``max_chars``
characters.  Their words are spliced
into sequences that switch between texts, so that switches are learned too.

Rules: a text that is null or has no letter is ``und`` with score 0; without
labelled rows every text is ``und``; labels are case-sensitive; extra columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = re.compile(r"[^\W\d_]+")
BITS = 17                   # feature weights: 2**BITS rows
MULT = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xC2B2AE3D27D4EB4F)
PER_LABEL = 300             # training texts a label
MAX_CHARS = 8000            # longest training text; of a longer one a window
PIECE_CHARS = 4 << 20       # text labelled in one pass
SPAN = (8, 40)              # words of a spliced span
LENGTH = 64                 # words of a training sequence
STEPS = 25                  # gradient steps over the whole sample


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray         # (2**BITS, labels)
    start: np.ndarray           # (labels,) log weights of the first word's label
    moves: np.ndarray           # (labels, labels) log weights of neighbours
    lexicon: np.ndarray         # sorted hashes of the sample's words


def _spread(h: np.ndarray, kind: int) -> np.ndarray:
    """Row of the weights for a feature hash of a kind."""
    x = (h + np.uint64(kind)) * MIX
    x ^= x >> np.uint64(31)
    return ((x * MULT) >> np.uint64(64 - BITS)).astype(np.int32)


def _fold(chars: np.ndarray) -> np.ndarray:
    """Hash of each row (the last axis is folded)."""
    h = np.zeros(chars.shape[:-1], np.uint64)
    for j in range(chars.shape[-1]):
        h = (h + chars[..., j]) * MULT + np.uint64(1)
    return h


def features(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per word length: indices of the words, their feature rows (words x features) and their word hashes."""
    lens = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lens, kind="stable")
    lens = lens[order]
    cuts = np.flatnonzero(np.r_[True, lens[1:] != lens[:-1]]) if len(lens) else np.zeros(0, np.int64)
    for s, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)], strict=True):
        n = int(lens[s])
        step = max(1, min(50_000, 2_000_000 // n))
        for k in range(s, e, step):
            part = order[k:min(k + step, e)]
            raw = np.frombuffer("".join([words[i] for i in part.tolist()]).encode("utf-32-le"), np.uint32).reshape(-1, n)
            chars = np.full((len(part), n + 2), 1, np.uint64)       # 1 marks the borders
            chars[:, 1:-1] = raw
            with np.errstate(over="ignore"):
                rows = [_spread(_fold(np.lib.stride_tricks.sliding_window_view(x, size, axis=1)), size)
                        for size, x in ((1, chars[:, 1:-1]), (2, chars), (3, chars))]
                rows += [_spread(_fold(chars[:, :size + 1]), 10 + size)[:, None] for size in (2, 3, 4) if size <= n]
                rows += [_spread(_fold(chars[:, n + 1 - size:]), 20 + size)[:, None] for size in (2, 3, 4) if size <= n]
                whole = _fold(chars)
            yield part, np.concatenate(rows, axis=1), whole


def emissions(m: Model, words: list[str]) -> np.ndarray:
    """Log scores (words x labels)."""
    out = np.zeros((len(words), len(m.labels)), np.float32)
    for part, rows, whole in features(words):
        score = np.zeros((len(part), len(m.labels)), np.float32)
        for j in range(rows.shape[1]):
            score += m.weights[rows[:, j]]
        if len(m.lexicon):
            known = m.lexicon[np.minimum(np.searchsorted(m.lexicon, whole), len(m.lexicon) - 1)] == whole
            with np.errstate(over="ignore"):
                score[known] += m.weights[_spread(whole[known], 30)]
        out[part] = score
    return out


def forward_backward(start: np.ndarray, moves: np.ndarray, local: np.ndarray, first: np.ndarray, lens: np.ndarray,
                     want_words: bool = False) -> tuple[np.ndarray, tuple[np.ndarray, ...] | None]:
    """Expected words of each label per sequence; if wanted, every word's probabilities and the two sides of its moves.

    The sides are the forward values and the words' scores times the backward
    values, each up to a factor of the word.

    ``local`` holds the words' scores (exp, words x labels) of all sequences in
    a row; sequence k starts at ``first[k]`` and has ``lens[k]`` > 0 words,
    longest sequences first.  All sequences advance together.
    """
    n, n_labels = len(lens), local.shape[1]
    alpha = np.empty_like(local)
    active = n - np.searchsorted(lens[::-1], np.arange(int(lens[0]) if n else 0), side="right")
    a = None
    for t, k in enumerate(active.tolist()):
        at = first[:k] + t
        a = (start if a is None else a[:k] @ moves) * local[at]
        a /= a.sum(axis=1, keepdims=True)
        alpha[at] = a
    words, after = (np.empty_like(local), np.empty_like(local)) if want_words else (None, None)
    total = np.zeros((n, n_labels))
    b = np.zeros((0, n_labels), local.dtype)
    for t in range(len(active) - 1, -1, -1):
        k = int(active[t])
        more = np.ones((k, n_labels), local.dtype)
        if len(b):
            back = (b * local[first[:len(b)] + t + 1]) @ moves.T
            more[:len(b)] = back / back.sum(axis=1, keepdims=True)
        b = more
        at = first[:k] + t
        p = alpha[at] * b
        p /= p.sum(axis=1, keepdims=True)
        total[:k] += p
        if want_words:
            words[at], after[at] = p, local[at] * b
    return total, (words, alpha, after) if want_words else None


def train(texts: list[str], langs: list[str], seed: int = 7, steps: int = STEPS) -> Model:
    """Maximum likelihood with a little shrinkage (Adam over the whole sample)."""
    labels = sorted(set(langs))
    number = {x: i for i, x in enumerate(labels)}
    n_labels, rng = len(labels), np.random.default_rng(seed)
    ids: dict[str, int] = {}
    spans = []
    for t, x in zip(texts, langs, strict=True):
        tokens = [ids.setdefault(w, len(ids)) for w in WORD.findall(t.lower())]
        at = 0
        while at < len(tokens):
            k = int(rng.integers(*SPAN))
            spans.append((number[x], tokens[at:at + k]))
            at += k
    # spans of different texts follow one another; a third stay next to their own text's next one
    order = np.argsort(np.arange(len(spans)) + (rng.random(len(spans)) < 2 / 3) * rng.integers(0, max(1, len(spans)), len(spans)))
    tokens = np.concatenate([np.array(spans[i][1], np.int32) for i in order] or [np.zeros(0, np.int32)])
    gold = np.repeat(np.array([spans[i][0] for i in order], np.int32), [len(spans[i][1]) for i in order])
    n_seq = max(1, len(tokens) // LENGTH)
    lens = np.full(n_seq, LENGTH) if len(tokens) >= LENGTH else np.array([len(tokens)])
    tokens, gold = tokens[:lens.sum()], gold[:lens.sum()]
    first = np.arange(n_seq) * LENGTH
    words = list(ids)
    word_of, rows_of, lexicon = [], [], []
    for part, rows, whole in features(words):
        with np.errstate(over="ignore"):
            rows = np.concatenate([rows, _spread(whole, 30)[:, None]], axis=1)
        word_of.append(np.repeat(part.astype(np.int32), rows.shape[1]))
        rows_of.append(rows.ravel())
        lexicon.append(whole)
    word_of, rows_of = np.concatenate(word_of), np.concatenate(rows_of)
    # plain lookup instead of a sort: the rows are few
    used = np.flatnonzero(np.bincount(rows_of, minlength=1 << BITS))
    slot_of = np.zeros(1 << BITS, np.int32)
    slot_of[used] = np.arange(len(used))
    slot = slot_of[rows_of]
    del rows_of
    w, start, moves = np.zeros((len(used), n_labels)), np.zeros(n_labels), np.zeros((n_labels, n_labels))
    params = [w, start, moves]
    mean, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    inner = np.ones(len(tokens), bool)
    inner[first] = False
    before = np.flatnonzero(inner) - 1
    every = np.arange(len(tokens))
    seen_moves = np.zeros((n_labels, n_labels))
    np.add.at(seen_moves, (gold[before], gold[before + 1]), 1)
    for step in range(1, steps + 1):
        score = np.stack([np.bincount(word_of, w[slot, k], len(words)) for k in range(n_labels)], axis=1)
        local = np.exp(score - score.max(axis=1, keepdims=True)).astype(np.float32)[tokens]
        s, m = (np.exp(x - x.max()).astype(np.float32) for x in (start, moves))
        _, (p, alpha, after) = forward_backward(s, m, local, first, lens, True)
        miss = p.copy()
        miss[every, gold] -= 1
        by_word = np.stack([np.bincount(tokens, miss[:, k], len(words)) for k in range(n_labels)], axis=1)
        # expected moves: forward value x move x what follows, normalised over each pair of neighbours
        a, b = alpha[before], after[before + 1]
        moved = (a / ((a @ m) * b).sum(axis=1, keepdims=True)).T.astype(np.float64) @ b * m
        grads = [np.stack([np.bincount(slot, by_word[word_of, k], len(used)) for k in range(n_labels)], axis=1) / n_seq + 1e-4 * w,
                 miss[first].sum(axis=0) / n_seq + 1e-4 * start,
                 (moved - seen_moves) / n_seq + 1e-4 * moves]
        for x, g, a, b in zip(params, grads, mean, square, strict=True):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            x -= 0.2 * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-6)
    weights = np.zeros((1 << BITS, n_labels), np.float32)
    weights[used] = w
    return Model(labels, weights, start, moves, np.unique(np.concatenate(lexicon)) if lexicon else np.zeros(0, np.uint64))


def label(m: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Label and score of every text."""
    names, scores = ["und"] * len(texts), np.zeros(len(texts))
    if not m.labels:
        return names, scores
    s = 0
    while s < len(texts):
        e, held = s, 0
        while e < len(texts) and held < PIECE_CHARS:
            held += len(texts[e] or "")
            e += 1
        _label_piece(m, texts, s, e, names, scores)
        s = e
    return names, scores


def _label_piece(m: Model, texts, s: int, e: int, names: list[str], scores: np.ndarray) -> None:
    from tramspark.llm.pieces import Numbers
    numbers, tokens, lens = Numbers(), [], []
    for t in texts[s:e]:
        found = WORD.findall(t.lower()) if t else []
        lens.append(len(found))
        tokens.extend(map(numbers.__getitem__, found))
    if not tokens:
        return
    score = emissions(m, list(numbers))
    local = np.exp(score - score.max(axis=1, keepdims=True))[np.array(tokens, np.int64)]
    lens = np.array(lens)
    order = np.argsort(-lens, kind="stable")
    order = order[lens[order] > 0]
    first = (np.cumsum(lens) - lens)[order]
    start, moves = (np.exp(x - x.max()).astype(np.float32) for x in (m.start, m.moves))
    total, _ = forward_backward(start, moves, local, first, lens[order])
    best = total.argmax(axis=1)
    for k, i in enumerate(order.tolist()):
        names[s + i] = m.labels[best[k]]
    scores[s + order] = np.clip(total[np.arange(len(best)), best] / lens[order], 0, 1)


def held_out(id_col: str) -> Column:
    """Rows that training never sees."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_label: int = PER_LABEL, max_chars: int = MAX_CHARS) -> Model:
    """A model from a bounded sample of the labelled rows that are not held out.

    About ``per_label`` texts of each label, twice as many at most, reach the
    driver; of a text longer than ``max_chars`` a window, placed by a hash.
    """
    text, spare = F.col(text_col), F.greatest(F.length(text_col) - max_chars, F.lit(0))
    place = F.xxhash64(F.col(id_col), text)         # of the text too: ids may be missing
    usable = docs.filter(~held_out(id_col) & F.col(lang_col).isNotNull() & text.isNotNull()).select(
        F.col(id_col).alias("id"), F.substring(text, F.pmod(F.shiftrightunsigned(place, 32), spare + 1).cast("int") + 1,
                                               F.lit(max_chars)).alias("text"),
        F.col(lang_col).alias("lang"), F.pmod(place, F.lit(1 << 30)).alias("place"))
    counts = usable.groupBy("lang").agg(F.count("*").alias("n"), F.min("place").alias("least")).collect()
    if not counts:
        return Model([], np.zeros((1, 0), np.float32), np.zeros(0), np.zeros((0, 0)), np.zeros(0, np.uint64))
    # the least place always counts: equal rows share theirs
    below = F.create_map(*[F.lit(x) for r in counts for x in (
        r["lang"], max(r["least"] + 1, min(1 << 30, (per_label << 30) // r["n"] + 1)))])
    first = F.row_number().over(Window.partitionBy("lang").orderBy("place", "id", "text"))
    rows = (usable.filter(F.col("place") < below[F.col("lang")]).withColumn("nth", first).filter(F.col("nth") <= 2 * per_label)
            .orderBy("place", "id", "text").collect())
    return train([r["text"] for r in rows], [r["lang"] for r in rows])


def _predicted(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = label(shared.value, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(names, pa.string()), pa.array(scores)],
                                             names=["id", "lang_pred", "score"])
    return run


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)        # size fixed by BITS and the labels
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(_predicted(shared), "id long, lang_pred string, score double"))


def keep_identified(docs: DataFrame, model: Model, min_score: float, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose language is undetermined or scored below ``min_score``; rows stay in place."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = label(shared.value, batch.column(at).to_pylist())
            yield batch.filter(pa.array([n != "und" and s >= min_score for n, s in zip(names, scores.tolist(), strict=True)], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
