"""Periodic runs: stretches of words that repeat with a period, found by sparse diagonals of earlier occurrences.

Words q apart that are equal lie on the diagonal of lag q.  The scan keeps, for
each lag at which the present word has an earlier occurrence, how long the
match on that diagonal already is; a diagonal that is not continued has ended,
and if its length suffices the run is emitted.  Taken word by word this is
quadratic in a frequent word, so lags are taken by octaves: a run of period q
in [2^t, 2^(t+1)) matches at least 2^t words on its diagonal and so covers an
aligned block of 2^(t-1) words.  Per octave the scan steps over aligned blocks,
looks up a block's earlier occurrences at the octave's lags only, counts the
blocks matched in a row, and fixes both ends of an ended diagonal to the word.
Blocks of doubled length are numbered from pairs of blocks of the present one;
only blocks that occur twice are kept, so ordinary prose ends after three or
four octaves.  A block of b words meets at most 4 b lags, so the work is at most
in proportion to n log n, however often one word repeats.

Texts are scanned many at a time (word numbers are a text's own, so no match
crosses texts), each text whole.

Rules: words are maximal stretches of bytes other than space and 0x09 to 0x0D;
a run has length >= max(``MIN_LENGTH``, 2 * period) with its smallest period and
cannot be extended either way; null and empty texts have no words and no runs;
ids may be null or repeated, every row is judged by its own text; an empty
table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 12
PASS_BYTES = 4 << 20        # texts scanned together (a longer one is a pass of its own)


def number_words(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts in one array, a separator (-1) after each text, and the place where each text begins."""
    numbers: list[int] = []
    starts = np.zeros(len(texts), np.int64)
    base = 0
    for k, words in enumerate(texts):
        starts[k] = len(numbers)
        own: dict[bytes, int] = {}
        numbers.extend([own.setdefault(w, base + len(own)) for w in words])
        base += len(own)
        numbers.append(-1)
    return np.array(numbers, np.int64), starts


class Blocks:
    """Blocks of one length: ``rank`` by starting place (-1: occurs once), and the repeated ones' places sorted by rank."""

    def __init__(self, places: np.ndarray, keys: np.ndarray, n: int):
        order = np.argsort(keys, kind="stable")     # places ascend, so equal keys keep them ascending
        sorted_keys = keys[order]
        same = sorted_keys[1:] == sorted_keys[:-1]
        again = np.zeros(len(keys), bool)
        again[1:] |= same
        again[:-1] |= same
        fresh = np.ones(len(keys), bool)
        fresh[1:] = ~same
        rank = np.cumsum(fresh)[again]
        self.places = places[order][again]
        self.rank = np.full(n + 1, -1, np.int32)
        self.rank[self.places] = rank
        self.keyed = rank * np.int64(n + 1) + self.places

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the blocks at places a and b (a != b, within the array) are equal."""
        x = self.rank[a]
        return (x >= 0) & (x == self.rank[b])

    def doubled(self, size: int, n: int) -> Blocks:
        """Blocks of 2 * size words, of which only those whose halves both occur again can."""
        places = np.sort(self.places)
        places = places[places + size < n]
        second = self.rank[places + size]
        places, second = places[second >= 0], second[second >= 0]
        return Blocks(places, self.rank[places] * np.int64(n + 1) + second, n)


def _lagged(blocks: Blocks, size: int, low: int, high: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of every aligned block and each of its earlier occurrences at lags in [low, high)."""
    aligned = blocks.places % size == 0
    at = blocks.places[aligned]
    first = blocks.keyed[aligned] - at      # the key of the block's rank at place 0
    lo = np.searchsorted(blocks.keyed, first + np.maximum(at - high + 1, 0))
    hi = np.searchsorted(blocks.keyed, first + np.maximum(at - low + 1, 0))
    count = np.maximum(hi - lo, 0)
    owner = np.repeat(np.arange(len(at)), count)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    return at[owner], at[owner] - blocks.places[lo[owner] + inside]


def _minimal(start: np.ndarray, period: np.ndarray, blocks: Blocks, size: int) -> np.ndarray:
    """Whether no divisor of the period is a period too (``size`` <= period < 2 * size)."""
    least = np.arange(int(period.max(initial=1)) + 1)
    for f in range(2, int(len(least) ** 0.5) + 1):
        if least[f] == f:
            multiples = least[f * f::f]
            multiples[multiples == np.arange(f * f, len(least), f)] = f
    good, rest = np.ones(len(period), bool), period.copy()
    live = np.flatnonzero(rest > 1)
    while len(live):
        f = least[rest[live]]
        s, q = start[live], period[live]
        shift, end = q // f, q - size
        good[live[blocks.equal(s, s + shift) & blocks.equal(s + end, s + end + shift)]] = False
        rest[live] //= f
        live = live[(rest[live] > 1) & good[live]]
    return good


def find_runs(numbers: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs in an array of word numbers (negative: separator), by start, then period."""
    n = len(numbers)
    words = np.flatnonzero(numbers >= 0)
    levels = [Blocks(words, numbers[words], n)]
    found = []
    octave = 0
    while True:
        low, high = 1 << octave, 2 << octave
        level = max(octave - 1, 0)
        size = 1 << level
        while len(levels) <= level:
            levels.append(levels[-1].doubled(1 << (len(levels) - 1), n))
        if not len(levels[level].places) or low > n // 2:
            break
        place, lag = _lagged(levels[level], size, low, high, n)
        order = np.argsort(lag * np.int64(n + size) + place)
        place, lag = place[order], lag[order]
        # a diagonal goes on while the next aligned block matches at the same lag
        ends = np.ones(len(place), bool)
        ends[:-1] = (lag[1:] != lag[:-1]) | (place[1:] != place[:-1] + size)
        last = np.flatnonzero(ends)
        first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
        start, stop, lag = place[first], place[last] + size, lag[first]
        need = np.maximum(lag, min_length - lag)
        likely = stop - start + 2 * (size - 1) >= need
        start, stop, lag, need = start[likely], stop[likely], lag[likely], need[likely]
        for k in range(level - 1, -1, -1):      # less than a block more on either side
            step = 1 << k
            stop = stop + np.where(levels[k].equal(stop, stop - lag), step, 0)
            before = start - step
            inside = before - lag >= 0
            b = np.where(inside, before, 1)
            start = np.where(inside & levels[k].equal(b, b - np.where(inside, lag, 1)), before, start)
        long = stop - start >= need
        start, stop, lag = start[long] - lag[long], stop[long], lag[long]
        if len(start):
            while len(levels) <= octave:
                levels.append(levels[-1].doubled(1 << (len(levels) - 1), n))
            keep = _minimal(start, lag, levels[octave], low)
            found.append(np.stack([start[keep], (stop - start)[keep], lag[keep]]))
        octave += 1
    runs = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    return tuple(runs[:, np.lexsort((runs[2], runs[0]))])


def repeats(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of n words some run holds after its first period."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, start + period, 1)
    np.add.at(steps, start + length, -1)
    return np.cumsum(steps[:n]) > 0


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _passes(texts: list[bytes | None]) -> Iterator[list[bytes | None]]:
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text or b"")
        if size >= PASS_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def scan(texts: list[bytes | None], min_length: int = MIN_LENGTH) -> tuple[list[int], pa.Array, list[bytes]]:
    """Words, runs and collapsed text (kept words, one space between them) of each text."""
    split = [(t or b"").split() for t in texts]
    numbers, starts = number_words(split)
    start, length, period = find_runs(numbers, min_length)
    gone = repeats(len(numbers), start, length, period)
    owner = np.searchsorted(starts, start, side="right") - 1
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    runs = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(start - starts[owner]), pa.array(length), pa.array(period)], fields=list(RUNS.value_type)))
    collapsed = []
    for k, words in enumerate(split):
        if bounds[k] < bounds[k + 1]:
            mine = gone[starts[k]:starts[k] + len(words)]
            words = [w for w, x in zip(words, mine.tolist(), strict=True) if not x]
        collapsed.append(b" ".join(words))
    return [len(x) for x in split], runs, collapsed


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """(id, n_words, runs: start, length, period by start and period, collapsed) of every row; no shuffle."""
    def work(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.binary()).to_pylist()
            at = 0
            for part in _passes(texts):
                n, runs, collapsed = scan(part, min_length)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(part)), pa.array(n, pa.int64()), runs, pa.array(collapsed, pa.binary()).view(pa.string())],
                    ["id", "n_words", "runs", "collapsed"])
                at += len(part)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        work, f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
