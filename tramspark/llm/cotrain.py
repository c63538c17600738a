"""Quality classifier by co-training on two views of a document.

The content view sees the text: its byte and byte-pair distribution and a few
counts (words, distinct words, lines, capitals, symbols).  The metadata view
sees what is known about the page without reading it: source, language,
declared length and lines.  Each view is a logistic regression.

In every round both views score all documents without a label; what one view
is confident about becomes a pseudo-label for the other one, and stays one in
later rounds.  All of them teach: each Newton step sums gradient and Hessian
over every pseudo-labelled document in the tasks and adds the sums up in Spark;
only these sums (a number per pair of features) reach the driver.  The
pseudo-labels of a class weigh together at most half of its true labels, each
the same.  Labelled rows kept aside calibrate each view by Platt scaling, and
the final score of every document adds the calibrated log odds of the views.

Bound (parameter): ``max_labelled`` labelled rows train and as many calibrate, a
uniform choice per class by a hash of the row.  Everything else covers all rows.

Rules: null texts and fields have features of their own; several labels of one
id count by their mean, for each row of the id; labels other than 0 and 1 are
ignored; rows that share an id, or have none, are rows like any other; ties in
confidence need no order, as all confident rows count; without labels of both
classes every document gets score 0.5 and stays; an empty table gives an empty
result; other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramspark.llm import common

# columns for bytes (each ASCII byte its own, those above by their high nibble), hashed byte pairs, hashed fields
BYTES, PAIRS, FIELDS = 136, 64, 64
COUNTS = 8
CONTENT = BYTES + PAIRS + COUNTS
META = FIELDS + 2
ROUNDS = 3
CONFIDENT = 0.95
SHRINK = 10.0           # ridge penalty on standardised features
MAX_LABELLED = 8000
PSEUDO_SHARE = 0.5      # most that a class's pseudo-labels weigh together, in its true labels
STEPS = 12              # Newton steps of a round at most
# Features, errors and curvatures are whole numbers of these fractions, so sums over rows are exact in any order.
Z_UNIT, Z_MOST, ERROR_UNIT, CURVE_UNIT, X_UNIT = 64, 32, 1 << 12, 1 << 16, 1 << 24
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def content_features(text: str | None) -> np.ndarray:
    out = np.zeros(CONTENT, np.float32)
    raw = (text or "").encode()
    if not raw:
        return out
    b = np.frombuffer(raw, np.uint8)
    for s in range(0, len(b), 1 << 20):     # pieces bound the memory of a long text
        part = b[s:s + (1 << 20)]
        out[:BYTES] += np.bincount(np.where(part < 128, part, 120 + (part >> 4)), minlength=BYTES)
        pair = part[:-1].astype(np.uint32) * 31 + part[1:]
        out[BYTES:BYTES + PAIRS] += np.bincount((pair * 2654435761 >> 20) % PAIRS, minlength=PAIRS)
    out[:BYTES + PAIRS] *= 10 / len(b)
    words, lines = raw.split(), raw.split(b"\n")
    n = max(1, len(words))
    counts = np.bincount(b, minlength=256)
    out[BYTES + PAIRS:] = [np.log1p(len(words)) / 5, len(set(words)) / n, sum(map(len, words)) / n / 5, len(set(lines)) / len(lines),
                           counts[_UPPER].sum() / len(b) * 5, counts[_SYMBOL].sum() / len(b) * 5, counts[_DIGIT].sum() / len(b) * 5,
                           np.log1p(np.log1p(len(words)) * (1 - len(set(words)) / n))]
    return out


def meta_features(source: str | None, lang: str | None, n_chars: int | None, n_lines: int) -> np.ndarray:
    out = np.zeros(META, np.float32)
    half = FIELDS // 2
    for at, x in ((0, source), (half, lang)):
        out[at + (0 if x is None else 1 + zlib.crc32(x.encode()) % (half - 1))] = 1
    out[FIELDS:] = [0 if n_chars is None else np.log1p(max(0, n_chars)) / 5, np.log1p(n_lines) / 3]
    return out


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text, source, lang, n_chars = (batch.column(c) for c in ("text", "source", "lang", "n_chars"))
        rows = []
        for i in range(batch.num_rows):
            t = text[i].as_py()
            rows.append(np.concatenate([content_features(t), meta_features(source[i].as_py(), lang[i].as_py(), n_chars[i].as_py(),
                                                                           (t or "").count("\n") + 1)]).astype(np.float16).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("id"), pa.array(rows, pa.binary())], names=["uid", "id", "x"])


def featured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
             chars_col: str = "n_chars") -> DataFrame:
    """(uid, id, x): both views of every row as half-precision numbers, content first."""
    rows = common.numbered(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                                       F.col(source_col).alias("source"), F.col(chars_col).cast("long").alias("n_chars")), "uid")
    return rows.select("uid", "id", "text", "lang", "source", "n_chars").mapInArrow(_featured, "uid long, id long, x binary")


def matrix(column) -> tuple[np.ndarray, np.ndarray]:
    """Both views from feature bytes."""
    x = np.frombuffer(b"".join(column), np.float16).reshape(len(column), CONTENT + META).astype(np.float64)
    return x[:, :CONTENT], x[:, CONTENT:]


class View:
    """Logistic regression on standardised features (Newton steps), then Platt scaling."""

    def __init__(self):
        self.w = self.b = self.mean = self.scale = None
        self.platt = (1.0, 0.0)

    def fit(self, x: np.ndarray, y: np.ndarray) -> View:
        """Newton steps on labelled rows alone."""
        self.mean = x.mean(axis=0)
        self.scale = x.std(axis=0) + 1e-3
        self.w, self.b = np.zeros(x.shape[1]), 0.0
        for _ in range(12):
            if _newton(self, _scaled(_sums(self, x, y), x.shape[1])) < 1e-6:
                break
        return self

    def standard(self, x: np.ndarray) -> np.ndarray:
        """Standardised features in whole units."""
        return np.rint(np.clip((x - self.mean) / self.scale, -Z_MOST, Z_MOST) * Z_UNIT)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.standard(x) @ (self.w / Z_UNIT) + self.b, -30, 30)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> View:
        """Platt scaling with smoothed targets."""
        s = self.raw(x)
        pos = y.sum()
        t = np.where(y > 0.5, (pos + 1) / (pos + 2), 1 / (len(y) - pos + 2))
        a, c = 1.0, 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a * s + c, -30, 30)))
            r, v = t - p, np.maximum(p * (1 - p), 1e-6)
            h = np.array([[(v * s * s).sum() + 1e-3, (v * s).sum()], [(v * s).sum(), v.sum() + 1e-3]])
            da, dc = np.linalg.solve(h, [(r * s).sum() - 1e-3 * (a - 1), r.sum()])
            a, c = a + da, c + dc
            if abs(da) + abs(dc) < 1e-8:
                break
        self.platt = (max(a, 0.0), c)       # a view that ranks the wrong way says nothing
        return self

    def odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.platt[0] * self.raw(x) + self.platt[1], -15, 15)


def pseudo_labels(rounds: list[tuple[View, View]], x: tuple[np.ndarray, np.ndarray], confident: float) -> list[np.ndarray]:
    """What each view learns from the other: 1, 0, or -1 where the other was in no round confident.  The first round counts."""
    out = []
    for v in (0, 1):
        told = np.full(len(x[0]), -1.0)
        for views in rounds:
            odds, edge = views[1 - v].odds(x[1 - v]), np.log(confident / (1 - confident))
            told = np.where(told >= 0, told, np.where(odds >= edge, 1.0, np.where(odds <= -edge, 0.0, -1.0)))
        out.append(told)
    return out


def _summed(rows: DataFrame, sums, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """``sums`` (whole numbers, arrays of ``sizes`` per batch) over all rows of ``x``: added up in tasks, then by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(sum(sizes), np.int64)
        for batch in batches:
            for s in range(0, batch.num_rows, 8192):        # few enough that a product's sum is exact
                total += np.concatenate(sums(matrix([x.as_py() for x in batch.column("x").slice(s, 8192)]))).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["k", "v"])

    # a number per pair of features at most
    found = (rows.select("x").mapInArrow(run, "k int, v long").groupBy("k")
             .agg(F.sum(F.col("v").cast("decimal(20,0)")).cast("double").alias("v")).toArrow())
    flat = np.zeros(sum(sizes))
    flat[found.column("k").to_numpy()] = found.column("v").to_numpy()
    return np.split(flat, np.cumsum(sizes)[:-1])


def _extra_moments(rounds, confident):
    """Per view and class: how many pseudo-labels, the sums of their features and of the squares (in units)."""
    def sums(x):
        out = []
        for v, told in enumerate(pseudo_labels(rounds, x, confident)):
            for c in (0, 1):
                z = x[v][told == c]
                out.append(np.concatenate([[len(z)], *(np.rint(k * X_UNIT).astype(np.int64).sum(axis=0) for k in (z, z * z))]))
        return out
    return sums


def _extra_steps(rounds, confident, views):
    """Per view and class: gradient and Hessian of the pseudo-labelled rows at the views' present weights (in units)."""
    def sums(x):
        return [_sums(views[v], x[v][told == c], np.full((told == c).sum(), float(c)))
                for v, told in enumerate(pseudo_labels(rounds, x, confident)) for c in (0, 1)]
    return sums


def _sums(view: View, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Gradient and upper half of the Hessian of the log likelihood, as whole numbers of their units."""
    z = np.c_[view.standard(x), np.full(len(x), Z_UNIT)]
    p = 1 / (1 + np.exp(-np.clip(z @ (np.r_[view.w, view.b] / Z_UNIT), -30, 30)))
    h = (z * np.rint(p * (1 - p) * CURVE_UNIT)[:, None]).T @ z
    return np.concatenate([z.T @ np.rint((y - p) * ERROR_UNIT), h[np.triu_indices(len(h))]])


def _scaled(sums: np.ndarray, n: int) -> np.ndarray:
    return np.concatenate([sums[:n + 1] / (Z_UNIT * ERROR_UNIT), sums[n + 1:] / (Z_UNIT ** 2 * CURVE_UNIT)])


def _newton(view: View, sums: np.ndarray) -> float:
    """One step of ``view`` by summed gradient and Hessian (penalty added here); its largest change."""
    n = len(view.w) + 1
    h = np.zeros((n, n))
    h[np.triu_indices(n)] = sums[n:]
    h = h + np.triu(h, 1).T
    w, penalty = np.r_[view.w, view.b], np.r_[np.full(n - 1, SHRINK), 1e-3]
    step = np.linalg.solve(h + np.diag(penalty), sums[:n] - penalty * w)
    view.w, view.b = view.w + step[:-1], view.b + step[-1]
    return float(np.abs(step).max())


def teach(rows: DataFrame, rounds: list[tuple[View, View]], xs, y: np.ndarray, confident: float, steps: int = STEPS) -> tuple[View, View]:
    """Both views fitted to the labelled rows and to all that the other has been sure of in some round."""
    widths = (CONTENT, META)
    moments = _summed(rows, _extra_moments(rounds, confident), tuple(1 + 2 * n for n in widths for _ in (0, 1)))
    views, weights = [], []
    for v, (x, n) in enumerate(zip(xs, widths, strict=True)):
        count = np.array([moments[2 * v + c][0] for c in (0, 1)])
        weight = np.minimum(PSEUDO_SHARE, PSEUDO_SHARE * np.array([(y == c).sum() for c in (0, 1)]) / np.maximum(count, 1))
        extra = sum(weight[c] * moments[2 * v + c] for c in (0, 1)) / X_UNIT
        total = len(y) + weight @ count
        mean = (x.sum(axis=0) + extra[1:n + 1]) / total
        square = ((x * x).sum(axis=0) + extra[n + 1:]) / total
        # from nothing, as plain Newton steps from the last round's weights may run away
        view = View()
        view.mean, view.scale, view.w, view.b = mean, np.sqrt(np.maximum(square - mean * mean, 0)) + 1e-3, np.zeros(n), 0.0
        views.append(view)
        weights.append(weight)
    for _ in range(steps):
        extra = _summed(rows, _extra_steps(rounds, confident, tuple(views)), tuple((n + 1) * (n + 4) // 2 for n in widths for _ in (0, 1)))
        change = []
        for v, (view, x, n) in enumerate(zip(views, xs, widths, strict=True)):
            told = sum(weights[v][c] * extra[2 * v + c] for c in (0, 1))
            change.append(_newton(view, _scaled(told + _sums(view, x, y), n)))
        if max(change) < 1e-3:
            break
    return tuple(views)


def _scored(views):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            odds = [v.odds(x) for v, x in zip(views[:2], matrix([x.as_py() for x in batch.column("x")]), strict=True)]
            p = [1 / (1 + np.exp(-o)) for o in (*odds, np.clip(odds[0] + odds[1] - views[2], -30, 30))]
            yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("id"), *map(pa.array, p)],
                                             names=["uid", "id", "p_content", "p_meta", "score"])
    return run


def _labels(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(key, y): one row per labelled id."""
    return (labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("string").alias("key"))
            .agg(F.avg(label_col).alias("y")))


def _first(rows: DataFrame, n: int, k: int) -> list:
    """About the first ``k`` of ``n`` rows by place.

    Places are uniform hashes, so a limit on the place lets little more than
    ``k`` rows through and the tasks send no more than these to the driver.
    """
    share = (1.5 * k + 100) / max(n, 1)
    if share < 1:
        rows = rows.filter(F.col("place") <= int(-2 ** 63 + 2 ** 64 * share))
    return rows.orderBy("place", "x").limit(k).collect()


def _labelled(rows: DataFrame, max_rows: int, aside: bool) -> tuple | None:
    """A bounded choice, by place, of labelled rows of each class: features and labels on the driver."""
    flag = F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(4)) == 3
    good = (F.col("y") >= 0.5).alias("good")
    known = rows.filter(F.col("y").isNotNull() & (flag if aside else ~flag)).select("x", "place", good)
    counts = {r["good"]: r["n"] for r in known.groupBy("good").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    xs, ys = [], []
    for c in (True, False):
        part = _first(known.filter(F.col("good") == c), counts[c], max_rows // 2)
        xs += [r["x"] for r in part]
        ys += [float(c)] * len(part)
    return matrix(xs), np.array(ys)


def train(rows: DataFrame, rounds: int = ROUNDS, max_labelled: int = MAX_LABELLED, confident: float = CONFIDENT) -> tuple | None:
    """Both calibrated views and the prior log odds, from ``rows`` (written table: id, x, place, y or null)."""
    seen, aside = (_labelled(rows, max_labelled, a) for a in (False, True))
    if seen is None or aside is None:
        return None
    (xs, y), (ax, ay) = seen, aside
    unlabelled = rows.filter("y IS NULL")
    known = [tuple(View().fit(x, y).calibrate(a, ay) for x, a in zip(xs, ax, strict=True))]
    for _ in range(rounds):
        taught = teach(unlabelled, known, xs, y, confident)
        known.append(tuple(v.calibrate(a, ay) for v, a in zip(taught, ax, strict=True)))
    return (*known[-1], float(np.log((ay.sum() + 1) / (len(ay) - ay.sum() + 1))))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             source_col: str = "source", chars_col: str = "n_chars", label_col: str = "quality", **bounds) -> DataFrame:
    """(uid, id, p_content, p_meta, score) of every row; ``score`` is the probability of good quality."""
    # the one shuffle of the features brings the labels to them; rows without an id are keys of their own
    rows = featured(docs, id_col, text_col, lang_col, source_col, chars_col).withColumn(
        "key", F.coalesce(F.col("id").cast("string"), F.concat(F.lit("row "), F.col("uid").cast("string"))))
    rows = common.stored(rows.join(_labels(labels, id_col, label_col), "key", "left")
                         .select("uid", "id", "x", "y", F.xxhash64("uid").alias("place")), "features")
    views = train(rows, **bounds)
    if views is None:
        half = F.lit(0.5)
        return rows.select("uid", "id", half.alias("p_content"), half.alias("p_meta"), half.alias("score"))
    return rows.select("uid", "id", "x").mapInArrow(_scored(views), "uid long, id long, p_content double, p_meta double, score double")
