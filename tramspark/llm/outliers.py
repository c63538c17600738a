"""Quality rules: robust multivariate outliers per language and source, in DataFrame operations only.

Base counts of every whole text give five transformed statistics, held in
whole thousandths so that all sums are exact and independent of the order.
For each group (language, source) the minimum-covariance-determinant estimate
is found by concentration steps: take the ``COVERAGE`` of the rows with the
smallest Mahalanobis distances, take their mean and covariance, and repeat.
There are two starts, medians with quartile ranges and the moments of all rows;
after ``TRIALS`` steps each, a group goes on from the one with the smaller
determinant.  A last step re-weights: all rows within the ``WEIGHT_QUANTILE`` of
the raw estimate count.  Rows beyond the ``REJECT_QUANTILE`` of the final one
are rejected.

Small groups lean on larger ones without a border: to every estimate ``PRIOR``
rows with the moments of the group's language are added, and to the language's
as many with those of the whole table; where the coverage is reached is decided
alike.  A group of three rows is judged nearly by its language, one of thousands
by its own.

One step is one aggregation: rows are counted and summed per (group, class of
distance), and the classes up to the one at which the coverage is reached are
added up.  A hot group is thus pre-aggregated before the shuffle like any other.

Rules: a null text has no words; null language or source form a group
``(none)``; rows that fail the base rules take no part in the estimates and have
no distance; all others have one, however small their group; repeated rows
count as often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramspark.llm import common

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS, MAX_REPEAT = 50, 50      # base rules: fewest words, largest percentage of words in repeated windows
COVERAGE = 0.75                     # share of a group's rows in the concentrated subset
STEPS = 5                           # concentration steps, those of the trials included
TRIALS = 2
WEIGHT_QUANTILE = 0.975
REJECT_QUANTILE = 1 - 1e-7
PRIOR = 50.0                        # rows that a group's language, and its language's table, count for
# Least standard deviations (thousandths): log words, log word length, log symbols, log repeated lines, log repeated words.
# Each is below what its statistic can deviate by over the root of the rejection limit (6.4), so each alone can reject: log
# repeated words of a row that passes the base rules is at most log 51, 3930 thousandths.
FLOORS = (200.0, 40.0, 200.0, 300.0, 450.0)
P = len(FLOORS)
CLASSES = 20                        # classes of distance per unit of its logarithm


def chi2_cdf(x: float, k: float) -> float:
    """Regularised lower incomplete gamma function by its series."""
    if x <= 0:
        return 0.0
    a, x = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= x / n
        total += term
    return min(1.0, total * math.exp(-x + a * math.log(x) - math.lgamma(a)))


def chi2_quantile(q: float, k: float) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < q else (low, mid)
    return (low + high) / 2


def consistency(share: float, k: int = P) -> float:
    """Factor that makes the covariance of the innermost ``share`` of normal rows that of all."""
    return share / chi2_cdf(chi2_quantile(share, k), k + 2)


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows found twice or more: windows are sorted by hash, equal neighbours kept, their cover counted."""
    def windows(w):
        return F.when(F.size(w) < 4, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))

    def cover(h):
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = _bound(placed, lambda p: F.filter(p, lambda x, k: F.coalesce(
            (x["h"] == F.get(p, k + 1)["h"]), F.lit(False)) | F.coalesce(x["h"] == F.get(p, k - 1)["h"], F.lit(False))))
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(F.sort_array(F.transform(twice, lambda x: x["i"])), start, lambda a, i: F.struct(
            i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")), lambda a: a["n"])

    return _bound(windows(words), lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), cover(h)).otherwise(F.lit(0).cast("long")))


def base_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                source_col: str = "source") -> DataFrame:
    """(id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed) of every whole text."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(lang_col), F.lit("(none)")).alias("lang"),
                       F.coalesce(F.col(source_col), F.lit("(none)")).alias("source"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumns({
        "words": F.filter(F.split("text", SPACES), lambda w: w != ""),
        "lines": F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD)),
        "n_symbols": F.regexp_count("text", F.lit(SYMBOLS)).cast("long")})
    rows = rows.select("id", "lang", "source", F.size("words").cast("long").alias("n_words"),
                       F.length(F.array_join("words", "")).cast("long").alias("word_chars"), "n_symbols",
                       (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                       _repeat_words(F.col("words")).alias("n_repeat_words"))
    return rows.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                           | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT))


def _statistics() -> list[Column]:
    """Transformed statistics in whole thousandths (rows without words are base-failed; their values do not count)."""
    n, c = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    raw = [F.log(n), F.log(c / n), F.log(1 + 100 * F.col("n_symbols") / c), F.log(1 + F.col("n_dup_lines").cast("double")),
           F.log(1 + 100 * F.col("n_repeat_words") / n)]
    return [F.floor(x * 1000 + 0.5).cast("long").alias(f"z{i}") for i, x in enumerate(raw, 1)]


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(1, P + 1) for j in range(1, i + 1)]


def _whitened(facts: DataFrame) -> DataFrame:
    """From centres c and covariances v: the inverse w of the Cholesky factor, so that |w (z - c)|^2 is the distance."""
    out = facts
    for i, j in _pairs():
        inner = F.col(f"v{i}{j}")
        for k in range(1, j):
            inner = inner - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        # the floors keep the diagonal positive; rounding must not undo that
        out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(inner, F.lit(FLOORS[i - 1] ** 2 / 100))) if i == j
                             else inner / F.col(f"l{j}{j}"))
    for j in range(1, P + 1):
        for i in range(j, P + 1):
            if i == j:
                out = out.withColumn(f"w{i}{j}", 1 / F.col(f"l{i}{i}"))
                continue
            inner = sum((F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)), F.lit(0.0))
            out = out.withColumn(f"w{i}{j}", -inner / F.col(f"l{i}{i}"))
    det = sum((F.log(f"l{i}{i}") for i in range(1, P + 1)), F.lit(0.0))
    return out.select("group", "lang", "n", det.alias("det"), *[f"c{i}" for i in range(1, P + 1)], *[f"w{i}{j}" for i, j in _pairs()])


def _distance() -> Column:
    total = F.lit(0.0)
    for i in range(1, P + 1):
        y = sum((F.col(f"w{i}{j}") * (F.col(f"z{j}") - F.col(f"c{j}")) for j in range(1, i + 1)), F.lit(0.0))
        total = total + F.pow(y, F.lit(2.0))
    return total


def _class(distance: Column) -> Column:
    return F.floor(F.log(F.greatest(distance, F.lit(1e-4))) * CLASSES).cast("int")


def _lean(groups: DataFrame, weight: str, values: list[str]) -> DataFrame:
    """``values`` (sums over ``weight`` rows) of every group with ``PRIOR`` rows of its language added, of which in turn the
    table's share is mixed in; ``weight`` grows alike."""
    whole = groups.agg(*[F.sum(c).cast("double").alias(c) for c in (weight, *values)]).first()
    total = whole[weight] or 1.0
    langs = groups.groupBy("lang").agg(F.count("*").alias("k"), *[F.sum(c).cast("double").alias(f"up_{c}") for c in (weight, *values)])
    langs = common.stored(langs.select("lang", "k", *[
        ((F.col(f"up_{c}") + F.lit(PRIOR * (whole[c] or 0.0) / total)) / (F.col(f"up_{weight}") + F.lit(PRIOR))).alias(f"up_{c}")
        for c in values]), "languages")
    joined = common.with_facts(groups, langs, ["lang"], "k", F.col("group"))
    return joined.select(*[c for c in groups.columns if c not in (weight, *values)], (F.col(weight) + F.lit(PRIOR)).alias(weight),
                         *[(F.col(c) + F.lit(PRIOR) * F.col(f"up_{c}")).alias(c) for c in values])


def _start(rows: DataFrame) -> DataFrame:
    """Medians and quartile ranges per group from counts of each statistic's values."""
    values = rows.select("group", "lang", F.explode(F.array(*[
        F.struct(F.lit(i).alias("k"), F.floor(F.col(f"z{i}") / 10).alias("v")) for i in range(1, P + 1)])).alias("e"))
    counts = values.groupBy("group", "lang", "e.k", "e.v").agg(F.count("*").alias("m"))
    w = Window.partitionBy("group", "k")
    upto = counts.withColumn("upto", F.sum("m").over(w.orderBy("v"))).withColumn("n", F.sum("m").over(w))
    q = upto.groupBy("group", "lang", "k").agg(*[F.min(F.when(F.col("upto") >= F.col("n") * share, F.col("v") * 10)).alias(name)
                                                 for share, name in ((0.25, "a"), (0.5, "b"), (0.75, "d"))], F.first("n").alias("n"))
    names = [f"{x}{i}" for i in range(1, P + 1) for x in ("c", "s")]
    # centres and squared ranges as sums over the group's rows, so that they lean like moments
    wide = common.stored(q.groupBy("group", "lang").agg(F.max("n").alias("n"), F.max("n").cast("double").alias("m"), *[
        F.max(F.when(F.col("k") == i, x * F.col("n"))).cast("double").alias(f"{name}{i}")
        for i in range(1, P + 1) for name, x in (("c", F.col("b")), ("s", F.pow((F.col("d") - F.col("a")) / 1.349, F.lit(2.0))))]), "starts")
    leaned = _lean(wide, "m", names)
    return leaned.select("group", "lang", "n", *[(F.col(f"c{i}") / F.col("m")).alias(f"c{i}") for i in range(1, P + 1)], *[
        (F.col(f"s{i}") / F.col("m") + FLOORS[i - 1] ** 2 if i == j else F.lit(0.0)).alias(f"v{i}{j}") for i, j in _pairs()])


def _shares_before(classes: DataFrame) -> DataFrame:
    """(lang, class, before, k): the share of a language's rows in lower classes, ``PRIOR`` rows of the table's shares added."""
    langs = classes.groupBy("lang", "class").agg(F.sum("m").alias("m"), F.count("*").alias("k"))
    up = Window.orderBy("class").rowsBetween(Window.unboundedPreceding, -1)     # a few hundred classes
    table = langs.groupBy("class").agg(F.sum("m").alias("m"))
    total = table.agg(F.sum("m").alias("n")).first()["n"] or 1
    table = table.select("class", (F.coalesce(F.sum("m").over(up), F.lit(0)) / F.lit(float(total))).alias("table_before"))
    w = Window.partitionBy("lang")
    lower = F.coalesce(F.sum("m").over(w.orderBy("class").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shares = langs.withColumns({"lower": lower, "of": F.sum("m").over(w)}).join(F.broadcast(table), "class")
    return shares.select("lang", "class", "k", ((F.col("lower") + F.lit(PRIOR) * F.col("table_before")) / (F.col("of") + F.lit(PRIOR))).alias("before"))


def _moments(rows: DataFrame, facts: DataFrame, which: str, factor: float) -> DataFrame:
    """Centre and covariance of each group's rows in the classes of distance that ``which`` picks.

    ``all``; ``covered``: classes before which less than ``COVERAGE`` of the group's rows lie, ``PRIOR`` rows spread like
    its language's counted in (so many outliers in a small group do not pass for its core); ``near``: classes within the
    ``WEIGHT_QUANTILE``.
    """
    sums = [F.count("*").alias("m"), *[F.sum(f"z{i}").alias(f"s{i}") for i in range(1, P + 1)],
            *[F.sum(F.col(f"z{i}") * F.col(f"z{j}")).alias(f"q{i}{j}") for i, j in _pairs()]]
    near = common.with_facts(rows, facts, ["group"], "n", F.col("uid")).withColumn("class", _class(_distance()))
    classes = common.stored(near.groupBy("group", "lang", "class").agg(F.first("n").alias("n"), *sums), "classes")
    if which == "covered":
        shares = common.stored(_shares_before(classes), "shares")
        lower = F.coalesce(F.sum("m").over(Window.partitionBy("group").orderBy("class").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        classes = common.with_facts(classes.withColumn("lower", lower), shares, ["lang", "class"], "k", F.col("group"))
        inside = F.col("lower") + F.lit(PRIOR) * F.col("before") < F.lit(COVERAGE) * (F.col("n") + F.lit(PRIOR))
    else:
        edge = math.floor(math.log(chi2_quantile(WEIGHT_QUANTILE, P)) * CLASSES)
        inside = F.col("class") <= edge if which == "near" else F.lit(True)
    names = ["m", *[f"s{i}" for i in range(1, P + 1)], *[f"q{i}{j}" for i, j in _pairs()]]
    chosen = classes.groupBy("group", "lang").agg(F.first("n").alias("n"), *[
        F.sum(F.when(inside, F.col(c)).otherwise(F.lit(0))).cast("double").alias(c) for c in names])
    leaned = _lean(common.stored(chosen, "moments"), "m", names[1:])
    m = F.col("m")
    mean = {i: F.col(f"s{i}") / m for i in range(1, P + 1)}
    out = leaned.select("group", "lang", "n", *[mean[i].alias(f"c{i}") for i in range(1, P + 1)], *[
        ((F.col(f"q{i}{j}") / m - mean[i] * mean[j]) * factor + (FLOORS[i - 1] ** 2 if i == j else 0.0)).alias(f"v{i}{j}")
        for i, j in _pairs()])
    return common.stored(_whitened(out), "estimates")


def estimates(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """Robust centre and whitening matrix of each group of ``rows`` (written table: group, lang, uid, z1..z5)."""
    first = common.stored(_whitened(_start(rows)), "estimates")
    rows = rows.drop("lang")
    trials = [first, _moments(rows, first, "all", 1.0)]
    for k, facts in enumerate(trials):
        for _ in range(TRIALS):
            facts = _moments(rows, facts, "covered", consistency(COVERAGE))
        trials[k] = facts
    # the smaller determinant of each group; of equal ones the first start's
    both = trials[0].withColumn("start", F.lit(0)).unionByName(trials[1].withColumn("start", F.lit(1)))
    rest = [c for c in trials[0].columns if c not in ("group", "det")]
    facts = common.stored(both.groupBy("group").agg(F.min(F.struct("det", "start", *rest)).alias("x")).select(
        "group", "x.det", *[f"x.{c}" for c in rest]), "estimates")
    for _ in range(steps - TRIALS):
        facts = _moments(rows, facts, "covered", consistency(COVERAGE))
    return _moments(rows, facts, "near", consistency(WEIGHT_QUANTILE))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance, kept) of every row."""
    base = base_counts(docs, id_col, text_col, lang_col, source_col)
    rows = common.stored(base.select("*", *_statistics(), F.monotonically_increasing_id().alias("uid"),
                                     F.to_json(F.array("lang", "source")).alias("group")), "base-counts")
    judged = rows.filter("NOT base_failed").select("group", "lang", "uid", *[f"z{i}" for i in range(1, P + 1)])
    facts = estimates(judged)
    far = common.with_facts(judged.drop("lang"), facts, ["group"], "n", F.col("uid")).select("uid", _distance().alias("distance"))
    limit = chi2_quantile(REJECT_QUANTILE, P)
    return (rows.join(far, "uid", "left")
            .select("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance",
                    (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= limit)).alias("kept")))
