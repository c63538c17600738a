import math
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import documents
from tramspark.llm import outliers, queries

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    twice = {g for g, n in Counter(grams).items() if n > 1}
    covered = {i + k for i, g in enumerate(grams) if g in twice for k in range(3)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


TEXTS = ["", None, "a", "a b c a b c", "a a a a a", "x y z " * 30, "one\ntwo\none\n\n \n\none\n", "a b c d a b c e b c d", "# * $\t%&\x0b|<>",
         "ä ö ü " * 3, "w x   y", "q " * 5000, " ".join(f"w{i % 977}" for i in range(30_000)), " ".join(map(str, range(200)))]


def test_base_counts(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "a b"), (3, TEXTS[3])]
    got = outliers.base_counts(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    for r, (i, t) in zip(got, rows, strict=True):
        assert (r["id"], *[r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")]) == (i, *base(t)), t


def test_chi_square():
    assert math.isclose(outliers.chi2_quantile(0.975, 5), 12.8325, abs_tol=1e-3)
    assert math.isclose(outliers.chi2_cdf(7.0, 5), 0.7794, abs_tol=1e-3)
    assert math.isclose(outliers.consistency(1 - 1e-9, 5), 1, abs_tol=1e-4)


def brute(groups):
    """The whole method for {(lang, source): statistics of its rows in thousandths}: the distances of each group's rows."""
    floors = np.diag(np.square(outliers.FLOORS))

    def lean(sums):
        """{group: (rows, values summed over them)} with the language's and the table's rows added, as means."""
        total = sum(n for n, _ in sums.values())
        table = sum(x for _, x in sums.values()) / total
        up = {}
        for lang in {g[0] for g in sums}:
            mine = [v for g, v in sums.items() if g[0] == lang]
            up[lang] = (sum(x for _, x in mine) + outliers.PRIOR * table) / (sum(n for n, _ in mine) + outliers.PRIOR)
        return {g: (x + outliers.PRIOR * up[g[0]]) / (n + outliers.PRIOR) for g, (n, x) in sums.items()}

    def distance(g, centre, cov):
        z = groups[g]
        return np.einsum("ni,ij,nj->n", z - centre, np.linalg.inv(cov), z - centre)

    def classes(g, e):
        return np.floor(np.log(np.maximum(distance(g, *e), 1e-4)) * outliers.CLASSES)

    def moments(inside, factor):
        sums = {g: (float(x.sum()), np.concatenate([[z[x].sum(axis=0)], z[x].T @ z[x]])) for g, x in inside.items() for z in [groups[g]]}
        return {g: (x[0], (x[1:] - np.outer(x[0], x[0])) * factor + floors) for g, x in lean(sums).items()}

    def before(values, c):
        return np.array([(values < x).mean() for x in c])

    def step(est):
        cs = {g: classes(g, e) for g, e in est.items()}
        whole = np.concatenate(list(cs.values()))
        inside = {}
        for g, c in cs.items():
            lang = np.concatenate([x for h, x in cs.items() if h[0] == g[0]])
            share = (len(lang) * before(lang, c) + outliers.PRIOR * before(whole, c)) / (len(lang) + outliers.PRIOR)
            inside[g] = len(c) * before(c, c) + outliers.PRIOR * share < outliers.COVERAGE * (len(c) + outliers.PRIOR)
        return moments(inside, outliers.consistency(outliers.COVERAGE))

    starts = {}
    for g, z in groups.items():
        v = np.floor(z / 10) * 10
        q = [np.sort(v, axis=0)[max(0, math.ceil(len(z) * s) - 1)] for s in (0.25, 0.5, 0.75)]
        starts[g] = (len(z), len(z) * np.stack([q[1], ((q[2] - q[0]) / 1.349) ** 2]))
    trials = [{g: (x[0], np.diag(x[1]) + floors) for g, x in lean(starts).items()},
              moments({g: np.ones(len(z), bool) for g, z in groups.items()}, 1.0)]
    for k, est in enumerate(trials):
        for _ in range(outliers.TRIALS):
            est = step(est)
        trials[k] = est
    est = {g: min((np.linalg.slogdet(t[g][1])[1], k) for k, t in enumerate(trials))[1] for g in groups}
    est = {g: trials[k][g] for g, k in est.items()}
    for _ in range(outliers.STEPS - outliers.TRIALS):
        est = step(est)
    edge = math.floor(math.log(outliers.chi2_quantile(outliers.WEIGHT_QUANTILE, outliers.P)) * outliers.CLASSES)
    inside = {g: classes(g, e) <= edge for g, e in est.items()}
    est = moments(inside, outliers.consistency(outliers.WEIGHT_QUANTILE))
    return {g: distance(g, *e) for g, e in est.items()}


def statistics(rows):
    b = np.array([base(t)[:5] for t in rows], float)
    n, c = np.maximum(b[:, 0], 1), np.maximum(b[:, 1], 1)
    return np.floor(1000 * np.stack([np.log(n), np.log(c / n), np.log(1 + 100 * b[:, 2] / c), np.log(1 + b[:, 3]),
                                     np.log(1 + 100 * b[:, 4] / n)], axis=1) + 0.5)


def check(rows, got):
    """rows: (id, text, lang, source) with distinct ids."""
    good = {r[0] for r in rows if not base(r[1])[5]}
    texts = {r[0]: r[1] for r in rows}
    members = {}
    for r in rows:
        if r[0] in good:
            members.setdefault((r[2], r[3]), []).append(r[0])
    found = brute({g: statistics([texts[i] for i in ids]) for g, ids in members.items()})
    far = {i: d for g, ids in members.items() for i, d in zip(ids, found[g], strict=True)}
    limit = outliers.chi2_quantile(outliers.REJECT_QUANTILE, outliers.P)
    for r in got:
        i = r["doc_id"] if "doc_id" in r else r["id"]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == base(texts[i])
        assert (r["distance"] is None) == (i not in far)
        if i in far:
            assert math.isclose(r["distance"], far[i], rel_tol=1e-6, abs_tol=1e-6)
        assert r["kept"] == (i in good and far.get(i, 0) <= limit)


def test_judge_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    vocabulary = ["".join(chr(97 + k) for k in rng.integers(0, 26, int(rng.integers(1, 9)))) for _ in range(3000)]
    rows = []
    for i in range(240):
        words = [vocabulary[k] for k in rng.integers(0, 3000, int(rng.integers(40, 300)))]
        text = " ".join(words)
        if i % 10 == 0:
            text = " ".join(w + "$$$&&" for w in words)
        rows.append((i, text, ["en", "de", None][i % 3], "big" if i % 3 < 2 else f"s{i % 5}"))
    rows += [(1000, None, "en", "big"), (1001, "", None, None), (1002, rows[1][1], "xx", "one")]
    got = outliers.judge(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    check(rows, got)
    assert not any(r["kept"] for r in got if r["id"] < 240 and r["id"] % 10 == 0)
    assert sum(not r["kept"] and not r["base_failed"] for r in got if r["id"] < 240 and r["id"] % 10) == 0


def test_each_statistic_alone_can_reject(spark):
    rng = np.random.default_rng(11)
    vocabulary = ["".join(chr(97 + k) for k in rng.integers(0, 26, int(rng.integers(2, 9)))) for _ in range(3000)]

    def words(n):
        return [vocabulary[k] for k in rng.integers(0, 3000, n)]

    rows = [(i, " ".join(words(int(rng.integers(100, 300)))), "en", "a") for i in range(150)]
    twice, lines = words(45), []
    for _ in range(9):      # one line of one word nine times, so that no window of three words comes twice
        lines += ["alone", " ".join(words(20))]
    planted = {
        "words": " ".join(words(20_000)),
        "word length": " ".join(a + b + c for a, b, c in zip(words(200), words(200), words(200), strict=True)),
        "symbols": " ".join("$" + w[1:] if k % 5 == 0 else w for k, w in enumerate(words(200))),
        "lines": "\n".join(lines),
        "repeated words": " ".join(words(50) + twice + words(60) + twice)}
    line = " ".join(words(12))
    rows += [(1000 + k, t, "en", "a") for k, t in enumerate(planted.values())]
    rows += [(2000, "\n".join([" ".join(words(150)), line, " ".join(words(150)), line]), "en", "a")]
    assert base(planted["repeated words"])[4:] == (90, False) and base(planted["lines"])[3:] == (8, 0, False)
    got = {r["id"]: r for r in outliers.judge(documents(spark, rows)).collect()}
    assert not any(r["base_failed"] for r in got.values())
    assert {k: got[1000 + i]["kept"] for i, k in enumerate(planted)} == dict.fromkeys(planted, False)
    assert got[2000]["kept"] and all(got[i]["kept"] for i in range(150))


@pytest.mark.parametrize("n", [3, 43, 53])
def test_outliers_of_small_groups_are_found_without_a_border(spark, n):
    rng = np.random.default_rng(n)
    vocabulary = ["".join(chr(97 + k) for k in rng.integers(0, 26, int(rng.integers(2, 9)))) for _ in range(3000)]

    def text(k=290):
        return " ".join(vocabulary[i] for i in rng.integers(0, 3000, int(k)))
    rows = [(i, text(rng.integers(200, 400)), "en", "small") for i in range(n)]
    rows += [(1000 + i, text(rng.integers(200, 400)), "en", f"s{i % 7}") for i in range(150)]
    rows += [(5000 + i, text() + " " + "# " * 270, "en", "small") for i in range(3)]
    got = {r["id"]: r for r in outliers.judge(documents(spark, rows)).collect()}
    bad = [got[5000 + i] for i in range(3)]
    # the marks are words too; in windows of three they repeat, but for less than half of all words
    assert all(r["base_failed"] or (r["distance"] > 41 and not r["kept"]) for r in bad)
    assert all(got[i]["kept"] and got[i]["distance"] is not None for i in range(n))


def test_empty_and_repeated(spark):
    assert outliers.judge(documents(spark, [])).count() == 0
    rows = [(1, TEXTS[-1], "en", "a")] * 3 + [(None, TEXTS[-1], "en", "a")]
    got = outliers.judge(documents(spark, rows)).collect()
    assert len(got) == 4 and all(r["kept"] for r in got)


def test_op10_equals_brute_force(spark):
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op10_outliers(spark, SF).collect()
    assert len(got) == len(rows)
    check(rows, got)


def test_native_only(spark):
    plan = queries.op10_outliers(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
