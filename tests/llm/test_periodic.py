import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tests.llm.helpers import documents
from tramspark.llm import periodic, queries

SF = "/root/testdata/sf0.001"


def brute_runs(w, min_length=12):
    """All maximal stretches by their definition, lag by lag."""
    out = set()
    for q in range(1, len(w) // 2 + 1):
        i = q
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            s, length = i - q, j - i + q
            if j > i and length >= max(min_length, 2 * q):
                x = w[s:s + length]
                if not any(x[p:] == x[:-p] for p in range(1, q)):
                    out.add((s, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(w, runs):
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    return [x for k, x in enumerate(w) if k not in gone]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_the_definition(seed):
    rng = random.Random(seed)
    for _ in range(120):
        docs = []
        for _ in range(rng.randint(0, 4)):
            w = [b"%d" % rng.randrange(rng.choice([1, 2, 2, 3, 5])) for _ in range(rng.randint(0, 60))]
            if w and rng.random() < 0.6:
                w = w[:rng.randint(0, 10)] + w[:rng.randint(1, 20)] * rng.randint(1, 6) + w[5:]
                w = w * rng.choice([1, 1, 2])
            docs.append(w)
        min_length = rng.choice([12, 12, 2, 5])
        numbers, starts = periodic.number_words(docs)
        found = [[] for _ in docs]
        for s, length, q in zip(*periodic.find_runs(numbers, min_length), strict=True):
            k = int(np.searchsorted(starts, s, side="right")) - 1
            found[k].append((int(s - starts[k]), int(length), int(q)))
        assert found == [brute_runs(w, min_length) for w in docs]


def test_one_word_repeated_is_near_linear():
    n, runs, collapsed = periodic.scan([b"a " * 300_000, b"b c " * 100_000])
    assert n == [300_000, 200_000]
    assert runs.to_pylist() == [[{"start": 0, "length": 300_000, "period": 1}], [{"start": 0, "length": 200_000, "period": 2}]]
    assert collapsed == [b"a", b"b c"]


def test_long_period_over_a_whole_text():
    unit = [b"%d" % (k * 7919 % 5003) for k in range(30_000)]
    (n,), runs, (kept,) = periodic.scan([b" ".join(unit * 3 + unit[:10])])
    found = runs.to_pylist()[0]
    assert {"start": 0, "length": 90_010, "period": 5003} in found or max(r["length"] for r in found) == 90_010


def test_edges_and_clashing_columns(spark):
    rows = [(1, None), (2, ""), (None, "x " * 12), (3, "x " * 11), (3, "a b\u00a0c " * 6), (3, "a b\u00a0c " * 6), (4, "\u2003" * 20)]
    found = sorted(map(tuple, periodic.detect(documents(spark, rows)).collect()), key=str)
    run = [(0, 12, 2)]
    assert found == sorted([(1, 0, [], ""), (2, 0, [], ""), (None, 12, [(0, 12, 1)], "x"), (3, 11, [], " ".join(["x"] * 11)),
                            (3, 12, run, "a b\u00a0c"), (3, 12, run, "a b\u00a0c"), (4, 1, [], "\u2003" * 20)], key=str)
    assert periodic.detect(documents(spark, [])).count() == 0


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = {r.doc_id: r for r in queries.op13_periodic_runs(spark, SF).collect()}
    assert len(found) == len(rows)
    some = 0
    for doc_id, text in rows:
        w = words_of(text)
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if n > 2500:
            continue
        runs = brute_runs(w)
        some += bool(runs)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        r = found[doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(collapse(w, runs)).encode()).hexdigest()
    assert some > 10
