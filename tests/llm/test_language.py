import itertools
import zlib

import numpy as np

from tests.llm.helpers import documents
from tramspark.llm import language, queries

SF = "/root/testdata/sf0.01"


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(2)
    start, moves = rng.random(3) + 0.1, rng.random((3, 3)) + 0.1
    lens = np.array([5, 3, 3, 1])
    first = np.cumsum(lens) - lens
    local = rng.random((lens.sum(), 3)) + 0.05
    total, (words, alpha, after) = language.forward_backward(start, moves, local, first, lens, True)
    for k, (f, n) in enumerate(zip(first, lens, strict=True)):
        by_word, pairs, z = np.zeros((n, 3)), np.zeros((max(n - 1, 0), 3, 3)), 0.0
        for path in itertools.product(range(3), repeat=int(n)):
            p = start[path[0]] * np.prod([local[f + t, y] for t, y in enumerate(path)])
            p *= np.prod([moves[a, b] for a, b in itertools.pairwise(path)])
            z += p
            for t, y in enumerate(path):
                by_word[t, y] += p
            for t, (a, b) in enumerate(itertools.pairwise(path)):
                pairs[t, a, b] += p
        assert np.allclose(words[f:f + n], by_word / z) and np.allclose(total[k], by_word.sum(axis=0) / z)
        for t in range(n - 1):
            q = alpha[f + t][:, None] * moves * after[f + t + 1][None]
            assert np.allclose(q / q.sum(), pairs[t] / z)


EN, DE = "the quick brown fox jumps over the lazy dog and runs away ", "der schnelle braune fuchs springt über den faulen hund und läuft weg "


def test_words_of_a_code_switched_text():
    m = language.train([EN * 20, DE * 20] * 8, ["en", "de"] * 8, steps=20)
    words = (EN + DE).split()
    score = language.emissions(m, words)
    local = np.exp(score - score.max(axis=1, keepdims=True))
    s, t = np.exp(m.start), np.exp(m.moves)
    _, (p, _, _) = language.forward_backward(s, t, local, np.array([0]), np.array([len(words)]), True)
    got = [m.labels[k] for k in p.argmax(axis=1)]
    assert got == ["en"] * len(EN.split()) + ["de"] * len(DE.split())
    names, scores = language.label(m, [EN + DE * 2, EN, None, "", "123 ...", DE * 5000])
    assert names == ["de", "en", "und", "und", "und", "de"] and scores[2:5].tolist() == [0, 0, 0]
    assert 0.5 < scores[0] < 0.8 and scores[1] > 0.95


def test_tables(spark):
    rows = [(i, (EN if i % 2 else DE) * 3, "en" if i % 2 else "de") for i in range(60)]
    rows += [(100, None, "en"), (101, "", None), (102, "12 !", "de"), (None, EN, None), (3, EN * 3, "en"), (104, EN, None)]
    docs = documents(spark, rows)
    model = language.fit(docs)
    got = language.identify(docs, model).collect()
    assert len(got) == len(rows)
    for r, (i, t, _) in zip(got, rows, strict=True):
        want = "und" if not t or not any(c.isalpha() for c in t) else "en" if t.startswith("the") else "de"
        assert (r["id"], r["lang_pred"]) == (i, want) and 0 <= r["score"] <= 1
    kept = language.keep_identified(docs, model, 0.5)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3
    empty = documents(spark, [])
    assert language.identify(empty, language.fit(empty)).count() == 0
    unlabelled = documents(spark, [(1, EN), (2, None)])
    assert {r["lang_pred"] for r in language.identify(unlabelled, language.fit(unlabelled)).collect()} == {"und"}


def test_op4_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op4_language(spark, SF).collect()
    assert len(got) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97


def test_every_label_is_sampled(spark, monkeypatch):
    monkeypatch.setattr(language, "train", lambda texts, langs: list(zip(texts, langs, strict=True)))
    rows = [(None, f"aa {i}", "aa") for i in range(200)]                        # no ids, first in text order
    rows += [(i, f"bb {i} " + "b" * 90, "bb") for i in range(40)]               # all longer than the limit
    rows += [(None, "same text", "cc")] * 50 + [(i, f"dd {i}", f"l{i:03}") for i in range(1000, 1400)]
    got = language.fit(documents(spark, rows), per_label=5, max_chars=60)
    sampled = {}
    for text, lang in got:
        sampled.setdefault(lang, []).append(text)
    assert set(sampled) == {"aa", "bb", "cc"} | {r[2] for r in rows[290:] if zlib.crc32(str(r[0]).encode()) % 4 != 2}
    assert all(1 <= len(x) <= 10 for x in sampled.values()) and {len(t) for t in sampled["bb"]} == {60}
