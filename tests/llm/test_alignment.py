import hashlib
import json
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
import sentencepiece
import tokenizers

from tests.llm.helpers import documents
from tramspark.llm import alignment, queries

SF = "/root/testdata/sf0.001"
V = alignment.Vocabularies(queries.BYTE_LEVEL, queries.PIECES)
ODD = [None, "", " ", "  a   b \n\n\t c ", "a▁b", "a ▁ b", "日本語 テスト 🎉🎉 ok", "x" * 3000, "<|endoftext|> <s> </s>", "\x00 a\x1c b\x85 c",
       "é" * 500, "don't we'll  'S", "a b", "a b", "١٢٣ ٤٥ 12 345", "\u00a0 x \u3000y"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    made = ["".join(rng.choice("abcdefgh é\n.,-'  тежшш\u00a0") for _ in range(rng.randint(1, 200))) for _ in range(200)]
    return ODD + made + [r[0] for r in duckdb.connect().execute(f"SELECT text FROM '{SF}/documents.parquet'").fetchall()]


def expected(texts):
    """Groups and links of each text, from the public libraries over whole texts and ends compared one by one."""
    first = tokenizers.Tokenizer.from_file(queries.BYTE_LEVEL)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    back = alignment.byte_characters()
    with open(queries.BYTE_LEVEL, encoding="utf-8") as f:
        bytes_a = {v: bytes(back[c] for c in k) for k, v in json.load(f)["model"]["vocab"].items() if k != "<|endoftext|>"}

    def bytes_b(i):
        piece = second.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()

    out = []
    for text in texts:
        whole = (" " + text).encode() if text else b""
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        if b"".join(bytes_a[i] for i in a) != whole or b"".join(map(bytes_b, b)) != whole:
            a, b = [], []
        ends_a, ends_b = (np.cumsum([0, *(len(f(i)) for i in ids)])[1:].tolist() for f, ids in ((bytes_a.get, a), (bytes_b, b)))
        groups, links, i, j = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            p, q = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append((a[i:p], b[j:q], end))
            links.append((a[p - 1], b[q - 1]))
            i, j = p, q
        out.append((a, b, groups, links))
    return out


def text_of(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b, _ in groups)


def test_tokens_and_groups_equal_the_libraries(texts):
    x, v = alignment.align_texts(texts, V.load()), V.load()
    want = expected(texts)
    got = alignment.group_text(x, v)
    for k, (a, b, groups, _) in enumerate(want):
        assert x.a[x.a_bounds[k]:x.a_bounds[k + 1]].tolist() == a, texts[k]
        assert x.b[x.b_bounds[k]:x.b_bounds[k + 1]].tolist() == b, texts[k]
        assert got[k] == text_of(groups)
    assert np.diff(x.groups).tolist() == [len(w[2]) for w in want]


def test_every_character_is_split_as_by_the_library():
    v = V.load()
    first = tokenizers.Tokenizer.from_file(queries.BYTE_LEVEL)
    first.encode_special_tokens = True
    rng = random.Random(7)
    chars = [chr(c) for c in range(0x3100) if c not in range(0xD800, 0xE000)] + [chr(rng.randrange(0x3100, 0xD800)) for _ in range(1500)]
    lines = [f"a{c}b {c}{c} 1{c} {c} {c}x\n" for c in chars]
    want = [e.ids for e in first.encode_batch([" " + x for x in lines], add_special_tokens=False)]
    assert v.a.encode(lines) == want
    second = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    places = [alignment.SAFE_CUT.split(x) for x in lines]
    assert [[i for w in ws for i in v.b.encode([w])[0]] for ws in places] == second.encode(lines)


@pytest.mark.parametrize("seed", range(30))
def test_common_cuts_of_random_ends(seed):
    rng = np.random.default_rng(seed)
    ends, bounds = [[], []], [[0], [0]]
    total = 0
    for _ in range(rng.integers(1, 6)):
        size = int(rng.integers(1, 300))
        for k in (0, 1):
            inner = np.flatnonzero(rng.random(size - 1) < rng.choice([0.02, 0.3, 0.9])) + 1
            if seed % 3 == 0:       # one text's middle without any common end
                inner = inner[(inner < size * 0.1) | (inner > size * 0.9) | (inner % 2 == k)]
            ends[k].extend((total + inner).tolist() + [total + size])
            bounds[k].append(len(ends[k]))
        total += size
    a, b = (np.array(e) for e in ends)
    cuts = alignment.common_cuts(a, b, *(np.array(x) for k in (0, 1) for x in (bounds[k][:-1], bounds[k][1:])))
    common = np.intersect1d(a, b)
    assert np.array_equal(a[cuts[0]], common) and np.array_equal(b[cuts[1]], common)


def test_a_long_cutless_interval_is_one_group():
    a, b = np.append(np.arange(1, 200_001, 2), 200_001), np.append(np.arange(2, 200_001, 2), 200_001)
    one, n = np.array([0]), (np.array([len(a)]), np.array([len(b)]))
    cuts = alignment.common_cuts(a, b, one, n[0], one, n[1])
    assert [c.tolist() for c in cuts] == [[len(a) - 2, len(a) - 1], [len(b) - 1, len(b)]] or [len(c) for c in cuts] == [1, 1]


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = expected([t for _, t in rows])
    counts = Counter(link for w in want for link in w[3])
    assert len(counts) <= V.load().max_pairs
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    found = {r.doc_id: r for r in queries.op12_alignment(spark, SF).collect()}
    assert len(found) == len(rows)
    for (doc_id, _), (a, b, groups, links) in zip(rows, want, strict=True):
        r = found[doc_id]
        digest = hashlib.sha256(text_of(groups).encode()).hexdigest() if groups else ""
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256) == (len(a), len(b), len(groups), len(links), digest)
        assert r.n_best == sum(counts[x] == best[x[1]] for x in links)
        assert r.count_sum == sum(counts[x] for x in links)


def test_operator_output_edges_and_clashing_columns(spark):
    rows = [(k if k % 3 else None, t) for k, t in enumerate(ODD)]
    docs = documents(spark, rows)
    want = Counter(str((i, a, b, [(sum(len(x[0]) for x in g[:k + 1]), sum(len(x[1]) for x in g[:k + 1]), g[k][2]) for k in range(len(g))]))
                   for (i, _), (a, b, g, _) in zip(rows, expected([t for _, t in rows]), strict=True))
    got = Counter(str((r.id, r.a_ids, r.b_ids, [tuple(x) for x in r.groups])) for r in alignment.align(docs, V).collect())
    assert got == want
    scored = alignment.link_scores(docs, V).collect()
    assert len(scored) == len(rows) and sum(r.n_links == 0 and r.groups_sha256 == "" for r in scored) >= 4
    assert alignment.link_scores(documents(spark, []), V).count() == 0


def test_words_are_cached_within_a_bound(monkeypatch):
    v = alignment.Loaded(V.load().a, V.load().b)
    monkeypatch.setattr(alignment, "CACHED_CHARS", 10)
    for text in ("one two three four", "five six", "one two"):
        x = alignment.align_texts([text], v)
        assert alignment.group_text(x, v) == [text_of(w[2]) for w in expected([text])]
    assert len(v.words.index) == 4
