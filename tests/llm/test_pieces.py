import random

import duckdb
import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from tests.llm.helpers import documents
from tramspark.llm import pieces, queries

SF = "/root/testdata/sf0.001"
EDGES = ["", " ", "  a   b    c\n\n\td ", "         x", "日本語 テスト 🎉🎉 ok", "a▁b ▁▁c", "x" * 3000, "tab\tand\x00nul",
         "aaaaaaaaaaaaaaaaaaaaaaaa bbbbbbb", "    " * 9 + "def f(x):\n        return x", "wörter straße ciónes", "<s> </s> <0x41>"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    made = ["".join(rng.choice("abcdefgh é\n.,-  тежшш") for _ in range(rng.randint(1, 200))) for _ in range(200)]
    return EDGES + made + [r[0] for r in duckdb.connect().execute(f"SELECT text FROM '{SF}/documents.parquet'").fetchall()]


def proto(kind=None, byte_pieces=True):
    p = pb.ModelProto()
    with open(queries.PIECES, "rb") as f:
        p.ParseFromString(f.read())
    if kind == pieces.UNIGRAM:
        # sums of these scores are exact, so that rounding decides no tie
        p.trainer_spec.model_type = pieces.UNIGRAM
        rng = np.random.default_rng(0)
        for x in p.pieces:
            if x.type == pieces.NORMAL:
                x.score = -3 - int(rng.integers(0, 12 * 256)) / 256
    if not byte_pieces:
        p.trainer_spec.byte_fallback = False
        kept = [x for x in p.pieces if x.type != pieces.BYTE]
        del p.pieces[:]
        p.pieces.extend(kept)
    return p


@pytest.mark.parametrize("kind,byte_pieces", [(pieces.BPE, True), (pieces.UNIGRAM, True), (pieces.BPE, False), (pieces.UNIGRAM, False)])
def test_equals_the_public_library(texts, kind, byte_pieces, monkeypatch):
    monkeypatch.setattr(pieces, "CACHED_WORDS", 3000)      # the words kept run out on the way
    p = proto(kind, byte_pieces)
    library = sentencepiece.SentencePieceProcessor(model_proto=p.SerializeToString())
    model = pieces.from_proto(p)
    encoder = pieces.Encoder(model)
    for s in range(0, len(texts), 50):
        part = texts[s:s + 50]
        flat, offsets = encoder.encode(part)
        for i, t in enumerate(part):
            assert flat[offsets[i]:offsets[i + 1]].tolist() == library.encode(t), t
        back = pieces.Decoder(model).decode(flat, offsets)
        if byte_pieces:
            assert back == [t.replace("▁", " ") for t in part]
        assert back == [library.decode(library.encode(t)) for t in part]


def test_encode_and_decode_tables(spark):
    rows = [(i, t) for i, t in enumerate(EDGES)] + [(90, None), (90, None), (None, "no id")]
    out = pieces.encode(documents(spark, rows), queries.PIECES, check=True)
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    got = sorted(((str(r["id"]), r["n_tokens"], r["ids"]) for r in out.collect()), key=str)
    assert got == sorted(((str(i), len(ids := library.encode(t or "")), ids) for i, t in rows), key=str)
    assert all(r["round_trip"] for r in out.collect() if r["id"] != 5)
    back = pieces.decode(out, queries.PIECES).collect()
    assert sorted((str(r["id"]), r["text"]) for r in back) == sorted((str(i), (t or "").replace("▁", " ")) for i, t in rows)
    assert pieces.encode(documents(spark, []), queries.PIECES).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, [])], "id long, ids array<int>")
    assert [r["text"] for r in pieces.decode(nothing, queries.PIECES).collect()] == ["", ""]


def test_op1_whole_table(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op1_sentencepiece(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r["round_trip"] and r["ids"] == library.encode(texts[r["doc_id"]]) and r["n_tokens"] == len(r["ids"])


def test_merging_by_steps_is_near_linear_in_a_run_of_blanks():
    import time
    rng = random.Random(2)
    m = pieces.load(queries.PIECES)
    node_of = {"".join(map(chr, c)): int(k) for n in m.keys for c, k in zip(m.chars[n].tolist(), m.nodes[n].tolist(), strict=True)}

    def plainly(word):
        parts = list(word)
        while True:
            found = [(-float(m.score[k]), i) for i in range(len(parts) - 1) if (k := node_of.get(parts[i] + parts[i + 1])) is not None]
            if not found:
                return [node_of.get(p, 0) for p in parts]
            i = min(found)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    for _ in range(300):
        word = "".join(rng.choice("▁▁▁▁abthe\n é") for _ in range(rng.randint(1, 60)))
        assert pieces._merge_by_steps(m, word, node_of) == plainly(word)
    start = time.time()
    assert sum(1 for _ in pieces._merge_by_steps(m, "▁" * 100_000, node_of)) > 1000
    assert time.time() - start < 10
