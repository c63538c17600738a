from collections import Counter

import duckdb
import pandas as pd
import sentencepiece

from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm.helpers import documents
from tests.llm.test_dedup_shard_simhash import brute_simhash, lower
from tramspark.llm import common, language, oracles, queries
from tramspark.session import shared_dir

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def key(r):
    return tuple(sorted((k, str(v)) for k, v in r.items()))


def same(got, want):
    assert Counter(map(key, got)) == Counter(map(key, want))


def components(rows):
    prints = [brute_simhash(r["text"]) for r in rows]
    top = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 and top[i] != top[j]:
                top = [top[j] if t == top[i] else t for t in top]
    return top


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    longest = docs.orderBy(F.length("text").desc()).limit(6)
    near = longest.select((F.col("doc_id") + 100_000).alias("doc_id"), F.concat("text", F.lit(" und Schluss")).alias("text"),
                          "lang", "source", "n_chars")
    path = shared_dir(spark, "pipeline-input")
    docs.unionByName(near).write.parquet(f"{path}/documents.parquet")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    rows = rows_of(docs)

    # language: the same model applied to one text after the other
    model = language.fit(docs)
    kept = []
    for r in rows:
        names, scores = language.label(model, [r["text"]])
        if names[0] != "und" and scores[0] >= cp.MIN_LANGUAGE:
            kept.append(r)
    docs = common.stored(cp.language_stage(spark, docs, SF), "t1")
    rows = rows_of(docs)
    same(rows, kept)

    by = {}
    for r in rows:
        by.setdefault(lower(r["text"]), []).append(r)
    docs = common.stored(cp.exact_stage(spark, docs, SF), "t2")
    got = rows_of(docs)
    same(got, [max(v, key=lambda r: r["doc_id"]) for v in by.values()])
    rows = got

    by = {}
    for r, t in zip(rows, components(rows), strict=True):
        by.setdefault(t, []).append(r)
    docs = common.stored(cp.simhash_stage(spark, docs, SF), "t3")
    got = rows_of(docs)
    same(got, [min(v, key=lambda r: r["doc_id"]) for v in by.values()])
    assert len(got) < len(rows)
    rows = got

    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows))
    epochs = dict(con.execute(f"SELECT doc_id, epochs FROM ({oracles.OP5.replace('* 4.0', '* 2.0')})").fetchall())
    docs = common.stored(cp.mixing_stage(spark, docs, SF), "t4")
    got = rows_of(docs)
    same(got, [r for r in rows for _ in range(epochs[r["doc_id"]])])
    rows = got

    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    out = rows_of(cp.pieces_stage(spark, docs, SF))
    same(out, [{"doc_id": r["doc_id"], "n_tokens": len(ids := library.encode(r["text"])), "ids": ids, "round_trip": True} for r in rows])
    same(rows_of(cp.run(spark, path)), out)


def test_awkward_rows_go_through_all_stages(spark):
    long = "The tram runs on time today and the next one too. " * 5000
    rows = [(1, "Plain words in a row here.", "en", "a"), (2, "Plain words in a row here.", "en", "a"), (2, "Plain words in a row here.", "en", "a"),
            (3, None, "en", None), (4, "", None, "b"), (None, "Another text of some words.", "en", "a"), (5, long, "en", "b"), (6, long.upper(), "en", "b"),
            (7, "1 2 3", "en", "c"), (8, "Ein ganz anderer Text mit vielen Wörtern.", "de", "c")]
    for given in (rows, []):
        docs = documents(spark, given)
        columns = docs.columns
        docs = common.stored(docs, "awkward")
        for _, stage in cp.STAGES[:-1]:
            docs = common.stored(stage(spark, docs, SF), "awkward")
            assert docs.columns == columns
        out = cp.STAGES[-1][1](spark, docs, SF).collect()
        ids = [r["doc_id"] for r in out]
        assert (sorted(set(ids), key=str) == sorted({2, None, 6, 8}, key=str)) if given else not ids


def test_stage_names_and_entry():
    import __spark_entry__
    assert [s[0] for s in cp.STAGES] == ["language ID", "exact dedup", "SimHash near-dedup", "mixing", "SentencePiece"]
    names = set(__spark_entry__.queries())
    assert {"pipeline", *queries.QUERIES} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= names
