import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import documents
from tramspark.llm import common, exact_dedup, oracles, queries, sharding, simhash

SF = "/root/testdata/sf0.001"
LONG = "Wort und wieder Wort. " * 20_000
ROWS = [(1, "Same text"), (2, "same TEXT"), (3, "same text"), (3, "Same text"), (4, None), (5, ""), (None, "same text"),
        (6, "ÄÖ"), (7, "äö"), (8, LONG), (9, LONG.upper()), (10, LONG[:-1] + "!"), (11, "a"), (12, "b"), (13, " \t\n")]


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def check_exact(rows, found):
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    want = {}
    for t, ids in groups.items():
        for i in ids:
            want.setdefault((i, hashlib.sha256(t.encode()).hexdigest()), []).append(
                (max((x for x in ids if x is not None), default=None), len(ids)))
    got = {}
    for r in found:
        got.setdefault((r["id"], r["sha"]), []).append((r["keep_id"], r["group_size"]))
    assert {k: sorted(map(str, v)) for k, v in got.items()} == {k: sorted(map(str, v)) for k, v in want.items()}
    # one row of each class stays, and it is the one named
    assert sum(r["uid"] == r["keep_uid"] for r in found) == len(groups)


SPLITS = ("spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes")


def test_row_ids_do_not_depend_on_the_splits(spark, tmp_path):
    """Executors that come or go between two scans change the splits."""
    texts = [f"text {i % 40}" for i in range(120)]
    path = str(tmp_path / "dö cs%20+")
    documents(spark, list(enumerate(texts))).repartition(6, "doc_id").write.parquet(path)
    before = {k: spark.conf.get(k, None) for k in SPLITS}
    try:
        got = []
        for n in (1, 12):
            for k, v in zip(SPLITS, (str(n), "1"), strict=True):
                spark.conf.set(k, v)
            rows = common.numbered(spark.read.parquet(path), "row")
            got.append({r["doc_id"]: r["row"] for r in rows.collect()})
            if n == 1:
                kept = exact_dedup.keep_one(spark.read.parquet(path))   # the last scan is with the other splits
        kept = sorted((r["doc_id"], r["text"]) for r in kept.collect())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got[0] == got[1] and len(set(got[0].values())) == 120
    assert kept == [(i, texts[i]) for i in range(80, 120)]


def test_exact_duplicates_edges(spark):
    check_exact(ROWS, exact_dedup.exact_duplicates(documents(spark, ROWS)).collect())


def test_exact_duplicates_survive_collisions(spark):
    rows = [(i, f"t{i % 40}") for i in range(200)]
    # primes this small make texts collide all the time
    check_exact(rows, exact_dedup.exact_duplicates(documents(spark, rows), primes=(2, 3)).collect())


def test_exact_empty_and_keep_one(spark):
    assert exact_dedup.exact_duplicates(documents(spark, [])).count() == 0
    docs = documents(spark, ROWS)
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({lower(t) for _, t in ROWS})
    assert exact_dedup.keep_one(documents(spark, [])).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.binary(max_size=300), st.integers(1, 64))
def test_chunks_combine(data, cut):
    table = exact_dedup.power_table(chunk=16)
    whole = exact_dedup.fingerprint(np.frombuffer(data, np.uint8), table)
    left, right = (exact_dedup.fingerprint(np.frombuffer(x, np.uint8), table) for x in (data[:cut], data[cut:]))
    assert exact_dedup.combine(left, right, len(data[cut:])) == whole
    assert whole == tuple(sum(b * pow(r, len(data) - 1 - i, p) for i, b in enumerate(data)) % p
                          for r, p in zip(exact_dedup.BASES, exact_dedup.PRIMES, strict=True))


def test_hot_key_is_dealt_over_salts(spark):
    rows = spark.range(5000).selectExpr("id", "IF(id < 3000, 0L, id) AS k")
    sizes = rows.groupBy("k").count().withColumnRenamed("count", "n")
    hot = common.hot_keys(sizes, ["k"], "n", 5000, "salts")
    assert [r["k"] for r in hot.collect()] == [0]
    out = common.attach(rows, sizes, ["k"], hot, rows["id"])
    assert out.count() == 5000 and out.agg({"n": "sum"}).first()[0] == 3000 * 3000 + 2000


def test_components(spark):
    edges = [(i, i + 1) for i in range(300)] + [(500, 600 + i) for i in range(200)] + [(1000, 1001), (1001, 1000), (5, 5)]
    got = {r["node"]: r["root"] for r in common.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[i] for i in range(301)} == {0} and {got[600 + i] for i in range(200)} == {500} and got[1001] == 1000
    assert len(got) == 301 + 201 + 2


def test_sharding_law_and_slots(spark):
    rows = [(i, "x" * (i % 7)) for i in range(3000)] + [(5, "again"), (5, "again"), (None, None)]
    out = sharding.shard_documents(documents(spark, rows), 8).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r["grown_shard"] in (r["shard"], 8) and 0 <= r["shard"] < 8
        u = [(int(hashlib.md5(f"{'null' if r['doc_id'] is None else r['doc_id']}|{s}".encode()).hexdigest()[:13], 16), s)
             for s in range(9)]
        assert r["shard"] == max(u[:8])[1] and r["grown_shard"] == max(u)[1]
    by = {}
    for r in out:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert {r["shard"] for r in out if r["doc_id"] == 5}.__len__() == 1
    sizes = {(r["doc_id"], r["size"], r["text_crc32"]) for r in out}
    assert sizes == {(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows}
    assert sharding.shard_documents(documents(spark, []), 8).count() == 0


def test_sharding_weights(spark):
    out = sharding.assign(spark.range(20_000), "id", [1, 3], "s").groupBy("s").count().collect()
    share = {r["s"]: r["count"] / 20_000 for r in out}
    assert abs(share[1] - 0.75) < 0.02


def brute_simhash(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", lower(text).encode())
    if not words:
        return 0
    k = min(3, len(words))
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, max_bits=3):
    prints = [brute_simhash(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= max_bits:
                root[top(i)] = top(j)
    tops = [top(i) for i in range(len(rows))]
    least = {t: min((rows[i][0] for i in range(len(rows)) if tops[i] == t and rows[i][0] is not None), default=None) for t in tops}
    return sorted((str(rows[i][0]), prints[i], str(least[tops[i]])) for i in range(len(rows)))


def as_rows(found):
    return sorted((str(r["id"]), r["fp"] % 2**64, str(r["component_id"])) for r in found)


def test_simhash_edges(spark):
    docs = documents(spark, ROWS)
    found = simhash.near_duplicates(docs).collect()
    assert as_rows(found) == brute_components(ROWS)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == len({r["component_id"] for r in found})
    assert sum(r["first"] for r in found) == kept.count()
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


def test_op6_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op6_simhash(spark, SF).collect()
    assert sorted((str(r["doc_id"]), int(r["fingerprint"], 16), str(r["component_id"])) for r in got) == brute_components(rows)


@pytest.mark.parametrize("group_rows", [4, 1024])
def test_trie_links_in_chunks(spark, group_rows):
    rng = np.random.default_rng(3)
    values = {0, 2**64 - 1}
    for _ in range(25):
        base = int(rng.integers(0, 2**63)) * 2 + 1
        for _ in range(12):
            x = base
            for b in rng.integers(0, 64, int(rng.integers(0, 5))):
                x ^= 1 << int(b)
            values.add(x)
    values = sorted(values)
    classes = common.stored(spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long"), "test")
    edges = simhash.links(classes, 3, group_rows).collect()
    assert all((r["a"] ^ r["b"]) % 2**64 != 0 for r in edges)
    root = {v: v for v in values}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    for r in edges:
        root[top(r["a"] % 2**64)] = top(r["b"] % 2**64)
    got = [top(v) for v in values]
    for i, v in enumerate(values):
        root[v] = v
    for i, v in enumerate(values):
        for w in values[:i]:
            if (v ^ w).bit_count() <= 3:
                root[top(v)] = top(w)
    want = [top(v) for v in values]
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_trie_walk_over_thousands(spark):
    """One group of thousands under a common prefix goes through the walk whole and keeps every link of all pairs."""
    rng = np.random.default_rng(5)
    values = rng.integers(0, 1 << 48, 3000, dtype=np.uint64)
    flips = rng.integers(0, 48, (3000, 5)).astype(np.uint64)
    near = values.copy()
    for k in range(5):              # up to five flipped bits: links and near misses
        near ^= np.where(rng.random(3000) < 0.6, np.uint64(1) << flips[:, k], np.uint64(0))
    values = np.unique(np.r_[values, near])
    n, found = len(values), []
    at = (np.array([0]), np.array([n]), np.array([0]), np.array([n]))
    simhash.trie_links(values, at, 16, 3, lambda i, j: found.append(np.c_[i, j]))
    got = np.concatenate(found)
    want = [np.c_[np.full(len(js), i), js] for i in range(n)
            for js in [i + 1 + np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= 3)]]
    assert sorted(map(tuple, got.tolist())) == sorted(map(tuple, np.concatenate(want).tolist()))
    classes = common.stored(spark.createDataFrame([(int(v),) for v in values], "fp long"), "walk")
    edges = simhash.links(classes).collect()
    assert all(int(r["a"] ^ r["b"]).bit_count() > 0 for r in edges)
    forest, where = simhash.Forest(n), {int(v): k for k, v in enumerate(values)}
    ends = np.array([(where[r["a"]], where[r["b"]]) for r in edges])
    forest.links(ends[:, 0], ends[:, 1])
    whole = simhash.Forest(n)
    whole.links(got[:, 0], got[:, 1])
    assert (forest.root == whole.root).all()


def test_components_without_edges(spark):
    assert common.components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("name", ["op2_sharding", "op9_exact_dedup"])
def test_contract_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    got = queries.QUERIES[name](spark, SF)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({oracles.ORACLES[name]})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
