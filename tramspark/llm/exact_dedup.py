"""Exact duplicates by composable polynomial fingerprints.

A text is normalised (A-Z lower-cased, nothing else), cut into chunks, and
each chunk is hashed on its own: two polynomials over its UTF-8 bytes, modulo
two primes.  Chunk hashes combine by shifting the left one by the right one's
length, so the chunks of a huge text can be hashed in any order or place.
Rows with equal (fingerprints, length) are only candidates: each is compared
with its group's representative chunk by chunk, and rows that differ form new
groups among themselves until none is left, so a collision never merges texts.

Rules: null text counts as empty; of equal texts the row with the largest id
stays (null ids are smallest; among rows of one id one row stays); an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramspark.llm import common

CHUNK = 4096                              # bytes hashed at once; sums stay below 2**63
PRIMES = (2_147_483_647, 2_147_483_629)   # the two largest primes below 2**31
BASES = (1_103_515_245, 69_069_069)


def power_table(primes: Sequence[int] = PRIMES, chunk: int = CHUNK) -> np.ndarray:
    """Row i holds base**(chunk - 1 - i) modulo each prime."""
    table = np.empty((chunk, 2), dtype=np.uint64)
    for k, (p, b) in enumerate(zip(primes, BASES, strict=True)):
        x = 1
        for i in range(chunk - 1, -1, -1):
            table[i, k] = x
            x = x * b % p
    return table


def chunk_hash(data: np.ndarray, table: np.ndarray, primes: Sequence[int] = PRIMES) -> tuple[int, int]:
    """Polynomial hashes of one chunk (uint8, at most as many bytes as the table has rows)."""
    sums = data.astype(np.uint64) @ table[len(table) - len(data):]
    return int(sums[0]) % primes[0], int(sums[1]) % primes[1]


def combine(left: tuple[int, int], right: tuple[int, int], right_bytes: int,
            primes: Sequence[int] = PRIMES) -> tuple[int, int]:
    """Hash of two adjacent pieces from their hashes: the left one is shifted by the right one's length."""
    return tuple((a * pow(b, right_bytes, p) + c) % p
                 for a, c, p, b in zip(left, right, primes, BASES, strict=True))


def fingerprint(data: np.ndarray, table: np.ndarray, primes: Sequence[int] = PRIMES) -> tuple[int, int]:
    chunk, out = len(table), (0, 0)
    for s in range(0, len(data), chunk):
        part = data[s:s + chunk]
        out = combine(out, chunk_hash(part, table, primes), len(part), primes)
    return out


def _bytes_of(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """One lower-cased (A-Z) buffer with all texts and the row offsets into it; nulls are empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    start, end = int(offsets[0]), int(offsets[-1])
    data = column.buffers()[2]
    return (data[start:end].to_pybytes().lower() if data is not None else b""), offsets - start


def _fingerprints(primes: Sequence[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = power_table(primes)
        for batch in batches:
            buf, offsets = _bytes_of(batch.column("text"))
            flat, view = np.frombuffer(buf, np.uint8), memoryview(buf)
            fp1, fp2, sha = [], [], []
            for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                a, b = fingerprint(flat[s:e], table, primes)
                fp1.append(a)
                fp2.append(b)
                sha.append(hashlib.sha256(view[s:e]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), batch.column("id"), pa.array(fp1, pa.int64()), pa.array(fp2, pa.int64()),
                 pa.array(np.diff(offsets), pa.int64()), pa.array(sha, pa.string())],
                names=["uid", "id", "fp1", "fp2", "len", "sha"])
    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, ao = _bytes_of(batch.column("text"))
        b, bo = _bytes_of(batch.column("rep_text"))
        a, b, same = memoryview(a), memoryview(b), []
        for s, e, t, u in zip(ao[:-1].tolist(), ao[1:].tolist(), bo[:-1].tolist(), bo[1:].tolist(), strict=True):
            same.append(e - s == u - t and all(a[s + k:min(s + k + CHUNK, e)] == b[t + k:min(t + k + CHUNK, u)]
                                               for k in range(0, e - s, CHUNK)))
        yield pa.RecordBatch.from_arrays([batch.column("uid"), pa.array(same, pa.bool_())], names=["uid", "same"])


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     primes: Sequence[int] = PRIMES) -> DataFrame:
    """Duplicate classes of ``docs``: (uid, id, keep_uid, keep_id, group_size, sha), one row per input row.

    ``uid`` is the row id of :func:`common.numbered` over ``docs``.
    """
    rows = common.numbered(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "uid")
    prints = common.stored(rows.select("uid", "id", "text").mapInArrow(
        _fingerprints(primes), "uid long, id long, fp1 long, fp2 long, len long, sha string"), "fingerprints")
    key = ["fp1", "fp2", "len"]
    pending = prints.select("uid", "id", *key)
    total = prints.count()
    found = []
    while True:
        groups = common.stored(pending.groupBy(*key).agg(F.count("*").alias("n"), F.max(F.struct("id", "uid")).alias("rep"))
                               .filter("n > 1").select(*key, "n", F.col("rep.id").alias("rep_id"),
                                                       F.col("rep.uid").alias("rep_uid")), "print-groups")
        if groups.isEmpty():
            break
        hot = common.hot_keys(groups, key, "n", total, "salts")
        members = common.stored(common.attach(pending, groups.drop("n"), key, hot, F.col("uid")), "print-members")
        # only the members' texts move, each row once by its unique id
        texts = common.stored(rows.select("uid", "text").join(
            members.select("uid", "rep_uid").hint("shuffle_hash"), "uid"), "member-texts")
        reps = texts.filter("uid = rep_uid").select("rep_uid", F.col("text").alias("rep_text"))
        hot_reps = common.hot_keys(groups, ["rep_uid"], "n", total, "salts")
        pairs = common.attach(texts.filter("uid <> rep_uid"), reps, ["rep_uid"], hot_reps, F.col("uid"))
        verdict = pairs.select("uid", "text", "rep_text").mapInArrow(_compare, "uid long, same boolean")
        checked = common.stored(members.join(verdict, "uid", "left")
                                .select("uid", "id", *key, "rep_id", "rep_uid",
                                        F.coalesce("same", F.lit(True)).alias("same")), "print-checked")
        found.append(checked.filter("same").select("uid", "rep_id", "rep_uid"))
        pending = checked.filter("not same").select("uid", "id", *key)
        if pending.isEmpty():
            break
    out = prints.select("uid", "id", "sha")
    if not found:
        return out.select("uid", "id", F.col("uid").alias("keep_uid"), F.col("id").alias("keep_id"),
                          F.lit(1).cast("long").alias("group_size"), "sha")
    classes = found[0]
    for more in found[1:]:
        classes = classes.unionByName(more)
    sizes = classes.groupBy("rep_uid").agg(F.count("*").alias("n"))
    sized = common.attach(classes, sizes, ["rep_uid"], common.hot_keys(sizes, ["rep_uid"], "n", total, "salts"),
                          F.col("uid"))
    return (out.join(sized.select("uid", "rep_uid", "rep_id", "n"), "uid", "left")
            .select("uid", "id", F.coalesce("rep_uid", "uid").alias("keep_uid"),
                    F.when(F.col("rep_uid").isNull(), F.col("id")).otherwise(F.col("rep_id")).alias("keep_id"),
                    F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), "sha"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class of equal texts, all columns kept."""
    docs = common.scanned(docs)
    uid = common.fresh("__uid", docs.columns)
    dropped = exact_duplicates(docs, id_col, text_col).filter("uid <> keep_uid").select(F.col("uid").alias(uid))
    return common.without(common.numbered(docs, uid), dropped, uid)
