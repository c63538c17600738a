"""Numeric and parsing parity helpers."""

import datetime as dt
import math

from pyspark.sql import functions as F

from tramspark.functions import scalar as S


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_binary_scaling_round(spark):
    assert one(spark, S.duck_round(F.lit(1.005), 2)) == 1.0
    assert one(spark, S.duck_round(F.lit(0.285), 2)) == 0.28
    assert one(spark, S.duck_round(F.lit(2.5), 0)) == 3.0
    assert one(spark, S.duck_round(F.lit(-2.5), 0)) == -3.0
    z = one(spark, S.duck_round(F.lit(-0.01), 1))
    assert z == 0.0 and math.copysign(1.0, z) == -1.0


def test_lenient_int(spark):
    assert one(spark, S.try_int(F.lit("1.5"))) == 2
    assert one(spark, S.try_int(F.lit("-1.5"))) == -2
    assert one(spark, S.try_int(F.lit("1e3"))) == 1000
    assert one(spark, S.try_int(F.lit("abc"))) is None
    assert one(spark, S.try_int(F.lit(None).cast("string"))) is None


def test_dates_need_full_text(spark):
    assert one(spark, S.try_date(F.lit("2026"))) is None
    assert one(spark, S.try_date(F.lit("2026-07"))) is None
    assert one(spark, S.try_date(F.lit("M1-abc"))) is None
    assert one(spark, S.try_date(F.lit("2026-07-22"))) == dt.date(2026, 7, 22)
    assert one(spark, S.try_timestamp(F.lit("2026-07-22T14:30:12"))) == dt.datetime(2026, 7, 22, 14, 30, 12)
    assert one(spark, S.try_timestamp(F.lit("fetch_time"))) is None


def test_time_of_day_past_midnight(spark):
    d = F.lit("2026-07-22").cast("date")
    assert one(spark, S.add_time_of_day(d, F.lit("25:30:00"))) == dt.datetime(2026, 7, 23, 1, 30)
    assert one(spark, S.add_time_of_day(d, F.lit("07:05:09"))) == dt.datetime(2026, 7, 22, 7, 5, 9)
    assert one(spark, S.add_time_of_day(d, F.lit("xx:10:00"))) is None
    assert one(spark, S.add_time_of_day(d, F.lit("10:00"))) is None


def test_seconds_count_boundaries(spark):
    a = F.lit("2024-01-01 00:00:00.9").cast("timestamp_ntz")
    b = F.lit("2024-01-01 00:00:01.1").cast("timestamp_ntz")
    assert one(spark, S.seconds_between(a, b)) == 1


def test_exact_grid_mean_and_median(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.2,), (0.3,)], "x double")
    r = df.agg(S.avg_of_scaled("x", 1).alias("a"), S.median_of_scaled("x", 1).alias("m")).first()
    assert r["a"] == 0.2 and r["m"] == 0.2


def test_round_matches_duckdb_on_random_doubles(spark):
    import random

    import duckdb
    rnd = random.Random(11)
    vals = [rnd.uniform(-200, 200) for _ in range(1500)] + [k / 1000 for k in range(-2000, 2000, 5)] + \
           [x + 0.005 for x in range(-20, 20)] + [1.005, 0.285, 2.675, -0.05, -0.0]
    df = spark.createDataFrame(list(enumerate(vals)), "i int, x double")
    got = df.select("i", *[S.duck_round("x", n).alias(f"r{n}") for n in (0, 1, 2, 3)]).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(vals)))
    want = {r[0]: r[1:] for r in con.execute("SELECT i, round(x, 0), round(x, 1), round(x, 2), round(x, 3) FROM t")
            .fetchall()}
    for r in got:
        w = want[r["i"]]
        for n in range(4):
            assert r[f"r{n}"] == w[n] and math.copysign(1, r[f"r{n}"]) == math.copysign(1, w[n]), (vals[r["i"]], n)


def test_lenient_parsing_matches_duckdb(spark):
    import duckdb
    texts = ["1", " 2 ", "1.5", "2.5", "-1.5", "1e3", "abc", "", "3.", ".5", "0x10", "+7", "2147483647",
             "2147483648", "-2147483648.4", "2147483647.5", "0X1f", "0b101", "-0x10", "0x", "1_000", "1__0", "_1", "1_",
             "1_000.5", "1e-3", "1.5e1", "2026-07-22 ", " 2026-07-22", "2026-07-22 25:00:00", "2026-07-22 14",
             "2026-07-22x", "2026-07-22 14:30:61", "20260722", "1d", "1f", "2.5F",
             "0x1p3", "1e400", "1.", ".5", "2026-07-22", "2026-7-2", "2026", "2026-07", "2026-07-22T14:30:12", "2026-07-22 14:30",
             "2026-07-22 14:30:12.123456", "fetch_time", "M1-abc", "2026-13-01", "2026-02-30"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r for r in df.select("t", S.try_int("t").alias("i"), S.try_date("t").alias("d"),
                                        S.try_timestamp("t").alias("ts"), S.try_double("t").alias("f")).collect()}
    con = duckdb.connect()
    for t in texts:
        i, d, ts, f = con.execute("SELECT try_cast(? AS INTEGER), try_cast(? AS DATE), try_cast(? AS TIMESTAMP), "
                                  "try_cast(? AS DOUBLE)", [t, t, t, t]).fetchone()
        assert (got[t]["i"], got[t]["d"], got[t]["ts"]) == (i, d, ts), t
        gf = got[t]["f"]
        assert (gf is None and f is None) or (gf == f) or (math.isnan(gf) and math.isnan(f)), (t, gf, f)
    # numeric specials (the reference engine also reads 'Infinity' as an
    # infinite timestamp, which has no counterpart here)
    specials = ["Infinity", "-Infinity", "inf", "-inf", "NaN", "nan"]
    sp = spark.createDataFrame([(t,) for t in specials], "t string")
    got = {r["t"]: r for r in sp.select("t", S.try_int("t").alias("i"), S.try_double("t").alias("f")).collect()}
    for t in specials:
        i, f = con.execute("SELECT try_cast(? AS INTEGER), try_cast(? AS DOUBLE)", [t, t]).fetchone()
        gf = got[t]["f"]
        assert got[t]["i"] == i and ((gf == f) or (math.isnan(gf) and math.isnan(f))), t
