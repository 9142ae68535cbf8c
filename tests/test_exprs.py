from datetime import date, datetime

from pyspark.sql import functions as F

from waferline.functions.exprs import pct, round_avg, safe_corr, ts_diff, yearweek


def test_yearweek_sunday_weeks(spark):
    df = spark.createDataFrame([(date(2024, 1, 6),), (date(2024, 1, 7),), (date(2023, 12, 31),),
                                (date(2024, 12, 31),), (date(2021, 1, 2),)], "d date")
    got = [r[0] for r in df.select(yearweek(F.col("d").cast("timestamp_ntz"))).collect()]
    assert got == [202353, 202401, 202353, 202452, 202052]


def test_timestampdiff_truncates_whole_units(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 59), datetime(2024, 1, 1, 1, 1)),
                                (datetime(2024, 1, 1, 0, 0), datetime(2024, 1, 1, 0, 59, 59))],
                               "a timestamp_ntz, b timestamp_ntz")
    got = df.select(ts_diff("HOUR", "a", "b").alias("h"), ts_diff("MINUTE", "a", "b").alias("m")).collect()
    assert [(r.h, r.m) for r in got] == [(0, 2), (0, 59)]


def test_safe_corr_constant_and_single_pair_are_null(spark):
    df = spark.createDataFrame([("c", 1.0, 5.0), ("c", 2.0, 5.0), ("one", 1.0, 2.0),
                                ("ok", 1.0, 2.0), ("ok", 2.0, 4.0), ("ok", 3.0, 7.0)], "g string, x double, y double")
    got = dict(df.groupBy("g").agg(safe_corr("x", "y").alias("r")).collect())
    assert got["c"] is None and got["one"] is None
    import numpy as np
    assert abs(got["ok"] - np.corrcoef([1, 2, 3], [2, 4, 7])[0, 1]) < 1e-12


def test_pct_division_by_zero_is_null(spark):
    r = spark.range(1).select(pct(F.lit(3), F.lit(0)).alias("a"), pct(F.lit(1), F.lit(8)).alias("b")).first()
    assert r.a is None and r.b == 12.5


def test_round_avg_is_exact_on_ties(spark):
    # (10.1 + 10.2) / 2 = 10.15 exactly: half-up gives 10.2 (a DOUBLE sum gives 10.149999...)
    df = spark.createDataFrame([(10.1,), (10.2,)], "v double").repartition(2)
    assert df.agg(round_avg("v", 1)).first()[0] == 10.2
    df = spark.createDataFrame([(0.04,), (0.051,)], "v double")
    assert df.agg(round_avg("v", 3)).first()[0] == 0.046
