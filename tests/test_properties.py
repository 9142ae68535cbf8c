"""Property-based checks (hypothesis): operators against brute force on random inputs."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import AS_OF, ago, equipment_row, make_tables, wt_row

from waferline.operators.intervals import interval_aggregate
from waferline.plans import layers as L
from waferline.plans import yields as Y

T0 = datetime(2024, 1, 1)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

minutes = st.integers(min_value=0, max_value=3 * 24 * 60)


@SETTINGS
@given(wins=st.lists(st.tuples(st.integers(0, 2), minutes, st.integers(0, 300)), min_size=1, max_size=25),
       evs=st.lists(st.tuples(st.integers(0, 2), minutes), max_size=60),
       bucket=st.sampled_from([600, 3600, 86400]))
def test_interval_aggregate_matches_brute_force(spark, wins, evs, bucket):
    w = [(k, T0 + timedelta(minutes=s), T0 + timedelta(minutes=s + d)) for k, s, d in wins]
    e = [(k, T0 + timedelta(minutes=m)) for k, m in evs]
    wdf = spark.createDataFrame(w, "k int, s timestamp_ntz, e timestamp_ntz")
    edf = spark.createDataFrame(e, "k int, t timestamp_ntz") if e else spark.createDataFrame([], "k int, t timestamp_ntz")
    got = {(r.k, r.s, r.e): r.n for r in
           interval_aggregate(wdf, edf, "k", "s", "e", "t", [F.count(F.lit(1)).alias("n")], bucket).collect()}
    want = {}
    for k, s, en in set(w):
        n = sum(1 for kk, t in e if kk == k and s <= t <= en)
        if n:
            want[(k, s, en)] = n
    assert got == want


@SETTINGS
@given(counts=st.lists(st.integers(1, 40), min_size=1, max_size=8))
def test_pareto_shares_sum_to_100(spark, counts):
    tests = []
    for b, c in enumerate(counts):
        tests += [wt_row(f"W{b}_{i}", "B1", 1, "T", ago(days=1), result="FAIL", bin_code=f"BIN{b}") for i in range(c)]
    out = Y.y5_defect_pareto(make_tables(spark, equipment=[equipment_row("T")], tests=tests), AS_OF).collect()
    assert abs(sum(r.pct_of_total for r in out) - 100) <= 0.005 * len(counts) + 1e-9
    assert abs(max(r.cumulative_pct for r in out) - sum(r.pct_of_total for r in out)) < 1e-9
    cums = [r.cumulative_pct for r in out]
    assert cums == sorted(cums)


@SETTINGS
@given(target=st.lists(st.tuples(st.integers(0, 6), st.integers(0, 9), st.integers(0, 5)), max_size=12),
       updates=st.lists(st.tuples(st.integers(0, 6), st.integers(0, 9), st.integers(0, 5)), max_size=12))
def test_upsert_is_idempotent_and_keeps_latest(spark, target, updates):
    schema = "k int, v int, ing timestamp_ntz"

    def df(rows):
        return spark.createDataFrame([(k, v, T0 + timedelta(hours=h)) for k, v, h in rows], schema)
    once = L.upsert(df(target), df(updates), ["k"], ["ing"])
    twice = L.upsert(once, df(updates), ["k"], ["ing"])
    a = sorted(tuple(r) for r in once.collect())
    assert a == sorted(tuple(r) for r in twice.collect())
    latest = {}
    for k, v, h in target + updates:
        latest[k] = max(latest.get(k, (-1, -1)), (h, v))
    assert {r[0]: (int((r[2] - T0).total_seconds() // 3600), r[1]) for r in a} == latest
