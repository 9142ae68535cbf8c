import os
import tempfile
from datetime import datetime, timedelta

import duckdb
import pytest

from pyspark.sql import functions as F

import __spark_entry__ as E
from waferline.streaming import pipeline as S
from waferline.streaming import queries as SQ

SF = "/root/testdata/sf0.001"


def _write_events(spark, folder, rows):
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                                "value double, props string").coalesce(1).write.parquet(folder)


def test_stream_daily_windows_equal_batch_on_closed_windows(spark):
    base = tempfile.mkdtemp(prefix="wl-stream-")
    t0 = datetime(2024, 1, 1, 6)
    rows = [(i, t0 + timedelta(hours=5 * i), i % 3, ["view", "error", "signup"][i % 3], 1.0, '{"k": 5}')
            for i in range(40)]
    _write_events(spark, f"{base}/in/part1", rows[:20])
    _write_events(spark, f"{base}/in/part2", rows[20:])
    stream = S.daily_metrics(S.late_tolerant(S.event_stream(spark, f"{base}/in/*", max_files_per_trigger=1)))
    out = S.run_available_now(stream, f"{base}/out", f"{base}/ck")
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    max_ts = max(r[1] for r in rows)
    want = {}
    for i, ts, tool, et, _, _ in rows:
        day = datetime(ts.year, ts.month, ts.day)
        if day + timedelta(days=1) <= max_ts - timedelta(hours=24):
            k = (day, day + timedelta(days=1), tool)
            e, r, a, d = want.get(k, (0, 0, 0, 0))
            want[k] = (e + 1, r + (et == "view"), a + (et == "error"), d + (et == "signup"))
    assert got == sorted(k + v for k, v in want.items())


def test_stream_dedupe_drops_redelivered_events(spark):
    d = SQ.s3_stream_dedupe(spark, SF)
    assert d.count() == d.select("event_id").distinct().count() == spark.read.parquet(f"{SF}/events.parquet").count()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["equipment_id", "equipment_type", "manufacturer"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_listed():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert {n for n in set(q) - set(o) if not n.startswith("op") and n != "pipeline"} == set()


def own_oracles():
    """Those of this library's own tables (the training-data operators have their tests)."""
    return sorted(n for n in E.oracle_sql() if not n.startswith("op"))


TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    import math
    import pandas as pd
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    if type(v).__name__ == "date":
        return datetime(v.year, v.month, v.day)
    return v


@pytest.mark.parametrize("name", own_oracles())
def test_query_matches_duckdb_oracle_sf0001(spark, duck, name):
    s = E.queries()[name](spark, SF).toPandas()
    o = duck.sql(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(o.columns)
    cols = sorted(s.columns)

    def key(df):
        out = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
        return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))
    assert key(s) == key(o)
    _ = os


@pytest.mark.parametrize("name", ["e2_mtbf", "b7_contamination", "sf6_yearweek", "s4_daily_metrics"])
def test_results_do_not_depend_on_session_time_zone(spark, name):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    a = sorted(tuple(r) for r in E.queries()[name](spark, SF).collect())
    b = sorted(tuple(r) for r in E.queries()[name](other, SF).collect())
    assert a == b


def test_foreach_batch_sink_replay_is_idempotent(spark):
    base = tempfile.mkdtemp(prefix="wl-epoch-")
    rows = [(i, datetime(2024, 1, 1) + timedelta(hours=i), 1, "error", 600.0, '{"k": 5}') for i in range(6)]
    _write_events(spark, f"{base}/in/p1", rows)
    counts = S.batch_rule_counts()
    out = S.run_available_now(S.event_stream(spark, f"{base}/in/*"), f"{base}/out", f"{base}/ck", foreach=counts)
    first = sorted(tuple(r) for r in spark.read.parquet(out).select("rule_id", "violations").collect())
    # replay epoch 0 by hand, as Spark would after a failure before the commit
    replay = spark.read.parquet(f"{base}/in/p1")
    from waferline.sources.driver import map_events
    counts(map_events(replay), 0).write.mode("overwrite").parquet(f"{out}/epoch=0")
    again = sorted(tuple(r) for r in spark.read.parquet(out).select("rule_id", "violations").collect())
    assert first == again and ("DQ009", 6) in first
