"""Kept KPIs, incremental runs and rules that fail while they run."""

from __future__ import annotations

import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import ago, batch_row, equipment_row, event_row, make_tables, rows, wt_row

from waferline.plans import kept as K
from waferline.plans import layers as L
from waferline.plans import quality as Q
from waferline.sources.layers import read_watermarks


def day_tests(days, wafers=3, result="PASS", batch="B1"):
    return [wt_row(f"W{w}", batch, s, "T", ago(days=d), result=result) for d in days for w in range(wafers) for s in (1, 2)]


def kept(spark, root):
    return sorted(rows(K.read_kept(spark, root, K.DAILY_YIELD), "test_date", "recipe", "tests", "wafers", "passed", "yield_pct"), key=str)


def full(spark, tests, batches):
    t = make_tables(spark, tests=tests, batches=batches)
    return sorted(rows(K.DAILY_YIELD.finish(K.DAILY_YIELD.partial(K.yield_rows(t.fact_wafer_tests, t.dim_wafer_batches))),
                       "test_date", "recipe", "tests", "wafers", "passed", "yield_pct"), key=str)


def add(spark, root, tests, batches, load):
    t = make_tables(spark, tests=tests, batches=batches)
    return K.refresh(spark, root, K.DAILY_YIELD, K.yield_rows(t.fact_wafer_tests, t.dim_wafer_batches), load)


BATCHES = [batch_row("B1", ago(days=9)), batch_row("B2", ago(days=9), recipe=None)]


def test_loads_in_any_order_give_one_full_build(spark, tmp_path):
    """Late rows, wafers seen in two loads, null recipes, wafers and dates, an empty load, a repeated load."""
    nulls = [(*r[:10], None) for r in day_tests([3], 1)] + [(None, *r[1:]) for r in day_tests([3], 1)]
    loads = [day_tests([5, 4]), day_tests([3, 2], result="FAIL", batch="B2") + nulls, [], day_tests([5, 1], 5, "FAIL")]
    for n, order in enumerate(([0, 1, 2, 3], [3, 1, 0, 2, 1])):
        root = str(tmp_path / f"r{n}")
        for k in order:
            add(spark, root, loads[k], BATCHES, str(k))
        assert kept(spark, root) == full(spark, sum(loads, []), BATCHES)


def test_a_load_touches_its_own_days_only(spark, tmp_path):
    root = str(tmp_path)
    add(spark, root, day_tests([5, 4]), BATCHES, "1")
    day = ago(days=4) + timedelta(minutes=20)
    other = next(p for p in os.listdir(f"{root}/curated/daily_yield") if p.startswith("day=") and str(day.date()) not in p)
    stamp = sorted(os.listdir(f"{root}/curated/daily_yield/{other}"))
    assert add(spark, root, day_tests([4], 9), BATCHES, "2") == [str(day.date())]
    assert sorted(os.listdir(f"{root}/curated/daily_yield/{other}")) == stamp


def test_a_load_run_again_with_other_rows_replaces_what_it_brought(spark, tmp_path):
    root = str(tmp_path)
    add(spark, root, day_tests([5]), BATCHES, "1")
    add(spark, root, day_tests([4, 3]), BATCHES, "2")
    add(spark, root, day_tests([3], 7), BATCHES, "2")      # day 4 was wrong: it goes
    assert kept(spark, root) == full(spark, day_tests([5]) + day_tests([3], 7), BATCHES)
    add(spark, root, [], BATCHES, "2")
    assert kept(spark, root) == full(spark, day_tests([5]), BATCHES)


def test_a_load_that_dies_after_its_state_is_run_again(spark, tmp_path):
    root = str(tmp_path)
    add(spark, root, day_tests([5]), BATCHES, "1")
    broken = K.KeptKpi("daily_yield", "test_date", ("recipe", "wafer_id"), ("tests", "passed"),
                       lambda st: (_ for _ in ()).throw(RuntimeError("killed")))
    t = make_tables(spark, tests=day_tests([5, 4]), batches=BATCHES)
    with pytest.raises(RuntimeError):
        K.refresh(spark, root, broken, K.yield_rows(t.fact_wafer_tests, t.dim_wafer_batches), "2")
    assert kept(spark, root) == full(spark, day_tests([5]), BATCHES)     # the old table still stands
    add(spark, root, day_tests([5, 4]), BATCHES, "2")
    assert kept(spark, root) == full(spark, day_tests([5]) + day_tests([5, 4]), BATCHES)


def fab(spark, bad_batch=False):
    start = ago(days=9)
    events = [event_row("T", ago(days=d, hours=h), "RUNNING" if h % 2 else "DOWN", ingest=ago(days=d, hours=h) + timedelta(hours=30 if h == 3 else 0))
              for d in (8, 6, 4, 2) for h in range(1, 6)]
    return make_tables(spark, equipment=[equipment_row("T")], batches=[batch_row("B1", start, hours=-1 if bad_batch else 4, seq="T")],
                       tests=day_tests([8, 6, 4, 2]), events=events)


def test_runs_with_kept_marks_equal_one_run(spark, tmp_path):
    t, blocking = fab(spark), ("DQ006", "DQ011")
    out = [K.incremental_run(spark, str(tmp_path / "a"), t, ago(days=d), ago(days=d).date(), blocking) for d in (7, 7, 5, 0)]
    assert [o["promoted"] for o in out] == [True] * 4 and out[1]["days"] == {"daily_yield": [], "daily_uptime": []}
    K.incremental_run(spark, str(tmp_path / "b"), t, ago(), ago().date(), blocking)
    for kpi in (K.DAILY_YIELD, K.DAILY_UPTIME):
        a, b = (sorted(map(tuple, K.read_kept(spark, str(tmp_path / x), kpi).collect()), key=str) for x in "ab")
        assert a == b and a
    marks = {r["source"]: r["current_ts"] for r in read_watermarks(spark, str(tmp_path / "a")).collect()}
    assert marks["events"] == t.fact_equipment_events.agg(F.max("ingestion_timestamp")).first()[0]
    ledger = spark.read.parquet(str(tmp_path / "a" / "dq_results"))
    assert sorted(rows(ledger.groupBy("run_date").count(), "count")) == [(len(Q.RULES),)] * 3      # day 7 was replaced


def test_a_blocked_run_promotes_nothing_and_keeps_its_marks(spark, tmp_path):
    root = str(tmp_path)
    bad = K.incremental_run(spark, root, fab(spark, bad_batch=True), ago(days=5), ago(days=5).date(), ("DQ006",))
    assert (bad["promoted"], bad["blocking_rules"]) == (False, ["DQ006"]) and read_watermarks(spark, root) is None
    assert not os.path.exists(f"{root}/curated") and os.path.exists(f"{root}/dq_results")
    good = K.incremental_run(spark, root, fab(spark), ago(days=5), ago(days=5).date(), ("DQ006",))
    assert good["promoted"] and good["load"] == bad["load"]


def fails(rid, table="tests"):
    return Q.Rule(rid, rid, "RANGE", "LOW", "staging", 0, "None", table=table, predicate=F.concat(F.lit("x"), F.col("batch_id")).cast("int") > 5,
                  example="batch_id")


def test_a_rule_that_fails_while_it_runs_takes_no_other_with_it(spark, monkeypatch):
    t = fab(spark)
    runs, outcomes = [], Q.rule_outcomes
    monkeypatch.setattr(Q, "rule_outcomes", lambda t, group, o: runs.append([r.rule_id for r in group]) or outcomes(t, group, o))
    broken = Q.Rule("XX2", "XX2", "RANGE", "HIGH", "raw", 0, "None",
                    builder=lambda t, o: t.fact_equipment_events.select(F.lit(None).alias("ex"), F.raise_error(F.lit("no luck")).cast("long").alias("w")))
    got = {r.rule_id: r for r in Q.run_isolated(t, rules=[fails("XX1"), broken]).collect()}
    assert {k for k, r in got.items() if r.status == "ERROR"} == {"XX1", "XX2"}
    assert "CAST_INVALID_INPUT" in got["XX1"].details[0] and "no luck" in got["XX2"].details[0] and got["XX1"].violations == -1
    assert len(runs) < 2 * len(got)
    plain = {r.rule_id: r for r in Q.run_checks(t).collect()}
    assert {k: r for k, r in got.items() if k in plain} == plain
    runs.clear()
    assert sorted(map(tuple, Q.run_isolated(t).collect())) == sorted(map(tuple, Q.run_checks(t).collect())) and len(runs) == 1 + 1


@pytest.mark.parametrize("options", [{}, {"dq014_keys": ("batch_id", "wafer_id", "process_step_id")}, {"dq007_denominator": "wafers"}])
def test_shared_grain_equals_each_rule_by_itself(spark, options):
    """Null keys, repeated rows, unknown batches and steps, nulls in every tested column."""
    s = ago(days=1)
    tests = [wt_row(f"W{i % 7}", f"B{i % 3}", 1 + i % 4, "T", s + timedelta(hours=(i * 5) % 9), minutes=(i * 37) % 90, dd=-1.0 if i % 8 == 3 else 0.1,
                    result=["PASS", "FAIL", None, "MAYBE"][i % 4]) for i in range(60)]
    tests += [(None, *tests[0][1:]), (None, *tests[1][1:]), (tests[2][0], None, *tests[2][2:]), (*tests[3][:2], None, *tests[3][3:]),
              (None, None, None, *tests[4][3:]), ("", *tests[5][1:]), tests[6], tests[6], (*tests[7][:5], None, *tests[7][6:]), wt_row("W9", "B1", 99, "T", s)]
    t = make_tables(spark, tests=tests, batches=[batch_row("B0", s), batch_row("B1", s), batch_row("B1", s)])
    o = Q.Options(**options)
    whole = {r.rule_id: r for r in Q.run_checks(t, rule_ids=list(Q.GRAIN_RULES), options=o).collect()}
    for rid in Q.GRAIN_RULES:
        assert whole[rid] == Q.run_checks(t, rule_ids=[rid], options=o).first()
    assert sum(r.violations > 0 for r in whole.values()) >= 8
    assert {r.rule_id: r.violations for r in Q.run_checks(t.with_(fact_wafer_tests=t.fact_wafer_tests.limit(0)), rule_ids=list(Q.GRAIN_RULES)).collect()
            } == dict.fromkeys(Q.GRAIN_RULES, 0)


def test_the_tests_are_read_once_for_ten_rules(spark, tmp_path):
    make_tables(spark, tests=day_tests([1])).fact_wafer_tests.write.parquet(str(tmp_path / "tests_table"))
    t = make_tables(spark, batches=BATCHES).with_(fact_wafer_tests=spark.read.parquet(str(tmp_path / "tests_table")))
    plan = Q.run_checks(t, rule_ids=list(Q.GRAIN_RULES))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
