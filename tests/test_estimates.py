"""Sampled rules with bounds, and the trend of stored runs."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from conftest import AS_OF, ago, batch_row, equipment_row, event_row, make_tables, rows, wt_row

from waferline.plans import estimates as ES
from waferline.plans import kept as K
from waferline.plans import layers as L
from waferline.plans.quality import run_checks
from waferline.sources.dirty import dirty_tables
from waferline.sources.driver import driver_tables


def test_all_clusters_hold_every_violation(spark):
    t = dirty_tables(driver_tables(spark, "/root/testdata/sf0.001"))
    whole = {r.rule_id: r.violations for r in run_checks(t, rule_ids=L.EXPENSIVE_RULES).collect()}
    got = {r.rule_id: r for r in ES.estimated_checks(t, 1.0).collect()}
    assert {k: r.found for k, r in got.items()} == whole and all(r.low == r.estimate == r.high for r in got.values())
    assert {k: r.status for k, r in got.items()} == {r.rule_id: r.status for r in run_checks(t, rule_ids=L.EXPENSIVE_RULES).collect()}


def test_bounds_hold_the_whole_count_at_the_stated_rate(spark):
    y = F.when(F.col("id") % 10 == 0, F.col("id") % 7 + 1)
    all_ = spark.range(4000).select("id", y.cast("long").alias("y")).filter("y is not null")
    total = all_.agg(F.sum("y")).first()[0]
    drawn = all_.select("y", F.explode(F.array(*[F.when(ES.in_sample("id", 0.2, str(s)), F.lit(s)) for s in range(60)])).alias("salt"))
    got = ES.bounds(drawn.filter("salt is not null"), "salt", 0.2).collect()
    assert len(got) == 60 and sum(r.low <= total <= r.high for r in got) >= 55
    assert all(r.high < 3 * total for r in got)


def test_verdicts_are_uncertain_where_the_threshold_is_inside(spark):
    empty = {r.rule_id: r for r in ES.estimated_checks(make_tables(spark), 0.05).collect()}
    assert len(empty) == len(L.EXPENSIVE_RULES)
    assert all(r.found == 0 and (r.low, r.high) == (0, 59) for r in empty.values())
    assert {r.status for r in empty.values() if r.threshold < 59} == {"UNCERTAIN"}
    tests = [wt_row(f"w{i}", f"X{i}", 1, "T", ago(days=1)) for i in range(400)]      # no batch is listed
    got = {r.rule_id: r for r in ES.estimated_checks(make_tables(spark, tests=tests), 0.2).collect()}
    assert got["DQ001"].status == "FAIL" and got["DQ001"].low <= 400 <= got["DQ001"].high


def test_trend_of_stored_runs(spark, tmp_path):
    root = str(tmp_path)
    tests = [wt_row(w, "B", 1, "T", ago(days=d, hours=1), dd=dd) for w, d, dd in (("a", 0, -1.0), ("b", 0, -1.0), ("c", 7, -1.0), ("d", 8, 1.0))]
    t = make_tables(spark, tests=tests, batches=[batch_row("B", ago(days=1))], equipment=[equipment_row("T")], events=[event_row("T", ago(days=1))])
    for back, days in ((0, 7), (7, 0), (7, 7)):                                       # the second run of the date counts
        upto = AS_OF - timedelta(days=back)
        K.ledger_run(root, t, upto, days, upto.date())
    got = rows(L.stored_trend(K.read_ledger(spark, root)).filter("rule_id = 'DQ008'"), "date", "violations", "prev_violations", "trailing_avg")
    assert got == [(ago(days=7).date(), 1, None, 1.0), (AS_OF.date(), 2, 1, 1.5)]


def test_input_of_several_runs_is_computed_once(spark, tmp_path, monkeypatch):
    tests = [wt_row(f"w{d}", "B", 1, "T", ago(days=d), dd=-1.0) for d in range(40)]
    events = [event_row("T", ago(days=d)) for d in range(40)]
    t = make_tables(spark, tests=tests, batches=[batch_row("B", ago(days=1))], equipment=[equipment_row("T")], events=events)
    runs = [(AS_OF - timedelta(days=b), n) for b, n in ((20, 5), (0, 2), (1, 3), (30, 0), (4, 1))]   # some overlap or touch, one is empty
    assert K._spans(runs) == [(ago(days=30), ago(days=30)), (ago(days=25), ago(days=20)), (ago(days=5), AS_OF)]
    kept = K.runs_input(str(tmp_path), t, runs)
    assert {r[0] for r in kept.fact_wafer_tests.select("wafer_id").collect()} == {f"w{d}" for d in (1, 2, 3, 4, 5, 21, 22, 23, 24, 25)}  # tested some minutes after their start
    for upto, days in runs:
        judged = []
        for k, x in enumerate((t, kept)):
            K.ledger_run(str(tmp_path / f"ledger{k}"), x, upto, days, upto.date())
            judged.append(rows(K.read_ledger(spark, str(tmp_path / f"ledger{k}")).filter(F.col("run_date") == F.lit(upto.date())), "rule_id", "violations", "status", "details"))
        assert judged[0] == judged[1]

    from waferline.plans import layer_queries as LQ
    plans, run = [], K.ledger_run
    monkeypatch.setattr(K, "ledger_run", lambda root, x, *a: (plans.append([d._jdf.queryExecution().optimizedPlan().toString() for d in (
        x.dim_wafer_batches, x.fact_wafer_tests, x.fact_equipment_events)]), run(root, x, *a)))
    LQ.c10_stored_trend(dirty_tables(driver_tables(spark, "/root/testdata/sf0.001")))
    assert len(plans) == 4 and not any(word in p for x in plans for p in x for word in ("Aggregate", "Join", "Union"))
