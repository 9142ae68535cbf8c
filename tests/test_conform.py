"""Orphan policies of the curated build."""

from __future__ import annotations

import pytest

from conftest import ago, batch_row, equipment_row, event_row, make_tables, maint_row, rows, wt_row

from waferline.plans import conform as CF

TESTS, STEPS, TOOLS = CF.FOREIGN_KEYS[0], CF.FOREIGN_KEYS[1], CF.FOREIGN_KEYS[2]


def tables(spark):
    s = ago(days=1)
    tests = [wt_row("ok", "B1", 1, "T", s), wt_row("ok", "B1", 1, "T", s), wt_row("batch", "BX", 1, "T", s), wt_row("null", None, 1, "T", s),
             wt_row("step", "B1", 99, "T", s), wt_row("two", "BX", 1, "V", s), wt_row("all", None, None, None, s)]
    return make_tables(spark, tests=tests, batches=[batch_row("B1", s), batch_row("B1", s), batch_row(None, s)],
                       equipment=[equipment_row("T")], events=[event_row("T", s), event_row("V", s)],
                       maintenance=[maint_row(1, None, s), maint_row(2, "T", s)])


def wafers(df):
    return sorted(r[0] for r in rows(df, "wafer_id"))


def test_each_foreign_key_has_its_policy(spark):
    t = tables(spark)
    curated, held = CF.conform(t, {TESTS: "drop", TOOLS: "quarantine"})
    assert wafers(curated.fact_wafer_tests) == ["ok", "ok", "step"] and curated.fact_wafer_tests.columns == t.fact_wafer_tests.columns
    assert sorted(rows(held["fact_wafer_tests"], "wafer_id", "orphan_keys")) == [
        ("all", ["batch_id", "process_step_id", "equipment_id"]), ("two", ["batch_id", "equipment_id"])]
    assert curated.fact_equipment_events.count() == 2                       # no policy: kept
    curated, held = CF.conform(t)
    assert curated.fact_wafer_tests.count() == 7 and held["fact_wafer_tests"].count() == 0


def test_written_routes_and_counts(spark, tmp_path):
    t, root = tables(spark), str(tmp_path)
    CF.write_conformed(t, root, dict.fromkeys(CF.FOREIGN_KEYS, "drop"))
    CF.write_conformed(t, root, {STEPS: "drop", TESTS: "quarantine"})       # in the place of the first
    assert wafers(CF.read_conformed(spark, root, "fact_wafer_tests")) == ["ok", "ok"]
    assert wafers(CF.read_conformed(spark, root, "fact_wafer_tests", "quarantine")) == ["all", "batch", "null", "two"]
    n = {(r.route, tuple(r.orphan_keys)): r.rows for r in CF.route_counts(spark, root, "fact_wafer_tests").collect()}
    assert n == {("curated", ()): 2, ("quarantine", ("batch_id",)): 2, ("drop", ("process_step_id",)): 1,
                 ("quarantine", ("batch_id", "equipment_id")): 1, ("quarantine", ("batch_id", "process_step_id", "equipment_id")): 1}
    assert CF.route_counts(spark, root, "maintenance_events").count() == 2
    empty = make_tables(spark)
    CF.write_conformed(empty, root)
    assert CF.read_conformed(spark, root, "fact_wafer_tests").count() == 0


def test_unknown_policies_are_refused(spark):
    with pytest.raises(ValueError):
        CF.routed(tables(spark), "fact_wafer_tests", {TESTS: "ignore"})


def test_large_dimensions_do_not_shuffle_the_fact(spark, tmp_path):
    s = ago(days=1)
    t = make_tables(spark, tests=[wt_row("w", "B1", 1, "T", s), wt_row("v", "BX", 1, "T", s), wt_row("n", None, 1, "U", s)],
                    batches=[batch_row(f"B{i}", s) for i in range(300)], equipment=[equipment_row("T")])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4000")
    try:
        df = CF.routed(t, "fact_wafer_tests", {TESTS: "drop"}, CF.orphan_keys(t, str(tmp_path)))
        assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()
        assert sorted(rows(df, "wafer_id", "orphan_keys", "route")) == sorted(rows(CF.routed(t, "fact_wafer_tests", {TESTS: "drop"}),
                                                                                 "wafer_id", "orphan_keys", "route"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
