"""Named tests for the reference traps not covered elsewhere."""

from datetime import timedelta

from conftest import AS_OF, ago, batch_row, equipment_row, event_row, make_tables, rows, wt_row

from waferline.plans import equipment as E
from waferline.plans import layers as L
from waferline.plans import quality as Q
from waferline.plans import trace as B
from waferline.plans import yields as Y


def test_t2_wafer_uniqueness_grain_is_an_option(spark):
    s = ago(days=1)
    tests = [wt_row("W1", "B1", 1, "T", s), wt_row("W1", "B1", 2, "T", s), wt_row("W2", "B1", 1, "T", s),
             wt_row("W2", "B1", 1, "T", s)]
    t = make_tables(spark, tests=tests)
    as_written = Q.run_checks(t, rule_ids=["DQ014"]).first()
    at_fact_grain = Q.run_checks(t, rule_ids=["DQ014"],
                                 options=Q.Options(dq014_keys=("batch_id", "wafer_id", "process_step_id"))).first()
    assert (as_written.violations, list(as_written.details)) == (2, ["W1", "W2"])      # every multi-step wafer
    assert (at_fact_grain.violations, list(at_fact_grain.details)) == (1, ["W2"])     # only the true repeat


def test_t9_stddev_is_the_sample_stddev(spark):
    d = ago(days=2)
    events = [event_row("T", d + timedelta(hours=h), "ALARM", temp=v) for h, v in enumerate([10.0, 20.0, 30.0] * 4)]
    t = make_tables(spark, equipment=[equipment_row("T")], events=events)
    got = rows(E.e3_alarm_severity(t, AS_OF), "total_alarms", "avg_alarm_temperature", "temp_variability")
    # 12 alarms on one day: sample stddev of (10,20,30)x4 = 8.528..., population would be 8.165
    assert got == [(12, 20.0, 8.53)]


def test_t18_time_filters_differ_between_queries(spark):
    # a batch that started 10 days ago but was tested yesterday: Y4 (batch start, 7 days) drops it,
    # B5 (test time, 14 days) keeps it
    old_start = ago(days=10)
    tests = [wt_row(f"W{i}", f"B{i}", 1, "T", ago(days=1, hours=i), result="PASS" if i % 2 else "FAIL")
             for i in range(12)]
    batches = [batch_row(f"B{i}", old_start + timedelta(hours=i)) for i in range(12)]
    t = make_tables(spark, equipment=[equipment_row("T")], tests=tests, batches=batches)
    assert Y.y4_batch_yield(t, AS_OF).count() == 0
    b5 = rows(B.b5_yield_autocorrelation(t, AS_OF), "batch_pairs_analyzed", "avg_yield")
    assert b5 == [(11, 54.55)]          # pairs i=1..11: six batches at 100 %, five at 0 %


def test_pl7_build_curated_renames_the_step_dimension(spark):
    t = make_tables(spark)
    raw = {"equipment_master": t.dim_equipment, "wafer_batches": t.dim_wafer_batches,
           "test_results": t.fact_wafer_tests, "equipment_logs": t.fact_equipment_events,
           "maintenance_events": t.maintenance_events,
           "process_steps": spark.createDataFrame([(1, "Photolithography", "LITHO", 45)],
                                                  "step_id int, name string, equipment_type string, duration_min int")}
    c = L.build_curated(raw)
    assert c.dim_process_steps.columns[:2] == ["process_step_id", "process_step_name"]
