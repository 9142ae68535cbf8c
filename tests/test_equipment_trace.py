from datetime import timedelta

from pyspark.sql import functions as F

from conftest import AS_OF, ago, batch_row, equipment_row, event_row, maint_row, make_tables, rows, wt_row

from waferline.plans import equipment as E
from waferline.plans import trace as B


def test_e2_mtbf_counts_gaps_truncates_hours_nulls_last(spark):
    t0 = ago(days=10)
    events = [event_row("X", t0, "DOWN"), event_row("X", t0 + timedelta(minutes=59), "DOWN"),
              event_row("Y", t0, "DOWN"),
              event_row("Z", t0, "DOWN"), event_row("Z", t0 + timedelta(hours=10), "DOWN"),
              event_row("Z", t0 + timedelta(hours=30), "DOWN"), event_row("Z", t0, "RUNNING")]
    eq = [equipment_row(x) for x in "XYZ"] + [equipment_row("OFF", status="INACTIVE")]
    t = make_tables(spark, equipment=eq, events=events)
    got = rows(E.e2_mtbf(t, AS_OF), "equipment_id", "failure_count", "mtbf_hours", "mtbf_days", "reliability_rating")
    assert got == [("X", 1, 0.0, 0.0, "🔴 POOR (<7 days)"), ("Z", 2, 15.0, 0.6, "🔴 POOR (<7 days)"),
                   ("Y", 0, None, None, "🔴 POOR (<7 days)")]


def test_e5_event_at_maintenance_time_counts_on_both_sides(spark):
    m = ago(days=20)
    events = [event_row("T", m, "ALARM"), event_row("T", m - timedelta(days=3), "RUNNING"),
              event_row("T", m + timedelta(days=7), "RUNNING"),
              event_row("T", m + timedelta(days=7, microseconds=1), "ALARM")]
    t = make_tables(spark, equipment=[equipment_row("T")], events=events,
                    maintenance=[maint_row("PM1", "T", m)])
    got = rows(E.e5_maintenance_effect(t, AS_OF), "maintenance_count", "avg_pre_alarm_rate_pct",
               "avg_post_alarm_rate_pct", "alarm_rate_change_pct")
    assert got == [(1, 50.0, 50.0, 0.0)]


def test_e6_tool_without_tests_is_tier4(spark):
    t = make_tables(spark, equipment=[equipment_row("IDLE1")], events=[event_row("IDLE1", ago(days=1), "DOWN")])
    got = rows(E.e6_criticality(t, AS_OF), "wafers_processed_30d", "yield_pct", "down_events",
               "criticality_score", "criticality_tier")
    # LEFT JOIN and AVG(CASE ... ELSE 0): one row that is no PASS
    assert got == [(0, 0.0, 1, 0.0, "🟢 TIER 4 - Low Impact Equipment")]


def test_e6_counts_a_wafer_of_two_batches_once_and_no_null_wafer(spark):
    s = ago(days=1)
    tests = [wt_row("W1", "B1", 1, "T", s), wt_row("W1", "B2", 1, "T", s), wt_row(None, "B2", 1, "T", s)]
    got = rows(E.e6_criticality(make_tables(spark, equipment=[equipment_row("T")], tests=tests), AS_OF),
               "batches_processed_30d", "wafers_processed_30d", "estimated_value_processed")
    assert got == [(2, 1, 1000)]


def test_e4_baseline_includes_current_week(spark):
    d = ago(days=3)
    events = [event_row("T", d, temp=10.0), event_row("T", d + timedelta(hours=1), temp=20.0, status="ALARM")]
    t = make_tables(spark, equipment=[equipment_row("T")], events=events)
    got = rows(E.e4_degradation(t, AS_OF), "current_week_alarms", "baseline_alarms", "degradation_status")
    assert got == [(1.0, 1.0, "🟢 STABLE")]


def test_b1_interval_conditions_inclusive(spark):
    s = ago(days=2)
    tests = [wt_row("W1", "B1", 1, "T", s, minutes=30), wt_row("W1", "B1", 2, "T", s + timedelta(hours=5))]
    events = [event_row("T", s, "ALARM", temp=10.0, pressure=1.0),
              event_row("T", s + timedelta(minutes=30), "RUNNING", temp=10.25, pressure=2.0),
              event_row("T", s + timedelta(minutes=31), "ALARM", temp=99.0)]
    t = make_tables(spark, equipment=[equipment_row("T")], tests=tests, events=events,
                    batches=[batch_row("B1", s)])
    got = rows(B.b1_wafer_trace(t, "W1"), "process_step_id", "duration_minutes", "avg_temp_c",
               "avg_pressure_torr", "alarms_during_process")
    assert got == [(1, 30, 10.13, 1.5, 1), (2, 20, None, None, 0)]


def test_b2_worst_step_ties_to_lower_step_and_fanout(spark):
    s = ago(days=2)
    tests = ([wt_row(f"W{i}", "B1", st, "T", s, result="FAIL") for i in range(3) for st in (2, 3)]
             + [wt_row("W9", "B1", 1, "T", s)])
    t = make_tables(spark, equipment=[equipment_row("T")], tests=tests, batches=[batch_row("B1", s)],
                    maintenance=[maint_row("PM", "T", s - timedelta(hours=1))])
    got = rows(B.b2_batch_root_cause(t, max_yield=50, denominator="tests"),
               "yield_pct", "recent_maintenance_count", "most_failed_step", "failures_at_worst_step",
               "likely_root_cause")
    # 7 test rows on the tool, one maintenance event in the 24 h before the batch -> 7
    assert got == [(14.29, 7, "Plasma Etch", 3, "🟡 Post-maintenance instability")]


def test_b6_in_progress_and_batch_without_tests(spark):
    t = make_tables(spark, batches=[batch_row("B1", ago(hours=1)), batch_row("B2", ago(days=3))],
                    tests=[wt_row("W1", "B1", 1, "T", ago(hours=1))])
    got = rows(B.b6_lot_trace(t, AS_OF), "batch_id", "wafer_count", "batch_yield", "equipment_route", "disposition")
    assert got == [("B1", 1, 100.0, "T", "IN PROGRESS"), ("B2", 0, None, None, "QUARANTINE")]


def test_b7_lag_ties_ordered_by_batch_and_maintenance_between(spark):
    s = ago(days=3)
    tests = [wt_row("a", "B1", 1, "T", s, result="FAIL"), wt_row("b", "B2", 1, "T", s, result="FAIL"),
             wt_row("c", "B3", 1, "T", s + timedelta(hours=5))]
    batches = [batch_row("B1", s), batch_row("B2", s), batch_row("B3", s + timedelta(hours=5))]
    t = make_tables(spark, tests=tests, batches=batches,
                    maintenance=[maint_row("PM", "T", s + timedelta(hours=2))])
    got = rows(B.b7_contamination(t, AS_OF).orderBy(F.desc("batch_id")), "batch_id", "prev_batch", "yield_delta",
               "maintenance_between", "contamination_risk")
    assert got == [("B3", "B2", 100.0, 1, "🟢 MAINTENANCE EFFECTIVE"),
                   ("B2", "B1", 0.0, 0, "🔴 POSSIBLE CONTAMINATION - No cleaning between low-yield batches")]
