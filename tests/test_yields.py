from datetime import timedelta

from conftest import AS_OF, ago, equipment_row, make_tables, rows, wt_row

from waferline.plans import yields as Y


def _tool_with(n_wafers, n_pass, tool="T1", start=None):
    start = start or ago(days=1)
    return [wt_row(f"{tool}_W{i:03d}", "B1", 1, tool, start, result="PASS" if i < n_pass else "FAIL")
            for i in range(n_wafers)]


def test_y1_wafer_denominator_exceeds_100_and_r1_uses_rows(spark):
    tests = [wt_row("W1", "B1", s, "T1", ago(days=1, hours=s)) for s in (1, 2, 3)]
    t = make_tables(spark, equipment=[equipment_row("T1")], tests=tests)
    y1 = rows(Y.y1_yield_by_equipment(t, AS_OF, min_wafers=1),
              "total_wafers_processed", "passed_wafers", "yield_pct", "performance_tier")
    assert y1 == [(1, 3, 300.0, "EXCELLENT")]
    r1 = rows(Y.r1_yield_tool_step(t, AS_OF, min_tests=1), "process_step", "yield_pct")
    assert sorted(r1) == [("Ion Implantation", 100.0), ("Photolithography", 100.0), ("Plasma Etch", 100.0)]


def test_y1_tiers_at_exact_boundaries(spark):
    tests = (_tool_with(20, 19, "A") + _tool_with(20, 18, "B") + _tool_with(20, 17, "C")
             + _tool_with(20, 16, "D"))
    t = make_tables(spark, equipment=[equipment_row(x) for x in "ABCD"], tests=tests)
    got = rows(Y.y1_yield_by_equipment(t, AS_OF, min_wafers=20), "equipment_id", "yield_pct", "performance_tier")
    assert got == [("D", 80.0, "NEEDS ATTENTION"), ("C", 85.0, "ACCEPTABLE"), ("B", 90.0, "GOOD"),
                   ("A", 95.0, "EXCELLENT")]


def test_y1_window_bound_and_having(spark):
    edge = ago(days=7)
    tests = ([wt_row("in", "B1", 1, "T1", edge - timedelta(minutes=20), test_ts=edge),
              wt_row("out", "B1", 1, "T1", edge, test_ts=edge - timedelta(microseconds=1))]
             + _tool_with(29, 29, "T29") + _tool_with(30, 30, "T30"))
    t = make_tables(spark, equipment=[equipment_row(x) for x in ("T1", "T29", "T30")], tests=tests)
    assert rows(Y.y1_yield_by_equipment(t, AS_OF, min_wafers=1).filter("equipment_id = 'T1'"),
                "total_wafers_processed") == [(1,)]
    assert rows(Y.y1_yield_by_equipment(t, AS_OF), "equipment_id") == [("T30",)]


def test_y2_moving_average_counts_rows_not_days(spark):
    tests = []
    for d, passes in ((25, 2), (11, 1), (3, 0)):          # gaps of many days between rows
        for i in range(2):
            tests.append(wt_row(f"W{d}{i}", "B1", 1, "T1", ago(days=d), result="PASS" if i < passes else "FAIL"))
    t = make_tables(spark, equipment=[equipment_row("T1")], tests=tests)
    got = rows(Y.y2_yield_trend(t, AS_OF, min_wafers=1).orderBy("test_date"),
               "yield_pct", "yield_7day_ma", "overall_avg_yield", "trend_status")
    assert got == [(100.0, 100.0, 50.0, "🟢 IMPROVED"), (50.0, 75.0, 50.0, "⚪ STABLE"),
                   (0.0, 50.0, 50.0, "🔴 SIGNIFICANT DROP")]


def test_y5_pareto_ties_share_cumulative(spark):
    tests = [wt_row(f"W{i}", "B1", 1, "T1", ago(days=1), result="FAIL", bin_code=b)
             for i, b in enumerate(["A", "A", "B", "C"])] + [wt_row("P", "B1", 1, "T1", ago(days=1))]
    t = make_tables(spark, equipment=[equipment_row("T1")], tests=tests)
    got = rows(Y.y5_defect_pareto(t, AS_OF), "defect_type", "pct_of_total", "cumulative_pct", "improvement_priority")
    assert got == [("A", 50.0, 50.0, "🔴 HIGH PRIORITY"), ("B", 25.0, 100.0, "🟢 LOW PRIORITY"),
                   ("C", 25.0, 100.0, "🟢 LOW PRIORITY")]


def test_y6_no_first_step_failure_gives_null_recovery(spark):
    tests = [wt_row("W1", "B1", 1, "T1", ago(days=2)), wt_row("W1", "B1", 6, "T1", ago(days=1)),
             wt_row("W2", "B1", 1, "T1", ago(days=2)), wt_row("W2", "B1", 6, "T1", ago(days=1), result="FAIL")]
    t = make_tables(spark, equipment=[equipment_row("T1")], tests=tests)
    got = rows(Y.y6_first_pass_yield(t, AS_OF))
    assert got == [(2, 2, 1, 100.0, 50.0, None)]


def test_y7_constant_series_correlation_is_null(spark):
    tests, events = [], []
    for d in range(1, 9):
        day = ago(days=d) + timedelta(hours=1)
        tests += [wt_row(f"W{d}_{i}", "B1", 1, "T1", day) for i in range(20)]
        events.append(("T1", day, "RUNNING", 1.0, 1.0, None, day))
    t = make_tables(spark, equipment=[equipment_row("T1")], tests=tests, events=events)
    got = rows(Y.y7_utilization_yield_corr(t, AS_OF), "avg_yield", "utilization_yield_correlation", "interpretation")
    assert got == [(100.0, None, "✅ No significant correlation")]
