"""Plan-shape checks: the scale properties the README claims, read from explain()."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["b1_wafer_trace", "b2_batch_root_cause_tests", "b7_contamination",
                                  "e5_maintenance_effect", "r3_wafer_lineage", "j4_interval_lookup",
                                  "x4_yield_excursion", "dq_results"])
def test_interval_lookups_are_equi_joins(spark, name):
    p = _plan(spark, name)
    assert "CartesianProduct" not in p
    for line in p.splitlines():
        if "BroadcastNestedLoopJoin" in line:
            # only the one-row rule catalogue / one-row aggregates may be nested-loop joined
            assert "Cross" in line or "rule_id" in line, line


def test_cross_joins_only_take_one_row_aggregates(spark):
    import re
    for name in E.queries():
        if name[0] == "s" and name[1].isdigit() or name.startswith("op") or name in ("pipeline", "pl6_write_upsert") or name.startswith(
                ("pl8_kept_dimension", "c10_stored_trend", "io_raw_landing")):
            continue                       # these run jobs when called
        p = _plan(spark, name)
        assert "CartesianProduct" not in p, name
        for m in re.finditer(r"BroadcastNestedLoopJoin", p):
            # every nested-loop join is a cross join with a one-row aggregate, or the
            # one-row-per-rule catalogue joined on a constant rule id
            window = p[m.start():m.start() + 700]
            assert "Cross" in window[:80] or "inline(" in window or "keys=[]" in window, (name, window[:300])


def test_y1_aggregates_before_the_dimension_join(spark):
    p = _plan(spark, "y1_yield_by_equipment")
    join_at = min(i for i in (p.find("BroadcastHashJoin"), p.find("SortMergeJoin")) if i >= 0)
    assert "HashAggregate" in p[join_at:], "the fact side must be aggregated below the join"


def test_scan_reads_only_needed_columns(spark):
    p = _plan(spark, "y1_yield_by_equipment")
    line = [ln for ln in p.splitlines() if "FileScan" in ln and "lineitem" in ln][0]
    read = line[line.index("ReadSchema: struct<") + len("ReadSchema: struct<"):].split(">")[0]
    cols = {c.split(":")[0] for c in read.split(",")}
    assert cols == {"l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_tax"}


def test_one_wafer_trace_prunes_events_behind_a_semi_join(spark):
    p = _plan(spark, "b1_wafer_trace_one")
    assert "LeftSemi" in p and "prune" not in p
    lines = p.splitlines()
    semi = [i for i, ln in enumerate(lines) if "LeftSemi" in ln]
    events = [i for i, ln in enumerate(lines) if "FileScan" in ln and "events.parquet" in ln]
    assert events and all(any(s < e for s in semi) for e in events)


@pytest.mark.parametrize("name", ["b1_wafer_trace", "b6_lot_trace", "b7_contamination", "r3_wafer_lineage", "x5_route_explode",
                                  "x6_route_conformance"])
def test_traces_of_everything_are_not_sorted_globally(spark, name):
    assert "rangepartitioning" not in _plan(spark, name)


@pytest.mark.parametrize("name", ["pl2_dedupe", "pl4_lookback", "pl6_upsert"])
def test_latest_rows_are_limited_before_the_shuffle(spark, name):
    p = _plan(spark, name)
    assert "SortAggregate" not in p and p.count("WindowGroupLimit") >= 2


def test_curated_facts_prune_by_date(spark, tmp_path):
    from waferline.plans import yields as Y
    from waferline.sources.driver import driver_tables
    from waferline.sources.layers import read_curated, write_curated
    write_curated(driver_tables(spark, SF), str(tmp_path))
    p = Y.y1_yield_by_equipment(read_curated(spark, str(tmp_path)))._jdf.queryExecution().executedPlan().toString()
    filters = [ln[ln.index("PartitionFilters"):ln.index("PushedFilters")] for ln in p.splitlines() if "FileScan" in ln]
    assert any("test_date" in f for f in filters)


@pytest.mark.parametrize("name,most", [("x4_yield_excursion", 18), ("b1_wafer_trace", 12), ("j4_interval_lookup", 6), ("r3_wafer_lineage", 9)])
def test_rows_with_windows_are_shuffled_once_per_step(spark, name, most):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # as with large dimensions
    try:
        assert _plan(spark, name).count("Exchange hashpartitioning") <= most
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", ["e6_criticality", "e6_criticality_dirty"])
def test_criticality_counts_without_expanding_rows(spark, name):
    assert "Expand" not in _plan(spark, name)


@pytest.mark.parametrize("name", ["b6_lot_trace", "b6_lot_trace_tests"])
def test_a_trace_of_all_lots_shuffles_no_raw_tests(spark, name):
    assert "LeftSemi" not in _plan(spark, name)
