"""Traceability and root-cause analytics.

Every correlated ``BETWEEN`` subquery of the reference is an
:func:`~waferline.operators.intervals.interval_sums` (prefix sums per tool, no
window x event join), every correlated equality subquery is a pre-aggregation joined back
on its key, and every per-tool LAG is the bucketed
:func:`~waferline.operators.sequence.keyed_lag`. Wafer/lot parameters are optional
filters; ``None`` traces every wafer/lot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waferline.functions.exprs import (flag, pct, round_avg, safe_corr, since, ts_diff, ts_lit,
                                       window_start)
from waferline.operators.intervals import interval_events, interval_sums, ratio_of, with_interval_sums
from waferline.operators.routes import explode_route, route_string
from waferline.operators.sequence import keyed_lag
from waferline.sources.tables import DEFAULT_AS_OF, FabTables
from waferline.plans.labels import (B1_STATUS_INDICATOR,
                                     B2_ROOT_CAUSE,
                                     B3_SEVERITY,
                                     B5_INTERPRETATION,
                                     B6_DISPOSITION,
                                     B7_CONTAMINATION_RISK)


def pass_():
    return F.col("pass_fail") == "PASS"


def fail_():
    return F.col("pass_fail") == "FAIL"


HOUR, DAY = 3600, 86400


def _ids(values):
    if values is None or isinstance(values, (list, tuple, set)):
        return values
    return [values]


def b1_wafer_trace(t: FabTables, wafer_ids=None) -> DataFrame:
    tests, few = t.fact_wafer_tests, _ids(wafer_ids) is not None
    if few:
        tests = tests.filter(F.col("wafer_id").isin(list(_ids(wafer_ids))))
    tests = tests.select("wafer_id", "batch_id", "process_step_id", "equipment_id",
                         F.col("start_time").alias("step_start"), F.col("end_time").alias("step_end"),
                         "pass_fail", "defect_density", "bin_code")
    batches = t.dim_wafer_batches.select("batch_id", "lot_number", "recipe",
                                         F.col("start_time").alias("batch_start"),
                                         F.col("end_time").alias("batch_end"))
    steps = t.dim_process_steps.select("process_step_id", "process_step_name", "equipment_type")
    dim = t.dim_equipment.select("equipment_id", "manufacturer")
    # All three subqueries share one window: one prefix-sum pass, through which the tests go
    # before they get the dimensions' columns.
    cond = with_interval_sums(tests, t.fact_equipment_events, "equipment_id", "step_start", "step_end", "event_timestamp", {
        "t_sum": F.col("temperature_c").cast("decimal(30,6)"),
        "t_n": F.col("temperature_c").isNotNull().cast("long"),
        "p_sum": F.col("pressure_torr").cast("decimal(30,6)"),
        "p_n": F.col("pressure_torr").isNotNull().cast("long"),
        "alarms_during_process": (F.col("status") == "ALARM").cast("long"),
    }, bucket_seconds=HOUR, prune=few)
    cond = cond.select(*tests.columns, "alarms_during_process", ratio_of("t_sum", "t_n", 2).alias("avg_temp_c"),
                       ratio_of("p_sum", "p_n", 3).alias("avg_pressure_torr"))
    out = cond.join(batches, "batch_id").join(steps, "process_step_id").join(dim, "equipment_id")
    out = out.select(
        "wafer_id", "batch_id", "lot_number", "recipe", "batch_start", "batch_end",
        "process_step_id", "process_step_name", "equipment_type", "equipment_id", "manufacturer",
        "step_start", "step_end", ts_diff("MINUTE", "step_start", "step_end").alias("duration_minutes"),
        "pass_fail", "defect_density", "bin_code", "avg_temp_c", "avg_pressure_torr",
        F.coalesce("alarms_during_process", F.lit(0)).alias("alarms_during_process"),
        F.when(fail_(), B1_STATUS_INDICATOR[0]).otherwise(B1_STATUS_INDICATOR[1]).alias("status_indicator"),
    )
    # Sorted for the wafers asked for; a trace of all wafers is a table, not a report.
    return out.orderBy("wafer_id", "process_step_id", "equipment_id", "step_start") if few else out


def batch_yield(tests: DataFrame, denominator: str = "wafers") -> DataFrame:
    """Per batch: distinct wafers, passed test rows and yield. ``denominator`` is
    ``wafers`` (COUNT(DISTINCT wafer_id), can exceed 100 % - trap T1) or ``tests``."""
    g = tests.groupBy("batch_id").agg(F.countDistinct("wafer_id").alias("wafer_count"),
                                      F.sum(flag(pass_())).alias("passed"),
                                      F.count("wafer_id").alias("n_tests"))
    den = "wafer_count" if denominator == "wafers" else "n_tests"
    return g.withColumn("yield_pct", F.round(pct("passed", den), 2))


def b2_batch_root_cause(t: FabTables, max_yield: float = 85, denominator: str = "wafers",
                        lookback_hours: int = 24, alarm_tools: int = 3, maint_events: int = 2,
                        step_failures: int = 10) -> DataFrame:
    tests = t.fact_wafer_tests
    low = batch_yield(tests, denominator).filter(F.col("yield_pct") < max_yield).select("batch_id",
                                                                                         "yield_pct")
    b = (low.join(t.dim_wafer_batches.select("batch_id", "lot_number", "recipe", "start_time",
                                             "end_time"), "batch_id"))
    bt = tests.select("batch_id", "equipment_id").join(low.select("batch_id"), "batch_id", "left_semi")
    # (batch, tool) pairs with the batch's test count on that tool (the fan-out of T6).
    tools = bt.groupBy("batch_id", "equipment_id").agg(F.count(F.lit(1)).alias("n_tests"))
    win = tools.join(b.select("batch_id", F.col("start_time").alias("b_start"),
                              F.col("end_time").alias("b_end")), "batch_id")
    win2 = win.withColumn("m_lo", F.col("b_start") - F.expr(f"INTERVAL {lookback_hours} HOURS"))
    a = interval_sums(win, t.fact_equipment_events, "equipment_id", "b_start", "b_end", "event_timestamp",
                      {"n_alarms": (F.col("status") == "ALARM").cast("long")}, bucket_seconds=HOUR, prune=True)
    m = interval_sums(win2, t.maintenance_events, "equipment_id", "m_lo", "b_start", "event_timestamp",
                      {"n_maint": F.lit(1).cast("long")}, bucket_seconds=6 * HOUR, prune=True)
    per_tool = (win2.join(a, ["equipment_id", "b_start", "b_end"], "left")
                .join(m, ["equipment_id", "m_lo", "b_start"], "left"))
    factors = per_tool.groupBy("batch_id").agg(
        F.count(F.when(F.col("n_alarms") > 0, 1)).alias("equipment_with_alarms"),
        F.coalesce(F.sum(F.col("n_tests") * F.col("n_maint")), F.lit(0)).alias("recent_maintenance_count"))
    fails = (tests.filter(fail_()).join(low.select("batch_id"), "batch_id", "left_semi")
             .groupBy("batch_id", "process_step_id").agg(F.count(F.lit(1)).alias("n")))
    names = t.dim_process_steps.select("process_step_id", "process_step_name")
    worst_n = fails.groupBy("batch_id").agg(F.max("n").alias("failures_at_worst_step"))
    worst_name = (fails.join(names, "process_step_id").groupBy("batch_id")
                  .agg(F.max_by("process_step_name",
                                F.struct(F.col("n"), -F.col("process_step_id"))).alias("most_failed_step")))
    out = (b.join(factors, "batch_id", "left").join(worst_name, "batch_id", "left")
           .join(worst_n, "batch_id", "left"))
    ea, rm, fw = (F.col("equipment_with_alarms"), F.col("recent_maintenance_count"),
                  F.col("failures_at_worst_step"))
    cause = (F.when(ea >= alarm_tools, B2_ROOT_CAUSE[0])
             .when(rm >= maint_events, B2_ROOT_CAUSE[1])
             .when(fw >= step_failures, F.concat(F.lit(B2_ROOT_CAUSE[2]),
                                                  F.col("most_failed_step")))
             .otherwise(B2_ROOT_CAUSE[3]))
    return out.select(
        "batch_id", "lot_number", "recipe", "start_time", "yield_pct",
        F.coalesce(ea, F.lit(0)).alias("equipment_with_alarms"),
        F.coalesce(rm, F.lit(0)).alias("recent_maintenance_count"),
        "most_failed_step", "failures_at_worst_step", cause.alias("likely_root_cause"),
    ).orderBy("yield_pct", "batch_id")


def b3_failing_routes(t: FabTables, as_of=DEFAULT_AS_OF, days: int = 30, min_wafers: int = 5,
                      top: int = 20, high: int = 50, moderate: int = 20) -> DataFrame:
    tests = since(t.fact_wafer_tests, "test_timestamp", as_of, days=days)
    # Route and failure count of a wafer in one aggregation chain over the tests.
    fwe = (route_string(tests.withColumn("failure_count", flag(fail_())), ["wafer_id", "batch_id"],
                        name="equipment_sequence", sums=["failure_count"])
           .filter(F.col("failure_count") > 0))
    total = tests.agg(F.countDistinct("wafer_id").alias("_all"))   # one row
    g = (fwe.groupBy("equipment_sequence")
         .agg(F.countDistinct("wafer_id").alias("failed_wafer_count"),
              F.countDistinct("batch_id").alias("affected_batches"))
         .filter(F.col("failed_wafer_count") >= min_wafers)
         .crossJoin(F.broadcast(total)))
    n = F.col("failed_wafer_count")
    return (g.select("equipment_sequence", "failed_wafer_count", "affected_batches",
                     F.round(pct(n, "_all"), 2).alias("pct_of_all_wafers"),
                     F.when(n >= high, B3_SEVERITY[0]).when(n >= moderate, B3_SEVERITY[1])
                     .otherwise(B3_SEVERITY[2]).alias("severity"))
            .orderBy(F.desc("failed_wafer_count"), "equipment_sequence")
            .limit(top))


def b4_first_failure_step(t: FabTables, as_of=DEFAULT_AS_OF, days: int = 30) -> DataFrame:
    tests = since(t.fact_wafer_tests, "test_timestamp", as_of, days=days)
    wfp = (tests.groupBy("wafer_id", "batch_id")
           .agg(F.min(F.when(fail_(), F.col("process_step_id"))).alias("first_failure_step"),
                F.max("process_step_id").alias("last_step_reached"))
           .filter(F.col("first_failure_step").isNotNull()))
    total = wfp.agg(F.countDistinct("wafer_id").alias("_all"))     # one row
    steps = t.dim_process_steps.select("process_step_id", "process_step_name", "equipment_type")
    j = wfp.join(steps, wfp.first_failure_step == steps.process_step_id)
    g = (j.groupBy("process_step_id", "process_step_name", "equipment_type")
         .agg(F.countDistinct("wafer_id").alias("wafers_failed_at_step"),
              F.round(F.avg(F.col("first_failure_step") * F.lit(100.0) / F.col("last_step_reached")), 1)
              .alias("avg_progress_pct_at_failure"))
         .crossJoin(F.broadcast(total)))
    return (g.select("process_step_id", "process_step_name", "equipment_type", "wafers_failed_at_step",
                     F.round(pct("wafers_failed_at_step", "_all"), 2).alias("pct_of_total_failures"),
                     "avg_progress_pct_at_failure")
            .orderBy(F.desc("wafers_failed_at_step"), "process_step_id"))


def _batch_tool_yield(tests: DataFrame, batches: DataFrame) -> DataFrame:
    """One row per (tool, batch) with the batch start and the yield over test rows."""
    return (tests.groupBy("equipment_id", "batch_id")
            .agg(F.round(pct(F.sum(flag(pass_())), F.count(F.lit(1))), 2).alias("yield_pct"))
            .join(batches.select("batch_id", "start_time"), "batch_id"))


def b5_yield_autocorrelation(t: FabTables, as_of=DEFAULT_AS_OF, days: int = 14, min_pairs: int = 10,
                             strong: float = 0.7, moderate: float = 0.4) -> DataFrame:
    tests = since(t.fact_wafer_tests, "test_timestamp", as_of, days=days)
    bs = _batch_tool_yield(tests, t.dim_wafer_batches)
    seq = keyed_lag(bs, "equipment_id", "start_time", ["yield_pct"], tie=["batch_id"],
                    bucket_seconds=DAY).filter(F.col("prev_yield_pct").isNotNull())
    g = (seq.groupBy("equipment_id")
         .agg(F.count(F.lit(1)).alias("batch_pairs_analyzed"),
              round_avg("yield_pct", 2).alias("avg_yield"),
              safe_corr("prev_yield_pct", "yield_pct").alias("r"))
         .filter(F.col("batch_pairs_analyzed") >= min_pairs))
    r = F.col("r")
    return (g.select("equipment_id", "batch_pairs_analyzed", "avg_yield",
                     F.round(r, 3).alias("yield_autocorrelation"),
                     F.when(r > strong, B5_INTERPRETATION[0])
                     .when(r > moderate, B5_INTERPRETATION[1])
                     .otherwise(B5_INTERPRETATION[2]).alias("interpretation"))
            .orderBy(F.desc_nulls_last("yield_autocorrelation"), "equipment_id"))


def b6_lot_trace(t: FabTables, as_of=DEFAULT_AS_OF, lots=None, denominator: str = "wafers",
                 release: float = 90, conditional: float = 70) -> DataFrame:
    b = t.dim_wafer_batches.select("lot_number", "batch_id", "recipe", "start_time", "end_time")
    if _ids(lots) is not None:
        b = b.filter(F.col("lot_number").isin(list(_ids(lots))))
    tests, few = t.fact_wafer_tests, _ids(lots) is not None
    if few:  # a trace of all lots reads all tests: the joins below leave out unknown batches
        tests = tests.join(b.select("batch_id"), "batch_id", "left_semi")
    y = batch_yield(tests, denominator)
    route = route_string(tests, ["batch_id"], name="equipment_route")
    j = b.join(y, "batch_id", "left").join(route, "batch_id", "left")
    den = "wafer_count" if denominator == "wafers" else "n_tests"
    yy = pct(F.coalesce("passed", F.lit(0)), F.coalesce(den, F.lit(0)))
    disp = (F.when(F.col("end_time") > ts_lit(as_of), B6_DISPOSITION[0])
            .when(yy >= release, B6_DISPOSITION[1]).when(yy >= conditional, B6_DISPOSITION[2])
            .otherwise(B6_DISPOSITION[3]))
    out = j.select(
        "lot_number", "batch_id", "recipe", "start_time", "end_time",
        F.coalesce("wafer_count", F.lit(0)).alias("wafer_count"),
        F.coalesce("passed", F.lit(0)).alias("passed_wafers"),
        F.round(yy, 2).alias("batch_yield"), "equipment_route", disp.alias("disposition"),
    )
    return out.orderBy(F.desc("start_time"), "batch_id") if few else out


def b7_contamination(t: FabTables, as_of=DEFAULT_AS_OF, days: int = 14, low: float = 80,
                     high: float = 90, recovered: float = 85) -> DataFrame:
    batches = t.dim_wafer_batches.filter(F.col("start_time") >= window_start(as_of, days=days))
    sb = _batch_tool_yield(t.fact_wafer_tests.join(batches.select("batch_id"), "batch_id", "left_semi"),
                           batches)
    seq = keyed_lag(sb, "equipment_id", "start_time", ["batch_id", "yield_pct", "start_time"],
                    tie=["batch_id"], bucket_seconds=DAY)
    mb = interval_sums(seq.filter(F.col("prev_start_time").isNotNull()), t.maintenance_events,
                       "equipment_id", "prev_start_time", "start_time", "event_timestamp",
                       {"maintenance_between": F.lit(1).cast("long")}, bucket_seconds=DAY, prune=True)
    j = (seq.filter(F.col("prev_batch_id").isNotNull())
         .join(mb, ["equipment_id", "prev_start_time", "start_time"], "left")
         .withColumn("maintenance_between", F.coalesce("maintenance_between", F.lit(0))))
    y, p, mbw = F.col("yield_pct"), F.col("prev_yield_pct"), F.col("maintenance_between")
    risk = (F.when((p < low) & (y < low) & (mbw == 0),
                   B7_CONTAMINATION_RISK[0])
            .when((p >= high) & (y < low) & (mbw == 0), B7_CONTAMINATION_RISK[1])
            .when((p < recovered) & (y >= high) & (mbw >= 1), B7_CONTAMINATION_RISK[2])
            .otherwise(B7_CONTAMINATION_RISK[3]))
    return j.select(
        "equipment_id", "batch_id", F.col("prev_batch_id").alias("prev_batch"),
        y.alias("current_yield"), p.alias("prev_yield"), F.round(y - p, 2).alias("yield_delta"),
        "maintenance_between", risk.alias("contamination_risk"))


def latest_maintenance(t: FabTables) -> DataFrame:
    """The latest maintenance event per tool overall (not as-of the test).
    A max-by aggregate (map-side partial) instead of ROW_NUMBER over the tool."""
    return (t.maintenance_events.groupBy("equipment_id")
            .agg(F.max_by("event_type", F.struct("event_timestamp", "event_id")).alias("recent_maintenance")))


def r3_wafer_lineage(t: FabTables, wafer_ids=None) -> DataFrame:
    tests = t.fact_wafer_tests
    if _ids(wafer_ids) is not None:
        tests = tests.filter(F.col("wafer_id").isin(list(_ids(wafer_ids))))
    wt = tests.select("wafer_id", "batch_id", "equipment_id", "process_step_id",
                      F.col("pass_fail").alias("test_result"), "start_time", "end_time")
    ev = t.fact_equipment_events.select("equipment_id", "event_timestamp",
                                        F.col("status").alias("equipment_status_during_process"))
    # The batches' columns come last, so the interval join shuffles narrow rows.
    lin = interval_events(wt, ev, "equipment_id", "start_time", "end_time", "event_timestamp",
                          bucket_seconds=HOUR)
    lin = lin.join(t.dim_wafer_batches.select("batch_id", "lot_number", "recipe"), "batch_id")
    lin = lin.join(latest_maintenance(t), "equipment_id", "left")
    out = lin.select("wafer_id", "batch_id", "lot_number", "recipe", "equipment_id", "process_step_id",
                     "test_result", "equipment_status_during_process", "recent_maintenance", "event_timestamp")
    if _ids(wafer_ids) is not None:
        out = out.orderBy("wafer_id", "process_step_id", "equipment_id", "event_timestamp")
    return out.drop("event_timestamp")


def x5_route_explode(t: FabTables) -> DataFrame:
    return explode_route(t.dim_wafer_batches)


def x6_route_conformance(t: FabTables) -> DataFrame:
    """Per batch: test rows whose tool equals the tool planned at that step position."""
    planned = explode_route(t.dim_wafer_batches).select(
        "batch_id", F.col("position").alias("process_step_id"), F.col("equipment_id").alias("planned"))
    j = t.fact_wafer_tests.select("batch_id", "process_step_id", "equipment_id").join(
        planned, ["batch_id", "process_step_id"], "left")
    ok = F.col("equipment_id").cast("string") == F.col("planned")
    g = j.groupBy("batch_id").agg(F.count(F.lit(1)).alias("tests"),
                                  F.count(F.when(ok, 1)).alias("conforming_tests"),
                                  F.count(F.when(F.col("planned").isNull(), 1)).alias("unplanned_steps"))
    return g.select("batch_id", "tests", "conforming_tests", "unplanned_steps",
                    F.round(pct("conforming_tests", "tests"), 2).alias("conformance_pct"))

