"""Fleet KPIs (X1-X4): chamber matching, executive KPIs, control limits, excursions.

Peer statistics use windows over already-aggregated rows (one row per tool and
recipe), and control limits are a per-tool aggregate joined back to the events -
never a window over raw events partitioned by tool.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waferline.functions.exprs import flag, pct, round_avg, ts_diff, window_start
from waferline.functions.exprs import since as since_
from waferline.operators.intervals import with_interval_sums
from waferline.plans.layers import clean_batch_share, daily_yield
from waferline.sources.tables import DEFAULT_AS_OF, FabTables

def pass_():
    return F.col("pass_fail") == "PASS"


def _dec2(c) -> F.Column:
    return F.col(c).cast("decimal(20,2)")


def x1_chamber_matching(t: FabTables, as_of=DEFAULT_AS_OF, days: int = 30) -> DataFrame:
    tests = (since_(t.fact_wafer_tests, "test_timestamp", as_of, days=days)
             .join(t.dim_wafer_batches.select("batch_id", "recipe"), "batch_id"))
    per = (tests.groupBy("recipe", "equipment_id")
           .agg(F.count(F.lit(1)).alias("tests"), F.sum(flag(pass_())).alias("passed"))
           .withColumn("yield_pct", F.round(pct("passed", "tests"), 2)))
    temp = (since_(t.fact_equipment_events, "event_timestamp", as_of, days=days)
            .groupBy("equipment_id").agg(round_avg("temperature_c", 2).alias("avg_temp_c")))
    dim = t.dim_equipment.select("equipment_id", "equipment_type")
    j = per.join(dim, "equipment_id").join(temp, "equipment_id", "left")
    # Peers: tools of the same type running the same recipe (one row per tool here).
    w = Window.partitionBy("equipment_type", "recipe")
    py = F.avg(_dec2("yield_pct")).over(w)
    pt = F.avg(_dec2("avg_temp_c")).over(w)
    return j.select(
        "equipment_type", "recipe", "equipment_id", "tests", "yield_pct", "avg_temp_c",
        F.count(F.lit(1)).over(w).alias("peer_tools"),
        F.round(py, 2).cast("double").alias("peer_yield_pct"),
        F.round(_dec2("yield_pct") - py, 2).cast("double").alias("yield_offset"),
        F.round(pt, 2).cast("double").alias("peer_temp_c"),
        F.round(_dec2("avg_temp_c") - pt, 2).cast("double").alias("temp_offset"),
    ).orderBy("equipment_type", "recipe", "equipment_id")


def x2_executive_kpis(t: FabTables, as_of=DEFAULT_AS_OF, days: int = 30, trend_days: int = 7) -> DataFrame:
    since = window_start(as_of, days=days)
    tests = since_(t.fact_wafer_tests, "test_timestamp", as_of, days=days)
    fab = tests.agg(F.round(pct(F.sum(flag(pass_())), F.count(F.lit(1))), 2).alias("fab_yield_pct"),
                    F.round(F.avg(ts_diff("SECOND", "start_time", "end_time").cast("decimal(20,0)")) / 60, 2)
                    .cast("double").alias("avg_step_minutes"))
    trend = (daily_yield(t, as_of, days=trend_days)
             .agg(round_avg("yield_pct", 2).alias("yield_7day_avg")))
    batches = (t.dim_wafer_batches.filter(F.col("start_time") >= since)
               .agg(F.round(F.count(F.lit(1)) / F.lit(float(days)), 2).alias("batches_per_day")))
    util = (since_(t.fact_equipment_events, "event_timestamp", as_of, days=days)
            .agg(F.round(pct(F.sum(flag(F.col("status") == "RUNNING")), F.count(F.lit(1))), 2)
                 .alias("utilization_pct")))
    clean = clean_batch_share(t).select(F.col("clean_pct").alias("batches_passing_all_rules_pct"))
    # Every input is a one-row aggregate: the cross joins multiply single rows.
    return (fab.crossJoin(trend).crossJoin(batches).crossJoin(util).crossJoin(clean)
            .select("fab_yield_pct", "yield_7day_avg", "batches_per_day", "avg_step_minutes",
                    "utilization_pct", "batches_passing_all_rules_pct"))


def x3_control_limits(t: FabTables, as_of=DEFAULT_AS_OF, days: int = 30, sigmas: float = 3.0) -> DataFrame:
    ev = since_(t.fact_equipment_events, "event_timestamp", as_of, days=days)
    lim = ev.groupBy("equipment_id").agg(
        F.count("temperature_c").alias("n"), round_avg("temperature_c", 3).alias("mean_temp_c"),
        F.avg("temperature_c").alias("_m"), F.stddev_samp("temperature_c").alias("_sd"))
    lim = lim.select("equipment_id", "n", "mean_temp_c", F.round("_sd", 3).alias("sd_temp_c"),
                     (F.col("_m") + sigmas * F.col("_sd")).alias("_ucl"),
                     (F.col("_m") - sigmas * F.col("_sd")).alias("_lcl"))
    # Events are counted per (tool, reading) before they meet the limits: no raw event is
    # shuffled on its tool, and a hot tool is spread over its readings.
    out = (ev.groupBy("equipment_id", "temperature_c").agg(F.count(F.lit(1)).alias("c"))
           .join(lim.select("equipment_id", "_ucl", "_lcl"), "equipment_id")
           .groupBy("equipment_id")
           .agg(F.sum(F.when((F.col("temperature_c") > F.col("_ucl")) | (F.col("temperature_c") < F.col("_lcl")),
                             F.col("c")).otherwise(0)).alias("out_of_control")))
    return (lim.join(out, "equipment_id", "left")
            .select("equipment_id", "n", "mean_temp_c", "sd_temp_c",
                    F.round("_ucl", 3).alias("ucl_temp_c"), F.round("_lcl", 3).alias("lcl_temp_c"),
                    F.coalesce("out_of_control", F.lit(0)).alias("out_of_control"))
            .orderBy(F.desc("out_of_control"), "equipment_id"))


def x4_yield_excursion(t: FabTables, drop_pts: float = 5.0, lookback_hours: int = 24) -> DataFrame:
    # One aggregate of the tests per (batch, tool) feeds the sums. (Tests without a tool have no
    # window, but count.)
    tests, lookback = t.fact_wafer_tests, F.expr(f"INTERVAL {lookback_hours} HOURS")
    bt = tests.groupBy("batch_id", "equipment_id").agg(F.count(F.lit(1)).alias("n"), F.sum(flag(pass_())).alias("p"))
    batches = t.dim_wafer_batches.select("batch_id", "lot_number", F.col("start_time").alias("b_start"),
                                         F.col("end_time").alias("b_end")).withColumn("m_lo", F.col("b_start") - lookback)
    base = tests.agg(pct(F.sum(flag(pass_())), F.count(F.lit(1))).alias("_base"))
    win = bt.join(batches, "batch_id").drop("batch_id")
    win = with_interval_sums(win, t.fact_equipment_events, "equipment_id", "b_start", "b_end", "event_timestamp",
                             {"n_alarms": (F.col("status") == "ALARM").cast("long")}, bucket_seconds=3600, bounds=batches)
    win = with_interval_sums(win.drop("b_end"), t.maintenance_events, "equipment_id", "m_lo", "b_start", "event_timestamp",
                             {"n_maint": F.lit(1).cast("long")}, bucket_seconds=6 * 3600, bounds=batches)
    # Lots' tools are counted as rows per (lot, tool), and their batches as rows per (lot, batch):
    # distinct counts beside the sums would send every row three times.
    zero = F.lit(0).cast("long")
    per_tool = (win.groupBy("lot_number", "equipment_id")
                .agg(*[F.sum(c).alias(c) for c in ("n", "p", "n_alarms", "n_maint")])
                .select("lot_number", zero.alias("batches"), "n", "p", F.col("equipment_id").isNotNull().cast("long").alias("tools"),
                        "n_alarms", "n_maint"))
    of_batch = (batches.join(tests.select("batch_id").distinct(), "batch_id").select("lot_number", "batch_id").distinct()
                .select("lot_number", F.lit(1).cast("long").alias("batches"), *[zero.alias(c) for c in ("n", "p", "tools", "n_alarms", "n_maint")]))
    per_lot = (per_tool.unionByName(of_batch).groupBy("lot_number")
               .agg(F.sum("batches").alias("batches"), F.sum("n").alias("tests"), F.sum("p").alias("passed"),
                    F.sum("tools").alias("tools"), F.sum("n_alarms").alias("alarms_during_batches"),
                    F.sum("n_maint").alias("maintenance_before_batches")))
    y = pct("passed", "tests")
    return (per_lot.crossJoin(F.broadcast(base))
            .select("lot_number", "batches", "tests", F.round(y, 2).alias("yield_pct"),
                    F.round("_base", 2).alias("baseline_pct"),
                    F.round(y - F.col("_base"), 2).alias("deviation_pts"), "tools",
                    "alarms_during_batches", "maintenance_before_batches",
                    (y < F.col("_base") - drop_pts).alias("excursion"))
            .orderBy("deviation_pts", "lot_number"))
