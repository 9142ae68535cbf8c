"""Yield analytics.

Plan shape shared by all of them: filter the fact on a literal time bound, join
dimensions only where a grouping key comes from them (Catalyst/AQE broadcast the
small side after checking its size; literal dims are hinted), aggregate with
partial (map-side) aggregation, and apply windows only to the already-aggregated
rows. Where no dimension column is a grouping key, the fact is aggregated first
and joined to the dimension afterwards, so only one row per group is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waferline.functions.exprs import (flag, pct, round_avg, safe_corr, since, stable, tier,
                                       window_start)
from waferline.sources.tables import DEFAULT_AS_OF, FabTables
from waferline.plans.labels import (Y1_PERFORMANCE_TIER,
                                     Y2_TREND_STATUS,
                                     Y4_DISPOSITION,
                                     Y5_PRIORITY,
                                     Y7_INTERPRETATION)


def pass_():
    return F.col("pass_fail") == "PASS"


def fail_():
    return F.col("pass_fail") == "FAIL"


def _tests_since(t: FabTables, as_of, days: int) -> DataFrame:
    return since(t.fact_wafer_tests, "test_timestamp", as_of, days=days)


def y1_yield_by_equipment(t: FabTables, as_of=DEFAULT_AS_OF, days: int = 7,
                          min_wafers: int = 30, tiers=(95, 90, 85)) -> DataFrame:
    per_tool = (_tests_since(t, as_of, days)
                .groupBy("equipment_id")
                .agg(F.countDistinct("wafer_id").alias("total_wafers_processed"),
                     F.sum(flag(pass_())).alias("passed_wafers"),
                     F.min("test_timestamp").alias("first_test"),
                     F.max("test_timestamp").alias("last_test"))
                .filter(F.col("total_wafers_processed") >= min_wafers))
    dim = t.dim_equipment.select("equipment_id", "equipment_type", "manufacturer")
    y = F.round(pct("passed_wafers", "total_wafers_processed"), 2)
    return (per_tool.join(dim, "equipment_id")
            .select("equipment_id", "equipment_type", "manufacturer", "total_wafers_processed",
                    "passed_wafers", y.alias("yield_pct"),
                    tier(y, list(zip(tiers, Y1_PERFORMANCE_TIER[:3])),
                         Y1_PERFORMANCE_TIER[3]).alias("performance_tier"),
                    F.datediff("last_test", "first_test").alias("days_in_operation"))
            .orderBy("yield_pct", "equipment_id"))


def y2_yield_trend(t: FabTables, as_of=DEFAULT_AS_OF, days: int = 30, min_wafers: int = 20,
                   ma_rows: int = 7, drop_major: float = 5, drop_minor: float = 2,
                   improve: float = 2) -> DataFrame:
    dim = t.dim_equipment.select("equipment_id", "equipment_type")
    daily = (_tests_since(t, as_of, days).join(dim, "equipment_id")
             .groupBy(F.to_date("test_timestamp").alias("test_date"), "equipment_type")
             .agg(F.countDistinct("wafer_id").alias("wafers"), F.sum(flag(pass_())).alias("passed"))
             .filter(F.col("wafers") >= min_wafers)
             .withColumn("yield_pct", F.round(pct("passed", "wafers"), 2)))
    # Windows run over one row per (day, type): a few thousand rows at most.
    w = Window.partitionBy("equipment_type").orderBy("test_date")
    ma = F.avg("yield_pct").over(w.rowsBetween(-(ma_rows - 1), 0))
    overall = F.avg("yield_pct").over(Window.partitionBy("equipment_type"))
    # The deviation is rounded from exact decimals: it often falls on a rounding tie.
    exact = F.col("yield_pct").cast("decimal(20,2)")
    dev = F.round(exact - F.avg(exact).over(w.rowsBetween(-(ma_rows - 1), 0)), 2).cast("double")
    d = daily.select("test_date", "equipment_type", "wafers", "yield_pct",
                     ma.alias("ma"), overall.alias("overall"), dev.alias("dev"))
    y, o = F.col("yield_pct"), F.col("overall")
    return d.select(
        "test_date", "equipment_type", "wafers", "yield_pct",
        stable("ma").alias("yield_7day_ma"), stable("overall").alias("overall_avg_yield"),
        F.col("dev").alias("deviation_from_trend"),
        F.when(y < o - drop_major, Y2_TREND_STATUS[0]).when(y < o - drop_minor, Y2_TREND_STATUS[1])
         .when(y > o + improve, Y2_TREND_STATUS[2]).otherwise(Y2_TREND_STATUS[3]).alias("trend_status"),
    ).orderBy(F.desc("test_date"), "equipment_type")


def y3_step_failure(t: FabTables, as_of=DEFAULT_AS_OF, days: int = 30) -> DataFrame:
    per_step = (_tests_since(t, as_of, days)
                .groupBy("process_step_id")
                .agg(F.countDistinct("wafer_id").alias("wafers_tested"),
                     F.sum(flag(pass_())).alias("passed"),
                     F.sum(flag(fail_())).alias("failed"),
                     F.count(F.lit(1)).alias("n"),
                     F.avg("defect_density").alias("avg_dd"),
                     F.avg(F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time"))
                           / F.lit(60.0)).alias("avg_min")))
    steps = t.dim_process_steps.select("process_step_id", "process_step_name",
                                                   "equipment_type")
    return (per_step.join(steps, "process_step_id")
            .select("process_step_id", "process_step_name", "equipment_type", "wafers_tested",
                    "passed", "failed", F.round(pct("failed", "n"), 2).alias("failure_rate_pct"),
                    stable("avg_dd").alias("avg_defect_density"),
                    F.round("avg_min", 1).alias("avg_duration_min"))
            .orderBy(F.desc("failure_rate_pct"), "process_step_id"))


def y4_batch_yield(t: FabTables, as_of=DEFAULT_AS_OF, days: int = 7,
                   tiers=(95, 90, 80)) -> DataFrame:
    batches = (t.dim_wafer_batches.filter(F.col("start_time") >= window_start(as_of, days=days))
               .select("batch_id", "lot_number", "recipe", F.col("start_time").alias("b_start")))
    m = (t.fact_wafer_tests.select("batch_id", "wafer_id", "pass_fail", "defect_density",
                                   "equipment_id").join(batches, "batch_id")
         .groupBy("batch_id", "lot_number", "recipe", F.col("b_start").alias("start_time"))
         .agg(F.countDistinct("wafer_id").alias("wafer_count"),
              F.sum(flag(pass_())).alias("passed_wafers"),
              round_avg("defect_density", 3).alias("avg_defect_density"),
              # bounded per batch: the distinct tools of one batch
              F.array_join(F.array_sort(F.collect_set(F.col("equipment_id").cast("string"))), ", ")
              .alias("equipment_used")))
    y = F.round(pct("passed_wafers", "wafer_count"), 2)
    return (m.select("batch_id", "lot_number", "recipe", F.to_date("start_time").alias("batch_date"),
                     "wafer_count", "passed_wafers", y.alias("batch_yield_pct"),
                     "avg_defect_density", "equipment_used",
                     tier(y, list(zip(tiers, Y4_DISPOSITION[:3])), Y4_DISPOSITION[3])
                     .alias("disposition"), "start_time")
            .orderBy("batch_yield_pct", F.desc("start_time"), "batch_id")
            .drop("start_time"))


def y5_defect_pareto(t: FabTables, as_of=DEFAULT_AS_OF, days: int = 30,
                     high: float = 80, medium: float = 95) -> DataFrame:
    bins = (_tests_since(t, as_of, days).filter(fail_())
            .groupBy("bin_code").agg(F.count(F.lit(1)).alias("defect_count")))
    total = bins.agg(F.sum("defect_count").alias("_all"))          # one row
    shares = bins.crossJoin(F.broadcast(total)).select(
        "bin_code", "defect_count", F.round(pct("defect_count", "_all"), 2).cast("decimal(18,2)").alias("pct_of_total"))
    # Bins with equal counts share the cumulative value, so it runs over the distinct counts:
    # no more than the square root of twice the rows, however many bin codes there are.
    by_count = shares.groupBy("defect_count").agg(F.sum("pct_of_total").alias("_s"))
    cum = by_count.select("defect_count", F.sum("_s").over(
        Window.orderBy(F.desc("defect_count")).rowsBetween(Window.unboundedPreceding, 0)).alias("cumulative_pct"))
    c = shares.join(cum, "defect_count")
    cp = F.col("cumulative_pct")
    return c.select(
        F.col("bin_code").alias("defect_type"), "defect_count",
        F.col("pct_of_total").cast("double").alias("pct_of_total"),
        cp.cast("double").alias("cumulative_pct"),
        F.when(cp <= high, Y5_PRIORITY[0]).when(cp <= medium, Y5_PRIORITY[1])
         .otherwise(Y5_PRIORITY[2]).alias("improvement_priority"),
    ).orderBy(F.desc("defect_count"), "defect_type")


def y6_first_pass_yield(t: FabTables, as_of=DEFAULT_AS_OF, days: int = 30,
                        first_step: int = 1) -> DataFrame:
    # Scalar subquery (SELECT MAX(process_step_id) FROM dim_process_steps): one row, broadcast.
    last_step = t.dim_process_steps.agg(F.max("process_step_id").alias("_last"))
    step = F.col("process_step_id")
    per_wafer = (_tests_since(t, as_of, days).crossJoin(F.broadcast(last_step))
                 .groupBy("wafer_id", "batch_id")
                 .agg(F.min(F.when(step == first_step, F.col("pass_fail"))).alias("first_r"),
                      F.max(F.when(step == F.col("_last"), F.col("pass_fail"))).alias("final_r")))
    s = per_wafer.agg(F.count(F.lit(1)).alias("total_wafers"),
                      F.sum(flag(F.col("first_r") == "PASS")).alias("first_pass_count"),
                      F.sum(flag(F.col("final_r") == "PASS")).alias("final_pass_count"),
                      F.sum(flag(F.col("first_r") == "FAIL")).alias("first_fail"))
    return s.select(
        "total_wafers", "first_pass_count", "final_pass_count",
        F.round(pct("first_pass_count", "total_wafers"), 2).alias("first_pass_yield"),
        F.round(pct("final_pass_count", "total_wafers"), 2).alias("final_yield"),
        F.round(pct(F.col("final_pass_count") - F.col("first_pass_count"), "first_fail"), 2)
        .alias("rework_recovery_rate"))


def y7_utilization_yield_corr(t: FabTables, as_of=DEFAULT_AS_OF, days: int = 30,
                              min_tests_per_day: int = 20, min_days: int = 7,
                              strong: float = -0.5, moderate: float = -0.3) -> DataFrame:
    util = (since(t.fact_equipment_events, "event_timestamp", as_of, days=days)
            .groupBy("equipment_id", F.to_date("event_timestamp").alias("date"))
            .agg(pct(F.sum(flag(F.col("status") == "RUNNING")), F.count(F.lit(1)))
                 .alias("utilization_pct")))
    dy = (_tests_since(t, as_of, days)
          .groupBy("equipment_id", F.to_date("test_timestamp").alias("date"))
          .agg(F.round(pct(F.sum(flag(pass_())), F.count(F.lit(1))), 2).alias("yield_pct"),
               F.count(F.lit(1)).alias("n"))
          .filter(F.col("n") >= min_tests_per_day).drop("n"))
    # Both sides are already one row per (tool, day): the join shuffles aggregates only.
    j = util.join(dy, ["equipment_id", "date"])
    g = (j.groupBy("equipment_id")
         .agg(F.avg("utilization_pct").alias("u"), F.avg("yield_pct").alias("y"),
              safe_corr("utilization_pct", "yield_pct").alias("r"), F.count(F.lit(1)).alias("n"))
         .filter(F.col("n") >= min_days))
    r = F.col("r")
    return g.select(
        "equipment_id", stable("u").alias("avg_utilization"), stable("y").alias("avg_yield"),
        stable(r).alias("utilization_yield_correlation"),
        F.when(r < strong, Y7_INTERPRETATION[0])
         .when(r < moderate, Y7_INTERPRETATION[1])
         .otherwise(Y7_INTERPRETATION[2]).alias("interpretation"),
    ).orderBy(F.asc_nulls_first("utilization_yield_correlation"), "equipment_id")


def r1_yield_tool_step(t: FabTables, as_of=DEFAULT_AS_OF, days: int = 7,
                       min_tests: int = 30) -> DataFrame:
    """Yield by tool and step; the denominator is test rows (COUNT(*))."""
    g = (_tests_since(t, as_of, days)
         .groupBy("equipment_id", "process_step_id")
         .agg(F.countDistinct("wafer_id").alias("total_wafers"),
              F.sum(flag(pass_())).alias("passed_wafers"), F.count(F.lit(1)).alias("n"))
         .filter(F.col("n") >= min_tests))
    dim = t.dim_equipment.select("equipment_id", "equipment_type")
    steps = t.dim_process_steps.select(
        "process_step_id", F.col("process_step_name").alias("process_step"))
    return (g.join(dim, "equipment_id").join(steps, "process_step_id")
            .select("equipment_id", "equipment_type", "process_step", "total_wafers",
                    "passed_wafers", F.round(pct("passed_wafers", "n"), 2).alias("yield_pct"))
            .orderBy(F.desc("yield_pct"), "equipment_id", "process_step"))
