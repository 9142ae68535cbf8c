"""Equipment-health analytics.

Events are aggregated per (tool, day) or (tool, week) with map-side partial
aggregation first; the tool dimension is joined to the (much smaller) aggregates.
Per-tool sequences (MTBF gaps) use the bucketed LAG of
:mod:`waferline.operators.sequence`; the maintenance windows of E5 use the bucketed
interval join of :mod:`waferline.operators.intervals`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waferline.functions.exprs import (as_of_date, flag, pct, round_avg, since, stable, tier,
                                       ts_diff, window_start, yearweek)
from waferline.operators.intervals import interval_sums, ratio_of
from waferline.operators.sequence import lag_col
from waferline.sources.tables import DEFAULT_AS_OF, FabTables
from waferline.plans.labels import (E1_HEALTH_STATUS,
                                     E2_RELIABILITY,
                                     E3_ALARM_SEVERITY,
                                     E4_DEGRADATION,
                                     E5_EFFECTIVENESS,
                                     E6_CRITICALITY,
                                     R2_HEALTH_STATUS)

def st_():
    return F.col("status")


def _events_since(t: FabTables, as_of, **kw) -> DataFrame:
    return since(t.fact_equipment_events, "event_timestamp", as_of, **kw)


def e1_uptime(t: FabTables, as_of=DEFAULT_AS_OF, days: int = 30, tiers=(95, 90, 85)) -> DataFrame:
    daily = (_events_since(t, as_of, days=days)
             .groupBy("equipment_id", F.to_date("event_timestamp").alias("date"))
             .agg(F.count(F.lit(1)).alias("n"),
                  F.sum(flag(st_() == "RUNNING")).alias("run"),
                  F.sum(flag(st_() == "ALARM")).alias("alarm"),
                  F.sum(flag(st_() == "DOWN")).alias("down")))
    per_tool = (daily.groupBy("equipment_id")
                .agg(stable(F.avg(pct("run", "n"))).alias("avg_uptime_pct"),
                     stable(F.avg(pct("alarm", "n"))).alias("avg_alarm_rate_pct"),
                     stable(F.avg(pct("down", "n"))).alias("avg_downtime_pct"),
                     F.sum("alarm").alias("total_alarms_30d"),
                     F.sum("down").alias("total_down_events_30d")))
    dim = t.dim_equipment.select("equipment_id", "equipment_type", "manufacturer")
    return (per_tool.join(dim, "equipment_id")
            .select("equipment_id", "equipment_type", "manufacturer", "avg_uptime_pct",
                    "avg_alarm_rate_pct", "avg_downtime_pct", "total_alarms_30d",
                    "total_down_events_30d",
                    tier("avg_uptime_pct", list(zip(tiers, E1_HEALTH_STATUS[:3])),
                         E1_HEALTH_STATUS[3]).alias("health_status"))
            .orderBy("avg_uptime_pct", "equipment_id"))


def down_gaps(t: FabTables, as_of=DEFAULT_AS_OF, days: int = 90) -> DataFrame:
    """Whole hours between consecutive DOWN events of a tool (TIMESTAMPDIFF truncates)."""
    down = (_events_since(t, as_of, days=days).filter(st_() == "DOWN")
            .select("equipment_id", "event_timestamp"))
    g = lag_col(down, "equipment_id", "event_timestamp", "event_timestamp", name="prev_ts")
    return (g.filter(F.col("prev_ts").isNotNull())
            .select("equipment_id",
                    ts_diff("HOUR", "prev_ts", "event_timestamp").alias("hours_between_failures")))


def e2_mtbf(t: FabTables, as_of=DEFAULT_AS_OF, days: int = 90,
            tiers=(720, 360, 168)) -> DataFrame:
    per_tool = (down_gaps(t, as_of, days).groupBy("equipment_id")
                .agg(F.count("hours_between_failures").alias("failure_count"),
                     F.avg(F.col("hours_between_failures").cast("decimal(20,0)")).alias("mh")))
    dim = (t.dim_equipment.filter(F.col("status") == "ACTIVE")
           .select("equipment_id", "equipment_type", "manufacturer", "install_date"))
    mh = F.col("mh")
    return (dim.join(per_tool, "equipment_id", "left")
            .select("equipment_id", "equipment_type", "manufacturer",
                    F.datediff(F.lit(as_of_date(as_of).date()), "install_date").alias("age_days"),
                    F.coalesce("failure_count", F.lit(0)).alias("failure_count"),
                    F.round(mh, 1).cast("double").alias("mtbf_hours"),
                    F.round(mh / 24, 1).cast("double").alias("mtbf_days"),
                    tier(mh, list(zip(tiers, E2_RELIABILITY[:3])), E2_RELIABILITY[3]).alias("reliability_rating"))
            .orderBy(F.asc_nulls_last("mtbf_hours"), "equipment_id"))


def e3_alarm_severity(t: FabTables, as_of=DEFAULT_AS_OF, days: int = 30, min_alarms: int = 10,
                      tiers=(100, 50, 20)) -> DataFrame:
    alarms = _events_since(t, as_of, days=days).filter(st_() == "ALARM")
    daily = (alarms.groupBy("equipment_id", F.to_date("event_timestamp").alias("date"))
             .agg(F.count(F.lit(1)).alias("alarm_count"),
                  F.avg(F.col("temperature_c").cast("decimal(30,6)")).alias("avg_temp"),
                  F.stddev_samp("temperature_c").alias("temp_std")))
    per_tool = (daily.groupBy("equipment_id")
                .agg(F.countDistinct("date").alias("days_with_alarms"),
                     F.sum("alarm_count").alias("total_alarms"),
                     round_avg("alarm_count", 1, scale=0).alias("avg_alarms_per_day"),
                     F.round(F.avg("avg_temp"), 1).cast("double").alias("avg_alarm_temperature"),
                     F.round(F.avg("temp_std"), 2).alias("temp_variability"))
                .filter(F.col("total_alarms") >= min_alarms))
    dim = t.dim_equipment.select("equipment_id", "equipment_type")
    return (per_tool.join(dim, "equipment_id")
            .select("equipment_id", "equipment_type", "days_with_alarms", "total_alarms",
                    "avg_alarms_per_day", "avg_alarm_temperature", "temp_variability",
                    tier("total_alarms", list(zip(tiers, E3_ALARM_SEVERITY[:3])), E3_ALARM_SEVERITY[3])
                    .alias("alarm_severity"))
            .orderBy(F.desc("total_alarms"), "equipment_id"))


def e4_degradation(t: FabTables, as_of=DEFAULT_AS_OF, weeks: int = 12, window_weeks: int = 4,
                   temp_high: float = 1.5, alarm_high: float = 2.0,
                   temp_moderate: float = 1.2) -> DataFrame:
    ev = (_events_since(t, as_of, weeks=weeks).filter(st_().isin("RUNNING", "ALARM")))
    weekly = (ev.groupBy("equipment_id", yearweek("event_timestamp").alias("year_week"))
              .agg(F.stddev_samp("temperature_c").alias("temp_std"),
                   F.count(F.when(st_() == "ALARM", 1)).alias("alarm_count")))
    # At most `weeks`+1 rows per tool: the per-tool window is bounded by construction.
    w = Window.partitionBy("equipment_id").orderBy("year_week").rowsBetween(-(window_weeks - 1), 0)
    trend = weekly.select("*", F.avg("temp_std").over(w).alias("temp_std_4wk_avg"),
                          F.avg("alarm_count").over(w).alias("alarm_4wk_avg"))
    cur = F.max_by(F.struct("temp_std", "temp_std_4wk_avg", "alarm_count", "alarm_4wk_avg"),
                   "year_week")
    per_tool = trend.groupBy("equipment_id").agg(F.max("year_week").alias("latest_week"),
                                                 cur.alias("c"))
    dim = t.dim_equipment.select("equipment_id", "equipment_type")
    ts_, tb = F.col("c.temp_std"), F.col("c.temp_std_4wk_avg")
    al, ab = F.col("c.alarm_count").cast("double"), F.col("c.alarm_4wk_avg")
    status = (F.when((ts_ > tb * temp_high) & (al > ab * alarm_high),
                     E4_DEGRADATION[0])
              .when(ts_ > tb * temp_moderate, E4_DEGRADATION[1])
              .otherwise(E4_DEGRADATION[2]))
    return (per_tool.join(dim, "equipment_id")
            .select("equipment_id", "equipment_type", "latest_week",
                    F.round(ts_, 3).alias("current_temp_variability"),
                    F.round(tb, 3).alias("baseline_temp_variability"),
                    al.alias("current_week_alarms"),
                    F.round(ab, 1).alias("baseline_alarms"),
                    status.alias("degradation_status"))
            .orderBy("degradation_status", "equipment_id"))


def e5_maintenance_effect(t: FabTables, as_of=DEFAULT_AS_OF, days: int = 90,
                          window_days: int = 7, high_factor: float = 0.7) -> DataFrame:
    m = (t.maintenance_events.filter(F.col("event_timestamp") >= window_start(as_of, days=days))
         .select("equipment_id", "event_type", F.col("event_timestamp").alias("mt")))
    span = F.expr(f"INTERVAL {window_days} DAYS")
    win = (m.select("equipment_id", "mt").distinct()
           .withColumn("w_lo", F.col("mt") - span).withColumn("w_hi", F.col("mt") + span))
    # Events and tests form one observation stream and the pre/post windows one window
    # set, so all four subqueries are one prefix-sum pass (both windows include mt).
    # Nothing before the earliest window matters: a literal bound that prunes partitions.
    reach = days + window_days
    obs = (_events_since(t, as_of, days=reach).select("equipment_id", F.col("event_timestamp").alias("ts"),
                                          (st_() == "ALARM").cast("long").alias("alarm"),
                                          F.lit(1).cast("long").alias("n_ev"),
                                          F.lit(0.0).alias("y"), F.lit(0).cast("long").alias("n_t"))
           .unionByName(since(t.fact_wafer_tests, "test_timestamp", as_of, days=reach).select(
               "equipment_id", F.col("test_timestamp").alias("ts"), F.lit(0).cast("long").alias("alarm"),
               F.lit(0).cast("long").alias("n_ev"),
               F.when(F.col("pass_fail") == "PASS", 100.0).otherwise(0.0).alias("y"),
               F.lit(1).cast("long").alias("n_t"))))
    windows = (win.select("equipment_id", F.col("w_lo").alias("s"), F.col("mt").alias("e"))
               .unionByName(win.select("equipment_id", F.col("mt").alias("s"), F.col("w_hi").alias("e"))))
    sums = interval_sums(windows, obs, "equipment_id", "s", "e", "ts",
                         {c: F.col(c) for c in ("alarm", "n_ev", "y", "n_t")}, bucket_seconds=86400)
    rates = sums.select("equipment_id", "s", "e", ratio_of("alarm", "n_ev").alias("alarm_rate"),
                        ratio_of("y", "n_t").alias("yield"))
    pre = rates.select("equipment_id", F.col("s").alias("w_lo"), F.col("e").alias("mt"),
                       F.col("alarm_rate").alias("pre_alarm_rate"), F.col("yield").alias("pre_yield"))
    post = rates.select("equipment_id", F.col("s").alias("mt"), F.col("e").alias("w_hi"),
                        F.col("alarm_rate").alias("post_alarm_rate"), F.col("yield").alias("post_yield"))
    per_m = (win.join(pre, ["equipment_id", "w_lo", "mt"], "left")
             .join(post, ["equipment_id", "mt", "w_hi"], "left")
             .select("equipment_id", "mt", "pre_alarm_rate", "post_alarm_rate", "pre_yield", "post_yield"))
    rows = (m.join(per_m, ["equipment_id", "mt"])
            .filter(F.col("pre_alarm_rate").isNotNull() & F.col("post_alarm_rate").isNotNull()))
    g = (rows.groupBy("equipment_id", "event_type")
         .agg(F.count(F.lit(1)).alias("maintenance_count"),
              F.avg(F.col("pre_alarm_rate") * 100).alias("pa"),
              F.avg(F.col("post_alarm_rate") * 100).alias("qa"),
              F.avg((F.col("post_alarm_rate") - F.col("pre_alarm_rate")) * 100).alias("da"),
              F.avg("pre_yield").alias("py"), F.avg("post_yield").alias("qy"),
              F.avg(F.col("post_yield") - F.col("pre_yield")).alias("dy"),
              F.avg("pre_alarm_rate").alias("par"), F.avg("post_alarm_rate").alias("qar")))
    eff = (F.when((F.col("qar") < F.col("par") * high_factor) & (F.col("qy") > F.col("py")),
                  E5_EFFECTIVENESS[0])
           .when(F.col("qar") < F.col("par"), E5_EFFECTIVENESS[1])
           .otherwise(E5_EFFECTIVENESS[2]))
    return g.select(
        "equipment_id", "event_type", "maintenance_count",
        F.round("pa", 2).alias("avg_pre_alarm_rate_pct"),
        F.round("qa", 2).alias("avg_post_alarm_rate_pct"),
        F.round("da", 2).alias("alarm_rate_change_pct"),
        F.round("py", 2).alias("avg_pre_yield"), F.round("qy", 2).alias("avg_post_yield"),
        F.round("dy", 2).alias("yield_improvement"),
        eff.alias("maintenance_effectiveness"),
    ).orderBy(F.desc_nulls_last("yield_improvement"), "equipment_id", "event_type")


def e6_criticality(t: FabTables, as_of=DEFAULT_AS_OF, days: int = 30, value_per_wafer: int = 1000,
                   tiers=(500, 200, 50)) -> DataFrame:
    tests = since(t.fact_wafer_tests, "test_timestamp", as_of, days=days)
    # The two distinct counts (which skip NULLs, and count a wafer of two batches once) are rows
    # per (tool, wafer) and per (tool, batch), each in an aggregate of its own: together they
    # would keep every row of a task in two hash maps, under wider keys.
    per_wafer = (tests.groupBy("equipment_id", "wafer_id")
                 .agg(F.sum(flag(F.col("pass_fail") == "PASS")).alias("p"), F.count(F.lit(1)).alias("n"))
                 .groupBy("equipment_id").agg(F.count("wafer_id").alias("wafers_processed_30d"),
                                              pct(F.sum("p"), F.sum("n")).alias("avg_yield")))
    per_batch = (tests.select("equipment_id", "batch_id").distinct()
                 .groupBy("equipment_id").agg(F.count("batch_id").alias("batches_processed_30d")))
    per_tool = per_wafer.join(per_batch, "equipment_id")
    downs = (_events_since(t, as_of, days=days).filter(st_() == "DOWN")
             .groupBy("equipment_id").agg(F.count(F.lit(1)).alias("down_events")))
    dim = (t.dim_equipment.filter(F.col("status") == "ACTIVE")
           .select("equipment_id", "equipment_type", "manufacturer"))
    j = (dim.join(per_tool, "equipment_id", "left").join(downs, "equipment_id", "left")
         .select("equipment_id", "equipment_type", "manufacturer",
                 F.coalesce("batches_processed_30d", F.lit(0)).alias("batches_processed_30d"),
                 F.coalesce("wafers_processed_30d", F.lit(0)).alias("wafers_processed_30d"),
                 # a tool without tests averages one "not PASS" row: 0
                 F.coalesce("avg_yield", F.lit(0.0)).alias("avg_yield"),
                 F.coalesce("down_events", F.lit(0)).alias("down_events")))
    score = ((F.col("wafers_processed_30d") / F.lit(100.0)) * (F.lit(100) - F.col("avg_yield"))
             * (F.lit(1) + F.col("down_events")))
    return j.select(
        "equipment_id", "equipment_type", "manufacturer", "batches_processed_30d",
        "wafers_processed_30d", F.round("avg_yield", 2).alias("yield_pct"), "down_events",
        (F.col("wafers_processed_30d") * value_per_wafer).alias("estimated_value_processed"),
        F.round(score, 2).alias("criticality_score"),
        tier(score, list(zip(tiers, E6_CRITICALITY[:3])), E6_CRITICALITY[3], op=">")
        .alias("criticality_tier"),
    ).orderBy(F.desc_nulls_last("criticality_score"), "equipment_id")


def r2_health_status(t: FabTables, as_of=DEFAULT_AS_OF, days: int = 30,
                     min_uptime: float = 0.85, max_alarms: int = 10) -> DataFrame:
    daily = (_events_since(t, as_of, days=days)
             .groupBy("equipment_id", F.date_trunc("day", "event_timestamp").alias("date"))
             .agg(F.avg(flag(st_() == "RUNNING")).alias("uptime_ratio"),
                  F.count(F.when(st_() == "ALARM", 1)).alias("alarm_count")))
    g = (daily.groupBy("equipment_id")
         .agg(stable(F.avg("uptime_ratio")).alias("avg_uptime"),
              F.sum("alarm_count").alias("total_alarms")))
    return g.select(
        "equipment_id", "avg_uptime", "total_alarms",
        F.when(F.col("avg_uptime") < min_uptime, R2_HEALTH_STATUS[0])
         .when(F.col("total_alarms") > max_alarms, R2_HEALTH_STATUS[1]).otherwise(R2_HEALTH_STATUS[2])
        .alias("health_status"),
    ).orderBy("avg_uptime", "equipment_id")

