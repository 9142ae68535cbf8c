"""Single-construct queries that exercise one operator each on the whole tables
(SURVEY §7.2): interval lookup, route string, Sunday weeks, orphans, moving
average, share of total, cumulative sum."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waferline.functions.exprs import pct, yearweek
from waferline.operators.intervals import ratio_of, with_interval_sums
from waferline.operators.routes import route_string
from waferline.plans.layers import daily_uptime
from waferline.sources.tables import FabTables


def j4_interval_lookup(t: FabTables) -> DataFrame:
    """Every distinct test window with the events of its tool inside it (prefix sums)."""
    w = t.fact_wafer_tests.select("equipment_id", "start_time", "end_time").distinct()
    # the tests have all bounds, unsorted out: their levels cost no second shuffle
    sums = with_interval_sums(w, t.fact_equipment_events, "equipment_id", "start_time", "end_time", "event_timestamp",
                              {"events_in_window": F.lit(1).cast("long"),
                               "t_sum": F.col("temperature_c").cast("decimal(30,6)"),
                               "t_n": F.col("temperature_c").isNotNull().cast("long")}, bucket_seconds=3600,
                              bounds=t.fact_wafer_tests)
    return (sums
            .select("equipment_id", "start_time", "end_time",
                    F.coalesce("events_in_window", F.lit(0)).alias("events_in_window"),
                    ratio_of("t_sum", "t_n", 2).alias("avg_temp_c")))


def ag9_route(t: FabTables) -> DataFrame:
    return route_string(t.fact_wafer_tests, ["wafer_id", "batch_id"], name="equipment_sequence")


def sf6_yearweek(t: FabTables) -> DataFrame:
    return (t.fact_equipment_events.groupBy(yearweek("event_timestamp").alias("year_week"))
            .agg(F.count(F.lit(1)).alias("events")).orderBy("year_week"))


def j7_orphans(t: FabTables) -> DataFrame:
    """Events of tools that are not in the equipment dimension (NULL ids included)."""
    orphans = t.fact_equipment_events.join(t.dim_equipment.select("equipment_id"), "equipment_id", "left_anti")
    return orphans.groupBy("equipment_id").agg(F.count(F.lit(1)).alias("events")).orderBy("equipment_id")


def w4_moving_avg(t: FabTables, rows: int = 7) -> DataFrame:
    """7-row moving average of each tool's daily uptime (rows present, not days);
    the per-tool window runs over one row per tool and day."""
    d = daily_uptime(t)
    w = Window.partitionBy("equipment_id").orderBy("date").rowsBetween(-(rows - 1), 0)
    return d.select("equipment_id", "date", "uptime_pct",
                    F.round(F.avg("uptime_pct").over(w), 9).alias("uptime_7row_avg"))


def w7_share(t: FabTables) -> DataFrame:
    """Share of every status in all events: the total is a one-row aggregate joined
    to the grouped rows (no single-partition window over the events)."""
    g = t.fact_equipment_events.groupBy("status").agg(F.count(F.lit(1)).alias("events"))
    total = t.fact_equipment_events.agg(F.count(F.lit(1)).alias("_all"))
    return (g.crossJoin(F.broadcast(total))
            .select("status", "events", F.round(pct("events", "_all"), 2).alias("share_pct")))


def w8_cumulative(t: FabTables) -> DataFrame:
    """Running total of events by day (default RANGE frame over the daily rows)."""
    d = (t.fact_equipment_events.groupBy(F.to_date("event_timestamp").alias("date"))
         .agg(F.count(F.lit(1)).alias("events")))
    w = Window.orderBy("date").rangeBetween(Window.unboundedPreceding, 0)
    return d.select("date", "events", F.sum("events").over(w).alias("cumulative_events"))
