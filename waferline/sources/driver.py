"""Deterministic star-schema view of the driver's TPC-H-like test tables.

The test data has no wafer tables, so the fab model is mapped onto it with fixed
arithmetic (SURVEY §7.3). The identical mapping is spelled out in DuckDB SQL in
:mod:`waferline.oracle` so that both engines see the same curated rows.

Everything here is narrow projections and row-wise expressions over the scans; the
only shuffles are the batch dimension (grouping orders by batch) and its planned
route (grouping tests by batch and step).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waferline.sources.schemas import EQUIPMENT_TYPES, PROCESS_STEP_ROWS, RECIPES
from waferline.sources.tables import FabTables

EPOCH = "2024-01-01 00:00:00"
WAFERS_PER_BATCH = 25
BATCHES_PER_LOT = 4


def _base() -> Column:
    return F.lit(EPOCH).cast("timestamp_ntz")


def _pick(values: list[str], idx0: Column) -> Column:
    """values[idx0] with a 0-based index column (NULL outside the list)."""
    return F.try_element_at(F.array(*[F.lit(v) for v in values]), idx0.cast("int") + 1)


def step_name(step: Column) -> Column:
    expr = None
    for sid, name, _, _ in PROCESS_STEP_ROWS:
        expr = (F.when(step == sid, F.lit(name)) if expr is None
                else expr.when(step == sid, F.lit(name)))
    return expr


def batch_start(batch: Column) -> Column:
    return F.timestamp_add("MINUTE", (batch * 7919) % 43200, _base())


def literal_table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small fixed table as a local relation (no RDD, no job to read it)."""
    names = [f.strip().split(" ")[0] for f in schema.split(",")]
    types = [f.strip().split(" ", 1)[1] for f in schema.split(",")]
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, n, t in zip(r, names, types)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def process_steps(spark: SparkSession) -> DataFrame:
    return literal_table(spark, PROCESS_STEP_ROWS,
                         "process_step_id int, process_step_name string, equipment_type string, duration_min int")


RAW_EVENTS_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                     "value double, props string")


def map_events(events: DataFrame) -> DataFrame:
    """Driver ``events`` rows -> equipment log rows (row-wise: batch or streaming)."""
    ev = events.select("event_id", "ts", "user_id", "event_type", "value", "props")
    return ev.select(
        F.col("user_id").alias("equipment_id"),
        F.col("ts").alias("event_timestamp"),
        F.when(F.col("event_type").isin("view", "click"), "RUNNING")
         .when(F.col("event_type") == "purchase", "IDLE")
         .when(F.col("event_type") == "error", "ALARM")
         .when(F.col("event_type") == "signup", "DOWN").alias("status"),
        F.col("value").alias("temperature_c"),
        F.get_json_object("props", "$.k").cast("double").alias("pressure_torr"),
        F.timestamp_add("SECOND", (F.col("event_id") * 9973) % 93600, F.col("ts"))
         .alias("ingestion_timestamp"),
        F.col("event_id"),
    )


def driver_tables(spark: SparkSession, sf_dir: str) -> FabTables:
    def rd(t: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{t}.parquet")

    sup = rd("supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    nat = rd("nation").select("n_nationkey", "n_name")
    dim_equipment = (
        sup.join(nat, sup.s_nationkey == nat.n_nationkey)
        .select(
            F.col("s_suppkey").alias("equipment_id"),
            _pick(EQUIPMENT_TYPES, F.pmod("s_nationkey", F.lit(7))).alias("equipment_type"),
            F.col("n_name").alias("manufacturer"),
            F.date_sub(F.lit("2024-01-01").cast("date"),
                       (F.lit(365) + (F.col("s_suppkey") * 37) % 1460).cast("int")).alias("install_date"),
            F.when(F.col("s_acctbal") < 0, "INACTIVE").otherwise("ACTIVE").alias("status"),
        ))

    li = rd("lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity",
                               "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    batch = F.expr(f"l_orderkey div {WAFERS_PER_BATCH}")
    start = F.timestamp_add("MINUTE", (batch * 7919) % 43200 + (F.col("l_linenumber") - 1) * 45,
                            _base())
    end = F.timestamp_add("MINUTE", (F.lit(12) + F.col("l_quantity")).cast("int"), start)
    fact_wafer_tests = li.select(
        F.col("l_orderkey").alias("wafer_id"),
        batch.alias("batch_id"),
        F.col("l_linenumber").alias("process_step_id"),
        step_name(F.col("l_linenumber")).alias("process_step_name"),
        F.col("l_suppkey").alias("equipment_id"),
        start.alias("start_time"),
        end.alias("end_time"),
        F.when(F.col("l_tax") >= 0.075, "FAIL").otherwise("PASS").alias("pass_fail"),
        F.col("l_discount").alias("defect_density"),
        F.concat("l_returnflag", "l_linestatus").alias("bin_code"),
        end.alias("test_timestamp"),
    )

    # Planned route of a batch: per step position the lowest tool id used for it.
    route = (li.groupBy(batch.alias("batch_id"), F.col("l_linenumber").alias("pos"))
             .agg(F.min("l_suppkey").alias("tool"))
             .groupBy("batch_id")
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "tool"))),
                                           lambda s: s["tool"].cast("string")), ",")
                  .alias("equipment_sequence")))
    b = F.col("batch_id")
    batches = (rd("orders").select(F.expr(f"o_orderkey div {WAFERS_PER_BATCH}").alias("batch_id"))
               .groupBy("batch_id").agg(F.count(F.lit(1)).cast("int").alias("wafer_count")))
    dim_wafer_batches = batches.join(route, "batch_id", "left").select(
        b,
        F.format_string("LOT_2024_%04d", F.expr(f"batch_id div {BATCHES_PER_LOT}")).alias("lot_number"),
        _pick(RECIPES, F.pmod(b, F.lit(3))).alias("recipe"),
        batch_start(b).alias("start_time"),
        F.timestamp_add("MINUTE", F.lit(195) + (b * 13) % 80, batch_start(b)).alias("end_time"),
        "equipment_sequence",
        "wafer_count",
    )

    fact_equipment_events = map_events(rd("events"))
    maintenance_events = (fact_equipment_events.filter(F.col("pressure_torr") < 10).select(
        "event_id", "equipment_id",
        F.when(F.col("event_id") % 2 == 0, "PREVENTIVE").otherwise("CORRECTIVE").alias("event_type"),
        "event_timestamp",
        (F.lit(1) + F.col("event_id") % 8).cast("int").alias("duration_hours"),
    ))
    return FabTables(dim_equipment=dim_equipment, dim_process_steps=process_steps(spark),
                     dim_wafer_batches=dim_wafer_batches, fact_wafer_tests=fact_wafer_tests,
                     fact_equipment_events=fact_equipment_events,
                     maintenance_events=maintenance_events)
