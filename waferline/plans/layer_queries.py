"""Registered layer-pipeline queries on the driver tables (PL1-PL10, C8-C12).

The watermark of the incremental examples is one week before the as-of instant."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waferline.functions.exprs import as_datetime, flag, ts_diff, ts_lit
from waferline.plans import conform as CF
from waferline.plans import dimension as D
from waferline.plans import estimates as ES
from waferline.plans import kept as K
from waferline.plans import layers as L
from waferline.plans import quality as Q
from waferline.plans import transforms as TR
from waferline.sources import landing as IO
from waferline.sources import versioned as V
from waferline.sources.tables import DEFAULT_AS_OF, FabTables

WM = as_datetime(DEFAULT_AS_OF) - timedelta(days=7)
EVENT_KEYS = ["equipment_id", "event_timestamp", "event_id"]

EVENTS_SCHEMA = T.StructType([
    T.StructField("equipment_id", T.LongType()), T.StructField("event_timestamp", T.TimestampNTZType()),
    T.StructField("status", T.StringType()), T.StructField("temperature_c", T.DoubleType()),
    T.StructField("pressure_torr", T.DoubleType()),
    T.StructField("ingestion_timestamp", T.TimestampNTZType()), T.StructField("event_id", T.LongType()),
])


def pl1_standardize(t: FabTables) -> DataFrame:
    good, rejects = L.standardize(L.as_raw_strings(t.fact_equipment_events), EVENTS_SCHEMA,
                                  required=["equipment_id", "event_timestamp"],
                                  allowed={"status": ["RUNNING", "IDLE", "ALARM", "DOWN"]})
    g = good.agg(F.count(F.lit(1)).alias("good_rows"))
    r = rejects.agg(F.count(F.lit(1)).alias("rejected_rows"))
    return g.crossJoin(r)


def pl1_rejects(t: FabTables) -> DataFrame:
    """Rejected rows of a text landing with bad casts, missing keys and unknown states."""
    raw = L.as_raw_strings(t.fact_equipment_events)
    e = F.col("event_id").cast("long")
    raw = (raw.withColumn("temperature_c", F.when(e % 223 == 2, "n/a").otherwise(F.col("temperature_c")))
           .withColumn("status", F.when(e % 211 == 1, "BROKEN").otherwise(F.col("status"))))
    _, rejects = L.standardize(raw, EVENTS_SCHEMA, required=["equipment_id", "event_timestamp"],
                               allowed={"status": ["RUNNING", "IDLE", "ALARM", "DOWN"]})
    order = ["cast:temperature_c", "null:equipment_id", "domain:status"]
    return rejects.select(e.alias("event_id"), F.array_join(F.array_sort("reject_reasons", lambda a, b: (
        F.array_position(F.array(*map(F.lit, order)), a) - F.array_position(F.array(*map(F.lit, order)), b)).cast("int")),
        ",").alias("reasons"))


def pl6_write_upsert(t: FabTables) -> DataFrame:
    """A table of files by day: loaded, then merged (twice) with later versions of a fifth
    of its keys, which move to other days."""
    from waferline.session import checkpoint_dir
    spark = t.fact_equipment_events.sparkSession
    path = f"{checkpoint_dir(spark)}/upsert-table-{uuid.uuid4().hex}"
    ev = t.fact_equipment_events.select("event_id", "event_timestamp", "ingestion_timestamp")
    later = ev.filter(F.col("event_id") % 5 == 0).select(
        "event_id", *[(F.col(c) + F.expr("INTERVAL 36 HOURS")).alias(c) for c in ("event_timestamp", "ingestion_timestamp")])
    day = lambda df: df.withColumn("event_date", F.to_date("event_timestamp"))
    for updates in (ev.filter(F.col("ingestion_timestamp") <= ts_lit(WM)), later, later):
        L.write_upsert(spark, day(updates), path, ["event_id"], ["ingestion_timestamp"], "event_date")
    return spark.read.parquet(path)


def pl6_versioned_upsert(t: FabTables) -> DataFrame:
    """The same three changes to a table of versions, and what its last version holds."""
    from waferline.session import checkpoint_dir
    spark = t.fact_equipment_events.sparkSession
    path = f"{checkpoint_dir(spark)}/versioned-table-{uuid.uuid4().hex}"
    ev = t.fact_equipment_events.select("event_id", "event_timestamp", "ingestion_timestamp")
    later = ev.filter(F.col("event_id") % 5 == 0).select(
        "event_id", *[(F.col(c) + F.expr("INTERVAL 36 HOURS")).alias(c) for c in ("event_timestamp", "ingestion_timestamp")])
    for updates in (ev.filter(F.col("ingestion_timestamp") <= ts_lit(WM)), later, later):
        V.write_upsert_versioned(spark, updates.withColumn("event_date", F.to_date("event_timestamp")), path,
                                 ["event_id"], ["ingestion_timestamp"], "event_date")
    return V.read_version(spark, path)


def pl2_dedupe(t: FabTables) -> DataFrame:
    return L.dedupe_latest(t.fact_wafer_tests, ["wafer_id", "process_step_id"], ["test_timestamp"])


def pl3_incremental(t: FabTables) -> DataFrame:
    return L.incremental(t.fact_equipment_events, WM)


def pl3_watermark(t: FabTables) -> DataFrame:
    return L.high_water_mark(L.incremental(t.fact_equipment_events, WM))


def pl4_lookback(t: FabTables) -> DataFrame:
    ev = t.fact_equipment_events
    loaded = ev.filter(F.col("ingestion_timestamp") <= ts_lit(WM))
    return L.lookback(ev, loaded, EVENT_KEYS, WM)


def pl5_watermark(t: FabTables) -> DataFrame:
    ev = t.fact_equipment_events.withColumnRenamed("equipment_id", "source")
    ing = F.col("ingestion_timestamp")
    state = (ev.groupBy("source").agg(
        F.max(F.when(ing <= ts_lit(WM), F.col("event_timestamp"))).alias("current_ts"),
        F.max(F.when(ing <= ts_lit(WM - timedelta(days=1)), F.col("event_timestamp"))).alias("previous_ts")))
    batch = (ev.filter((ing > ts_lit(WM)) & (ing <= ts_lit(DEFAULT_AS_OF)))
             .groupBy("source").agg(F.max("event_timestamp").alias("new_ts")))
    return L.advance_watermark(state, batch)


def pl6_upsert(t: FabTables) -> DataFrame:
    ev = t.fact_equipment_events
    target = ev.filter(F.col("ingestion_timestamp") <= ts_lit(WM))
    updates = ev.filter(F.col("ingestion_timestamp") > ts_lit(WM - timedelta(hours=24)))
    return L.upsert(target, updates, ["event_id"], ["ingestion_timestamp"])


def pl8_scd2(t: FabTables) -> DataFrame:
    return L.scd2(L.daily_status_snapshots(t), "equipment_id", ["status"])


def pl10_dq_warning(t: FabTables) -> DataFrame:
    f = L.with_dq_warning(t.fact_wafer_tests, "tests")
    return f.filter(F.size("dq_warning") > 0).select(
        "wafer_id", "batch_id", "process_step_id", "equipment_id", "start_time",
        F.array_join("dq_warning", ",").alias("dq_warning"))


SAMPLE = 0.05


def c8_sampled_checks(t: FabTables) -> DataFrame:
    return Q.as_text(L.sampled_checks(t, SAMPLE))


def c9_incremental_checks(t: FabTables) -> DataFrame:
    return Q.as_text(L.incremental_checks(t, WM))


def c10_violation_trend(t: FabTables) -> DataFrame:
    return L.violation_trend(L.daily_violations(t))


def c12_clean_batch_share(t: FabTables) -> DataFrame:
    return L.clean_batch_share(t)


def dq_custom(t: FabTables) -> DataFrame:
    """Rules of one's own: a predicate, a builder, and one in error (isolated)."""
    rules = [Q.Rule("XR001", "High defects", "RANGE", "MEDIUM", "staging", 10, "Review", table="tests",
                    predicate=F.col("defect_density") > 0.09, example="wafer_id"),
             Q.Rule("XR002", "Silent tools", "COMPLETENESS", "HIGH", "raw", 0, "Check wiring",
                    builder=lambda t, o: t.dim_equipment.join(t.fact_equipment_events, "equipment_id", "left_anti").select(
                        F.col("equipment_id").alias("ex"), F.lit(1).alias("w"))),
             Q.Rule("XR003", "Broken", "RANGE", "LOW", "raw", 0, "None", table="tests", predicate=F.col("no_such_column") > 0)]
    return Q.run_checks(t, rule_ids=["XR001", "XR002", "XR003"], rules=rules).select("rule_id", "status", "violations")


# ------------------------------------------------------------------ PL9 kept KPIs, incremental runs
def _kept_root(t: FabTables, name: str) -> str:
    from waferline.session import checkpoint_dir
    return f"{checkpoint_dir(t.fact_wafer_tests.sparkSession)}/{name}-{uuid.uuid4().hex}"


def pl9_kept_yield(t: FabTables) -> DataFrame:
    """Three loads, the last of late rows, the second run twice: the kept table after them."""
    spark, root = t.fact_wafer_tests.sparkSession, _kept_root(t, "kept-yield")
    tests, late = t.fact_wafer_tests, F.coalesce(F.col("wafer_id") % 10 == 0, F.lit(False))
    new = F.col("test_timestamp") > ts_lit(WM)
    parts = {"1": tests.filter(~new & ~late), "2": tests.filter(new & ~late), "3": tests.filter(late)}
    for load in ("1", "2", "2", "3"):
        K.refresh(spark, root, K.DAILY_YIELD, K.yield_rows(parts[load], t.dim_wafer_batches), load)
    return K.read_kept(spark, root, K.DAILY_YIELD)


def pl9_kept_uptime(t: FabTables) -> DataFrame:
    """Events in three loads by arrival, so that a load has late events of earlier days."""
    spark, root = t.fact_wafer_tests.sparkSession, _kept_root(t, "kept-uptime")
    ev, ing = t.fact_equipment_events, F.col("ingestion_timestamp")
    a, b = ts_lit(WM - timedelta(days=7)), ts_lit(WM)
    for load, part in (("1", ing <= a), ("2", (ing > a) & (ing <= b)), ("3", (ing > b) | ing.isNull())):
        K.refresh(spark, root, K.DAILY_UPTIME, K.uptime_rows(ev.filter(part)), load)
    return K.read_kept(spark, root, K.DAILY_UPTIME)


#: The rules that block a run on the driver tables, whose wafers repeat steps and batches.
BLOCKING = ("DQ006", "DQ011", "DQ012")


def pl_incremental_run(t: FabTables) -> DataFrame:
    """Load, validate, promote, advance: runs of three dates with kept marks, then the kept
    uptime beside the number of rule results of all runs."""
    spark, root = t.fact_wafer_tests.sparkSession, _kept_root(t, "incremental")
    for day in (14, 7, 0):
        upto = as_datetime(DEFAULT_AS_OF) - timedelta(days=day)
        K.incremental_run(spark, root, t, upto, upto.date(), BLOCKING, layer="raw")
    runs = spark.read.parquet(f"{root}/dq_results").agg(F.countDistinct("run_date").alias("runs"), F.count(F.lit(1)).alias("results")).first()
    return K.read_kept(spark, root, K.DAILY_UPTIME).select("*", F.lit(runs[0]).cast("long").alias("runs"), F.lit(runs[1]).cast("long").alias("results"))


def c3_isolated(t: FabTables) -> DataFrame:
    """All rules and two that fail while they run: a cast of text and a division by zero."""
    rules = [Q.Rule("XR004", "Bin as number", "RANGE", "LOW", "staging", 0, "None", table="tests",
                    predicate=(F.concat(F.lit("x"), F.col("wafer_id").cast("string")).cast("int") > 5), example="wafer_id"),
             Q.Rule("XR005", "Broken share", "RANGE", "LOW", "raw", 0, "None",
                    builder=lambda t, o: t.fact_equipment_events.groupBy("equipment_id").agg((F.lit(1) / (F.count("event_id") * 0)).alias("w"))
                    .select(F.col("equipment_id").cast("string").alias("ex"), F.col("w").cast("long").alias("w")))]
    res = Q.run_isolated(t, rules=rules)
    return Q.as_text(res).withColumn("details", F.when(F.col("status") != "ERROR", F.col("details")))


# ------------------------------------------------------------------ PL7 conformed build
def pl7_conformed(t: FabTables) -> DataFrame:
    """The facts written under each orphan policy, counted by what their rows' keys lack."""
    spark, out = t.fact_wafer_tests.sparkSession, None
    orphans = CF.orphan_keys(t, _kept_root(t, "orphans"))
    for policy in CF.POLICIES:
        root = _kept_root(t, f"conformed-{policy}")
        CF.write_conformed(t, root, dict.fromkeys(CF.FOREIGN_KEYS, policy), orphans)
        for table in sorted({fk[0] for fk in CF.FOREIGN_KEYS}):
            n = CF.route_counts(spark, root, table).select(F.lit(policy).alias("policy"), F.lit(table).alias("fact"), "route",
                                                           F.array_join("orphan_keys", ",").alias("orphan_keys"), "rows")
            out = n if out is None else out.unionByName(n)
    return out


# ------------------------------------------------------------------ PL11 versioned transforms
def _test_versions() -> list[TR.Version]:
    cycle = F.col("cycle_s")
    return [TR.Version("v1", {"cycle_s": ts_diff("SECOND", "start_time", "end_time").cast("long")}),
            TR.Version("v2", {"cycle_s": F.when(cycle.between(10, 3600), cycle), "passed": flag(F.col("pass_fail") == "PASS").cast("long")}),
            TR.Version("v3", {"slow": cycle > 1800})]


def pl11_backfill(t: FabTables) -> DataFrame:
    """Tests written by three versions of a transform, each with its own columns, read as one
    table and brought to the last version."""
    spark, root = t.fact_wafer_tests.sparkSession, _kept_root(t, "transforms")
    base = t.fact_wafer_tests.select("wafer_id", "batch_id", "process_step_id", "start_time", "end_time", "pass_fail")
    third = F.pmod(F.coalesce(F.col("batch_id"), F.lit(0)), F.lit(3))
    for k, name in enumerate(("v1", "v2", "v3")):
        TR.apply(base.filter(third == k), _test_versions(), name).write.parquet(f"{root}/part={k}")
    return TR.backfill(spark.read.option("mergeSchema", True).parquet(root).drop("part"), _test_versions())


# ------------------------------------------------------------------ PL8 kept dimension
def _kept_dimension(t: FabTables, close: bool) -> DataFrame:
    """Snapshots of the days, every fourth at a time and out of order; the first merge has another
    status for its days and is then made right."""
    spark, root = t.fact_wafer_tests.sparkSession, _kept_root(t, "dimension")
    snaps = L.daily_status_snapshots(t)
    turn = F.pmod(F.datediff("snapshot_date", F.lit("2024-01-01").cast("date")), F.lit(4))
    for k in (2, 0, 3, 1, 2):
        D.merge_snapshots(spark, root, snaps.filter(turn == k).withColumn("status", F.col("status") if D.read_dimension(spark, root) is not None
                          else F.lit("UNKNOWN")), "equipment_id", ["status"], close=close)
    return D.read_dimension(spark, root)


def pl8_kept_dimension(t: FabTables) -> DataFrame:
    return _kept_dimension(t, False)


def pl8_kept_dimension_closed(t: FabTables) -> DataFrame:
    """The same, where a tool that a day's snapshot lacks ends its version."""
    return _kept_dimension(t, True)


# ------------------------------------------------------------------ C8 with bounds, C10 from the ledger
def c8_estimated_checks(t: FabTables) -> DataFrame:
    return ES.estimated_checks(t, SAMPLE)


def c10_stored_trend(t: FabTables) -> DataFrame:
    """Runs of three dates in the ledger, not in their order, one of them first with other rows;
    the trend of every rule from what is stored. What the runs judge is computed once for all."""
    spark, root = t.fact_wafer_tests.sparkSession, _kept_root(t, "ledger")
    runs = [(as_datetime(DEFAULT_AS_OF) - timedelta(days=day), days) for day, days in ((7, 1), (14, 7), (0, 7), (7, 7))]
    t = K.runs_input(root, t, runs)
    for upto, days in runs:
        K.ledger_run(root, t, upto, days, upto.date())
    return L.stored_trend(K.read_ledger(spark, root))


# ------------------------------------------------------------------ IO1-IO4 raw landing
LANDED = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("equipment_id", T.LongType()),
                       T.StructField("event_timestamp", T.TimestampNTZType()), T.StructField("status", T.StringType())])


def io_raw_landing(t: FabTables) -> DataFrame:
    """Events landed as CSV, where some lines have a word for a number, lack fields or have one
    too many; then the raw rows of the last ten days, read by date, beside all malformed lines."""
    spark, root = t.fact_wafer_tests.sparkSession, _kept_root(t, "landing")
    e = F.col("event_id")
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in LANDED.names]
    tool = F.when(e % 101 == 3, F.lit("tool-x")).otherwise(text[1])
    line = F.concat_ws(",", text[0], tool, F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"), text[3])
    line = F.when(e % 103 == 4, F.concat_ws(",", text[0], text[1])).when(e % 107 == 5, F.concat(line, F.lit(",more"))).otherwise(line)
    t.fact_equipment_events.select(line.alias("value")).write.text(f"{root}/landing/equipment_logs")
    IO.land(spark, f"{root}/landing/equipment_logs", root, "equipment_logs", LANDED, "1", "event_timestamp")
    day = F.lit((as_datetime(DEFAULT_AS_OF) - timedelta(days=10)).date())
    good = IO.read_raw(spark, root, "equipment_logs", LANDED).filter(F.col("event_date") >= day).drop("load")
    held = F.split("line", ",")
    bad = IO.read_quarantine(spark, root, "equipment_logs").select(
        held[0].cast("long").alias("event_id"), F.size(held).cast("long").alias("fields"))
    return good.withColumn("fields", F.lit(None).cast("long")).unionByName(bad, allowMissingColumns=True)
