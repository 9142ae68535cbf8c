"""Kept daily KPIs (PL9) and the incremental run around them (PL3, PL5, PL10, IO6).

A KPI is kept as two Parquet tables below ``root``:

* ``state/<name>/load=<id>/day=<date>``: what one load adds, as mergeable partial sums per
  grain (for the yield: date, recipe and wafer, so distinct wafers stay exact). A load owns its
  folder; running it again replaces the folder, so nothing is counted twice.
* ``curated/<name>/day=<date>``: the KPI rows. A load recomputes only the days that it touches
  (or touched before it was run again), from the states of all loads of those days; other
  days are neither read nor written.

Rows may come in any order and as late as they like: they go to the day they belong to.
Partial sums are combined before each shuffle, and the tables are pruned by day.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waferline.functions.exprs import as_datetime, flag, pct, ts_lit
from waferline.plans import layers as L
from waferline.plans.quality import Options, gate, run_checks
from waferline.sources.layers import read_watermarks, store_results, store_watermarks
from waferline.sources.tables import FabTables

#: Day of rows without a date.
NO_DAY = "none"


@dataclass(frozen=True)
class KeptKpi:
    """``date`` and ``keys`` are the grain of the state, ``sums`` its additive columns;
    ``finish`` turns merged states into KPI rows."""

    name: str
    date: str
    keys: Sequence[str]
    sums: Sequence[str]
    finish: Callable[[DataFrame], DataFrame]

    def partial(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(self.date, *self.keys).agg(*[F.sum(c).cast("long").alias(c) for c in self.sums])


def _yield(state: DataFrame) -> DataFrame:
    g = state.groupBy("test_date", "recipe").agg(F.sum("tests").alias("tests"), F.count("wafer_id").alias("wafers"),
                                                 F.sum("passed").alias("passed"))
    return g.withColumn("yield_pct", F.round(pct("passed", "tests"), 2))


def _uptime(state: DataFrame) -> DataFrame:
    return state.withColumn("uptime_pct", F.round(pct("running", "events"), 2))


#: Yield per day and recipe; the state's grain holds the wafer, so it counts each once.
DAILY_YIELD = KeptKpi("daily_yield", "test_date", ("recipe", "wafer_id"), ("tests", "passed"), _yield)
#: Uptime per tool and day.
DAILY_UPTIME = KeptKpi("daily_uptime", "date", ("equipment_id",), ("events", "running", "alarms", "downs"), _uptime)


def yield_rows(tests: DataFrame, batches: DataFrame) -> DataFrame:
    """What ``DAILY_YIELD`` sums, of test rows and their batches' recipes."""
    return tests.join(batches.select("batch_id", "recipe"), "batch_id").select(
        F.to_date("test_timestamp").alias("test_date"), "recipe", "wafer_id", F.lit(1).alias("tests"),
        flag(F.col("pass_fail") == "PASS").alias("passed"))


def uptime_rows(events: DataFrame) -> DataFrame:
    st = F.col("status")
    return events.select(F.to_date("event_timestamp").alias("date"), "equipment_id", F.lit(1).alias("events"),
                         flag(st == "RUNNING").alias("running"), flag(st == "ALARM").alias("alarms"), flag(st == "DOWN").alias("downs"))


def _folders(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of a folder's partitions by ``column``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def refresh(spark: SparkSession, root: str, kpi: KeptKpi, rows: DataFrame, load: str) -> list[str]:
    """Add ``rows`` (date, keys, sums) as the load ``load`` to the kept KPI, or put them in the
    place of what that load brought before. Returns the days that were recomputed."""
    state, out = f"{root.rstrip('/')}/state/{kpi.name}", f"{root.rstrip('/')}/curated/{kpi.name}"
    mine = f"{state}/load={load}"
    before = _folders(spark, mine, "day")
    day = F.coalesce(F.col(kpi.date).cast("string"), F.lit(NO_DAY))
    part = kpi.partial(rows).withColumn("day", day)
    part.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("day").parquet(mine)
    now = _folders(spark, mine, "day")
    days = sorted({*before, *now})
    if not days:
        return []
    schema = T.StructType([*part.schema.fields, T.StructField("load", T.StringType())])
    merged = kpi.partial(spark.read.schema(schema).parquet(state).filter(F.col("day").isin(days)))
    (kpi.finish(merged).withColumn("day", day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day").parquet(out))
    held = {d for x in _folders(spark, state, "load") for d in _folders(spark, f"{state}/load={x}", "day")}
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    for d in set(days) - held:  # a load that was run again no longer has rows of that day
        fs_path(out).getFileSystem(spark._jsc.hadoopConfiguration()).delete(fs_path(f"{out}/day={d}"), True)
    return days


def read_kept(spark: SparkSession, root: str, kpi: KeptKpi) -> DataFrame:
    """The kept KPI's rows."""
    return spark.read.parquet(f"{root.rstrip('/')}/curated/{kpi.name}").drop("day")


# ------------------------------------------------------------------ one incremental run
SOURCES = {"tests": ("fact_wafer_tests", "test_timestamp"), "events": ("fact_equipment_events", "ingestion_timestamp")}


def incremental_run(spark: SparkSession, root: str, t: FabTables, upto, run_date, blocking: Sequence[str] | None = None,
                    layer: str | None = None, options: Options | None = None) -> dict:
    """Load -> validate -> promote -> advance, once, over what has arrived after the kept marks
    up to ``upto`` (tests by test time, events by arrival, so late events are in).

    1. the marks are read (none before the first run); rows between mark and ``upto`` are new;
    2. the rules run over the new rows (``layer``: those of one layer); results go to the
       ledger ``dq_results`` under ``run_date`` (a second run of the date replaces them);
    3. if a CRITICAL rule (or one of ``blocking``) fails, nothing is promoted and no mark moves;
    4. else the KPIs take the new rows under the load's number, and the marks are stored last.

    A run that dies anywhere is run again: its marks have not moved, so it sees the same rows
    and takes the same load number. Returns load, promoted, blocking_rules, rows, days."""
    marks = read_watermarks(spark, root)
    held = {r["source"]: r["current_ts"] for r in marks.collect()} if marks is not None else {}  # a row per source
    load = f"{marks_version(spark, root) + 1:06d}"
    new = {}
    for source, (table, ts) in SOURCES.items():
        df = getattr(t, table).filter(F.col(ts) <= ts_lit(upto))
        new[source] = L.incremental(df, held[source], ts) if held.get(source) is not None else df
    arrived = t.with_(fact_wafer_tests=new["tests"], fact_equipment_events=new["events"])
    results = run_checks(arrived, layer=layer, options=options)
    store_results(results, root, run_date, layer or "all")
    stored = spark.read.parquet(f"{root.rstrip('/')}/dq_results").filter(
        (F.col("run_date") == F.lit(str(run_date)).cast("date")) & (F.col("layer") == (layer or "all")))
    bad = set(gate(stored).first()["blocking_rules"])
    if blocking is not None:
        bad = {r["rule_id"] for r in stored.filter(F.col("rule_id").isin(list(blocking)) & (F.col("status") == "FAIL")).select("rule_id").collect()}
    out = {"load": load, "promoted": not bad, "blocking_rules": sorted(bad), "days": {}}
    if bad:
        return out
    out["days"] = {DAILY_YIELD.name: refresh(spark, root, DAILY_YIELD, yield_rows(new["tests"], t.dim_wafer_batches), load),
                   DAILY_UPTIME.name: refresh(spark, root, DAILY_UPTIME, uptime_rows(new["events"]), load)}
    top = None
    for source, (_, ts) in SOURCES.items():
        m = new[source].agg(F.max(ts).alias("new_ts")).select(F.lit(source).alias("source"), "new_ts")
        top = m if top is None else top.unionByName(m)
    if marks is None:
        marks = top.select("source", F.lit(None).cast("timestamp_ntz").alias("current_ts"), F.lit(None).cast("timestamp_ntz").alias("previous_ts"))
    store_watermarks(L.advance_watermark(marks.select("source", "current_ts", "previous_ts"), top).drop("action"), root)
    return out


def marks_version(spark: SparkSession, root: str) -> int:
    return max((int(v) for v in _folders(spark, f"{root.rstrip('/')}/watermarks", "version")), default=0)


# ------------------------------------------------------------------ runs in the ledger
def _span(upto, days: int) -> tuple:
    """After when and up to when a run's rows came."""
    return as_datetime(upto) - timedelta(days=days), as_datetime(upto)


def _within(ts: str, after, upto) -> Column:
    return (F.col(ts) > ts_lit(after)) & (F.col(ts) <= ts_lit(upto))


def _spans(runs: Sequence[tuple]) -> list[tuple]:
    """The runs' spans, those that touch or overlap as one: a time is compared as seldom as can be."""
    out: list[tuple] = []
    for after, upto in sorted(_span(*r) for r in runs):
        if out and after <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], upto))
        else:
            out.append((after, upto))
    return out


def runs_input(root: str, t: FabTables, runs: Sequence[tuple]) -> FabTables:
    """``t`` for several runs of :func:`ledger_run`, ``(upto, days)`` each: every row of the facts that
    one of them judges and the whole batch dimension, which all of them judge, are computed once and
    read from files below ``root``, however much work lies between the tables and their sources."""
    spark, path = t.fact_wafer_tests.sparkSession, f"{root.rstrip('/')}/runs_input"
    rows = {"dim_wafer_batches": t.dim_wafer_batches}
    for table, ts in SOURCES.values():
        rows[table] = getattr(t, table).filter(reduce(or_, [_within(ts, *x) for x in _spans(runs)]))
    for name, df in rows.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    return t.with_(**{name: spark.read.schema(df.schema).parquet(f"{path}/{name}") for name, df in rows.items()})


def ledger_run(root: str, t: FabTables, upto, days: int, run_date, options: Options | None = None) -> None:
    """Judge what the ``days`` days up to ``upto`` brought (tests by test time, events by arrival)
    with all rules, and keep the results under ``run_date``; a second run of the date takes the
    place of the first. Read the runs with :func:`read_ledger`."""
    new = {}
    for table, ts in SOURCES.values():
        new[table] = getattr(t, table).filter(_within(ts, *_span(upto, days)))
    store_results(run_checks(t.with_(**new), options=options), root, run_date, "all")


def read_ledger(spark: SparkSession, root: str, layer: str = "all") -> DataFrame:
    """The rule results of all stored runs of a layer, with their run_date; other layers are not read."""
    return spark.read.parquet(f"{root.rstrip('/')}/dq_results").filter(F.col("layer") == layer)
