"""Streams that keep state between micro-batches as tables in the shared folder.

* S5, rules about neighbours and groups: :func:`event_rules_sink` (DQ004, DQ017) and
  :func:`test_rules_sink` (DQ005, DQ014) add each micro-batch to a kept state, and
  :func:`rule_items` gives the violations of all that has arrived. Whatever the order in which
  rows arrive and however they are cut into micro-batches, the result is that of the batch rules.
* S2, late rows: :func:`route_sink` sends rows more than 24 h behind the mark of their source to
  a rescue table and the others on; :func:`rescued` is the look-back (PL4) over that table.
* S4, daily windows: :func:`daily_windows_sink` adds up every row, however late, by day and tool.

What a micro-batch writes lies in folders of its own number and is replaced if Spark replays it,
so a run that dies anywhere is just run again. A stream's state belongs to its checkpoint: a new
checkpoint needs a new root. Events are kept by day (:mod:`waferline.plans.kept`): a micro-batch
recomputes the days it touches, no other. Null keys, days and times are values like any other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waferline.functions.exprs import flag, ts_diff
from waferline.operators.sequence import keyed_lag
from waferline.plans import kept as K
from waferline.plans import layers as L
from waferline.plans.quality import Options

Sink = Callable[[DataFrame, int], None]


def _load(epoch: int) -> str:
    return f"{epoch:012d}"


def _complete(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the partitions of a folder whose writing was finished."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    return [v for v in K._folders(spark, path, column) if fs.exists(fs_path(f"{path}/{column}={v}/_SUCCESS"))]


# ------------------------------------------------------------------ S5: rules about events
def _arrivals(state: DataFrame) -> DataFrame:
    """DQ004 of one tool and arrival day: what follows an event that happened later, and the
    day's first and last event. Equal rows never break the order, so the state holds each once.
    A busy tool's day is spread over its hours."""
    order = F.struct("ingestion_timestamp", "event_timestamp")
    seq = keyed_lag(state, ["equipment_id", "arrival_date"], "ingestion_timestamp", ["event_timestamp"],
                    tie=["event_timestamp"], bucket_seconds=3600)
    return seq.groupBy("arrival_date", "equipment_id").agg(
        F.count_if(F.col("event_timestamp") < F.col("prev_event_timestamp")).alias("inside"),
        F.min(order)["event_timestamp"].alias("first_event"), F.max(order)["event_timestamp"].alias("last_event"))


def _downs(state: DataFrame) -> DataFrame:
    """DQ017 of one tool and day: a gap of days lies between the last DOWN of one day and the
    first of the next that has any."""
    return state.groupBy("date", "equipment_id").agg(F.min("event_timestamp").alias("first_down"),
                                                     F.max("event_timestamp").alias("last_down"))


ARRIVALS = K.KeptKpi("stream_arrivals", "arrival_date", ("equipment_id", "ingestion_timestamp", "event_timestamp"), ("n",), _arrivals)
DOWNS = K.KeptKpi("stream_downs", "date", ("equipment_id", "event_timestamp"), ("n",), _downs)


def event_rules_sink(root: str) -> Sink:
    """Adds the micro-batches of an event stream to the state of DQ004 and DQ017 below ``root``."""
    def sink(batch: DataFrame, epoch: int) -> None:
        arrived = batch.select(F.to_date("ingestion_timestamp").alias("arrival_date"), *ARRIVALS.keys, F.lit(1).alias("n"))
        down = batch.filter((F.col("status") == "DOWN") & F.col("event_timestamp").isNotNull()).select(
            F.to_date("event_timestamp").alias("date"), *DOWNS.keys, F.lit(1).alias("n"))
        K.refresh(batch.sparkSession, root, ARRIVALS, arrived, _load(epoch))
        K.refresh(batch.sparkSession, root, DOWNS, down, _load(epoch))
    return sink


# ------------------------------------------------------------------ S5: rules about tests
#: Kept grain of the tests: one row per batch, wafer and step.
GRAIN = ("batch_id", "wafer_id", "process_step_id")
#: A compacted state is written every this many micro-batches.
COMPACT_EVERY = 16


def _merged(state: DataFrame) -> DataFrame:
    return state.groupBy(*GRAIN).agg(F.min("first_start").alias("first_start"), F.max("last_start").alias("last_start"),
                                     F.sum("nulls").alias("nulls"), F.sum("n").alias("n"))


def _steps(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame | None:
    """The kept steps: the last compacted state and the micro-batches after it."""
    base = f"{root}/state/stream_steps"
    known = lambda v: upto is None or int(v) <= upto
    spans = [v for v in _complete(spark, f"{base}/merged", "upto") if known(v)]
    last = max(spans, default="")
    parts = [f"{base}/merged/upto={last}"] if last else []
    parts += [f"{base}/added/epoch={v}" for v in _complete(spark, f"{base}/added", "epoch") if v > last and known(v)]
    return _merged(spark.read.parquet(*parts)) if parts else None


def test_rules_sink(root: str, compact_every: int = COMPACT_EVERY) -> Sink:
    """Adds the micro-batches of a test stream to the state of DQ005 and DQ014 below ``root``:
    mergeable sums per (batch, wafer, step), a folder per micro-batch, merged into one folder
    every ``compact_every`` of them (it counts once its ``_SUCCESS`` mark is written)."""
    def sink(batch: DataFrame, epoch: int) -> None:
        spark, base, start = batch.sparkSession, f"{root}/state/stream_steps", F.col("start_time")
        rows = batch.select(*GRAIN, start.alias("first_start"), start.alias("last_start"), flag(start.isNull()).alias("nulls"), F.lit(1).alias("n"))
        _merged(rows).write.mode("overwrite").parquet(f"{base}/added/epoch={_load(epoch)}")
        if (epoch + 1) % compact_every == 0 and _load(epoch) not in _complete(spark, f"{base}/merged", "upto"):
            _steps(spark, root, epoch).write.mode("overwrite").parquet(f"{base}/merged/upto={_load(epoch)}")
    return sink


test_rules_sink.__test__ = False   # not a test, whatever its name


def rule_items(spark: SparkSession, root: str, options: Options | None = None) -> DataFrame:
    """Items (rule_id, ex, w) of DQ004, DQ005, DQ014 and DQ017 over all that has arrived, as the
    batch rules give them. Read are one row per tool and day, and one per wafer and step."""
    o = options or Options()
    if o.dq004_order != "ingestion_timestamp" or o.dq017_exclude_maintained or o.dq017_hours < 24:
        raise ValueError("the kept state answers DQ004 by arrival, and DQ017 for gaps of a day or more whatever the maintenance")
    out = spark.range(0).select(F.lit("").alias("rule_id"), F.lit("").alias("ex"), F.lit(0).cast("long").alias("w"))

    def add(rule: str, df: DataFrame, ex: str, w) -> None:
        nonlocal out
        out = out.unionByName(df.select(F.lit(rule).alias("rule_id"), F.col(ex).cast("string").alias("ex"), w.cast("long").alias("w")))

    if K._folders(spark, f"{root}/curated/{ARRIVALS.name}", "day"):
        w = Window.partitionBy("equipment_id").orderBy(F.col("arrival_date").asc_nulls_first())
        days = K.read_kept(spark, root, ARRIVALS).withColumn("before", F.lag("last_event").over(w))
        bad = F.sum(F.col("inside") + flag(F.col("first_event") < F.col("before")))
        add("DQ004", days.groupBy("equipment_id").agg(bad.alias("v")).filter("v > 0"), "equipment_id", F.col("v"))
    if K._folders(spark, f"{root}/curated/{DOWNS.name}", "day"):
        w = Window.partitionBy("equipment_id").orderBy("date")
        days = K.read_kept(spark, root, DOWNS).withColumn("next", F.lead("first_down").over(w))
        long = days.groupBy("equipment_id").agg(F.max(ts_diff("HOUR", "last_down", "next")).alias("h")).filter(F.col("h") > o.dq017_hours)
        add("DQ017", long, "equipment_id", F.lit(1))
    steps = _steps(spark, root)
    if steps is not None:
        w = Window.partitionBy("batch_id", "wafer_id").orderBy(F.col("process_step_id").asc_nulls_first())
        seq = steps.withColumn("before", F.lag("last_start").over(w))
        bad = seq.filter((F.col("nulls") == 0) & (F.col("first_start") < F.col("before"))).groupBy("batch_id").agg(F.count(F.lit(1)).alias("v"))
        add("DQ005", bad, "batch_id", F.col("v"))
        again = steps.groupBy(*o.dq014_keys).agg(F.sum("n").alias("v")).filter("v > 1")
        add("DQ014", again, "wafer_id", F.lit(1))
    return out


def rule_counts(spark: SparkSession, root: str, options: Options | None = None) -> DataFrame:
    """(rule_id, violations, affected): per rule its violations and how many ids they name."""
    items = rule_items(spark, root, options).groupBy("rule_id", "ex").agg(F.sum("w").alias("w"))
    return items.groupBy("rule_id").agg(F.sum("w").alias("violations"), F.count("ex").alias("affected"))


# ------------------------------------------------------------------ S2: two routes
def _marks(spark: SparkSession, root: str, before: int) -> DataFrame | None:
    done = [v for v in _complete(spark, f"{root}/marks", "epoch") if int(v) < before]
    return spark.read.parquet(f"{root}/marks/epoch={max(done)}") if done else None


def route_sink(root: str, source: str = "equipment_id", ts: str = "event_timestamp", hours: int = 24) -> Sink:
    """Splits each micro-batch by the mark of a row's ``source``, the newest ``ts`` that earlier
    micro-batches brought of it: rows more than ``hours`` behind go to the route ``rescue``, all
    others (also those of a new source or without a time) to ``main``. No row is lost. The marks
    are written last, one row per source, beside the rows."""
    def sink(batch: DataFrame, epoch: int) -> None:
        spark, marks = batch.sparkSession, _marks(batch.sparkSession, root, epoch)
        top = batch.groupBy(F.col(source).alias("mark_source")).agg(F.max(ts).alias("mark_ts"))
        if marks is None:
            routed = batch.withColumn("route", F.lit("main"))
        else:
            late = F.col(ts) < F.col("mark_ts") - F.expr(f"INTERVAL {hours} HOURS")
            routed = (batch.join(marks, F.col(source).eqNullSafe(F.col("mark_source")), "left")
                      .select(*batch.columns, F.when(late, "rescue").otherwise("main").alias("route")))
            top = top.unionByName(marks).groupBy("mark_source").agg(F.max("mark_ts").alias("mark_ts"))
        (routed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("route")
         .parquet(f"{root}/rows/epoch={_load(epoch)}"))
        top.write.mode("overwrite").parquet(f"{root}/marks/epoch={_load(epoch)}")
    return sink


def route(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The rows of one route (``main`` or ``rescue``), without the columns of the folders."""
    return spark.read.parquet(f"{root}/rows").filter(F.col("route") == name).drop("epoch", "route")


def rescued(spark: SparkSession, root: str, keys, ts: str = "event_timestamp", order=("ingestion_timestamp",)) -> DataFrame:
    """PL4 over the rescue table: its rows whose key the main route has not loaded, the latest of
    each, from its oldest row on."""
    late = route(spark, root, "rescue")
    oldest = late.agg(F.min(ts)).first()[0]
    if oldest is None:
        return late
    return L.lookback(late, route(spark, root, "main"), keys, oldest, ts=ts, order=order)


# ------------------------------------------------------------------ S4: windows that no row is late for
def daily_windows_sink(root: str) -> Sink:
    """Adds each micro-batch to the kept counts per tool and day; only its days are recomputed."""
    def sink(batch: DataFrame, epoch: int) -> None:
        K.refresh(batch.sparkSession, root, K.DAILY_UPTIME, K.uptime_rows(batch), _load(epoch))
    return sink


def daily_windows(spark: SparkSession, root: str) -> DataFrame:
    start = F.col("date").cast("timestamp_ntz")
    return K.read_kept(spark, root, K.DAILY_UPTIME).select(
        start.alias("window_start"), (start + F.expr("INTERVAL 1 DAY")).alias("window_end"),
        "equipment_id", "events", "running", "alarms", "downs")
