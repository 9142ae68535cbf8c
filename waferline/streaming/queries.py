"""Registered streaming queries: each runs its stream to completion with
``availableNow`` into a fresh folder under the shared checkpoint folder and
returns the sink read back as a batch DataFrame."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waferline.functions.exprs import as_datetime, ts_lit
from waferline.plans.layers import dedupe_latest
from waferline.sources.tables import DEFAULT_AS_OF, FabTables
from waferline.streaming import pipeline as S
from waferline.streaming import stateful as ST

EVENT_COLS = ["equipment_id", "event_timestamp", "status", "temperature_c", "pressure_torr",
              "ingestion_timestamp", "event_id"]


def _source(sf_dir: str) -> str:
    return f"{sf_dir}/events*.parquet"      # glob: the driver ships single files


def s1_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of event files and one kept checkpoint: the second run loads only what the
    first has not seen, and a third finds nothing new."""
    out, ck = S.stream_dir(spark, "s1")
    landing = out.removesuffix("/out") + "/landing"
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    for drop in (0, 1, None):
        if drop is not None:
            raw.filter(F.col("event_id") % 2 == drop).write.parquet(f"{landing}/drop={drop}")
        stream = S.event_stream(spark, f"{landing}/drop=*").select(*EVENT_COLS)
        S.run_available_now(stream, out, ck)
    return spark.read.parquet(out)


def s2_late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events ingested more than 24 h after they happened, flagged as they stream in (a
    stateless route: nothing waits for a watermark)."""
    out, ck = S.stream_dir(spark, "s2")
    st = S.event_stream(spark, _source(sf_dir))
    late = st.filter(F.col("ingestion_timestamp") > F.col("event_timestamp") + F.expr("INTERVAL 24 HOURS"))
    S.run_available_now(late.select(*EVENT_COLS, F.timestamp_diff(
        "HOUR", F.col("event_timestamp"), F.col("ingestion_timestamp")).alias("delay_hours")), out, ck)
    return spark.read.parquet(out)


def s3_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event files delivered twice, each micro-batch merged into a table of files by day."""
    out, ck = S.stream_dir(spark, "s3-upsert")
    a, b = (S.event_stream(spark, _source(sf_dir)).select(*EVENT_COLS, F.to_date("event_timestamp").alias("event_date"))
            for _ in range(2))
    sink = S.upsert_sink(out, ["event_id"], ["ingestion_timestamp"], "event_date")
    q = (a.unionByName(b).writeStream.option("checkpointLocation", ck).trigger(availableNow=True)
         .foreachBatch(sink).outputMode("append").start())
    q.awaitTermination()
    return spark.read.parquet(out).select(*EVENT_COLS)


def s3_stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event files delivered twice (two sources), deduplicated on the key."""
    out, ck = S.stream_dir(spark, "s3")
    a = S.event_stream(spark, _source(sf_dir))
    b = S.event_stream(spark, _source(sf_dir))
    d = S.dedupe_stream(S.late_tolerant(a.unionByName(b)), ["event_id"])
    S.run_available_now(d.select(*EVENT_COLS), out, ck)
    return spark.read.parquet(out)


def s4_daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows: each micro-batch writes the windows it changed (update mode), and the
    last version of a window is its result - also of those the watermark has not closed."""
    out, ck = S.stream_dir(spark, "s4")
    S.run_available_now(S.daily_metrics(S.late_tolerant(S.event_stream(spark, _source(sf_dir)))), out, ck, mode="update",
                        foreach=lambda batch, epoch: batch.withColumn("version", F.lit(epoch).cast("long")))
    return dedupe_latest(spark.read.parquet(out).drop("epoch"), ["window_start", "window_end", "equipment_id"],
                         ["version"]).drop("version")


def s5_stream_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, ck = S.stream_dir(spark, "s5")
    S.run_available_now(S.event_stream(spark, _source(sf_dir)), out, ck, foreach=S.batch_rule_counts())
    return (spark.read.parquet(out).groupBy("rule_id")
            .agg(F.sum("violations").alias("violations")).orderBy("rule_id"))


# ------------------------------------------------------------------ state between micro-batches
def _drops(df: DataFrame, name: str, number, sink, last: int = 2) -> None:
    """Land ``df`` in drops 0 to ``last`` by ``number`` and run a stream with one kept
    checkpoint after each, every drop a micro-batch for ``sink(root)``."""
    spark = df.sparkSession
    out, ck = S.stream_dir(spark, name)
    landing = out.removesuffix("/out") + "/landing"
    for k in range(last + 1):
        df.filter(number == k).write.parquet(f"{landing}/drop={k}")
        stream = spark.readStream.schema(df.schema).parquet(f"{landing}/drop=*")
        (stream.writeStream.option("checkpointLocation", ck).trigger(availableNow=True)
         .foreachBatch(sink).start().awaitTermination())


def s5_stateful_checks(t: FabTables) -> DataFrame:
    """Three drops that part neighbours and copies: DQ004, DQ005, DQ014 and DQ017 over all."""
    spark = t.fact_wafer_tests.sparkSession
    root, _ = S.stream_dir(spark, "s5-state")
    _drops(t.fact_equipment_events, "s5-events", F.col("event_id") % 3, ST.event_rules_sink(root))
    part = F.pmod(F.coalesce(F.col("wafer_id"), F.lit(0)) + F.coalesce(F.col("process_step_id"), F.lit(0)), F.lit(3))
    _drops(t.fact_wafer_tests, "s5-tests", part, ST.test_rules_sink(root, compact_every=2))
    return ST.rule_counts(spark, root)


def s2_two_routes(t: FabTables) -> DataFrame:
    """Three drops by arrival, the last with stragglers of all days: what went on, and what the
    look-back takes from the rescue table."""
    spark, ing = t.fact_equipment_events.sparkSession, F.col("ingestion_timestamp")
    root, _ = S.stream_dir(spark, "s2-routes")
    wm = as_datetime(DEFAULT_AS_OF) - timedelta(days=7)
    drop = (F.when(F.col("event_id") % 10 == 0, 2).when(ing <= ts_lit(wm - timedelta(days=7)), 0).when(ing <= ts_lit(wm), 1).otherwise(2))
    _drops(t.fact_equipment_events.select(*EVENT_COLS), "s2-drops", drop, ST.route_sink(root))
    main, late = ST.route(spark, root, "main"), ST.rescued(spark, root, ["event_id"])
    return main.withColumn("route", F.lit("main")).unionByName(late.withColumn("route", F.lit("rescue")))


def s4_daily_metrics_kept(t: FabTables) -> DataFrame:
    """All daily windows after three drops that each hold rows of every day."""
    spark = t.fact_equipment_events.sparkSession
    root, _ = S.stream_dir(spark, "s4-kept")
    _drops(t.fact_equipment_events, "s4-drops", F.col("event_id") % 3, ST.daily_windows_sink(root))
    return ST.daily_windows(spark, root)
