"""Structured Streaming forms of the ingest and monitoring operators.

* S1 incremental ingest: a file-source stream with a checkpoint in the shared
  checkpoint folder; ``trigger(availableNow=True)`` processes what has arrived and
  stops, so the same job serves scheduled incremental loads. The checkpoint is
  the watermark state of PL3 (which files/offsets are done).
* S2 late data: rows that arrive more than 24 h after their event, routed as they come;
  ``late_tolerant`` is the watermark that stateful operators put under themselves.
* S3 idempotent load: ``dropDuplicatesWithinWatermark`` on the event key, and
  ``foreachBatch`` upserts (PL6) for sinks that must be merged.
* S4 equipment metrics: daily tumbling windows per tool, in append mode (a window is
  emitted once the watermark passes its end) or update mode (each change is emitted).
* S5 rule checks per micro-batch: the fused row-rule aggregate of the DQ runner
  inside ``foreachBatch``.

Event times are TIMESTAMP_NTZ in the tables; watermarks need TIMESTAMP, so the
stream carries ``event_ts`` = the NTZ value read as a UTC instant (no dependence
on the session time zone) and converts window bounds back to NTZ.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waferline.plans.quality import Options, row_rules
from waferline.session import checkpoint_dir
from waferline.sources.driver import RAW_EVENTS_SCHEMA, map_events

_EPOCH_NTZ = "1970-01-01 00:00:00"


def ntz_to_instant(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit(_EPOCH_NTZ).cast("timestamp_ntz"), c))


def instant_to_ntz(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    micros = F.timestamp_diff("MICROSECOND", F.timestamp_micros(F.lit(0)), c)
    return F.timestamp_add("MICROSECOND", micros, F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))


def event_stream(spark: SparkSession, source: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 source: driver event files (a folder or glob) -> equipment log rows."""
    r = spark.readStream.schema(RAW_EVENTS_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return map_events(r.parquet(source)).withColumn("event_ts", ntz_to_instant("event_timestamp"))


def late_tolerant(stream: DataFrame, hours: int = 24, ts: str = "event_ts") -> DataFrame:
    """Accept events up to ``hours`` behind the newest event time seen."""
    return stream.withWatermark(ts, f"{hours} hours")


def dedupe_stream(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """S3: drop repeated keys that arrive within the watermark delay (state is
    evicted once the watermark passes, so it stays bounded)."""
    return stream.dropDuplicatesWithinWatermark(list(keys))


def daily_metrics(stream: DataFrame, ts: str = "event_ts") -> DataFrame:
    """Per tool and day - events, running/alarm/down counts (append mode)."""
    st = F.col("status")
    g = stream.groupBy(F.window(ts, "1 day").alias("w"), "equipment_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.count(F.when(st == "RUNNING", 1)).alias("running"),
        F.count(F.when(st == "ALARM", 1)).alias("alarms"),
        F.count(F.when(st == "DOWN", 1)).alias("downs"))
    return g.select(instant_to_ntz("w.start").alias("window_start"),
                    instant_to_ntz("w.end").alias("window_end"),
                    "equipment_id", "events", "running", "alarms", "downs")


def batch_rule_counts(options: Options | None = None, table: str = "events") -> Callable[[DataFrame, int], DataFrame]:
    """The row-level rules of ``table`` as one fused aggregate of a micro-batch."""
    rr = {r: v for r, v in row_rules(options or Options()).items() if v[0] == table}
    stack = ", ".join(f"'{r}', `{r}`" for r in rr)

    def counts(batch: DataFrame, epoch_id: int) -> DataFrame:
        agg = batch.agg(*[F.count_if(p).alias(r) for r, (_, p, _) in rr.items()])
        return agg.select(F.lit(epoch_id).cast("long").alias("epoch_id"),
                          F.expr(f"stack({len(rr)}, {stack}) AS (rule_id, violations)"))
    return counts


def stream_dir(spark: SparkSession, name: str) -> tuple[str, str]:
    """(output path, checkpoint path) of a new run under the shared checkpoint folder."""
    base = f"{checkpoint_dir(spark)}/streams/{name}-{uuid.uuid4().hex}"
    return f"{base}/out", f"{base}/checkpoint"


def run_available_now(df: DataFrame, out: str, checkpoint: str, mode: str = "append",
                      foreach: Callable[[DataFrame, int], DataFrame] | None = None) -> str:
    """S1 trigger: process everything available, then stop. With ``foreach`` each
    micro-batch's result DataFrame is written to its own ``epoch=<id>`` folder under
    ``out`` with overwrite, so an epoch that Spark replays after a failure replaces
    its earlier output instead of duplicating it (exactly-once per epoch)."""
    w = df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if foreach is not None:
        def sink(batch: DataFrame, epoch_id: int) -> None:
            foreach(batch, epoch_id).write.mode("overwrite").parquet(f"{out}/epoch={epoch_id}")
        q = w.foreachBatch(sink).outputMode(mode).start()
    else:
        q = w.format("parquet").option("path", out).outputMode(mode).start()
    q.awaitTermination()
    return out


def upsert_sink(target: str, keys: Sequence[str], order: Sequence[str], partition_col: str
                ) -> Callable[[DataFrame, int], None]:
    """S3 + PL6: ``foreachBatch`` function merging each micro-batch into ``target``."""
    from waferline.plans.layers import write_upsert

    def sink(batch: DataFrame, epoch_id: int) -> None:
        write_upsert(batch.sparkSession, batch, target, keys, order, partition_col)
    return sink
