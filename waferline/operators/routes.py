"""Equipment routes: ordered tool strings per wafer/batch (AG9) and their explode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def route_string(df: DataFrame, group: Sequence[str], tool: str = "equipment_id",
                 step: str = "process_step_id", sep: str = ",", name: str = "route",
                 sums: Sequence[str] = ()) -> DataFrame:
    """``GROUP_CONCAT(DISTINCT tool ORDER BY step SEPARATOR sep)`` per group.

    A tool used at several steps is placed once, at its lowest step (ties between
    tools on the same step: by tool id as text). The per-group list is bounded by
    the distinct tools of one wafer/batch; the first aggregation is map-side.
    ``sums`` are numeric columns summed per group in the same aggregation chain."""
    per_tool = df.groupBy(*group, tool).agg(F.min(step).alias("_s"), *[F.sum(c).alias(c) for c in sums])
    items = F.collect_list(F.struct(F.col("_s"), F.col(tool).cast("string").alias("_t")))
    return per_tool.groupBy(*group).agg(
        F.array_join(F.transform(F.array_sort(items), lambda x: x["_t"]), sep).alias(name),
        *[F.sum(c).alias(c) for c in sums])


def explode_route(batches: DataFrame, seq: str = "equipment_sequence", sep: str = ",",
                  id_col: str = "batch_id") -> DataFrame:
    """``equipment_sequence`` -> one row per (batch, 1-based position, tool)."""
    return batches.select(id_col, F.posexplode(F.split(F.col(seq), sep)).alias("pos0", "tool")).select(
        id_col, (F.col("pos0") + 1).cast("int").alias("position"),
        F.trim("tool").alias("equipment_id"))
