"""Previous/next row per key (LAG/LEAD) that stays balanced when one key is hot.

``F.lag(v).over(Window.partitionBy(key).orderBy(ts))`` sends every row of a key to
one task; if one tool holds a third of all events, that task sorts a third of the
table. Here the window is partitioned by ``(key, time bucket)`` instead, so a hot
key is spread over as many tasks as it has buckets. The first row of each bucket
takes its predecessor from a per-bucket summary (one row per key and bucket, built
with map-side partial aggregation) whose own LAG runs over buckets only - its size
is bounded by the time span, not by the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waferline.functions.exprs import epoch_seconds


def _names(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def keyed_lag(df: DataFrame, key, order: str, values: Sequence[str], tie: Sequence[str] = (),
              prefix: str = "prev_", bucket_seconds: int = 86400,
              direction: str = "lag", bucket: Sequence[Column] | None = None) -> DataFrame:
    """Add ``prefix + v`` = value of ``v`` on the previous (``lag``) or next (``lead``)
    row with the same ``key`` ordered by ``(order, *tie)``; NULL on the first/last row.

    ``order`` is a timestamp column bucketed by ``bucket_seconds``, or any column
    when ``bucket`` gives the bucket columns explicitly (they must not decrease along
    the order, e.g. ``[step, day(start_time)]`` for the order ``(step, start_time)``).
    ``tie`` should make the order total (rows tied on the full order key get an
    arbitrary but consistent neighbour, as LAG does).
    """
    keys = _names(key)
    tie = list(tie)
    order_cols = [order, *tie]
    rec = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)],
                   *[F.col(v).alias(v) for v in values])
    b = F.struct(*bucket) if bucket else F.floor(epoch_seconds(order) / bucket_seconds)
    d = df.withColumn("_b", b).withColumn("_r", rec)
    if direction == "lag":
        w_in = Window.partitionBy(*keys, "_b").orderBy(*[F.col(c).asc_nulls_first() for c in order_cols])
        w_b = Window.partitionBy(*keys).orderBy(F.col("_b").asc_nulls_first())
    elif direction == "lead":
        w_in = Window.partitionBy(*keys, "_b").orderBy(*[F.col(c).desc_nulls_last() for c in order_cols])
        w_b = Window.partitionBy(*keys).orderBy(F.col("_b").desc_nulls_last())
    else:
        raise ValueError(direction)
    # NB: NULL order values form their own bucket, which sorts first (like NULLS FIRST).
    # The bucket edge (last row along the direction) comes from the same window spec,
    # so the carry branch reuses the window's exchange instead of re-reading the input.
    d = d.select("*", F.lag("_r").over(w_in).alias("_in"),
                 F.lead("_r").over(w_in).isNull().alias("_edge_row"))
    edges = d.filter("_edge_row").select(*keys, "_b", F.col("_r").alias("_edge"))
    carry = edges.select(*[F.col(k).alias(f"_ck{i}") for i, k in enumerate(keys)], F.col("_b").alias("_cb"),
                         F.lag("_edge").over(w_b).alias("_carry"))
    # NULL keys are a sequence of their own, as in a window: the join must be null-safe.
    same = F.col("_b").eqNullSafe(F.col("_cb"))
    for i, k in enumerate(keys):
        same = same & d[k].eqNullSafe(F.col(f"_ck{i}"))
    out = d.join(carry, same, "left").withColumn("_p", F.coalesce("_in", "_carry"))
    return out.select(*df.columns, *[F.col("_p")[v].alias(prefix + v) for v in values])


def lag_col(df: DataFrame, key, order: str, value: str, tie: Sequence[str] = (),
            name: str | None = None, **kw) -> DataFrame:
    out = keyed_lag(df, key, order, [value], tie=tie, prefix="_prev_", **kw)
    return out.withColumnRenamed("_prev_" + value, name or "prev_" + value)

