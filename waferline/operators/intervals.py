"""Interval lookups (J4, J5): what the events of the same key do inside ``[start, end]``.

The reference writes these as correlated ``BETWEEN`` subqueries, which Spark plans as a
nested loop of events with windows.

* ``interval_sums`` (counts, sums, averages) needs no join of windows with events at all:
  prefix sums per key, with the window ends as marker rows.
* ``with_interval_sums`` appends such sums to the rows that hold the windows, which pass one
  shuffle with their other columns and are joined with nothing: for more windows than events.
* ``interval_events`` / ``interval_aggregate`` return or aggregate the overlaps themselves:
  an equi-join on ``(key, level, time bucket)`` plus the range predicate. A window's level
  grows with its length, so that it touches at most three buckets of its level, however
  long (or mis-dated) it is; events are joined once per level that occurs among the windows.

The shuffle key always holds a time bucket, so a hot key is spread over its buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waferline.functions.exprs import epoch_seconds


def _bucket(c, seconds: int) -> Column:
    return F.floor(epoch_seconds(c) / seconds)


def _leveled(windows: DataFrame, events: DataFrame, key: str, start: str, end: str, ts: str,
             bucket_seconds: int, event_key: str) -> tuple[DataFrame, DataFrame]:
    """Distinct windows and the events, each with a level ``_l`` and a bucket ``_b``: a
    bucket of level l is 2**l times ``bucket_seconds`` long, no shorter than the window."""
    length = (epoch_seconds(end) - epoch_seconds(start)).cast("double")
    level = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(length / bucket_seconds, F.lit(1.0))))).cast("int")
    size = F.lit(bucket_seconds) * F.pow(F.lit(2.0), F.col("_l"))
    at = lambda c: F.floor(epoch_seconds(c) / size)
    w = (windows.select(key, start, end).distinct()
         .filter(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(end) >= F.col(start)))
         .withColumn("_l", level).withColumn("_b", F.explode(F.sequence(at(start), at(end)))))
    # The levels that occur: at most one per doubling of the time span, so a few dozen rows.
    levels = w.select("_l").distinct()
    ev = events if event_key == key else events.withColumnRenamed(event_key, key)
    return w, ev.crossJoin(F.broadcast(levels)).withColumn("_b", at(ts))


def interval_aggregate(windows: DataFrame, events: DataFrame, key: str, start: str, end: str,
                       ts: str, aggs: Sequence[Column], bucket_seconds: int = 3600,
                       event_key: str | None = None) -> DataFrame:
    """One row per distinct ``(key, start, end)`` of ``windows`` that contains at
    least one event (``start <= ts <= end``, both ends inclusive) with the ``aggs``.

    ``aggs`` may reference event columns and the window's ``start``/``end`` columns
    (for conditional sub-windows). Windows without events are absent: left-join the
    result back and ``coalesce`` counts to 0 (averages stay NULL)."""
    ek = event_key or key
    w, ev = _leveled(windows, events, key, start, end, ts, bucket_seconds, ek)
    j = (w.join(ev, [key, "_l", "_b"])
         .filter((F.col(ts) >= F.col(start)) & (F.col(ts) <= F.col(end))))
    return j.groupBy(key, start, end).agg(*aggs)


def interval_lookup(left: DataFrame, events: DataFrame, key: str, start: str, end: str,
                    ts: str, aggs: Sequence[Column], defaults: dict | None = None,
                    bucket_seconds: int = 3600, event_key: str | None = None) -> DataFrame:
    """``left`` with the interval aggregates appended (left outer: every left row is
    kept; ``defaults`` fills aggregates of windows without events, e.g. counts -> 0)."""
    agg = interval_aggregate(left, events, key, start, end, ts, aggs, bucket_seconds, event_key)
    out = left.join(agg, [key, start, end], "left")
    for c, v in (defaults or {}).items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out


def _seen(left: DataFrame, events: DataFrame, key: str, start: str, end: str, ts: str, bucket_seconds: int,
          bounds: DataFrame | None) -> tuple[Column, DataFrame, DataFrame]:
    """(whether a row's window holds anything, ``left`` with the level ``_l`` and the bucket ``_b`` in
    which its window starts, the events of ``_k``, ``_t`` with every ``_l`` and ``_b`` of windows that may
    reach them). A bucket is no shorter than its level's windows, so a window ends in the bucket
    of its start or the next one, and an event is seen from its own and the one before. Rows with
    an empty window or no key are spread by their hash. ``bounds``: a smaller table that has
    the starts and ends of all windows of ``left``, to find the levels that occur."""
    ok = F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(end) >= F.col(start))
    length = (epoch_seconds(end) - epoch_seconds(start)).cast("double")
    level = F.when(ok, F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(length / bucket_seconds, F.lit(1.0)))))).otherwise(0).cast("int")
    size = F.lit(bucket_seconds) * F.pow(F.lit(2.0), F.col("_l"))
    valid = F.coalesce(ok & F.col(key).isNotNull(), F.lit(False))
    w = left.withColumn("_l", level).withColumn("_b", F.when(valid, F.floor(epoch_seconds(start) / size))
                                                .otherwise(F.xxhash64(*left.columns)))
    # The levels that occur: at most one per doubling of the time span, so a few dozen rows.
    levels = (left if bounds is None else bounds).select(level.alias("_l")).distinct()
    at = F.floor(epoch_seconds(ts) / size)
    ev = events.crossJoin(F.broadcast(levels)).withColumn("_b", F.explode(F.array(at, at - 1)))
    return valid, w, ev


def interval_events(left: DataFrame, events: DataFrame, key: str, start: str, end: str,
                    ts: str, bucket_seconds: int = 3600, event_key: str | None = None) -> DataFrame:
    """Left outer interval join returning the matching event rows (one output row
    per (left row, event) overlap; left rows without events appear once with NULLs).

    Left rows are in one bucket each, so one outer join keeps them; they are shuffled once."""
    ek = event_key or key
    _, w, ev = _seen(left, events.withColumnRenamed(ek, "_k").filter(F.col("_k").isNotNull()), key, start, end, ts,
                     bucket_seconds, None)
    ev = ev.withColumnRenamed("_l", "_el").withColumnRenamed("_b", "_eb")
    on = ((F.col(key) == F.col("_k")) & (F.col("_l") == F.col("_el")) & (F.col("_b") == F.col("_eb"))
          & (F.col(ts) >= F.col(start)) & (F.col(ts) <= F.col(end)))
    first = [key, start, end]
    return (w.join(ev, on, "left").drop("_k", "_l", "_b", "_el", "_eb")
            .select(*first, *[c for c in left.columns if c not in first], *[c for c in events.columns if c != ek]))


def _pruned(windows: DataFrame, events: DataFrame, key: str, event_key: str, start: str, end: str, ts: str) -> DataFrame:
    """The events that a window of their key may reach: between the key's first start and last end."""
    reach = windows.groupBy(F.col(key).alias("_wk")).agg(F.min(start).alias("_lo"), F.max(end).alias("_hi"))
    return events.join(reach, (F.col(event_key) == F.col("_wk")) & (F.col(ts) >= F.col("_lo")) & (F.col(ts) <= F.col("_hi")),
                       "left_semi")


def with_interval_sums(left: DataFrame, events: DataFrame, key: str, start: str, end: str, ts: str,
                       values: dict, bucket_seconds: int = 86400, event_key: str | None = None,
                       prune: bool = False, bounds: DataFrame | None = None) -> DataFrame:
    """``left`` with the sums of event ``values`` (name -> numeric Column) over
    ``start <= ts <= end`` of the same key: 0 where no event is inside, NULL where the key or a
    bound is NULL or ``end < start``. The same sums as :func:`interval_sums`, for many windows.

    * Left rows take part in prefix sums of the events they see (key, level, bucket), once
      placed at their start and once at their end: ``P(end) - P(start-)``. Both orders are sorts
      in one partitioning, so left rows are shuffled once, as they are (copies, too).
    * Events are collapsed per (key, ts), then seen from two buckets of each level.

    The work is linear in rows however densely windows overlap, and a hot key is spread over
    its buckets. ``prune`` and ``bounds``: see ``_pruned`` and ``_seen``."""
    ek, names = event_key or key, list(values)
    if prune:
        events = _pruned(left, events, key, ek, start, end, ts)
    ev = (events.select(F.col(ek).alias("_k"), F.col(ts).cast("timestamp_ntz").alias("_t"),
                        *[values[n].alias("_v_" + n) for n in names])
          .filter(F.col("_k").isNotNull() & F.col("_t").isNotNull())
          .groupBy("_k", "_t").agg(*[F.sum("_v_" + n).alias("_v_" + n) for n in names]))
    valid, w, ev = _seen(left, ev, key, start, end, "_t", bucket_seconds, bounds)
    w = w.withColumn("_k", F.col(key)).withColumn("_w", F.lit(True))
    u = w.unionByName(ev, allowMissingColumns=True)
    vals = ["_v_" + n for n in names]

    def upto(bound: str, kind: int) -> list[Column]:
        # at equal times, starts come before events and ends after them
        run = Window.partitionBy("_k", "_l", "_b").orderBy(
            F.coalesce(F.col("_t"), F.col(bound).cast("timestamp_ntz")), F.when(F.col("_w"), kind).otherwise(1)
        ).rowsBetween(Window.unboundedPreceding, 0)
        return [F.coalesce(F.sum(v).over(run), F.lit(0)) for v in vals]

    d = u.select("*", *[c.alias(f"_s{i}") for i, c in enumerate(upto(start, 0))])
    d = d.select("*", *[c.alias(f"_e{i}") for i, c in enumerate(upto(end, 2))]).filter("_w")
    return d.select(*left.columns, *[F.when(valid, F.col(f"_e{i}") - F.col(f"_s{i}")).alias(n) for i, n in enumerate(names)])


def interval_sums(windows: DataFrame, events: DataFrame, key: str, start: str, end: str, ts: str,
                  values: dict, bucket_seconds: int = 86400, event_key: str | None = None,
                  prune: bool = False) -> DataFrame:
    """Sums of event ``values`` (name -> numeric Column) over ``start <= ts <= end``
    for every distinct window ``(key, start, end)``, by prefix sums - no join of
    windows with events, so the work is linear in rows however densely windows
    overlap or events repeat.

    * Events are collapsed per (key, ts) first: copies of one reading are one row.
    * Window ends become marker rows next to the events: at equal time, start
      markers sort before events (sum over ts < start) and end markers after them
      (sum over ts <= end); ``sum = P(end) - P(start-)``.
    * The running sum is computed per (key, time bucket) and the totals of earlier
      buckets are carried in from a one-row-per-bucket table, so a hot key is
      spread over its buckets (same scheme as the bucketed LAG).

    ``prune`` drops, before anything is grouped, the events that no window of their key can
    reach (a semi join on each key's first start and last end): for few windows.
    ``P(end) - P(start-)`` cancels whatever lies outside, so results are the same.

    Returns (key, start, end, *values) with 0 sums for windows without events and
    NULL for windows with a NULL bound or ``end < start``."""
    ek = event_key or key
    names = list(values)
    if prune:
        events = _pruned(windows, events, key, ek, start, end, ts)
    ev = (events.select(F.col(ek).alias("_k"), F.col(ts).cast("timestamp_ntz").alias("_t"),
                        *[values[n].alias(n) for n in names])
          .groupBy("_k", "_t").agg(*[F.sum(n).alias(n) for n in names])
          .select("_k", "_t", F.lit(1).alias("_kind"), F.lit(None).cast("timestamp_ntz").alias("_s"),
                  F.lit(None).cast("timestamp_ntz").alias("_e"), *names))
    w = (windows.select(F.col(key).alias("_k"), F.col(start).cast("timestamp_ntz").alias("_s"),
                        F.col(end).cast("timestamp_ntz").alias("_e")).distinct()
         .filter(F.col("_s").isNotNull() & F.col("_e").isNotNull() & (F.col("_e") >= F.col("_s"))))
    zero = [F.lit(0).cast(ev.schema[n].dataType).alias(n) for n in names]
    # both markers of a window from one pass over the windows
    ends = F.explode(F.array(F.struct(F.col("_s").alias("_t"), F.lit(0).alias("_kind")),
                             F.struct(F.col("_e").alias("_t"), F.lit(2).alias("_kind"))))
    marks = w.select("_k", "_s", "_e", ends.alias("_m")).select("_k", "_m._t", "_m._kind", "_s", "_e", *zero)
    u = ev.unionByName(marks).withColumn("_b", _bucket("_t", bucket_seconds))
    run = Window.partitionBy("_k", "_b").orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    d = u.select("_k", "_b", "_kind", "_s", "_e", *[F.sum(n).over(run).alias(n) for n in names])
    # Totals of all earlier buckets of the key. Built from the two pre-aggregated inputs
    # (their exchanges are shared with the main branch), one row per key and bucket;
    # buckets that hold only markers get a zero row so every marker finds its carry.
    tot = (ev.select("_k", _bucket("_t", bucket_seconds).alias("_b"), *names)
           .unionByName(w.select("_k", F.explode(F.array(_bucket("_s", bucket_seconds),
                                                        _bucket("_e", bucket_seconds))).alias("_b"), *zero))
           .groupBy("_k", "_b").agg(*[F.sum(n).alias(n) for n in names]))
    earlier = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = tot.select("_k", "_b", *[F.sum(n).over(earlier).alias("_c_" + n) for n in names])
    p = (d.filter(F.col("_kind") != 1).join(carry, ["_k", "_b"])
         .select("_k", "_s", "_e", "_kind",
                 *[(F.col(n) + F.coalesce(F.col("_c_" + n), F.lit(0))).alias(n) for n in names]))
    # one aggregate per window instead of joining the start and end halves: P(end) - P(start-)
    sign = F.when(F.col("_kind") == 2, F.lit(1)).otherwise(F.lit(-1))
    return p.groupBy("_k", "_s", "_e").agg(*[F.sum(F.col(n) * sign).alias(n) for n in names]).select(
        F.col("_k").alias(key), F.col("_s").alias(start), F.col("_e").alias(end), *names)


def ratio_of(total, count, digits: int | None = None) -> Column:
    """An average from interval sums: NULL when the window holds no counted event."""
    r = F.try_divide(F.col(total) if isinstance(total, str) else total,
                     F.col(count) if isinstance(count, str) else count)
    return (F.round(r, digits) if digits is not None else r).cast("double")
