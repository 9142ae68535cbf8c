"""Column expressions shared by the operators. All are built-in Spark expressions
(whole-stage codegen), no Python UDFs."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- time
def ts_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal, independent of the session and Python time zones."""
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, date):
        value = value.strftime("%Y-%m-%d 00:00:00")
    return F.lit(str(value)).cast("timestamp_ntz")


def as_datetime(value) -> datetime:
    if isinstance(value, datetime):
        return value
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    return datetime.fromisoformat(str(value))


def as_of_date(as_of) -> datetime:
    """``CURRENT_DATE`` of the reference: the as-of instant truncated to midnight."""
    d = as_datetime(as_of)
    return datetime(d.year, d.month, d.day)


def window_start(as_of, days: float = 0, weeks: float = 0, hours: float = 0) -> Column:
    """``CURRENT_DATE - INTERVAL n`` as a literal (constant-folded, pushable)."""
    return ts_lit(as_of_date(as_of) - timedelta(days=days, weeks=weeks, hours=hours))


def since(df, ts: str, as_of, **interval):
    """``df`` rows with ``ts >= CURRENT_DATE - INTERVAL`` (as of ``as_of``). When the
    table is date-partitioned (an ``event_date`` column next to ``event_timestamp``)
    the same bound is also put on the partition column, so whole partitions are
    pruned before any file is opened."""
    bound = window_start(as_of, **interval)
    out = df.filter(F.col(ts) >= bound)
    part = {"event_timestamp": "event_date", "test_timestamp": "test_date"}.get(ts)
    if part and part in df.columns:
        out = out.filter(F.col(part) >= F.to_date(bound))
    return out


def ts_diff(unit: str, start, end) -> Column:
    """``TIMESTAMPDIFF(unit, start, end)``: whole units, truncated toward zero."""
    return F.timestamp_diff(unit, col(start), col(end))


def epoch_seconds(ts) -> Column:
    """Seconds since 1970 for TIMESTAMP and TIMESTAMP_NTZ alike (no zone shift)."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            col(ts).cast("timestamp_ntz"))


def yearweek(ts) -> Column:
    """MySQL ``YEARWEEK(ts)`` (mode 0: weeks start on Sunday; days before the first
    Sunday belong to the last week of the previous year)."""
    d = F.to_date(col(ts))
    sunday = F.date_sub(d, F.dayofweek(d) - 1)
    return (F.year(sunday) * 100 + F.floor((F.dayofyear(sunday) + 6) / 7)).cast("int")


# ---------------------------------------------------------------- ratios
def flag(pred: Column) -> Column:
    """``CASE WHEN pred THEN 1 ELSE 0 END`` (NULL predicate counts as 0)."""
    return F.when(pred, 1).otherwise(0)


def pct(num, den) -> Column:
    """``100.0 * num / den`` in DOUBLE; NULL when den is 0 (ANSI-safe)."""
    return F.try_divide(F.lit(100.0) * col(num).cast("double"), col(den).cast("double"))


def ratio(num, den) -> Column:
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def safe_corr(x, y) -> Column:
    """Pearson correlation that returns NULL (not an error) for constant input or a
    single pair. ``corr`` raises DIVIDE_BY_ZERO under ANSI mode in that case."""
    x, y = col(x).cast("double"), col(y).cast("double")
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def stable(c, digits: int = 9) -> Column:
    """Round a floating aggregate the reference leaves unrounded, so results do not
    depend on the summation order chosen by the partitioning."""
    return F.round(col(c), digits)


def tier(value, thresholds: list[tuple[float, str]], default: str, op: str = ">=") -> Column:
    """``CASE WHEN v >= t1 THEN l1 WHEN v >= t2 ... ELSE default END``; NULL falls to ELSE."""
    v = col(value)
    expr = None
    for t, label in thresholds:
        cond = {">=": v >= t, ">": v > t, "<=": v <= t, "<": v < t}[op]
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)


def round_avg(c, digits: int, scale: int = 6) -> Column:
    """``ROUND(AVG(c), digits)`` computed in exact decimal arithmetic.

    Averages of few-decimal readings often land exactly on a rounding tie; a DOUBLE
    sum makes the tie's side depend on summation order (i.e. on partitioning).
    A DECIMAL sum is exact and order-free, so the result is deterministic."""
    return F.round(F.avg(col(c).cast(f"decimal(30,{scale})")), digits).cast("double")
