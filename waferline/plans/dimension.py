"""A kept type-2 dimension, into which dated snapshots are merged in any order (PL8).

:func:`waferline.plans.layers.scd2` builds a history from all snapshots at once. Here the
history is kept, and a merge brings one snapshot or a few: later ones, earlier ones, or a date
that was merged before, whose rows it replaces. After any order of merges the history is that
of all snapshots.

Besides the versions the table keeps what a later merge needs to know, the *sightings*: per key
one row for each run of consecutive days on which snapshots show the same attributes. A
snapshot between two days of one version can so split it in the right place. Both, and the days
merged, are one table of versions (:mod:`waferline.sources.versioned`), so readers see the
dimension before or after a merge, and a merge that dies is run again.

A merge reads and writes the dimension once, as a full snapshot does; its windows run over one
key's sightings, which the calendar bounds. The driver holds the days of the merged snapshots.

Keys that vanish: with ``close=False`` a key that later snapshots lack keeps its last version
open, as in ``scd2``. With ``close=True`` it ends the day before the first snapshot without
it, and a return starts a new version.

Defined cases: a null key is a key like any other, and null attributes are values; of several
rows of a key on one date the one with the greatest attributes counts, nulls smallest; rows
without a date belong to no snapshot and are left out; a merge of no rows and no ``dates`` changes
nothing, one of no rows with ``dates`` says that no key was there on them.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waferline.sources.versioned import read_version, write_version

SEEN, DAY, VERSION = "seen", "day", "version"


def _days(dates: Sequence[date]):
    return F.array(*[F.lit(d) for d in sorted(dates)]).cast("array<date>")


def without_days(sightings: DataFrame, key: str, attrs: Sequence[str], dates: Sequence[date]) -> DataFrame:
    """The sightings on all other days than ``dates``: runs are cut around these."""
    cuts = F.filter(_days(dates), lambda d: d.between(F.col("first_date"), F.col("last_date")))
    pieces = F.expr("""filter(transform(sequence(0, size(cuts)), i -> struct(
        coalesce(date_add(get(cuts, i - 1), 1), first_date) AS first_date, coalesce(date_sub(get(cuts, i), 1), last_date) AS last_date)),
        p -> p.first_date <= p.last_date)""")
    return sightings.withColumn("cuts", cuts).select(key, *attrs, F.explode(pieces).alias("p")).select(key, *attrs, "p.*")


def joined_days(sightings: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """Sightings of a key on days that follow each other, with the same attributes, made one."""
    w = Window.partitionBy(key).orderBy("first_date")
    value = F.struct(*attrs)
    goes_on = F.lag(value).over(w).eqNullSafe(value) & (F.lag("last_date").over(w) == F.date_sub("first_date", 1))
    runs = sightings.withColumn("new", F.when(goes_on, 0).otherwise(1)).withColumn("run", F.sum("new").over(w))
    return (runs.groupBy(key, "run").agg(*[F.first(a).alias(a) for a in attrs], F.min("first_date").alias("first_date"),
                                         F.max("last_date").alias("last_date")).drop("run"))


def versions_of(sightings: DataFrame, key: str, attrs: Sequence[str], dates: Sequence[date], close: bool) -> DataFrame:
    """key, attrs, first_date, last_date (null while current): a row per version."""
    w = Window.partitionBy(key).orderBy("first_date")
    value, follows = F.struct(*attrs), F.lead("first_date").over(w)
    missed = F.array_min(F.filter(_days(dates), lambda d: d > F.col("last_date")))
    ended = F.when(follows.isNull() | (missed < follows), missed) if close else F.lit(None).cast("date")
    rows = sightings.withColumn("ended", ended)
    starts = F.lag("first_date").over(w).isNull() | ~F.lag(value).over(w).eqNullSafe(value) | F.lag("ended").over(w).isNotNull()
    first = rows.withColumn("start", starts).withColumn("n", F.sum(F.col("start").cast("int")).over(w))
    whole = first.groupBy(key, "n").agg(*[F.first(a).alias(a) for a in attrs], F.min("first_date").alias("first_date"),
                                        F.max("ended").alias("ended"))
    after = F.lead("first_date").over(Window.partitionBy(key).orderBy("first_date"))
    return whole.select(key, *attrs, "first_date", F.date_sub(F.least("ended", after), 1).alias("last_date"))


def merge_snapshots(spark: SparkSession, root: str, snapshots: DataFrame, key: str, attrs: Sequence[str],
                    date_col: str = "snapshot_date", dates: Sequence[date] = (), close: bool = False) -> int | None:
    """Merge whole snapshots (key, attrs, date) into the dimension below ``root``. ``dates``:
    further days of which this is the whole snapshot, for days without a row. Returns the version
    of the table that holds it, or None if there was nothing to merge."""
    rows = (snapshots.filter(F.col(date_col).isNotNull()).groupBy(key, F.to_date(date_col).alias("first_date"))
            .agg(F.max(F.struct(*attrs)).alias("value")).select(key, *[F.col("value")[a].alias(a) for a in attrs],
                                                               "first_date", F.col("first_date").alias("last_date")))
    new = {r[0] for r in rows.select("first_date").distinct().collect()} | set(dates)     # a row per day
    if not new:
        return None
    kept, known = read_version(spark, root), set()
    if kept is not None:
        known = {r[0] for r in kept.filter(F.col("kind") == DAY).select("first_date").collect()}
        rows = without_days(kept.filter(F.col("kind") == SEEN).drop("kind"), key, attrs, new).unionByName(rows)
    seen = joined_days(rows, key, attrs)
    days = spark.range(1).select(*[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in (key, *attrs)],
                                 F.explode(_days(new | known)).alias("first_date")).withColumn("last_date", F.col("first_date"))
    parts = {SEEN: seen, DAY: days, VERSION: versions_of(seen, key, attrs, new | known, close)}
    table = None
    for kind, df in parts.items():
        df = df.select(key, *attrs, "first_date", "last_date", F.lit(kind).alias("kind"))
        table = df if table is None else table.unionByName(df)
    return write_version(spark, table, root, "kind")


def read_dimension(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """The history, as ``scd2`` gives it, as of a version of the table (the last one if None);
    None before the first merge."""
    kept = read_version(spark, root, version)
    if kept is None:
        return None
    own = [c for c in kept.columns if c not in ("first_date", "last_date", "kind")]
    return kept.filter(F.col("kind") == VERSION).select(
        *own, F.col("first_date").alias("effective_start_date"), F.col("last_date").alias("effective_end_date"),
        F.col("last_date").isNull().alias("current_flag"))


def at_date(facts: DataFrame, dimension: DataFrame, key: str, on) -> DataFrame:
    """Each fact with the attributes of its key's version on the date ``on`` (nulls where there
    is none). The join is on the key; a key's versions are bounded by the calendar, and its facts
    go to them, not to each other."""
    own = [c for c in dimension.columns if c not in (key, "effective_start_date", "effective_end_date", "current_flag")]
    taken = {c.lower() for c in facts.columns}
    names = {c: f"{c}_then" if c.lower() in taken else c for c in own}
    d = dimension.select(F.col(key).alias("_dk"), F.col("effective_start_date").alias("_ds"),
                         F.col("effective_end_date").alias("_de"), *[F.col(c).alias(n) for c, n in names.items()])
    day = F.to_date(on if not isinstance(on, str) else F.col(on))
    return facts.withColumn("_day", day).join(
        d, F.col(key).eqNullSafe(F.col("_dk")) & (F.col("_day") >= F.col("_ds")) & (F.col("_de").isNull() | (F.col("_day") <= F.col("_de"))),
        "left").drop("_dk", "_ds", "_de", "_day")
