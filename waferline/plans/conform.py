"""The curated build's foreign keys (PL7): what happens to rows whose key no dimension has.

Each foreign key of a fact has a policy: ``keep`` the row, ``drop`` it, or put it into
``quarantine``. A null key is an orphan, too. A row with several orphan keys goes the strictest
way: quarantine before drop before keep, so nothing that anyone wants to look at is lost.

A fact meets the distinct keys of each dimension in a left join: small dimensions are broadcast
by their measured size; for large ones, whose side has one row per key, the adaptive skew join
splits hot keys. Before a fact is written, its distinct keys that no dimension has are found and
kept in files: they are mostly few, so that its rows meet them without a shuffle, however large
the dimensions are. It is written in one pass, partitioned by route; dropped rows are counted in
another, which Spark leaves out where no policy drops.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waferline.sources.tables import FabTables

#: Strictest last.
POLICIES = ("keep", "drop", "quarantine")

#: (fact, its column, dimension, key of the dimension)
FOREIGN_KEYS = (
    ("fact_wafer_tests", "batch_id", "dim_wafer_batches", "batch_id"),
    ("fact_wafer_tests", "process_step_id", "dim_process_steps", "process_step_id"),
    ("fact_wafer_tests", "equipment_id", "dim_equipment", "equipment_id"),
    ("fact_equipment_events", "equipment_id", "dim_equipment", "equipment_id"),
    ("maintenance_events", "equipment_id", "dim_equipment", "equipment_id"),
)


def _checked(policies: Mapping) -> dict:
    wrong = {k: p for k, p in policies.items() if k not in FOREIGN_KEYS or p not in POLICIES}
    if wrong:
        raise ValueError(f"no such foreign key or policy: {wrong}")
    return {fk: policies.get(fk, "keep") for fk in FOREIGN_KEYS}


def orphan_keys(t: FabTables, root: str) -> dict[tuple, DataFrame]:
    """The distinct keys of each foreign key that its dimension lacks (null keys left out), kept
    below ``root/orphan_keys``: read back, their size is known before a fact is joined with them."""
    out = {}
    for i, fk in enumerate(FOREIGN_KEYS):
        fact = getattr(t, fk[0])
        keys = fact.select(F.col(fk[1]).alias("_key")).filter(F.col("_key").isNotNull()).distinct()
        known = getattr(t, fk[2]).select(F.col(fk[3]).alias("_known")).distinct()
        path = f"{root.rstrip('/')}/orphan_keys/{i}"
        keys.join(known, F.col("_key") == F.col("_known"), "left_anti").write.mode("overwrite").parquet(path)
        out[fk] = fact.sparkSession.read.schema(keys.schema).parquet(path)
    return out


def routed(t: FabTables, fact: str, policies: Mapping | None = None, orphans: Mapping | None = None) -> DataFrame:
    """The rows of ``fact`` with ``orphan_keys`` (the columns whose key no dimension has, in the
    order of ``FOREIGN_KEYS``) and ``route``: ``curated``, ``drop`` or ``quarantine``. Foreign
    keys without a policy are kept. Copies stay copies. ``orphans``: what :func:`orphan_keys` found."""
    df, rules, lacks = getattr(t, fact), _checked(policies or {}), []
    names = df.columns
    for i, fk in enumerate(k for k in FOREIGN_KEYS if k[0] == fact):
        if orphans is not None:
            lost = orphans[fk].select(F.col("_key").alias(f"_key{i}"))
            df = df.join(lost, F.col(fk[1]) == F.col(f"_key{i}"), "left")
            lacks.append((fk, F.col(fk[1]).isNull() | F.col(f"_key{i}").isNotNull()))
            continue
        known = getattr(t, fk[2]).select(F.col(fk[3]).alias(f"_key{i}")).filter(F.col(f"_key{i}").isNotNull()).distinct()
        df = df.join(known, F.col(fk[1]) == F.col(f"_key{i}"), "left")
        lacks.append((fk, F.col(f"_key{i}").isNull()))

    def any_of(policy: str) -> Column:
        return reduce(lambda a, b: a | b, [miss for fk, miss in lacks if rules[fk] == policy], F.lit(False))

    orphans = F.array_compact(F.array(*[F.when(miss, F.lit(fk[1])) for fk, miss in lacks]))
    way = F.when(any_of("quarantine"), "quarantine").when(any_of("drop"), "drop").otherwise("curated")
    return df.select(*names, orphans.alias("orphan_keys"), way.alias("route"))


def conform(t: FabTables, policies: Mapping | None = None) -> tuple[FabTables, dict[str, DataFrame]]:
    """(tables whose facts hold the curated rows, quarantined rows by fact), both lazy."""
    curated, held = {}, {}
    for fact in dict.fromkeys(fk[0] for fk in FOREIGN_KEYS):
        rows = routed(t, fact, policies)
        curated[fact] = rows.filter(F.col("route") == "curated").drop("orphan_keys", "route")
        held[fact] = rows.filter(F.col("route") == "quarantine").drop("route")
    return t.with_(**curated), held


def write_conformed(t: FabTables, root: str, policies: Mapping | None = None, orphans: Mapping | None = None) -> None:
    """Write every fact below ``root/conformed`` by route, in the place of what was there. Of
    dropped rows their number is kept, by orphan keys. ``orphans``: what :func:`orphan_keys`
    found in ``t``; without them they are looked for."""
    orphans = orphan_keys(t, root) if orphans is None else orphans
    for fact in dict.fromkeys(fk[0] for fk in FOREIGN_KEYS):
        rows, path = routed(t, fact, policies, orphans), f"{root.rstrip('/')}/conformed/{fact}"
        (rows.filter(F.col("route") != "drop").write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("route").parquet(f"{path}/rows"))
        (rows.filter(F.col("route") == "drop").groupBy("route", "orphan_keys").agg(F.count(F.lit(1)).alias("rows"))
         .write.mode("overwrite").parquet(f"{path}/dropped"))
        # A fact without rows has no folder by route: an empty file tells its columns.
        rows.limit(0).write.mode("overwrite").parquet(f"{path}/columns")


def _written(spark: SparkSession, root: str, fact: str) -> DataFrame:
    path = f"{root.rstrip('/')}/conformed/{fact}"
    return spark.read.schema(spark.read.parquet(f"{path}/columns").schema).parquet(f"{path}/rows")


def read_conformed(spark: SparkSession, root: str, fact: str, route: str = "curated") -> DataFrame:
    """The written rows of one route (those in quarantine with their orphan keys); only its
    folder is read."""
    rows = _written(spark, root, fact).filter(F.col("route") == route)
    return rows.drop("orphan_keys", "route") if route == "curated" else rows.drop("route")


def route_counts(spark: SparkSession, root: str, fact: str) -> DataFrame:
    """(route, orphan_keys, rows) of a written fact, dropped rows included."""
    n = _written(spark, root, fact).groupBy("route", "orphan_keys").agg(F.count(F.lit(1)).alias("rows"))
    return n.unionByName(spark.read.parquet(f"{root.rstrip('/')}/conformed/{fact}/dropped"))
