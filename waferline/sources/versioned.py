"""Tables whose changes are seen whole or not at all (PL6).

Below a table's folder:

* ``data/kept_version=<number>-<id>/<column>=<value>/``: the partitions that one change wrote;
* ``versions/<number>.json``: which folder holds each partition of that version, and the schema.

A change writes its partitions to a folder of its own, then the list of all partitions to a
hidden file, and renames that into ``versions``: the rename is the moment it happens. Readers
take the highest number, so they see the old table or the new one; a change that dies on the way
leaves the old one, and is run again. Partitions a change does not touch are neither read nor
written, and a running reader keeps the files of its version until :func:`drop_versions`.
The list has one entry per partition, the only thing the driver holds. Two writers at once: the
second to rename finds its number taken and fails without a trace in the table (by the file
system's rename; on a file system whose rename replaces files, run one writer a table).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waferline.plans.layers import dedupe_latest, upsert

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
FOLDER = "kept_version"


class _Files:
    """The few file operations that a version needs, on whatever file system it lies."""

    def __init__(self, spark: SparkSession, root: str):
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        self.io = spark._jvm.org.apache.commons.io.IOUtils

    def names(self, folder: str) -> list[str]:
        p = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.fs.create(self.path(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def publish(self, hidden: str, name: str) -> None:
        if self.fs.exists(self.path(name)) or not self.fs.rename(self.path(hidden), self.path(name)):
            raise RuntimeError(f"another writer has made {name}: run the change again")

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of a table's versions, ascending; empty where there is no table."""
    return [int(n[:-5]) for n in _Files(spark, root).names(f"{root}/versions") if n.endswith(".json") and not n.startswith(".")]


def _listed(spark: SparkSession, root: str, version: int) -> dict:
    return json.loads(_Files(spark, root).read(f"{root}/versions/{version:012d}.json"))


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """The table as of a version (the last one if None); None where there is no table."""
    known = versions(spark, root)
    if not known:
        return None
    held = _listed(spark, root, known[-1] if version is None else version)
    schema = T.StructType.fromJson(held["schema"])
    paths = [f"{root}/data/{folder}/{part}" for part, folder in sorted(held["partitions"].items())]
    if not paths:
        return spark.createDataFrame([], schema)
    with_folder = T.StructType([*schema.fields, T.StructField(FOLDER, T.StringType())])
    return spark.read.schema(with_folder).option("basePath", f"{root}/data").parquet(*paths).select(*schema.names)


def write_upsert_versioned(spark: SparkSession, updates: DataFrame, root: str, keys: Sequence[str], order: Sequence[str],
                           partition_col: str) -> int:
    """Merge ``updates`` into the table and return the version that this makes. As in
    :func:`waferline.plans.layers.write_upsert` the latest row of a key stays, a key may move to
    another partition, and a partition without rows goes; but all of it appears at once, each
    touched partition is written once, and the same updates again change nothing. Null is a key
    like any other."""
    files, known = _Files(spark, root), versions(spark, root)
    number = known[-1] + 1 if known else 1
    old = _listed(spark, root, known[-1])["partitions"] if known else {}
    folder = f"{FOLDER}={number:012d}-{uuid.uuid4().hex[:12]}"
    target = read_version(spark, root)
    if target is None:
        merged, touched = dedupe_latest(updates, keys, order), set()
    else:
        new = updates.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).distinct()
        same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
        held = target.join(new, same, "left_semi").select(partition_col)
        days = updates.select(partition_col).union(held).distinct()
        merged = upsert(target.join(days.withColumnRenamed(partition_col, "_p"),
                                    F.col(partition_col).eqNullSafe(F.col("_p")), "left_semi"), updates, keys, order)
        names = days.select(F.coalesce(F.col(partition_col).cast("string"), F.lit(NULL_PARTITION)).alias("v"))
        touched = {f"{partition_col}={r.v}" for r in names.collect()}          # a row per partition
    merged.write.mode("overwrite").partitionBy(partition_col).parquet(f"{root}/data/{folder}")
    written = [n for n in files.names(f"{root}/data/{folder}") if n.startswith(f"{partition_col}=")]
    plain = {n for n in old if _unescaped(n) in touched}
    parts = {**{p: f for p, f in old.items() if p not in plain}, **{p: folder for p in written}}
    _commit(files, root, number, parts, merged.schema)
    return number


def _unescaped(name: str) -> str:
    """A partition folder's name with the characters that Spark escapes (``%3A``) as they were."""
    from urllib.parse import unquote
    return unquote(name)


def _commit(files: _Files, root: str, number: int, parts: dict, schema: T.StructType) -> None:
    hidden = f"{root}/versions/.{uuid.uuid4().hex}.tmp"
    files.write(hidden, json.dumps({"partitions": parts, "schema": json.loads(schema.json())}))
    files.publish(hidden, f"{root}/versions/{number:012d}.json")


def drop_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Forget all but the last ``keep`` versions and delete the folders that none of those names
    (also those of changes that died). Returns the deleted folders. Not beside a running change."""
    if keep < 1:
        raise ValueError("the last version stays")
    files, known = _Files(spark, root), versions(spark, root)
    used = {f for v in known[-keep:] for f in _listed(spark, root, v)["partitions"].values()}
    for v in known[:-keep]:
        files.delete(f"{root}/versions/{v:012d}.json")
    for n in files.names(f"{root}/versions"):
        if n.endswith(".tmp"):
            files.delete(f"{root}/versions/{n}")
    gone = [n for n in files.names(f"{root}/data") if n.startswith(f"{FOLDER}=") and n not in used]
    for n in gone:
        files.delete(f"{root}/data/{n}")
    return gone


def write_version(spark: SparkSession, table: DataFrame, root: str, partition_col: str) -> int:
    """Put ``table`` whole in the place of the last version; returns the version that this makes.
    ``table`` may be made from the last version, whose files stay as they are."""
    files, known = _Files(spark, root), versions(spark, root)
    number = known[-1] + 1 if known else 1
    folder = f"{FOLDER}={number:012d}-{uuid.uuid4().hex[:12]}"
    table.write.mode("overwrite").partitionBy(partition_col).parquet(f"{root}/data/{folder}")
    written = [n for n in files.names(f"{root}/data/{folder}") if n.startswith(f"{partition_col}=")]
    _commit(files, root, number, dict.fromkeys(written, folder), table.schema)
    return number
