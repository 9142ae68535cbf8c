"""Sharding by a consistent-hash ring with virtual nodes and bounded loads (operator 5).

Every shard has ``virtual`` points on a ring of 2**48 places, every document one place (a
hash of its id and text checksum). A document belongs to the first shard point after it; a
shard takes no more than its bound, and what overflows goes on clockwise to the next shard
with room. The bounds are the law ``rows``: n // shards, and one more for the first
n % shards shards, so that counts differ by one at most whatever the input is.

The ring is cut into cells at all shard points and at ``GRID`` even places: at most
GRID + shards * virtual cells, a number that the parameters fix and the data does not. The
cells' counts alone decide how many of each cell's documents, in ring order, go to which
shard (``plan``): that table and the cells are small by construction and are broadcast.
Documents get their places by a window within their cell.

Equal texts are separate documents with places of their own: a group of copies with a third
of all rows spreads over the ring. Rows alike in doc_id, size and checksum count as one with
a multiplicity, until the end.

Defined cases: a null text has no bytes (size 1, checksum 0); null doc_ids are placed by
their text; repeated rows get slots of their own; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waferline.llm.common import fresh, stored
from waferline.llm.mix import hash48

SHARDS, VIRTUAL, GRID = 8, 256, 4096
PLACES = 1 << 48


def ring(shards: int, virtual: int = VIRTUAL) -> list[tuple[int, int]]:
    """(place, shard) of all shard points, in order. A shard's points do not depend on the
    number of shards."""
    return sorted((int(hashlib.md5(f"shard {s} point {v}".encode()).hexdigest()[:12], 16), s)
                  for s in range(shards) for v in range(virtual))


def cells(shards: int, virtual: int = VIRTUAL, grid: int = GRID) -> list[tuple[int, int, int, list[int]]]:
    """(cell, first place, end, shards in the clockwise order of their first points)."""
    points = ring(shards, virtual)
    places = [p for p, _ in points]
    cuts = sorted({*places, *range(0, PLACES, PLACES // grid)})
    out = []
    for k, (lo, hi) in enumerate(zip(cuts, [*cuts[1:], PLACES], strict=True)):
        order: list[int] = []
        at = bisect.bisect_left(places, hi)
        for step in range(len(points)):
            s = points[(at + step) % len(points)][1]
            if s not in order:
                order.append(s)
                if len(order) == shards:
                    break
        out.append((k, lo, hi, order))
    return out


def plan(counts: dict[int, int], order: list[tuple[int, int, int, list[int]]], shards: int) -> list[tuple[int, int, int, int, int]]:
    """(cell, from, to, shard, slot of the first): in rounds, each cell offers what it still
    holds to its next shard clockwise, and the shard takes what it has room for."""
    n = sum(counts.values())
    room = [n // shards + (s < n % shards) for s in range(shards)]
    used, done, out = [0] * shards, dict.fromkeys(counts, 0), []
    for step in range(shards):
        for k, _, _, prefer in order:
            left = counts.get(k, 0) - done.get(k, 0)
            s = prefer[step]
            take = min(left, room[s] - used[s])
            if take > 0:
                out.append((k, done[k], done[k] + take, s, used[s]))
                used[s] += take
                done[k] += take
    return out


def assign(docs: DataFrame, shards: int = SHARDS, virtual: int = VIRTUAL, grid: int = GRID) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: one row per row of ``docs`` (doc_id, text)."""
    return assign_copies(docs, shards, virtual, grid).drop("copy")


def assign_copies(docs: DataFrame, shards: int, virtual: int, grid: int) -> DataFrame:
    """``assign`` with ``copy``: the number, from 0, of a row among those of its id and text."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    layout = cells(shards, virtual, grid)
    ring_cells = F.broadcast(spark.createDataFrame(pa.table({
        "cell": pa.array([c[0] for c in layout], pa.int32()), "lo": pa.array([c[1] for c in layout], pa.int64()),
        "hi": pa.array([c[2] for c in layout], pa.int64()),
        "even": pa.array([c[1] // (PLACES // grid) for c in layout], pa.int64())})))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"))
            .groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
            .withColumn("place", hash48(F.col("doc_id"), F.col("text_crc32")))
            .withColumn("even", F.floor(F.col("place") / (PLACES // grid)).cast("long"))
            .join(ring_cells, "even").filter("lo <= place and place < hi").drop("even", "lo", "hi"))
    rows = stored(rows, "shard-rows")
    counts = {r[0]: r[1] for r in rows.groupBy("cell").agg(F.sum("copies")).collect()}  # at most one row per cell
    steps = plan(counts, layout, shards)
    names = ("cell", "first", "end", "shard", "slot_at")
    planned = F.broadcast(spark.createDataFrame(pa.table({
        n: pa.array([s[i] for s in steps], pa.int32() if n in ("cell", "shard") else pa.int64()) for i, n in enumerate(names)})))
    inside = Window.partitionBy("cell").orderBy("place", "doc_id", "size", "text_crc32")
    ahead = F.coalesce(F.sum("copies").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # Copies unfold in two steps, so that no array grows with their number.
    step = 1 << 16
    each = (rows.withColumn("ahead", ahead)
            .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / step))))
            .withColumn("copy", F.explode(F.sequence(F.col("part") * step,
                                                     F.least(F.col("copies"), (F.col("part") + 1) * step) - 1)))
            .withColumn("nth", F.col("ahead") + F.col("copy")))
    return (each.join(planned, "cell").filter("first <= nth and nth < end")
            .select("doc_id", "size", "text_crc32", "copy", "shard", (F.col("slot_at") + F.col("nth") - F.col("first")).alias("slot")))


def digest(assigned: DataFrame) -> DataFrame:
    return assigned.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                           F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, virtual: int = VIRTUAL, grid: int = GRID) -> None:
    """Write the documents as ``path/shard=K``, with their slot, all other columns kept. Rows of
    one id and text are numbered, in two levels, and each takes one of their places."""
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    (row,) = fresh(docs, "shard_row")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "shard-documents")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    thin = rows.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.pmod(F.xxhash64(row), F.lit(256)).alias("bucket"))
    key = ["id", "size", "text_crc32"]
    thin = thin.withColumn("id", F.struct("doc_id"))  # a null id is a key like any other
    before = Window.partitionBy(*key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = thin.groupBy(*key, "bucket").agg(F.count(F.lit(1)).alias("n")).select(
        *key, "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy(*key, "bucket").orderBy("row")) - 1
    numbered = thin.withColumn("place", place).join(sizes, [*key, "bucket"]).select(*key, (F.col("place") + F.col("before")).alias("copy"), "row")
    places = assign_copies(docs, shards, virtual, grid).withColumn("id", F.struct("doc_id")).drop("doc_id")
    found = numbered.join(places, [*key, "copy"]).select(F.col("row").alias(row), "shard", "slot")
    (rows.select(*[f"`{c}`" for c in kept], row).join(found, row).drop(row).write.partitionBy("shard").parquet(path))
