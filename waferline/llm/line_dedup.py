"""Removal of lines that repeat across documents, with two Bloom filters (operator 11).

1. ``line_keys`` (where the texts lie): a 128-bit digest of each line's key, the line without
   white space at its ends and A-Z lower-cased. Keys of fewer than ``LEAST`` code points take
   no part. Digests are stored; texts do not move yet.
2. ``seen_twice``: half of each digest goes into two Bloom filters, one of hashes seen once and
   one of hashes seen again. The filters are cut into slices by the hash, and the number of
   slices grows with the measured number of lines, so they are as full at any size. A piece of
   rows sends each of its hashes once, however often the line occurs, marked if several of its
   documents hold it; a slice's pieces meet in one bounded group.
3. ``suspects``: the digests are probed against the twice-seen filter, which is broadcast in
   rounds of ``ROUND_SLICES`` slices (a fixed number of bytes; the digests are stored by round,
   so each is read once). Only lines that hit are shuffled.
4. ``confirm``: suspects are counted exactly by the whole digest: smallest and largest id per
   key, combined before the shuffle. Keys in two documents or more lose their lines but in the
   smallest document. Lines of very common keys are joined by broadcast (``join_unique``).
5. The numbers of dropped lines meet their documents, which move once.

Defined cases: a null or empty text is one empty line and stays; all rows of one doc_id are
one document, as are all rows without id, which come after every id; repeated rows lose the
same lines; all lines of a key stay in the first document, repeated or not; equal lines of one
document alone stay; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waferline.llm.common import join_unique, list_of, stored
from waferline.session import checkpoint_dir

#: Least code points of a key.
LEAST = 10
#: Filter bits per line, bits that a hash sets, bits of a slice, slices broadcast at once (32 MB).
LINE_BITS, SETS, SLICE_BITS, ROUND_SLICES = 12, 3, 1 << 22, 64
#: Lines of a piece: what one task puts together before it sends hashes.
PIECE = 1 << 20

SPACE = b" \t\n\x0b\x0c\r"
_LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))
_ODD = np.random.default_rng(11).integers(0, 1 << 63, SETS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def digests(text: str | None, least: int = LEAST) -> tuple[list[int], bytes]:
    """(numbers of the lines with a key, their keys' digests of 16 bytes each)."""
    at, out = [], []
    for i, line in enumerate((text or "").encode("utf-8", "surrogatepass").split(b"\n")):
        k = line.strip(SPACE)
        if len(k) >= least and (len(k) >= 4 * least or len(k.decode("utf-8", "surrogatepass")) >= least):
            at.append(i)
            out.append(xxhash.xxh3_128_digest(k.translate(_LOWER)))
    return at, b"".join(out)


def line_keys(docs: DataFrame, slices: int, round_slices: int = ROUND_SLICES, least: int = LEAST) -> DataFrame:
    """Store doc_id, mark (checksum of the text, which tells rows of one id apart), and per line
    with a key its number and digest (lo, hi), by round of the slice of lo."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                piece = b.slice(at, 512)
                found = [digests(t, least) for t in piece.column(2).to_pylist()]
                row = np.repeat(np.arange(len(found)), [len(x) for x, _ in found])
                line = np.array([i for x, _ in found for i in x], np.int32)
                both = np.frombuffer(b"".join(d for _, d in found), np.uint64).reshape(-1, 2)
                part = slice_of(both[:, 0], slices) // round_slices
                for r in np.unique(part).tolist():
                    mine = part == r
                    rows, first = np.unique(row[mine], return_index=True)
                    cut = np.r_[first, mine.sum()]
                    yield pa.RecordBatch.from_arrays(
                        [piece.column(0).take(pa.array(rows)), piece.column(1).take(pa.array(rows)),
                         list_of(line[mine], cut, pa.int32()), list_of(both[mine, 0].view(np.int64), cut, pa.int64()),
                         list_of(both[mine, 1].view(np.int64), cut, pa.int64()), pa.array(np.full(len(rows), r, np.int32))],
                        ["doc_id", "mark", "line", "lo", "hi", "round"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")).alias("mark"),
                       F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, mark long, line array<int>, lo array<long>, hi array<long>, round int")
    return stored(rows, "line-keys", ["round"])


def slice_of(h: np.ndarray, slices: int) -> np.ndarray:
    """Slice of each hash: its upper half scaled to their number, so slices are ranges."""
    return ((h >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)).astype(np.int64)


def places(h: np.ndarray) -> np.ndarray:
    """The ``SETS`` bits of each hash within its slice."""
    return ((h[None] * _ODD[:, None]) >> np.uint64(64 - SLICE_BITS.bit_length() + 1)).astype(np.int64)


def merge_filters(pieces: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The twice-seen filter of a slice, from (distinct hashes, seen in several documents) of
    its pieces: a hash whose bits are all in the once-seen filter by now is seen again."""
    once, twice = np.zeros(SLICE_BITS, bool), np.zeros(SLICE_BITS, bool)
    for h, several in pieces:
        at = places(h)
        twice[at[:, once[at].all(axis=0) | several]] = True
        once[at] = True
    return twice


def seen_twice(keys: DataFrame, slices: int, piece: int = PIECE) -> DataFrame:
    """Store (slice, bits): the twice-seen filter."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size = [], 0, 0

        def flush():
            h = np.concatenate([x for x, _ in held])
            row = np.concatenate([x for _, x in held])
            order = np.lexsort((row, h))
            h, row = h[order], row[order]
            new = np.r_[True, h[1:] != h[:-1]]
            other = np.r_[False, (h[1:] == h[:-1]) & (row[1:] != row[:-1])]
            first = np.flatnonzero(new)
            several = np.logical_or.reduceat(other, first)
            h = h[first]
            s = slice_of(h, slices)
            present, at = np.unique(s, return_index=True)
            cut = np.r_[at, len(h)]
            return pa.RecordBatch.from_arrays(
                [pa.array(present.astype(np.int32)), list_of(h.view(np.int64), cut, pa.int64()), list_of(several, cut, pa.bool_())],
                ["slice", "hashes", "several"])

        for b in batches:
            lo = b.column(0)
            n = np.diff(lo.offsets.to_numpy())
            held.append((lo.flatten().to_numpy().view(np.uint64), rows + np.repeat(np.arange(len(n)), n)))
            rows, size = rows + len(n), size + int(n.sum())
            if size >= piece:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def build(rows: pa.Table) -> pa.Table:
        bits = merge_filters((np.array(h.values, np.int64).view(np.uint64), np.array(s.values, bool))
                             for h, s in zip(rows["hashes"], rows["several"], strict=True))
        return pa.table({"slice": rows["slice"].slice(0, 1), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    return stored(keys.select("lo").mapInArrow(send, "slice int, hashes array<long>, several array<boolean>")
                  .groupBy("slice").applyInArrow(build, "slice int, bits binary"), "line-filter")


def suspects(keys: DataFrame, filters: DataFrame, slices: int, round_slices: int = ROUND_SLICES) -> DataFrame:
    """Store the lines whose hash is in the twice-seen filter: doc_id, mark, line, lo, hi."""
    spark = keys.sparkSession
    schema = "doc_id long, mark long, line int, lo long, hi long"
    path = f"{checkpoint_dir(spark)}/llm-line-suspects-{uuid.uuid4().hex}"

    for r in range(-(-slices // round_slices)):
        base = r * round_slices
        rows = filters.filter(F.col("slice").between(base, base + round_slices - 1)).collect()  # a fixed number of bytes
        bits = np.zeros((round_slices, SLICE_BITS // 8), np.uint8)
        for x in rows:
            bits[x["slice"] - base] = np.frombuffer(x["bits"], np.uint8)
        shared = spark.sparkContext.broadcast(bits)

        def probe(batches: Iterator[pa.RecordBatch], shared=shared, base=base) -> Iterator[pa.RecordBatch]:
            bits = shared.value
            for b in batches:
                n = np.diff(b.column(2).offsets.to_numpy())
                lo = b.column(3).flatten()
                h = lo.to_numpy().view(np.uint64)
                s = slice_of(h, slices) - base
                hit = np.ones(len(h), bool)
                for at in places(h):
                    hit &= (bits[s, at >> 3] >> (7 - (at & 7)) & 1).astype(bool)
                row = pa.array(np.repeat(np.arange(len(n)), n)[hit])
                keep = pa.array(hit)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(row), b.column(1).take(row), b.column(2).flatten().filter(keep), lo.filter(keep),
                     b.column(4).flatten().filter(keep)], ["doc_id", "mark", "line", "lo", "hi"])

        (keys.filter(F.col("round") == r).select("doc_id", "mark", "line", "lo", "hi")
         .mapInArrow(probe, schema).write.mode("append").parquet(path))
        shared.unpersist()
    return spark.read.schema(schema).parquet(path)


def confirm(found: DataFrame) -> DataFrame:
    """The lines to drop: doc_id, mark, line."""
    ids = found.groupBy("lo", "hi").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"),
                                        F.max(F.col("doc_id").isNull()).alias("no_id"))
    repeated = ids.filter((F.col("first") < F.col("last")) | (F.col("no_id") & F.col("first").isNotNull())).select("lo", "hi", "first")
    lines = join_unique(found, stored(repeated, "line-repeated"), ["lo", "hi"])
    return lines.filter(F.col("doc_id").isNull() | (F.col("doc_id") > F.col("first"))).select("doc_id", "mark", "line").distinct()


def drop_repeated_lines(docs: DataFrame, least: int = LEAST, line_bits: int = LINE_BITS, round_slices: int = ROUND_SLICES,
                        piece: int = PIECE) -> DataFrame:
    """doc_id, text (what is kept, never null), n_lines, dropped (numbers of dropped lines): a
    row per row of ``docs`` (doc_id, text)."""
    text = F.col("text").cast("string")
    lines = docs.agg(F.sum(F.length(text) - F.length(F.translate(text, "\n", "")) + 1)).first()[0] or 0
    slices = max(1, -(-lines * line_bits // SLICE_BITS))
    keys = line_keys(docs, slices, round_slices, least)
    found = suspects(keys, seen_twice(keys, slices, piece), slices, round_slices)
    drops = confirm(found).groupBy("doc_id", "mark").agg(F.array_sort(F.collect_list("line")).alias("dropped"))
    drops = drops.select(F.col("doc_id").alias("d"), F.col("mark").alias("m"), "dropped")
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text"))
    joined = rows.join(drops, F.col("doc_id").eqNullSafe(F.col("d")) & (F.xxhash64("text") == F.col("m")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                piece = b.slice(at, 512)
                kept, n = [], []
                for t, gone in zip(piece.column(1).to_pylist(), piece.column(2).to_pylist(), strict=True):
                    t = t or ""
                    n.append(t.count("\n") + 1)
                    if gone:
                        gone = set(gone)
                        t = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)
                    kept.append(t)
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(kept, pa.string()), pa.array(n, pa.int64()), piece.column(2)],
                                                 ["doc_id", "text", "n_lines", "dropped"])

    return (joined.select("doc_id", "text", F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))
            .mapInArrow(run, "doc_id long, text string, n_lines long, dropped array<int>"))


def digest(result: DataFrame) -> DataFrame:
    """The contract's columns of ``drop_repeated_lines``'s result."""
    return result.select("doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"),
                         F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
     l AS (SELECT r, doc_id, i, ls[i] AS line,
                  translate(trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
           FROM (SELECT r, doc_id, ls, unnest(generate_series(1, len(ls))) AS i FROM d)),
     m AS (SELECT k, min(doc_id) AS first FROM l WHERE length(k) >= 10 GROUP BY k
           HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 2),
     g AS (SELECT l.*, m.k IS NOT NULL AND (doc_id IS NULL OR doc_id <> m.first) AS gone FROM l LEFT JOIN m USING (k))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM g GROUP BY r
"""
