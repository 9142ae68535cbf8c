"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waferline.session import checkpoint_dir

#: Lower-cases A-Z only, as the contracts ask (never the locale's or Unicode's rules).
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the lineage, and
    a lost executor only costs the tasks that read what it held."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores as make it differ from all columns of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def join_unique(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", hot: int = 1000) -> DataFrame:
    """Join a stored ``left`` with ``right``, whose keys are unique. A key that holds more than
    1/``hot`` of the rows of ``left`` would fill one task; there are fewer than ``hot`` such keys,
    so their rows of ``right`` are broadcast and only the others are shuffled. No key is null."""
    many = left.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
    total = left.count()
    keys = [r[:-1] for r in many.filter(F.col("__n") > max(1, total // hot)).collect()]  # fewer than ``hot`` rows
    if not keys:
        return left.join(right, on, how)
    few = F.broadcast(left.sparkSession.createDataFrame([tuple(k) for k in keys], left.select(*on).schema))
    rare = left.join(few, on, "left_anti").join(right, on, how)
    often = left.join(few, on, "left_semi").join(F.broadcast(right.join(few, on, "left_semi")), on, how)
    return rare.unionByName(often)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def n_words(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


#: Bytes that separate words, mapped to a space; A-Z to a-z. Bytes of 0x80 and above are
#: parts of multi-byte characters, which all belong to words.
def byte_table(is_word) -> bytes:
    t = bytearray(range(256))
    for i in range(256):
        if 65 <= i <= 90:
            t[i] = i + 32
        if i < 128 and not is_word(t[i]):
            t[i] = 32
    return bytes(t)


#: Words ``[^\x20\x09-\x0D]+``: everything but the ASCII white space.
SPACED = byte_table(lambda b: not (b == 32 or 9 <= b <= 13))
#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``: digits, a-z and all beyond ASCII.
ALNUM = byte_table(lambda b: 48 <= b <= 57 or 97 <= b <= 122)


def split_words(texts, table: bytes) -> tuple[pa.Array, np.ndarray]:
    """(flat binary array of all words, number of words per text) of an iterable of
    ``str | None``."""
    words: list[bytes] = []
    counts = []
    for t in texts:
        w = t.encode("utf-8", "surrogatepass").translate(table).split(b" ") if t else []
        if b"" in w:
            w = [x for x in w if x]
        counts.append(len(w))
        words += w
    return pa.array(words, pa.large_binary()), np.array(counts, np.int64)


def starts_of(counts: np.ndarray) -> np.ndarray:
    """Start of each run of ``counts`` and the end of the last: an exclusive prefix sum."""
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of ``arange(s, s + c)`` over all pairs."""
    counts = np.asarray(counts, np.int64)
    if not counts.sum():
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(ends[-1]) + np.repeat(np.asarray(starts, np.int64) - (ends - counts), counts)


def list_of(values, offsets, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.asarray(offsets), pa.int32()), pa.array(values, kind))


def in_batches(batches, limit: int, weigh):
    """Regroup an iterator of Arrow record batches into lists of rows whose summed
    ``weigh(row)`` reaches ``limit``: bounded pieces of a partition. Rows are dicts; a row
    is never cut, so a piece holds at most one row beyond the limit."""
    piece, total = [], 0
    for b in batches:
        for r in b.to_pylist():
            piece.append(r)
            total += weigh(r)
            if total >= limit:
                yield piece
                piece, total = [], 0
    if piece:
        yield piece
