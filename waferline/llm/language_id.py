"""Language identification by nearest centroids (operator 6).

A text's vector holds the tf-idf weights of its character 1- to 3-grams (lower case, letters
only, runs of anything else as one border), hashed to ``DIMENSIONS`` and of length 1. Each
language has up to ``CENTROIDS`` centroids, found by spherical k-means on a bounded sample of
its labelled texts (``SAMPLE`` per language, distinct by id and text, chosen by a hash of both). Inverse document
frequencies count all labelled training texts. A text gets the language of its nearest
centroid by cosine.

A text is rejected where its cosine is below what its language allows at its length, counted
in distinct n-grams (two classes per doubling). Each half of a language's sample is measured
against centroids of the other half, whole and in cuts of 4, 8, 16... characters; a class
allows ``SPREAD`` times the distance from the median cosine to the 5 % quantile, downwards
from the median. One or two words tell little, so nearly all of them pass; texts of ten words
or more in a language that was not learned mostly go.

The model is a matrix of languages x centroids x dimensions: bounded by its parameters, and
small enough to broadcast. Texts never move: both passes read them where they lie.

Defined cases: null texts and texts without a letter are ``und`` with score 0, as is every
text when there is nothing to learn from; rows with null lang are predicted, not learned
from; a null doc_id is in no held-out fold; repeated rows count as often as they come; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DIMENSIONS = 1 << 14
GRAMS = 3
SAMPLE, CENTROIDS, ROUNDS = 1500, 4, 12
#: Rejection: width below the median, least pieces for a class's quantiles, least cosine of all.
SPREAD, PIECES, FLOOR = 3.0, 20, 0.01
CLASSES = 2 * DIMENSIONS.bit_length()
FOLDS, HELD = 4, 2
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    """In the test fold: crc32 of the id as text modulo 4 is 2 (null id: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD, F.lit(False))


@lru_cache(1)
def _letters() -> np.ndarray:
    """Per code point: is it a letter (Unicode category L)?"""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def gram_counts(texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(dimensions, counts) of each text's n-grams; both empty without letters."""
    for text in texts:
        c = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        ok = _letters()[c]
        if not ok.any():
            yield np.zeros(0, np.int64), np.zeros(0, np.int64)
            continue
        c = np.where(ok, c, 0).astype(np.uint64)
        c = c[ok | np.r_[True, ok[:-1]]]  # one border for a run of others
        c = np.r_[np.uint64(0), c, np.uint64(0)]
        found = []
        code = np.zeros(len(c), np.uint64)
        for n in range(1, GRAMS + 1):
            m = len(c) - n + 1
            if m <= 0:
                break
            code = code[:m] * np.uint64(0x110003) + c[n - 1:n - 1 + m] + np.uint64(n)
            h = (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - DIMENSIONS.bit_length() + 1)
            found.append(h[c[:m] > 0] if n == 1 else h)
        counts = np.bincount(np.concatenate(found).astype(np.int64), minlength=DIMENSIONS)
        at = np.flatnonzero(counts)
        yield at, counts[at]


def weigh(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weights at the dimensions ``at``, of length 1."""
    w = (1 + np.log(counts)) * idf[at]
    return w / max(np.sqrt((w * w).sum()), 1e-12)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """(number of texts per dimension, number of texts) over all rows of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = 0, np.zeros(DIMENSIONS + 1, np.int64)
        for b in batches:
            for at, _ in gram_counts(b.column(0).to_pylist()):
                df[at] += 1
                n += 1
        df[DIMENSIONS] = n
        yield pa.RecordBatch.from_arrays([pa.array([df], pa.list_(pa.int64()))], ["df"])

    parts = docs.select(F.col("text").cast("string")).mapInArrow(run, "df array<long>")
    rows = parts.select(F.posexplode("df").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(DIMENSIONS + 1, np.int64)
    for r in rows:  # one row per dimension
        df[r[0]] = r[1]
    return df[:-1], int(df[-1])


class Rows:
    """Sparse vectors: dimensions and weights of all rows one after the other."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]]):
        self.size = np.array([len(at) for at, _ in vectors], np.int64)
        self.at = np.concatenate([at for at, _ in vectors] or [np.zeros(0, np.int64)]).astype(np.int32)
        self.weights = np.concatenate([w for _, w in vectors] or [np.zeros(0)]).astype(np.float32)
        self.start = np.cumsum(self.size) - self.size

    def __len__(self) -> int:
        return len(self.size)

    def dense(self, i: int) -> np.ndarray:
        out = np.zeros(DIMENSIONS, np.float32)
        mine = slice(self.start[i], self.start[i] + self.size[i])
        out[self.at[mine]] = self.weights[mine]
        return out

    def cosines(self, vector: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.weights * vector[self.at], self.start)

    def sum(self, some: np.ndarray) -> np.ndarray:
        """The sum of the rows that the mask ``some`` names."""
        mine = np.repeat(some, self.size)
        return np.bincount(self.at[mine], self.weights[mine], minlength=DIMENSIONS).astype(np.float32)


def spherical_means(x: Rows, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids of length 1 of non-empty rows."""
    chosen = [0]
    near = x.cosines(x.dense(0))
    while len(chosen) < min(k, len(x)):  # start from rows far from each other
        far = int(np.argmin(near))
        if near[far] > 1 - 1e-6:
            break
        chosen.append(far)
        near = np.maximum(near, x.cosines(x.dense(far)))
    c = np.array([x.dense(i) for i in chosen])
    for _ in range(rounds):
        own = np.argmax(np.array([x.cosines(v) for v in c]), axis=0)
        for j in range(len(c)):
            if (own == j).any():
                m = x.sum(own == j)
                c[j] = m / max(np.linalg.norm(m), 1e-12)
    return c


def length_class(n_grams: int) -> int:
    """Two classes per doubling of the number of distinct n-grams."""
    return int(2 * np.log2(n_grams))


def least_cosines(texts: list, vectors: list, idf: np.ndarray, k: int) -> np.ndarray:
    """The least cosine allowed per length class, from ``texts`` and their vectors."""
    seen: list[list[float]] = [[] for _ in range(CLASSES)]
    for half in (0, 1):
        if half >= len(vectors):
            break
        by_dimension = np.ascontiguousarray(spherical_means(Rows(vectors[half::2]), k).T)
        for i, text in enumerate(texts[1 - half::2]):
            size = 4
            while True:
                at = i * 7919 % max(1, len(text) - size + 1)
                dims, counts = next(gram_counts([text[at:at + size]]))
                if len(dims):
                    seen[length_class(len(dims))].append(float((weigh(dims, counts, idf) @ by_dimension[dims]).max()))
                if size >= len(text):
                    break
                size *= 2
    out, last = np.full(CLASSES, FLOOR), None
    for c, cosines in enumerate(seen):
        if len(cosines) >= PIECES:
            low, middle = np.quantile(cosines, [0.05, 0.5])
            last = middle - SPREAD * (middle - low)
        elif cosines and last is None:  # too few to know their spread
            out[c] = max(FLOOR, min(cosines) / 2)
            continue
        if last is not None:  # longer texts come nearer: a shorter class's bound holds for them
            out[c] = max(FLOOR, last)
    return out


class Model:
    """languages (of each centroid), centroids by dimension, least cosines of its language by
    length class, idf."""

    def __init__(self, languages: list[str], centroids: np.ndarray, least: np.ndarray, idf: np.ndarray):
        self.languages, self.by_dimension, self.least, self.idf = languages, np.ascontiguousarray(centroids.T), least, idf

    def predict(self, text) -> tuple[str, float, bool]:
        """(language, score, rejected)."""
        at, counts = next(gram_counts([text]))
        if not len(at) or not self.languages:
            return UNKNOWN, 0.0, True
        cosines = weigh(at, counts, self.idf) @ self.by_dimension[at]
        best = int(np.argmax(cosines))
        score = float(min(1.0, max(0.0, cosines[best])))
        return self.languages[best], score, score < self.least[best, length_class(len(at))]


def fit(labelled: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS) -> Model:
    """Learn from all rows of ``labelled`` (doc_id, text, lang; lang not null)."""
    df, n = document_frequencies(labelled)
    idf = np.log((n + 1) / (df + 1)) + 1
    sizes = {r[0]: r[1] for r in labelled.groupBy("lang").agg(F.count(F.lit(1))).collect()}
    if not sizes:
        return Model([], np.zeros((0, DIMENSIONS)), np.zeros((0, CLASSES)), idf)
    share = None  # of 2**40 hash values, by language
    for lang, size in sizes.items():
        part = min(1 << 40, -(-(sample << 40) // size))
        share = (F if share is None else share).when(F.col("lang") == lang, F.lit(part).cast("long"))
    # The hash is of id and text, and equal rows count once: no id, null or repeated, fills the sample.
    chosen = (labelled.withColumn("hash", F.xxhash64("doc_id", "text"))
              .filter(F.pmod("hash", F.lit(1 << 40)) < share).dropDuplicates(["lang", "hash"]))

    def run(rows: pa.Table) -> pa.Table:
        order = sorted(zip(rows["doc_id"].to_pylist(), rows["text"].to_pylist(), strict=True), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
        texts, vectors = [], []  # a text has some hundred n-grams: sparse, or the sample would fill a task
        for (_, text), (at, counts) in zip(order, gram_counts(t for _, t in order), strict=True):
            if len(at):
                texts.append(text)
                vectors.append((at.astype(np.int32), weigh(at, counts, idf).astype(np.float32)))
        if not texts:
            return pa.table({"lang": pa.array([], pa.string()), "vector": pa.array([], pa.list_(pa.float32())), "least": pa.array([], pa.list_(pa.float64()))})
        c = spherical_means(Rows(vectors), centroids)
        least = [least_cosines(texts, vectors, idf, centroids)] * len(c)
        return pa.table({"lang": pa.array([rows["lang"][0].as_py()] * len(c), pa.string()),
                         "vector": pa.array(list(c), pa.list_(pa.float32())), "least": pa.array(least, pa.list_(pa.float64()))})

    found = (chosen.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
             .groupBy("lang").applyInArrow(run, "lang string, vector array<float>, least array<double>").collect())
    found.sort(key=lambda r: r[0])  # languages x centroids rows
    return Model([r[0] for r in found], np.array([r[1] for r in found]).reshape(-1, DIMENSIONS),
                 np.array([r[2] for r in found]).reshape(-1, CLASSES), idf)


def identify(text: Column, model: Model, spark: SparkSession) -> Column:
    """A struct column of lang_pred, score, rejected for a column of texts."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score", "rejected"])

    return predict(text.cast("string"))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")


def identify_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected, learned from the rows outside the fold."""
    found = identify(F.col("text"), fit(training_rows(docs)), docs.sparkSession)
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), found.alias("found")).select(
        "doc_id", "held_out", "found.*")


def accepted_documents(docs: DataFrame) -> DataFrame:
    """The documents whose language is recognised, all columns kept."""
    found = identify(F.col("text"), fit(training_rows(docs)), docs.sparkSession)
    return docs.filter(~found["rejected"])


def crc_fold(doc_id) -> bool:
    """The fold in Python, for tests."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD
