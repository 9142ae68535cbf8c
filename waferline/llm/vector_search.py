"""Exact top-k search by multi-resolution segment statistics (operator 8).

Vectors are cut into 2, 8, then 16 segments; each segment has a mean and a deviation (the
length of what is left of it). For two vectors the inner product is at most::

    sum over segments of   length * mean * mean'  +  deviation * deviation'

which for vectors of given lengths is a lower bound of their distance. Coarse bounds drop
most candidates, finer ones more, and the survivors are compared exactly. A candidate is
dropped only when its bound is below the k-th best score so far, so results are exact.

Queries are a stated set, taken in blocks of ``BLOCK`` rows: a block is broadcast, every
task keeps its k best per query while its candidates stream past, and a window over those
few rows per query and task picks the final k.

Defined cases: null vectors, vectors with null or non-finite components (or of 1e150 and more,
whose squares are not finite), empty vectors and null vec_ids take no part; vectors are compared with those of their own length only; ties go
to the smaller vec_id; repeated rows are candidates each (a query's own id never is its
candidate), and a repeated query is searched once per different vector, the best of all
reported; scores beyond 64 bits stop at the limit; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waferline.llm.common import stored

LEVELS = (2, 8, 16)
K, SCALE, EVERY = 5, 256, 50
BLOCK, CHUNK = 4096, 4096
#: Components from here on count as non-finite: their squares are, and no score could hold them.
LIMIT = 1e150


def integers(ids: list, vectors: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: (ids, floor(SCALE * x)) of the rows that take part."""
    by_length: dict[int, list] = {}
    flat = vectors.flatten()
    values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    sizes = [0 if n is None else n for n in vectors.value_lengths().to_pylist()]
    at = 0
    for i, n in zip(ids, sizes, strict=True):
        x = values[at:at + n]
        at += n
        if n and i is not None and (np.abs(x) < LIMIT).all():
            by_length.setdefault(n, []).append((i, x))
    return {n: (np.array([r[0] for r in rows], np.int64), np.floor(SCALE * np.array([r[1] for r in rows])))
            for n, rows in by_length.items()}


def statistics(v: np.ndarray, segments: int) -> np.ndarray:
    """Rows whose dot products bound the vectors' inner products from above."""
    n = v.shape[1]
    cut = np.unique(np.arange(min(segments, n)) * n // min(segments, n))
    size = np.diff(np.r_[cut, n])
    mean = np.add.reduceat(v, cut, axis=1) / size
    rest = v - np.repeat(mean, size, axis=1)
    return np.hstack([mean * np.sqrt(size), np.sqrt(np.add.reduceat(rest * rest, cut, axis=1))])


def exact_scores(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Integer inner products: in doubles where those are exact, else in Python integers."""
    if np.abs(rows).max(initial=0) * np.abs(q).max(initial=0) * len(q) < 2.0 ** 53:
        return (rows @ q).astype(np.int64)
    whole = [int(x) for x in q]
    lim = 1 << 63
    return np.array([max(-lim, min(lim - 1, sum(int(a) * b for a, b in zip(r, whole, strict=True)))) for r in rows], np.int64)


class Best:
    """The k best candidates of each query of one length so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.levels = [statistics(vectors, s) for s in LEVELS]
        self.found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(ids)
        self.compared = 0

    def _merge(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        s, i = np.r_[self.found[q][0], scores], np.r_[self.found[q][1], ids]
        order = np.lexsort((i, -s.astype(object) if (s == np.iinfo(np.int64).min).any() else -s))[:self.k]
        self.found[q] = s[order], i[order]

    def add(self, ids: np.ndarray, v: np.ndarray) -> None:
        levels = [statistics(v, s) for s in LEVELS]
        # Rounding may move a bound by a few units in the last place of the lengths' product.
        slack = 1e-9 * np.linalg.norm(self.vectors, axis=1) * np.linalg.norm(v, axis=1).max() + 1e-6
        for lo in range(0, len(self.ids), 256):
            coarse = self.levels[0][lo:lo + 256] @ levels[0].T
            for j, bound in enumerate(coarse):
                q = lo + j
                bound[ids == self.ids[q]] = -np.inf
                seen = np.zeros(len(ids), bool)
                if len(self.found[q][0]) < self.k:  # first the likeliest, for a threshold
                    some = np.argpartition(-bound, min(4 * self.k, len(ids) - 1))[:4 * self.k]
                    some = some[np.isfinite(bound[some])]
                    self._merge(q, exact_scores(v[some], self.vectors[q]), ids[some])
                    seen[some] = True
                    self.compared += len(some)
                least = float(self.found[q][0][-1]) - slack[q] if len(self.found[q][0]) >= self.k else -np.finfo(float).max
                left = np.flatnonzero((bound >= least) & ~seen)
                for mine, theirs in zip(self.levels[1:], levels[1:], strict=True):
                    if len(left):
                        left = left[theirs[left] @ mine[q] >= least]
                if len(left):
                    self.compared += len(left)
                    self._merge(q, exact_scores(v[left], self.vectors[q]), ids[left])


def _search_block(vectors: DataFrame, queries: dict[int, tuple[np.ndarray, np.ndarray]], k: int) -> DataFrame:
    shared = vectors.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {n: Best(i, v, k) for n, (i, v) in shared.value.items()}
        for b in batches:
            for at in range(0, b.num_rows, CHUNK):
                piece = b.slice(at, CHUNK)
                for n, (ids, v) in integers(piece.column(0).to_pylist(), piece.column(1)).items():
                    if n in best:
                        best[n].add(ids, v)
        for x in best.values():
            size = [len(s) for s, _ in x.found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(x.ids, size)), pa.array(np.concatenate([i for _, i in x.found])),
                 pa.array(np.concatenate([s for s, _ in x.found]))], ["query_id", "vec_id", "score"])

    return vectors.mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of ``vectors`` (vec_id, embedding) for each
    row of ``queries`` (the same columns)."""
    pick = lambda d: d.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    rows, parts = [], []
    candidates = pick(vectors)

    def search():
        one = integers([r[0] for r in rows], pa.array([r[1] for r in rows], pa.list_(pa.float64())))
        return _search_block(candidates, {n: _distinct(*x) for n, x in one.items()}, k)

    for r in pick(queries).toLocalIterator():
        rows.append(r)
        if len(rows) == block:  # a full block is searched and written, then its rows go
            parts.append(stored(search(), "top-k"))
            rows = []
    if rows or not parts:
        parts.append(search())
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def _distinct(ids: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique(np.hstack([ids[:, None].astype(object), v.astype(object)]).astype(str), axis=0, return_index=True)[1] \
        if len(np.unique(ids)) < len(ids) else np.arange(len(ids))
    return ids[both], v[both]


def every_nth(vectors: DataFrame, n: int = EVERY) -> DataFrame:
    """The contract's queries: vec_ids divisible by ``n``."""
    return vectors.filter(F.col("vec_id") % n == 0)


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     p AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
           FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
     r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
