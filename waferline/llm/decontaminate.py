"""Benchmark decontamination with a distributed positional inverted index (operator 10).

1. ``build_index`` cuts the documents into segments of bounded size, wherever they lie (no
   shuffle of texts), and stores for each (segment, term) the list of word positions as
   gaps, plus one row per segment with its documents. The index is a Parquet table in the
   shared folder.
2. ``phrase_hits`` looks up phrases. Per segment, each phrase starts from its rarest term:
   that term's positions minus its offset are the candidates, which are then intersected
   with the offset-adjusted lists of the other terms, rarest first. ``slop`` > 0 gives
   proximity matches: every term may stand up to ``slop`` words off its place.
3. ``decontaminate`` applies 13-word windows of the benchmark and counts, per document, the
   words inside any occurrence.

Phrases are a stated query set: they pass in blocks of bounded size, each block broadcast
and its result written before the next. A segment's size bounds a task's memory, however
many documents share a passage.

Defined cases: null or word-less texts have no words (n_words 0, no hits, clean); items of
no words have no window; an item with null id hits but is not listed; repeated rows and
repeated doc_ids are judged row by row; extra columns are ignored; an empty benchmark leaves
every document clean; empty documents give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from waferline.llm.common import ALNUM, list_of, ranges, split_words, starts_of, stored

WINDOW = 13
SEGMENT_WORDS = 1 << 20
BLOCK_BYTES = 8 << 20
#: Free positions between two documents of a segment, so that no phrase spans both.
GAP = 64

INDEX_SCHEMA = "segment string, term binary, gaps array<int>, doc_ids array<long>, n_words array<int>"
HIT_SCHEMA = ("segment string, place int, doc_id long, n_words long, hits array<int>, items array<string>")


def _segment(seg: str, ids: list, counts: np.ndarray, words: pa.Array, terms: pa.Array | None) -> pa.RecordBatch:
    """The rows of one segment: its documents, then one row per term."""
    starts = starts_of(counts + GAP)[:-1]
    pos = ranges(starts, counts)
    if terms is None:
        coded = words.dictionary_encode()
        tid, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    else:
        tid = pc.index_in(words, value_set=terms).fill_null(-1).to_numpy()
        pos, tid, names = pos[tid >= 0], tid[tid >= 0].astype(np.int64), terms
    order = np.argsort(tid, kind="stable")
    tid, pos = tid[order], pos[order]
    present, first = np.unique(tid, return_index=True)
    gaps = np.diff(pos, prepend=0)
    gaps[first] = pos[first]
    n = len(present)
    cols = [
        pa.array([seg] * (n + 1)),
        pa.concat_arrays([pa.nulls(1, pa.binary()), names.take(pa.array(present)).cast(pa.binary())]),
        list_of(gaps.astype(np.int32), np.r_[0, 0, first[1:], len(pos)] if n else [0, 0], pa.int32()),
        pa.array([ids] + [None] * n, pa.list_(pa.int64())),
        pa.array([counts.astype(np.int32)] + [None] * n, pa.list_(pa.int32())),
    ]
    return pa.RecordBatch.from_arrays(cols, ["segment", "term", "gaps", "doc_ids", "n_words"])


def build_index(docs: DataFrame, terms: pa.Array | None = None, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """Store the positional index of ``docs`` (doc_id, text) and return it. ``terms``
    restricts it to the terms that a stated query set can ask for; None indexes all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        ids, counts, words, total = [], [], [], 0

        def flush():
            return _segment(f"{part}-{k}", ids, np.concatenate(counts), pa.concat_arrays(words), terms)

        for b in batches:
            for at in range(0, b.num_rows, 512):
                piece = b.slice(at, 512)
                w, c = split_words(piece.column(1).to_pylist(), ALNUM)
                ids += piece.column(0).to_pylist()
                counts.append(c)
                words.append(w)
                total += len(w) + len(c)
                if total >= segment_words:
                    yield flush()
                    ids, counts, words, total, k = [], [], [], 0, k + 1
        if ids:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, INDEX_SCHEMA)
    return stored(rows, "postings")


def _phrase_table(phrases: list[list[bytes]], terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(matrix of term numbers padded with -1, lengths)."""
    lens = np.array([len(p) for p in phrases], np.int64)
    flat = pc.index_in(pa.array([w for p in phrases for w in p], pa.large_binary()),
                       value_set=terms.cast(pa.large_binary())).to_numpy()
    m = np.full((len(phrases), int(lens.max(initial=1))), -1, np.int64)
    m[np.repeat(np.arange(len(phrases)), lens), ranges(np.zeros(len(lens)), lens)] = flat
    return m, lens


def _occurrences(matrix: np.ndarray, key: np.ndarray, first: np.ndarray, cnt: np.ndarray, span: int,
                 slop: int, most: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(phrase, start position) of every occurrence. ``key`` = term * span + position, in
    order; ``first`` and ``cnt`` give each term's list in it."""
    have = np.where(matrix >= 0, cnt[matrix], np.iinfo(np.int64).max)
    live = np.flatnonzero(have.min(axis=1, initial=np.iinfo(np.int64).max) > 0) if len(matrix) else np.zeros(0, int)
    live = live[matrix[live, 0] >= 0] if len(live) else live
    order = np.argsort(have[live], axis=1, kind="stable")
    rarest = matrix[live, order[:, 0]] if len(live) else np.zeros(0, int)
    cut = np.flatnonzero(np.diff(np.cumsum(cnt[rarest]) // most, prepend=0)) if len(live) else []
    for lo, hi in zip([0, *cut], [*cut, len(live)], strict=True):
        if lo == hi:
            continue
        p, o, r = live[lo:hi], order[lo:hi], rarest[lo:hi]
        row = np.repeat(np.arange(hi - lo), cnt[r])
        start = key[ranges(first[r], cnt[r])] % span - np.repeat(o[:, 0], cnt[r])
        if slop:  # the rarest term itself may stand off its place
            row, start = np.tile(row, 2 * slop + 1), np.concatenate([start + d for d in range(-slop, slop + 1)])
        for k in range(1, matrix.shape[1]):
            t = matrix[p[row], o[row, k]]
            if not len(t):
                break
            want = t * span + start + o[row, k]
            # slop 0: the list holds the very position; else any position within slop.
            at = np.searchsorted(key, want - slop)
            got = key[np.minimum(at, len(key) - 1)]
            ok = (t < 0) | ((at < len(key)) & (got >= want - slop) & (got <= want + slop))
            row, start = row[ok], start[ok]
        yield p[row], start


def phrase_hits(index: DataFrame, phrases: list[list[bytes]], items: list[list[str]], slop: int = 0,
                all_documents: bool = True) -> DataFrame:
    """Per document of ``index`` with hits (or every document): the places of its words that
    lie in an occurrence of any phrase, and the items that own the occurring phrases.
    ``phrases`` and ``items`` (the item ids of each phrase) are one bounded block."""
    spark = index.sparkSession
    names = sorted({w for p in phrases for w in p})
    terms = pa.array(names, pa.binary())
    matrix, lens = _phrase_table(phrases, terms)
    shared = spark.sparkContext.broadcast((names, matrix, lens, items))

    def run(seg: pa.Table) -> pa.Table:
        names, matrix, lens, items = shared.value
        head = seg.filter(pc.is_null(seg["term"]))
        ids = head["doc_ids"][0].as_py()
        counts = np.array(head["n_words"][0].as_py(), np.int64)
        starts = starts_of(counts + GAP)
        span = int(starts[-1]) + 2 * matrix.shape[1] + 4 * slop + GAP  # of one term in the composite key
        lists = seg.filter(pc.is_valid(seg["term"])).combine_chunks()
        tid = pc.index_in(lists["term"], value_set=pa.array(names, pa.binary())).fill_null(-1).to_numpy()
        mine = np.flatnonzero(tid >= 0)
        mine = mine[np.argsort(tid[mine], kind="stable")]
        gaps = lists["gaps"].take(pa.array(mine)).combine_chunks() if len(mine) else None
        cnt, first = np.zeros(len(names) + 1, np.int64), np.zeros(len(names) + 1, np.int64)
        key = np.zeros(0, np.int64)
        if len(mine):
            gaps = gaps.chunk(0) if isinstance(gaps, pa.ChunkedArray) else gaps
            size = np.diff(gaps.offsets.to_numpy())
            flat = gaps.flatten().to_numpy().astype(np.int64)
            at = starts_of(size)[:-1]
            run_ = np.cumsum(flat)
            pos = run_ - np.repeat(run_[at] - flat[at], size)
            key = np.repeat(tid[mine].astype(np.int64), size) * span + pos
            cnt[tid[mine]], first[tid[mine]] = size, at
        marks = np.zeros(span + 1, np.int32)
        doc_of, owner = [], []
        for p, s in _occurrences(matrix, key, first, cnt, span, slop) if len(key) else ():
            d = np.searchsorted(starts, s, side="right") - 1
            inside = (s >= 0) & (s + lens[p] <= starts[d] + counts[np.minimum(d, len(counts) - 1)] + slop)
            p, s, d = p[inside], s[inside], d[inside]
            np.add.at(marks, s, 1)
            np.add.at(marks, s + lens[p], -1)
            pair = np.unique(d * len(lens) + p)
            doc_of.append(pair // len(lens))
            owner.append(pair % len(lens))
        hit = np.flatnonzero(np.cumsum(marks) > 0)
        hd = np.searchsorted(starts, hit, side="right") - 1
        keep = hit - starts[hd] < counts[np.minimum(hd, len(counts) - 1)]
        hit, hd = hit[keep], hd[keep]
        found: dict[int, set] = {}
        for d, p in zip(np.concatenate(doc_of).tolist() if doc_of else [], np.concatenate(owner).tolist() if owner else []):
            found.setdefault(d, set()).update(items[p])
        show = np.arange(len(counts)) if all_documents else np.unique(hd)
        per = np.bincount(hd, minlength=len(counts))[show]
        return pa.table({
            "segment": pa.array([seg["segment"][0].as_py()] * len(show), pa.string()), "place": pa.array(show, pa.int32()),
            "doc_id": pa.array([ids[i] for i in show], pa.int64()), "n_words": pa.array(counts[show], pa.int64()),
            "hits": list_of((hit - starts[hd]).astype(np.int32), starts_of(per), pa.int32()),
            "items": pa.array([sorted(found.get(i, ())) for i in show.tolist()], pa.list_(pa.string())),
        })

    return index.groupBy("segment").applyInArrow(run, HIT_SCHEMA)


def terms_only(index: DataFrame, names: list[bytes]) -> DataFrame:
    """The index rows that phrases made of ``names`` (one bounded block) can need."""
    wanted = index.sparkSession.createDataFrame(pa.table({"term": pa.array(names, pa.binary())}))
    lists = index.filter(F.col("term").isNotNull()).join(F.broadcast(wanted), "term", "left_semi")
    return index.filter(F.col("term").isNull()).unionByName(lists.select(index.columns))


def windows_of(texts, ids, size: int = WINDOW) -> tuple[list[list[bytes]], list[list[str]]]:
    """Distinct windows of ``size`` words of the items, with the item ids of each; a shorter
    item, if it has words, is one window."""
    found: dict[tuple, set] = {}
    for text, item in zip(texts, ids, strict=True):
        flat, _ = split_words([text], ALNUM)
        w = flat.to_pylist()
        for i in range(max(1, len(w) - size + 1) if w else 0):
            found.setdefault(tuple(w[i:i + size]), set()).update(() if item is None else (str(item),))
    keys = sorted(found)
    return [list(k) for k in keys], [sorted(found[k]) for k in keys]


def terms_of(phrases: list[list[bytes]]) -> pa.Array:
    return pa.array(sorted({w for p in phrases for w in p}), pa.large_binary())


def benchmark_blocks(benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES):
    """The benchmark's windows, in blocks of about ``block_bytes`` of item text: at least
    one block, which may be empty."""
    texts, ids, size, some = [], [], 0, False
    for r in benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).toLocalIterator():
        ids.append(r[0])
        texts.append(r[1])
        size += len(r[1] or "")
        if size >= block_bytes:
            yield windows_of(texts, ids, window)
            texts, ids, size = [], [], 0
            some = True
    if ids or not some:
        yield windows_of(texts, ids, window)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0,
                  block_bytes: int = BLOCK_BYTES, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, hits (places of words inside an occurrence),
    items (sorted ids), contaminated (hits make at least a twentieth of the words)."""
    blocks = benchmark_blocks(benchmark, window, block_bytes)
    first = next(blocks)
    second = next(blocks, None)
    if second is None:  # one block: only its own terms are worth storing
        one = phrase_hits(build_index(docs, terms_of(first[0]), segment_words), *first, slop)
    else:  # the whole index, once; a document's hits of the blocks are united
        index, both = build_index(docs, None, segment_words), None
        for k, (phrases, items) in enumerate(chain((first, second), blocks)):
            names = terms_of(phrases).cast(pa.binary()).to_pylist()
            got = stored(phrase_hits(terms_only(index, names), phrases, items, slop, all_documents=k == 0), "hits")
            both = got if both is None else both.unionByName(got)
        one = both.groupBy("segment", "place", "doc_id", "n_words").agg(
            F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    n_hit = F.size("hits")
    return one.select("doc_id", "n_words", "hits", "items",
                      ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"))


def digest(result: DataFrame) -> DataFrame:
    """The contract's columns of ``decontaminate``'s result."""
    return result.select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
     b AS (SELECT CAST(item_id AS VARCHAR) AS item,
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
     bw AS (SELECT DISTINCT item, list_slice(w, i, i + 12) AS ws
            FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS i FROM b WHERE len(w) > 0)),
     sizes AS (SELECT DISTINCT len(ws) AS n FROM bw),
     dw AS (SELECT r, i, n, list_slice(w, i, i + n - 1) AS ws
            FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
     m AS (SELECT dw.r, dw.i, dw.n, bw.item FROM dw JOIN bw USING (ws)),
     h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM m) GROUP BY r),
     it AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, coalesce(len(w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(w), 0) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN it USING (r)
"""
