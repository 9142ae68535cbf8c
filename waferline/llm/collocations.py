"""Phrase collocations: frequent phrases of 2 to 5 words, scored by their weakest cut (operator 12).

1. ``survivors`` (first pass): each task counts the hashes of its n-grams piece by piece and
   sends them to the hash partition they belong to, sorted and packed. A partition merges what
   it gets into one Misra-Gries summary: counters are added, and when there are more than its
   capacity, the next largest count is taken from all. Its capacity is twice the partition's
   measured mass by ``least``, so what is taken from a counter adds up to less than half of
   ``least``, and every phrase of ``least`` occurrences survives. Memory depends on the mass of
   a partition alone (their number grows with the texts), never on distinct n-grams. Hashes
   that coincide only add counts: nothing frequent is lost.
2. The surviving hashes of each partition become its slice of a filter of at most
   ``FILTER_BYTES`` in all, which is broadcast. A fuller filter lets more through, no less.
3. ``count_phrases`` (second pass): n-grams that pass, and whose two shorter parts pass, are
   counted exactly by their words, added up per piece before the shuffle. Words are counted
   all.
4. ``score``: counts of both sides of each cut are joined (very common sides by broadcast), and
   scores are exact decimals (to 10^17 words). Phrases inside a longer one as frequent are dropped.

Defined cases: null texts are empty; null lang is ``und``, together with that lang; repeated
rows count as often as they come; no phrase crosses a piece or a text; ties end with the
phrase's bytes; doc_id is not read; extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waferline.llm.common import join_unique, stored

LEAST, LONGEST, TOP = 100, 5, 2000
#: n-grams of a hash partition, words of a piece, bytes of the filter.
PART_MASS, PIECE, FILTER_BYTES = 1 << 22, 1 << 19, 64 << 20
#: Filter bits per survivor, and bits that one sets.
SLOTS, SETS = 16, 3

_RNG = np.random.default_rng(12)
_ODD = _RNG.integers(0, 1 << 63, SETS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = _RNG.integers(0, 1 << 63, 3, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BORDERS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(i + 32 if 65 <= i <= 90 else 10 if i in _BORDERS else 32 if i == 9 else i for i in range(256))
BORDER = b"\n"


class Piece:
    """The words of some texts: ``code`` per place (-1 at borders), ``words`` by code, the number
    of the lang per place, ``langs``, and the hash of each n-gram where one is."""

    def __init__(self, by_lang: dict[str, list[bytes]]):
        self.langs = sorted(by_lang)
        tokens = [(b" \n ".join(by_lang[x]).translate(_TABLE).replace(b"\n", b" \n ") + b" \n").split(b" ") for x in self.langs]
        tokens = [[w for w in t if w] for t in tokens]
        coded = pa.array([w for t in tokens for w in t], pa.large_binary()).dictionary_encode()
        self.words, self.code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        names = self.words.to_pylist()
        self.code[self.code == names.index(BORDER)] = -1
        self.lang = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
        self._h = np.array([xxhash.xxh3_64_intdigest(w) for w in names], np.uint64)[self.code]
        self._seed = np.array([xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass"), seed=1) for x in self.langs], np.uint64)

    def hashes(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, places of its n-grams, their hashes) for n of 2 to ``LONGEST``."""
        h, ok = self._h, self.code >= 0
        whole, s = ok, (self._seed[self.lang] ^ h) * _MIX[0]
        for n in range(2, LONGEST + 1):
            m = max(0, len(h) - n + 1)
            whole = whole[:m] & ok[n - 1:n - 1 + m]
            s = s[:m]
            s = (s ^ (s >> np.uint64(29))) * _MIX[1] + h[n - 1:n - 1 + m]
            at = np.flatnonzero(whole)
            x = s[at]
            x = (x ^ (x >> np.uint64(32))) * _MIX[2]
            yield n, at, x ^ (x >> np.uint64(29))


def pieces(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Piece]:
    """Pieces of about ``size`` words of a partition (text, lang)."""
    held: dict[str, list[bytes]] = {}
    bytes_ = 0
    for b in batches:
        for at in range(0, b.num_rows, 256):
            part = b.slice(at, 256)
            for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                t = (text or "").encode("utf-8", "surrogatepass")
                held.setdefault(lang, []).append(t)
                bytes_ += len(t) + 1
            if bytes_ >= 6 * size:
                yield Piece(held)
                held, bytes_ = {}, 0
    if held:
        yield Piece(held)


def part_of(h: np.ndarray, parts: int) -> np.ndarray:
    return (h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)


def pack(values: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted 32-bit values as gaps, byte planes apart, and their counts."""
    squeeze = zstandard.ZstdCompressor(level=1)
    gaps = np.diff(values, prepend=np.uint32(0)).astype("<u4")
    return (squeeze.compress(gaps.view(np.uint8).reshape(-1, 4).T.tobytes()), squeeze.compress(counts.astype("<u4").tobytes()))


def unpack(gaps: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    loose = zstandard.ZstdDecompressor()
    planes = np.frombuffer(loose.decompress(gaps), np.uint8).reshape(4, -1)
    values = np.cumsum(np.ascontiguousarray(planes.T).view("<u4")[:, 0], dtype=np.uint32)
    return values, np.frombuffer(loose.decompress(counts), "<u4").astype(np.int64)


class Summary:
    """A Misra-Gries summary of ``capacity`` counters; two are merged by adding the counters of
    one to the other. A value's true count is at most ``lost`` more than its counter."""

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.values, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self._held: list = []
        self._size = 0

    def add(self, values: np.ndarray, counts: np.ndarray) -> None:
        self._held.append((values, counts))
        self._size += len(values)
        if self._size >= 4 * self.capacity:
            self.settle()

    def settle(self) -> None:
        v = np.concatenate([self.values, *[x for x, _ in self._held]])
        c = np.concatenate([self.counts, *[x for _, x in self._held]])
        self._held, self._size = [], 0
        order = np.argsort(v, kind="stable")
        v, c = v[order], c[order]
        first = np.flatnonzero(np.r_[True, v[1:] != v[:-1]]) if len(v) else np.zeros(0, int)
        v, c = v[first], np.add.reduceat(c, first) if len(first) else c
        if len(v) > self.capacity:
            least = int(np.partition(c, len(c) - self.capacity - 1)[len(c) - self.capacity - 1])
            self.lost += least
            v, c = v[c > least], c[c > least] - least
        self.values, self.counts = v, c

    def frequent(self, least: int) -> np.ndarray:
        """All values that can have ``least`` occurrences."""
        self.settle()
        return self.values[self.counts + self.lost >= least]


def filter_bits(survivors: np.ndarray, most: int) -> np.ndarray:
    bits = np.zeros(max(8, min(SLOTS * len(survivors), most)), bool)
    bits[filter_places(survivors, np.uint64(len(bits)))] = True
    return bits


def filter_places(values: np.ndarray, size) -> np.ndarray:
    return ((values.astype(np.uint64) * _ODD[:, None] >> np.uint64(32)) * size >> np.uint64(32)).astype(np.int64)


def survivors(docs: DataFrame, least: int, parts: int, piece: int = PIECE, slack: int = 2) -> list:
    """Rows (part, size, bits): the filter's slice of each hash partition; at most ``FILTER_BYTES``."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in pieces(batches, piece):
            h = np.concatenate([x for _, _, x in p.hashes()])
            if not len(h):
                continue
            key = np.sort(part_of(h, parts) << np.uint64(32) | h & np.uint64(0xFFFFFFFF))
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            counts = np.diff(first, append=len(key))
            key = key[first]
            owner = key >> np.uint64(32)
            cut = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1], True])
            rows = [(int(owner[a]), int(counts[a:b].sum()), *pack(key[a:b].astype(np.uint32), counts[a:b])) for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                                             ["part", "mass", "gaps", "counts"])

    def merge(rows: pa.Table) -> pa.Table:
        s = Summary(slack * pc.sum(rows["mass"]).as_py() // least + 1)
        for gaps, counts in zip(rows["gaps"], rows["counts"], strict=True):
            s.add(*unpack(gaps.as_py(), counts.as_py()))
        bits = filter_bits(s.frequent(least), FILTER_BYTES * 8 // parts)
        return pa.table({"part": rows["part"].slice(0, 1), "size": pa.array([len(bits)]), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    return (docs.mapInArrow(send, "part int, mass long, gaps binary, counts binary")
            .groupBy("part").applyInArrow(merge, "part int, size long, bits binary").collect())


def count_phrases(docs: DataFrame, slices: list, parts: int, piece: int = PIECE) -> DataFrame:
    """Store (lang, phrase, words, f): counts by piece of all words and of the n-grams that pass."""
    size, start = np.zeros(parts, np.uint64), np.zeros(parts, np.int64)
    held = 0  # bits of the slices so far, each of whole bytes
    for r in slices:
        size[r["part"]], start[r["part"]] = r["size"], held
        held += 8 * len(r["bits"])
    bits = np.frombuffer(b"".join(r["bits"] for r in slices) or b"\0", np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast((size, start, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, start, bits = shared.value

        def passes(h: np.ndarray) -> np.ndarray:
            part = part_of(h, parts).astype(np.int64)
            ok = size[part] > 0
            for at in filter_places(h & np.uint64(0xFFFFFFFF), size[part]):
                at = np.minimum(at + start[part], 8 * len(bits) - 1)
                ok &= (bits[at >> 3] >> (7 - (at & 7)) & 1).astype(bool)
            return ok

        for p in pieces(batches, piece):
            langs = pa.array(p.langs, pa.string())
            at = np.flatnonzero(p.code >= 0)
            v = len(p.words)
            ids = np.full(len(p.code), -1, np.int64)
            ids[at] = p.lang[at] * v + p.code[at]
            found, live = [(1, at)], None
            for n, at, h in p.hashes():
                ok = passes(h)
                if live is not None:  # both shorter parts have passed
                    ok &= live[at] & live[at + 1]
                found.append((n, at[ok]))
                live = np.zeros(len(p.code), bool)
                live[at[ok]] = True
            for n, at in found:
                if not len(at):
                    break
                key = ids[at] if n == 1 else ids[at] * v + p.code[at + n - 1]
                _, first, same, f = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
                ids[at] = same  # from now on a place's id is that of its n-gram
                i = at[first]
                text = [p.words.take(pa.array(p.code[i + k])).cast(pa.large_string()) for k in range(n)]
                text = pc.binary_join_element_wise(*text, pa.scalar(" ", pa.large_string())) if n > 1 else text[0]
                yield pa.RecordBatch.from_arrays([langs.take(pa.array(p.lang[i])), text.cast(pa.string()), pa.array(np.full(len(i), n, np.int32)), pa.array(f)],
                                                 ["lang", "phrase", "words", "f"])

    return stored(docs.mapInArrow(run, "lang string, phrase string, words int, f long"), "phrase-counts")


def frequent_phrases(docs: DataFrame, least: int = LEAST, part_mass: int = PART_MASS, piece: int = PIECE, slack: int = 2) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, f) of all words and phrases of ``least`` occurrences, (lang, n))."""
    texts = docs.select(F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    bytes_ = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-bytes_ * 4 // (5 * part_mass)))  # about five bytes a word, four n-grams a word
    counts = count_phrases(texts, survivors(texts, least, parts, piece, slack), parts, piece)
    totals = stored(counts.filter("words = 1").groupBy("lang").agg(F.sum("f").alias("n")), "word-totals")
    phrases = counts.groupBy("lang", "phrase").agg(F.first("words").alias("words"), F.sum("f").alias("f")).filter(F.col("f") >= least)
    return stored(phrases, "phrases"), totals


def score(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, words, a, l, r, n, score: each candidate with its lowest-scoring cut."""
    cuts = (phrases.filter("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
            .withColumn("left", F.expr("substring_index(phrase, ' ', k)")).withColumn("right", F.expr("substring_index(phrase, ' ', k - words)")))
    side = lambda c, f: phrases.select("lang", F.col("phrase").alias(c), F.col("f").alias(f))
    left = stored(join_unique(stored(cuts, "cuts"), side("left", "l"), ["lang", "left"]), "cuts-left")
    both = stored(join_unique(left, side("right", "r"), ["lang", "right"]), "cuts-both")
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    known = (join_unique(both, totals, ["lang"]).withColumn("num", exact("a") * exact("n") * F.lit(1000).cast("decimal(4,0)"))
             .withColumn("den", exact("l") * exact("r")).withColumn("score", F.expr("num div den")))
    best = known.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "words", "a", "l", "r", "n")).alias("best"))
    return best.select("lang", "phrase", *[F.col(f"best.{c}").alias(c) for c in ("words", "a", "l", "r", "n", "score")])


def uncovered(scored: DataFrame, phrases: DataFrame) -> DataFrame:
    """``scored`` without phrases inside a longer one as frequent. Then one a word longer is as
    frequent, too, so the parts of that length are enough."""
    longer = phrases.filter("words > 2")
    parts = F.explode(F.array(F.expr("substring_index(phrase, ' ', words - 1)"), F.expr("substring_index(phrase, ' ', 1 - words)")))
    inside = longer.select("lang", parts.alias("phrase"), F.col("f").alias("a")).distinct()
    return scored.join(inside, ["lang", "phrase", "a"], "left_anti")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, part_mass: int = PART_MASS, piece: int = PIECE, slack: int = 2) -> DataFrame:
    """lang, rank, phrase, words, a, l, r, n, score: the first ``top`` phrases of each lang."""
    phrases, totals = frequent_phrases(docs, least, part_mass, piece, slack)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = uncovered(score(phrases, totals), phrases).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "words", "a", "l", "r", "n", "score")


def digest(result: DataFrame) -> DataFrame:
    """The contract's columns of ``collocations``'s result."""
    return result.drop("words")


ORACLE = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
     w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM t),
     g AS (SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS p
           FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k)),
     f AS (SELECT lang, k, p, count(*) AS f FROM g GROUP BY lang, k, p HAVING count(*) >= 100),
     n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
     c AS (SELECT x.lang, x.k, x.p, x.f AS a, l.f AS l, r.f AS r, n.n, l.k AS cut,
                  (CAST(1000 AS HUGEINT) * x.f * n.n) // (CAST(l.f AS HUGEINT) * r.f) AS score
           FROM f x JOIN f l ON l.lang = x.lang AND l.k < x.k AND l.p = array_to_string(list_slice(string_split(x.p, ' '), 1, l.k), ' ')
                    JOIN f r ON r.lang = x.lang AND r.k = x.k - l.k AND r.p = array_to_string(list_slice(string_split(x.p, ' '), l.k + 1, x.k), ' ')
                    JOIN n ON n.lang = x.lang
           WHERE x.k > 1),
     b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
     o AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM f y WHERE y.lang = b.lang AND y.k > b.k AND 100 * y.f >= 100 * b.a
                                             AND contains(' ' || y.p || ' ', ' ' || b.p || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank, p AS phrase, a, l, r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score
FROM o QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) <= 2000
"""
