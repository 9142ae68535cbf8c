"""Language-model scoring with a sharded Elias-Fano bigram trie (operator 9).

The model is a bigram model with a Dirichlet prior on the add-one unigram distribution::

    P(w | v) = (c(v w) + m * U(w)) / (c(v) + m),     U(w) = (c(w) + 1) / (N + V + 1)

with c counted over all training documents; m is the one of ``PRIORS`` under which the
training tokens are likeliest when each is left out of its own counts.

1. ``count_chunks`` walks the documents where they lie, in chunks of bounded size. A chunk
   keeps its token sequence (one row) and sends each shard its distinct words and bigrams
   with their training counts (one row per shard): a hot word or pair is one entry per chunk.
2. ``answer_shards``: a shard adds up what all chunks sent, builds its trie and looks up every
   chunk's entries in it. Level 1 holds the sorted contexts and, as an Elias-Fano sequence,
   the pointers to their successors; level 2 the sorted successors, and for each an 8-bit
   code of its count's logarithm (a count, not a smoothed probability). A context's successors
   are spread over ``SPLITS`` shards, and over more the heavier it is (``context_splits``), so a
   context that a third of all words follows does not fall to a few tasks. Levels live within the call; a pointer is selected on the sequence's bits.
3. ``score_chunks`` joins each chunk with its answers and scores its documents.

Nothing is collected but the totals N and V and a likelihood per prior. Words are known by
64-bit hashes, successors by 32 bits within their context's shard; word counts are exact,
beyond 32 bits, too (a chunk's own fit in them).
Shards and chunks grow in number with the input, not in size.

Defined cases: null and word-less texts hold the end token only; a null doc_id trains;
repeated rows count and are scored each; extra columns are ignored; without training
documents N and V are 0; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from waferline.llm.common import SPACED, split_words, starts_of, stored

CHUNK_TOKENS = 2_000_000
#: Text bytes per shard, and the least number of shards.
SHARD_BYTES, LEAST_SHARDS = 16 << 20, 48
#: Shards of a context's successors, at least, and the part of a shard that one of them may fill before there are more.
SPLITS, HOT = 4, 0.25
#: Bytes of text in which the contexts are weighed for that.
WEIGH_BYTES = 32 << 20
PRIORS = (1.0, 10.0, 100.0, 1000.0)
FOLDS, HELD = 7, 2

_END, _BEGIN = np.uint64(xxhash.xxh3_64_intdigest(b"")), np.uint64(xxhash.xxh3_64_intdigest(b" "))
PARTS = ("chunk string, shard int, doc_ids array<long>, lengths array<int>, tokens binary, marks binary, "
         "words binary, word_counts binary, contexts binary, fanout binary, successors binary, counts binary, "
         "n_train long")
ANSWERS = "chunk string, shard int, word_counts binary, codes binary, n_vocabulary long"
SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, "
          "scores array<double>, left_out array<double>")


def held_out(doc_id) -> bool:
    """In the test fold: crc32 of the id as text (null: none) modulo 7 is 2."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD


# ------------------------------------------------------------------ compact levels

#: Bytes of a block of a bit vector, for each of which the ones before it are kept.
_SELECT = 16

class EliasFano:
    """A monotone sequence: low bits packed, high bits as unary gaps in a bit vector."""

    def __init__(self, values: np.ndarray):
        n, top = len(values), int(values[-1]) + 1 if len(values) else 1
        self.n, self.low_bits = n, max(0, int(np.log2(top / max(n, 1)))) if top > n else 0
        low = (values & ((1 << self.low_bits) - 1)).astype(np.uint64)
        self.low = np.packbits(((low[:, None] >> np.arange(self.low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8))
        high = np.zeros(n + (top >> self.low_bits) + 1, np.uint8)
        high[(values >> self.low_bits) + np.arange(n)] = 1
        self.high = np.packbits(high)

        block = np.add.reduceat(np.unpackbits(self.high).reshape(-1, 8).sum(axis=1, dtype=np.int64), np.arange(0, len(self.high), _SELECT))
        self.ones = np.r_[0, np.cumsum(block)]  # one bits before each block of the bit vector

    def get(self, at: np.ndarray) -> np.ndarray:
        """The members with the numbers ``at``: each one bit is selected in its block, whose number of
        earlier ones is kept; only the blocks and low bits that are asked for are read."""
        out = np.empty(len(at), np.int64)
        padded = np.r_[self.high, np.zeros(-len(self.high) % _SELECT, np.uint8)].reshape(-1, _SELECT)
        for k in range(0, len(at), 1 << 16):
            i = np.asarray(at[k:k + (1 << 16)], np.int64)
            block = np.searchsorted(self.ones, i, side="right") - 1
            upto = np.cumsum(np.unpackbits(padded[block], axis=1), axis=1, dtype=np.int16)
            place = (upto <= (i - self.ones[block])[:, None]).sum(axis=1)  # bits before the wanted one
            bit = i[:, None] * self.low_bits + np.arange(self.low_bits)
            low = (self.low[bit >> 3] >> (7 - (bit & 7))) & 1 if self.low_bits else np.zeros((len(i), 0), np.int64)
            out[k:k + len(i)] = ((block * (8 * _SELECT) + place - i) << self.low_bits) + (low.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)
        return out


def to_codes(counts: np.ndarray) -> np.ndarray:
    """8-bit codes on a logarithmic scale: exact to 128, then four steps per doubling."""
    codes, wide = np.minimum(counts, 128).astype(np.uint8), np.flatnonzero(counts > 128)
    codes[wide] = np.minimum(128 + np.round(4 * np.log2(counts[wide] / 128)), 255)
    return codes


def from_codes(codes: np.ndarray) -> np.ndarray:
    c = codes.astype(np.float64)
    return np.where(c <= 128, c, 128 * 2 ** ((c - 128) / 4))


def _starts_of_runs(a: np.ndarray) -> np.ndarray:
    """Where each run of equal values of the sorted ``a`` begins."""
    new = np.ones(len(a), bool)
    np.not_equal(a[1:], a[:-1], out=new[1:])
    return np.flatnonzero(new)


class Trie:
    """Two levels of a shard: contexts, and each context's successors with their codes."""

    def __init__(self, contexts: np.ndarray, successors: np.ndarray, counts: np.ndarray):
        """Pairs may repeat; their counts add up."""
        self.contexts = np.unique(contexts)
        pairs = np.searchsorted(self.contexts, contexts).view(np.uint64)
        pairs <<= np.uint64(32)
        pairs |= successors
        order = np.argsort(pairs)
        pairs = pairs[order]
        new = _starts_of_runs(pairs)
        self.codes = to_codes(np.add.reduceat(counts[order], new, dtype=np.int64) if len(new) else np.zeros(0, np.int64))
        del order
        pairs = pairs[new]
        self.successors = (pairs & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        fanout = np.bincount((pairs >> np.uint64(32)).astype(np.int64), minlength=len(self.contexts))
        self.pointers = EliasFano(starts_of(fanout))

    def look_up(self, contexts: np.ndarray, successors: np.ndarray) -> np.ndarray:
        """The codes of the pairs, 0 where unseen: find the context, then search for the
        successor within its range of level 2."""
        out = np.zeros(len(contexts), np.uint8)
        if not len(self.contexts):
            return out
        at = np.minimum(np.searchsorted(self.contexts, contexts), len(self.contexts) - 1)
        seen = np.flatnonzero(self.contexts[at] == contexts)
        asked, back = np.unique(at[seen], return_inverse=True)
        lo, hi, want = self.pointers.get(asked)[back], self.pointers.get(asked + 1)[back], successors[seen]
        end = hi.copy()
        while True:  # all binary searches in step
            open_ = lo < hi
            if not open_.any():
                break
            mid = (lo + hi) // 2
            less = open_ & (self.successors[np.minimum(mid, len(self.successors) - 1)] < want)
            lo = np.where(less, mid + 1, lo)
            hi = np.where(open_ & ~less, mid, hi)
        found = (lo < end) & (self.successors[np.minimum(lo, len(self.successors) - 1)] == want)
        out[seen[found]] = self.codes[lo[found]]
        return out


# ------------------------------------------------------------------ chunks

def _press(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def _open(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


def _press_counts(a: np.ndarray) -> bytes:
    """Counts in 32 bits where they fit, else in 64."""
    return _press(a.astype(np.uint64 if len(a) and int(a.max()) >> 32 else np.uint32))


def _open_counts(b: bytes, n: int) -> np.ndarray:
    """The ``n`` counts that ``_press_counts`` wrote."""
    raw = zstandard.ZstdDecompressor().decompress(b)
    return np.frombuffer(raw, np.uint64 if n and len(raw) == 8 * n else np.uint32)


def _raw40(h: np.ndarray) -> bytes:
    return np.ascontiguousarray(h.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _open40(b: bytes) -> np.ndarray:
    wide = np.zeros((len(b) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(b, np.uint8).reshape(-1, 5)
    return wide.view("<u8").ravel()


def _shard(mark: np.ndarray, split, shards: int) -> np.ndarray:
    """Shard of a word (split 0) or of a context's successors, by 16-bit marks."""
    h = mark.astype(np.uint64)
    h <<= np.uint64(16)
    h += np.asarray(split, np.uint64)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h >>= np.uint64(33)
    h %= np.uint64(shards)
    return h.astype(np.int32)


def _by_shard(shard: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the members in order of their shards, and where each shard's begin."""
    return np.argsort(shard, kind="stable").astype(np.int32), starts_of(np.bincount(shard, minlength=shards))


class Chunk:
    """Distinct bigrams of a token sequence (codes of words, then end and begin marks). Arrays as
    long as the sequence are few and 32-bit, and let go as soon as they have been used."""

    def __init__(self, tokens: np.ndarray, lengths: np.ndarray, marks: np.ndarray, splits: np.ndarray, shards: int):
        size = len(marks)
        keys = np.empty(len(tokens), np.int64)
        keys[1:] = tokens[:-1]
        keys[starts_of(lengths)[:-1]] = size - 1
        keys *= size
        keys += tokens
        order = np.argsort(keys)
        keys = keys[order]
        new = _starts_of_runs(keys)
        keys, n = keys[new], len(keys)
        self.pair_of = np.empty(n, np.int32)
        self.pair_of[order] = np.repeat(np.arange(len(new), dtype=np.int32), np.diff(new, append=n))
        del order, new
        self.left, self.right = (keys // size).astype(np.int32), (keys % size).astype(np.int32)
        del keys
        context = marks[self.left]
        self.pair_order, self.pair_cut = _by_shard(_shard(context, marks[self.right] % splits[context], shards), shards)
        self.word_order, self.word_cut = _by_shard(_shard(marks, 0, shards), shards)

    def pairs(self, shard: int) -> np.ndarray:
        return self.pair_order[self.pair_cut[shard]:self.pair_cut[shard + 1]]

    def words(self, shard: int) -> np.ndarray:
        return self.word_order[self.word_cut[shard]:self.word_cut[shard + 1]]


_NAMES = [f.split()[0] for f in PARTS.split(", ")]
_TYPES = [pa.string(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), *[pa.binary()] * 8, pa.int64()]


def _chunk_rows(name: str, ids: list, counts: np.ndarray, words: list[pa.Array], splits: np.ndarray, shards: int) -> Iterator[pa.RecordBatch]:
    """The rows of a chunk. ``words`` is emptied: the words are not kept beside their codes."""
    coded = pa.concat_arrays(words).dictionary_encode()
    words.clear()
    hashes = np.array([*map(xxhash.xxh3_64_intdigest, coded.dictionary.to_pylist()), _END, _BEGIN], np.uint64)
    marks = (hashes >> np.uint64(48)).astype(np.uint16)
    lengths = counts + 1
    ends = np.cumsum(lengths) - 1
    tokens = np.empty(int(lengths.sum()), np.int32)
    inner = np.ones(len(tokens), bool)
    inner[ends] = False
    tokens[inner] = coded.indices.to_numpy()
    tokens[ends] = len(hashes) - 2
    del coded, inner
    trains = np.array([not held_out(i) for i in ids])
    token_trains = np.repeat(trains, lengths)
    c = Chunk(tokens, lengths, marks, splits, shards)
    pair_counts = np.bincount(c.pair_of, weights=token_trains, minlength=len(c.left)).astype(np.uint32)
    word_counts = np.bincount(tokens, weights=token_trains, minlength=len(hashes)).astype(np.uint32)
    word_counts[-1], n_train = trains.sum(), int(token_trains.sum())
    del token_trains
    c.pair_of = None  # the rows need the distinct pairs only

    def row(*values):
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _TYPES, strict=True)], _NAMES)

    yield row(name, -1, ids, lengths.tolist(), _press(tokens.astype(np.uint32)), marks.tobytes(),
              *[None] * 6, n_train)
    del tokens
    for s in range(shards):
        w, p = c.words(s), c.pairs(s)
        if not len(w) and not len(p):
            continue
        left = c.left[p]
        new = np.flatnonzero(np.diff(left, prepend=-1))
        yield row(name, s, None, None, None, None, hashes[w].tobytes(), _press(word_counts[w]),
                  _raw40(hashes[left[new]]), _press(np.diff(np.r_[new, len(p)]).astype(np.uint32)),
                  (hashes[c.right[p]] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(), _press(pair_counts[p]), None)


def context_splits(docs: DataFrame, shards: int, share: float = 1.0) -> np.ndarray:
    """Over how many shards the successors of the words of each 16-bit mark are spread: ``SPLITS``,
    or more if they are so many that a part would exceed ``HOT`` of a shard. The words are weighed
    in a random ``share`` of the documents. It says where a pair is counted, not what is counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.zeros(1 << 16, np.int64)
        for b in batches:
            weight[int(_BEGIN) >> 48] += b.num_rows  # each text's first word follows the begin mark
            for at in range(0, b.num_rows, 256):
                coded = split_words(b.column(0).slice(at, 256).to_pylist(), SPACED)[0].value_counts()
                marks = np.array([*map(xxhash.xxh3_64_intdigest, coded.field(0).to_pylist())], np.uint64) >> np.uint64(48)
                np.add.at(weight, marks.astype(np.int64), coded.field(1).to_numpy())
        seen = np.flatnonzero(weight)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(weight[seen])], ["mark", "weight"])

    some = docs.select(F.col("text").cast("string"))
    if share < 1:
        some = some.sample(share, seed=1)
    got = some.mapInArrow(run, "mark int, weight long").groupBy("mark").agg(F.sum("weight").alias("weight")).toArrow()  # 65,536 rows at most
    marks, weight = got["mark"].to_numpy(), got["weight"].to_numpy()
    splits = np.full(1 << 16, SPLITS, np.uint16)
    splits[marks] = np.clip(np.ceil(weight / max(weight.sum(), 1) * shards / HOT), SPLITS, min(max(shards, SPLITS), (1 << 16) - 1))
    return splits


def count_chunks(docs: DataFrame, shards: int, splits: np.ndarray, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """Store the chunks of ``docs`` (doc_id, text) and what they send to the shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        ids, counts, words, total = [], [], [], 0
        for b in batches:
            for at in range(0, b.num_rows, 256):
                piece = b.slice(at, 256)
                w, c = split_words(piece.column(1).to_pylist(), SPACED)
                ids += piece.column(0).to_pylist()
                counts.append(c)
                words.append(w)
                total += len(w) + len(c)
                if total >= chunk_tokens:
                    yield from _chunk_rows(f"{part}-{k}", ids, np.concatenate(counts), words, splits, shards)
                    ids, counts, words, total, k = [], [], [], 0, k + 1
        if ids:
            yield from _chunk_rows(f"{part}-{k}", ids, np.concatenate(counts), words, splits, shards)

    return stored(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PARTS), "lm-chunks")


def answer_shards(chunks: DataFrame) -> DataFrame:
    """Store, per chunk and shard, the total counts of its words and the codes of its pairs."""

    def run(rows: pa.Table) -> pa.Table:
        col = lambda n: (x.as_buffer() for x in rows[n])  # noqa: E731 - a view per row, no copy of the column
        words = [np.frombuffer(b, np.uint64) for b in col("words")]
        known, back = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(back, weights=np.concatenate([_open(b, np.uint32) for b in col("word_counts")]),
                            minlength=len(known)).astype(np.uint64)
        vocabulary = int((total[known != _BEGIN] > 0).sum())
        pairs = lambda: ((np.repeat(_open40(c), _open(f, np.uint32)), np.frombuffer(s, np.uint32))  # noqa: E731 - of one chunk at a time
                         for c, f, s in zip(col("contexts"), col("fanout"), col("successors"), strict=True))
        counts = [_open(b, np.uint32) for b in col("counts")]
        trained = [(c[n > 0], s[n > 0], n[n > 0]) for (c, s), n in zip(pairs(), counts, strict=True)]
        del counts
        levels = [np.concatenate(x) for x in zip(*trained)]
        del trained
        trie = Trie(*levels)
        del levels
        cut = starts_of([len(w) for w in words])
        return pa.table({
            "chunk": rows["chunk"].cast(pa.string()), "shard": rows["shard"].cast(pa.int32()),
            "word_counts": pa.array([_press_counts(total[back[cut[i]:cut[i + 1]]]) for i in range(len(words))], pa.binary()),
            "codes": pa.array([_press(trie.look_up(c, s)) for c, s in pairs()], pa.binary()),
            "n_vocabulary": pa.array([vocabulary] + [0] * (len(words) - 1), pa.int64())})

    sent = chunks.filter("shard >= 0").select("chunk", "shard", "words", "word_counts", "contexts", "fanout", "successors", "counts")
    return stored(sent.groupBy("shard").applyInArrow(run, ANSWERS), "lm-answers")


def score_chunks(chunks: DataFrame, answers: DataFrame, n: int, v: int, shards: int, splits: np.ndarray) -> DataFrame:
    """Score each chunk's documents, under every prior."""

    def run(own: pa.Table, got: pa.Table) -> pa.Table:
        ids, lengths = own["doc_ids"][0].as_py(), np.array(own["lengths"][0].as_py(), np.int64)
        marks = np.frombuffer(own["marks"][0].as_py(), np.uint16)
        tokens = _open(own["tokens"][0].as_buffer(), np.int32)
        c = Chunk(tokens, lengths, marks, splits, shards)
        count, pair = np.zeros(len(marks)), np.zeros(len(c.left))
        for s, w, p in zip(got["shard"].to_pylist(), got["word_counts"].to_pylist(), got["codes"].to_pylist(), strict=True):
            own_words = c.words(s)
            count[own_words] = _open_counts(w, len(own_words))
            pair[c.pairs(s)] = from_codes(_open(p, np.uint8))
        first = starts_of(lengths)[:-1]
        before, now = count[c.left], count[c.right]
        pair = np.minimum(pair, np.minimum(before, now))
        held = np.array([held_out(i) for i in ids])
        scores, left_out = [], []
        for m in PRIORS:
            p = (pair + m * (now + 1) / (n + v + 1)) / (before + m)
            scores.append(np.add.reduceat(np.log10(p, out=p)[c.pair_of], first))
            p = (np.maximum(pair - 1, 0) + m * np.maximum(now, 1) / (n + v + 1)) / (np.maximum(before - 1, 0) + m)
            left_out.append(np.where(held, 0.0, np.add.reduceat(np.log10(p, out=p)[c.pair_of], first)))
        return pa.table({
            "doc_id": pa.array(ids, pa.int64()), "held_out": pa.array(held), "n_tokens": pa.array(lengths),
            "n_known": pa.array(np.add.reduceat((count > 0).astype(np.int64)[tokens], first)),
            "log_counts": pa.array(np.add.reduceat(np.log10(count + 1)[tokens], first)),
            "scores": pa.array(list(np.array(scores).T), pa.list_(pa.float64())),
            "left_out": pa.array(list(np.array(left_out).T), pa.list_(pa.float64()))})

    own = chunks.filter("shard = -1").select("chunk", "doc_ids", "lengths", "tokens", "marks")
    return stored(own.groupBy("chunk").cogroup(answers.select("chunk", "shard", "word_counts", "codes").groupBy("chunk"))
                  .applyInArrow(run, SCORES), "lm-scores")


def score_documents(docs: DataFrame, shards: int | None = None, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, prior per
    document of ``docs`` (doc_id, text)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if shards is None:
        shards = max(LEAST_SHARDS, -(-size // SHARD_BYTES))
    splits = context_splits(docs, shards, min(1.0, WEIGH_BYTES / max(size, 1)))
    chunks = count_chunks(docs, shards, splits, chunk_tokens)
    answers = answer_shards(chunks)
    n = chunks.agg(F.sum("n_train")).first()[0] or 0
    v = answers.agg(F.sum("n_vocabulary")).first()[0] or 0
    scores = score_chunks(chunks, answers, n, v, shards, splits)
    likely = scores.agg(*[F.sum(F.get("left_out", F.lit(k))).alias(str(k)) for k in range(len(PRIORS))]).first()
    best = max(range(len(PRIORS)), key=lambda k: (likely[k] if likely[k] is not None else 0.0, -k))
    return scores.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
        (F.col("log_counts") - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))).alias("base_score"),
        F.get("scores", F.lit(best)).alias("score"), F.lit(PRIORS[best]).alias("prior"))
