from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.fixtures import awkward_rows, documents, key, prose, rows_of, words
from waferline.llm import language_model as lm
from waferline.llm import tokens as tk

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def brute_tokens(rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    out, start = [], 0
    for i, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out, start


def check_tokens(spark, rows, **options):
    segments = tk.write_tokens(documents(spark, rows), PATH, **options)
    got = rows_of(tk.digest(segments), "doc_id", "start", "n_tokens", "ids_crc32")
    want, total = brute_tokens(rows)
    assert sorted(((r[0], *r[2:]) for r in got), key=key) == sorted(want, key=key)
    at = 0
    for r in sorted(got, key=lambda r: r[1]):  # gapless, in ascending doc_id order
        assert r[1] == at
        at += r[2]
    ids = [r[0] for r in sorted(got, key=lambda r: r[1])]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0)) and at == total
    return segments


def test_tokens_of_awkward_rows(spark):
    check_tokens(spark, awkward_rows(), n_ranges=3)
    check_tokens(spark, [])
    check_tokens(spark, [(5, None, None, None)])
    check_tokens(spark, [(i % 7, prose(i, 40 * i), "en", "a") for i in range(60)], n_ranges=5)


def test_pieces_encode_as_whole_texts():
    from tokenizers import Tokenizer
    import pyarrow as pa

    texts = ["", "a", "  a  b ", "a\n \nb", "a   b", " a", "a ", "\n", "x<|endoftext|> y <|endoftext|>", "é　 ü  z", "a\x1c b\x1cc",
             ",\x1cb ,\x1c", "don't 's  're", "日本語 テスト 123 4", "a\tb\t c", " ", " " * 5, "a\n\n\n b", "a\x85 b", "a  b", " "]
    whole = Tokenizer.from_file(PATH)
    ids, n = tk.Encoder(PATH).encode(pa.array(texts))
    cut = np.r_[0, np.cumsum(n)]
    assert [ids[cut[i]:cut[i + 1]].tolist() for i in range(len(texts))] == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


def test_random_texts_encode_as_whole_texts():
    import random

    import pyarrow as pa
    from tokenizers import Tokenizer

    r = random.Random(1)
    signs = ["a", "the", "The", " ", " ", "  ", "\n", "\n", ".", ",", ".,", "'s", "'", "é", "Ünï", "日本", "1", "23", "-", "\t", "\x1c", "\xa0", "\u3000",
             "\x00", "<|endoftext|>", "&&&", "(", ")", "\r\n", "\U0001F600", "ﬁ", "ª", "×", "ÿ"]
    texts = ["".join(r.choice(signs) for _ in range(r.randrange(1, 14))) for _ in range(6000)]
    whole, own = Tokenizer.from_file(PATH), tk.Encoder(PATH)
    want = [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    for at in range(0, len(texts), 500):
        ids, n = own.encode(pa.array(texts[at:at + 500]))
        cut = np.r_[0, np.cumsum(n)]
        for i, t in enumerate(texts[at:at + 500]):
            assert ids[cut[i]:cut[i + 1]].tolist() == want[at + i], repr(t)


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 3000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    for high in (1, 2, 300, 50257, 1 << 31):
        ids = rng.integers(0, high, n).astype(np.uint32)
        if n:
            ids[rng.random(n) < 0.95] %= 700
        seg = tk.pack(ids)
        assert (tk.unpack(seg, n) == ids).all()
        for k in range(n // tk.BLOCK):
            assert (tk.read_block(seg, k) == ids[k * tk.BLOCK:(k + 1) * tk.BLOCK]).all()
    if n > 256:  # outliers do not widen a block
        ids = np.full(n, 5, np.uint32)
        ids[7] = 50_000
        seg = tk.pack(ids)
        assert seg["width"].max() == 0 and len(seg["exception_at"]) == 1


def brute_scores(rows, prior):
    end, begin = "", " "  # no word is either
    d = [(i, [*words(t), end]) for i, t, *_ in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in d]
    c, b, starts = Counter(), Counter(), 0
    for (_, w), h in zip(d, held):
        if not h:
            c.update(w)
            b.update(zip([begin, *w[:-1]], w))
            starts += 1
    n, v = sum(c.values()), len(c)
    before = {**c, begin: starts}
    out = []
    for (i, w), h in zip(d, held):
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)
        score = sum(math.log10((b[p, x] + prior * (c[x] + 1) / (n + v + 1)) / (before.get(p, 0) + prior)) for p, x in zip([begin, *w[:-1]], w))
        out.append((i, h, len(w), sum(c[x] > 0 for x in w), n, base, score))
    return out


@pytest.mark.parametrize("chunk", [200, 10**6])
def test_scores_against_brute_force(spark, chunk):
    rows = awkward_rows() + [(i, prose(i, 30, 60), "en", "a") for i in range(100, 200)]
    df = lm.score_documents(documents(spark, rows), shards=5, chunk_tokens=chunk)
    got = sorted(rows_of(df, "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"), key=key)
    want = sorted(brute_scores(rows, df.first()["prior"]), key=key)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5]) and g[6] == pytest.approx(w[6])


def test_scores_of_edge_tables(spark):
    assert rows_of(lm.score_documents(documents(spark, []), shards=3)) == []
    held = next(i for i in range(100) if lm.held_out(i))
    r = lm.score_documents(documents(spark, [(held, "never seen", "en", "a")]), shards=3).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (True, 3, 0, 0, 0.0, 0.0)


def test_trie_and_levels():
    rng = np.random.default_rng(0)
    for values in ([], [0], [0, 0, 0], [5, 5, 9, 4000], np.sort(rng.integers(0, 10**7, 1000)).tolist()):
        levels = lm.EliasFano(np.array(values, np.int64))
        assert levels.get(np.arange(len(values))).tolist() == values
        some = rng.permutation(len(values))[:50]
        assert levels.get(some).tolist() == [values[i] for i in some]
    long = np.cumsum(rng.integers(0, 3, 200_000) * (rng.random(200_000) < 0.1) * 500)   # more than one slice, empty blocks
    assert (lm.EliasFano(long).get(np.arange(len(long))) == long).all()
    left, right = rng.integers(0, 50, 3000).astype(np.uint64), rng.integers(0, 30, 3000).astype(np.uint32)
    n = rng.integers(1, 4, 3000)
    want = Counter()
    for a, b, c in zip(left.tolist(), right.tolist(), n.tolist()):
        want[a, b] += c
    trie = lm.Trie(left, right, n)
    asked = [(a, b) for a in range(60) for b in range(40)]
    got = lm.from_codes(trie.look_up(np.array([a for a, _ in asked], np.uint64), np.array([b for _, b in asked], np.uint32)))
    assert got.tolist() == [want[x] for x in asked]
    counts = np.array([1, 128, 129, 1000, 10**6, 10**9])
    assert (np.abs(np.log2(lm.from_codes(lm.to_codes(counts)) / counts)) <= 0.13).all()


def test_counts_beyond_32_bits():
    for counts in ([], [0, 5], [2**32 - 1], [2**32 + 5, 1], [2**40]):
        a = np.array(counts, np.uint64)
        assert lm._open_counts(lm._press_counts(a), len(a)).tolist() == counts


def test_hot_contexts_are_spread_by_weight(spark):
    rows = [(i, " ".join(f"the w{(7 * i + k) % 900}" for k in range(60)), "en", "a") for i in range(40)]
    docs = documents(spark, rows)
    splits = lm.context_splits(docs, 60)
    mark = lambda word: lm.xxhash.xxh3_64_intdigest(word) >> 48
    assert splits[mark(b"the")] >= 60 and splits[mark(b"w1")] == lm.SPLITS
    assert lm.context_splits(documents(spark, [(1, "a", "en", "a")] * 300), 60)[int(lm._BEGIN) >> 48] > lm.SPLITS
    sent = lm.count_chunks(docs, 60, splits, 1000).filter("shard >= 0").select("successors").collect()
    assert max(len(r[0]) // 4 for r in sent) <= 90  # of about 900 pairs a chunk; a fourth of those of "the" would be more
    few, many = ({(r["doc_id"], r["n_known"], round(r["score"], 9)) for r in lm.score_documents(docs, shards=s).collect()} for s in (1, 60))
    assert few == many and len(few) == 40


def test_memory_of_chunks_and_levels():
    """Arrays beside the input stay few: an executor's workers hold chunks and shards whole."""
    import tracemalloc

    def peak(f):
        tracemalloc.start()
        try:
            f()
            return tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    rng, n = np.random.default_rng(3), 1 << 19
    left, right = rng.integers(0, n // 4, n).astype(np.uint64), rng.integers(0, 1 << 32, n).astype(np.uint32)
    assert peak(lambda: lm.Trie(left, right, np.ones(n, np.uint32))) <= 60 * n
    tokens, lengths, marks = rng.integers(0, 1000, n).astype(np.int32), np.full(n // 64, 64), np.arange(1002).astype(np.uint16)
    assert peak(lambda: lm.Chunk(tokens, lengths, marks, np.full(1 << 16, 4, np.uint16), 8)) <= 50 * n
