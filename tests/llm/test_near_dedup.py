from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm.fixtures import awkward_rows, documents, key, prose, rows_of, words
from waferline.llm import near_dedup as nd


def shingle_set(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """(doc_id, n_shingles, component_id, kept) of every row, by comparing all pairs."""
    sets = [shingle_set(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None] if sets[i] else []
        c = min(ids, default=None) if sets[i] else r[0]
        out.append((r[0], len(sets[i]), c, r[0] == c))
    return out


def check(spark, rows):
    got = rows_of(nd.near_duplicates(documents(spark, rows)), "doc_id", "n_shingles", "component_id", "kept")
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def edited(text, r, share):
    w = text.split()
    for _ in range(max(1, int(share * len(w)))):
        w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
    return " ".join(w)


def test_awkward_rows(spark):
    check(spark, awkward_rows())
    check(spark, [])
    check(spark, [(1, None, None, None), (2, "", "en", "a")])


def test_groups_chains_and_borders(spark):
    r = random.Random(11)
    rows, i = [], 0
    for g in range(12):  # groups of near copies, from just linked to just not
        base = prose(100 + g, 80 + 20 * g)
        for k in range(12):
            rows.append((i := i + 1, edited(base, r, 0.004 * (k % 5) * (1 + g % 3)), "en", "a"))
        rows.append((i := i + 1, base, "en", "a"))
    text = prose(77, 120)  # a chain: each linked to the next, the ends far apart
    for _ in range(15):
        rows.append((i := i + 1, text, "en", "a"))
        text = edited(text, r, 0.012)
    shared = prose(5, 60)  # many documents around one passage
    rows += [(i := i + 1, prose(1000 + k, 40) + " " + shared, "en", "a") for k in range(60)]
    rows += [(i := i + 1, shared, "en", "a")] * 3
    r.shuffle(rows)
    check(spark, rows)


def test_residual_pairs_find_what_stars_miss(spark):
    """Classes of one band whose links do not touch its smallest member."""
    r = random.Random(4)
    base = prose(9, 200)
    a, b = edited(base, r, 0.01), edited(base, r, 0.01)
    rows = [(1, a, "en", "a"), (2, b, "en", "a"), (3, prose(10, 200), "en", "a")]
    sets = {i: next(nd.shingles([t])) for i, t, *_ in rows}
    cls = {i: nd.class_of(s) for i, s in sets.items()}
    import zstandard
    bands = spark.createDataFrame([(99, c) for c in cls.values()], "key long, cls long")
    packed = spark.createDataFrame([(cls[i], bytearray(zstandard.compress(t.encode()))) for i, t, *_ in rows], "cls long, packed binary")
    none = spark.createDataFrame([], "cls long, label long")
    pairs = nd.residual(bands, none, packed)
    assert rows_of(nd.confirm(pairs, packed)) == [(min(cls[1], cls[2]), max(cls[1], cls[2]))]


def test_components_on_random_graphs(spark):
    r = random.Random(2)
    links = {(r.randrange(60), r.randrange(60)) for _ in range(45)} | {(i, i + 1) for i in range(100, 160)}
    links = [(min(x), max(x)) for x in links if x[0] != x[1]]
    got = dict(rows_of(nd.components(spark.createDataFrame(links, "a long, b long"))))
    want = {x: x for p in links for x in p}
    for _ in want:
        for a, b in links:
            want[a] = want[b] = min(want[a], want[b])
    assert got == want


def test_first_of_each_keeps_one_whole_document(spark):
    rows = awkward_rows()
    docs = documents(spark, rows)
    out = nd.first_of_each(docs)
    assert out.columns == docs.columns
    kept = rows_of(out, "doc_id", "text")
    assert (1, rows[0][1]) in kept and sum(t == rows[0][1] for _, t in kept) == 1
    assert (2, None) in kept and (3, "") in kept


def test_first_of_each_judges_rows_of_null_and_repeated_ids(spark):
    copy, other = prose(1, 60), prose(2, 60)
    rows = [(1, copy, "en", "a"), (8, copy, "en", "a"), (8, other, "en", "a"), (8, other, "en", "a"),  # id 8: a copy of 1, and another text
            (None, prose(3, 60), "en", "a"), (None, prose(4, 60), "en", "a"), (None, prose(4, 60) + " tail", "en", "a"),
            (None, None, "en", "a"), (None, "", "en", "a"), (8, " ", "en", "a"), (None, copy, "en", "a"),
            (9, prose(5, 60), "en", "a"), (9, prose(5, 60) + " tail", "en", "a")]
    docs = documents(spark, rows)
    out = nd.first_of_each(docs)
    assert out.columns == docs.columns
    kept = rows_of(out, "doc_id", "text")
    fixed = [(1, copy), (8, other), (None, prose(3, 60)), (None, None), (None, ""), (8, " ")]
    assert all(kept.count(x) == 1 for x in fixed) and len(kept) == len(fixed) + 2
    assert sum(i is None and (t or "").startswith(prose(4, 60)) for i, t in kept) == 1
    assert sum(i == 9 for i, _ in kept) == 1


def test_decontamination_stage_judges_rows_of_null_and_repeated_ids(spark, tmp_path):
    import corpus_pipeline

    item = prose(50, 30)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, item, "en", "a"), (None, prose(3, 60), "en", "a"), (None, None, "en", "a"), (8, item, "en", "a"),
            (8, prose(4, 60), "en", "a"), (9, prose(5, 60), "en", "a")]
    docs = documents(spark, rows)
    out = corpus_pipeline.without_benchmark(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    assert sorted(rows_of(out, "doc_id", "text"), key=key) == sorted([(i, t) for i, t, *_ in rows if t != item], key=key)


@pytest.mark.parametrize("similarity", [0.5, 0.75, 0.9])
def test_signature_estimates_similarity(similarity):
    """Shares of equal minima and maxima follow the sets' similarity; bands rarely miss."""
    rng = np.random.default_rng(8)
    n, missed, equal = 400, 0, []
    for _ in range(40):
        common = rng.integers(0, 1 << 63, int(n * similarity), dtype=np.uint64) * 2
        only = int(n * (1 - similarity) / 2)
        a = np.unique(np.r_[common, rng.integers(0, 1 << 63, only, dtype=np.uint64)])
        b = np.unique(np.r_[common, rng.integers(0, 1 << 63, only, dtype=np.uint64)])
        x, y = nd.band_keys(a), nd.band_keys(b)
        equal.append((x == y).mean())
        missed += not (x == y).any()
    assert abs(np.mean(equal) - similarity ** nd.ROWS) < 0.06
    assert missed == 0 or similarity < 0.75


def crowd(seed, n, edits, words_=150, base=True):
    """A text and ``n`` copies with ``edits`` words changed in each."""
    r = random.Random(seed)
    text = prose(seed, words_, 5000).split()
    out = [" ".join(text)] if base else []
    for k in range(n):
        w = list(text)
        for i in r.sample(range(words_), edits):
            w[i] = f"e{k}x{i}"
        out.append(" ".join(w))
    return out


def test_a_crowd_just_below_the_bound_gives_few_pairs(spark):
    """Five words of 150 changed: no copy reaches another. What is left to compare grows with
    the copies, not with their square."""
    made, confirm = [], nd.confirm

    def counted(pairs, sets, size=nd.WORDS):
        made.append(pairs.count())
        return confirm(pairs, sets, size)

    sizes = []
    for n in (150, 300):
        made.clear()
        nd.confirm = counted
        try:
            check(spark, [(i, t, "en", "a") for i, t in enumerate(crowd(5, n, 6, base=False))])
        finally:
            nd.confirm = confirm
        sizes.append(sum(made))
    assert sizes[1] < 3 * sizes[0] + 100


@pytest.mark.parametrize("edits", [2, 3, 4])
def test_recall_on_crowds(spark, edits):
    """With the text they come from, and without: pairs of copies at 0.65 to 0.9."""
    rows = [(i, t, "en", "a") for i, t in enumerate(crowd(edits, 120, edits) + crowd(10 + edits, 120, edits, base=False))]
    check(spark, rows)


def test_bitmaps_bound_what_sets_have_apart():
    rng = np.random.default_rng(3)
    for n in (1, 40, 700):
        a, b = (np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64)) for _ in range(2))
        b = np.union1d(a[: n // 2], b)
        apart = len(np.setxor1d(a, b))
        x = nd.bitmap(a) ^ nd.bitmap(b)
        assert sum(int(v).bit_count() for v in x.view(np.uint64)) <= apart
