from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.fixtures import LOWER, awkward_rows, documents, key, prose, rows_of
from waferline.llm import collocations as cl

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute(rows, least, top=cl.TOP):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f[lang].update(tuple(w[i:i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        frequent = {p: a for p, a in counts.items() if a >= least}
        inside = {p[i:i + k] for p, a in frequent.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if a >= frequent[p[i:i + k]]}
        found = []
        for p, a in frequent.items():
            if len(p) > 1 and p not in inside:
                s, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                found.append((-s, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])]
    return out


def check(spark, rows, least, **kw):
    got = rows_of(cl.collocations(documents(spark, rows), least, **kw), *COLUMNS)
    assert sorted(got, key=key) == sorted(brute(rows, least, kw.get("top", cl.TOP)), key=key)
    return got


def rows_with_phrases(seed, n):
    r = random.Random(seed)
    part = lambda: r.choice(["New York City", "of the", "a\ta", prose(r.randrange(10**6), 6, 30), "é日 é日 é日"])
    return [(i, r.choice([" ", ". ", "\n", "!"]).join(part() for _ in range(r.randrange(30))), r.choice(["en", None, "und", "de"]), "a") for i in range(n)]


@pytest.mark.parametrize("kw", [{}, {"part_mass": 300, "piece": 40}, {"part_mass": 300, "piece": 40, "top": 7}])
def test_against_brute_force(spark, kw):
    """Also with many hash partitions and small pieces, where summaries are merged often."""
    assert len(check(spark, awkward_rows() + rows_with_phrases(1, 150), 5, **kw)) > 10


def test_awkward_rows(spark):
    check(spark, [], 2)
    check(spark, [(1, None, None, None), (2, "", "en", "a"), (None, " .\n\t, ", "en", None)], 1)
    same = (7, "x y x y x. x y", "en", "a")
    check(spark, [same, same, (None, "x y x y", None, None)], 2)


def test_one_word_and_one_phrase_nearly_everywhere(spark):
    """Every phrase begins or ends with the same word: a side that is joined by broadcast."""
    check(spark, [(i, " ".join(f"the w{(i + j) % 40} of" for j in range(30)), "en", "a") for i in range(60)], 20, part_mass=2000)


def test_scores_pass_64_bits(spark):
    phrases = spark.createDataFrame([("en", "x", 1, 9 * 10**16), ("en", "y", 1, 8 * 10**16), ("en", "x y", 2, 7 * 10**16)],
                                    "lang string, phrase string, words int, f long")
    totals = spark.createDataFrame([("en", 9 * 10**16)], "lang string, n long")
    assert rows_of(cl.score(phrases, totals), "score") == [(1000 * 7 * 9 * 10**32 // (9 * 8 * 10**32),)]


@pytest.mark.parametrize("seed", range(5))
def test_summary_keeps_every_frequent_value(seed):
    """Whatever the order and the cut into pieces, with far fewer counters than values."""
    r = np.random.default_rng(seed)
    stream = np.r_[r.integers(0, 1 << 32, 20_000), np.repeat(r.integers(0, 1 << 32, 12), 100)].astype(np.uint32)
    r.shuffle(stream)
    s = cl.Summary(2 * len(stream) // 100 + 1)
    for x in np.array_split(stream, 37):
        s.add(*cl.unpack(*cl.pack(*np.unique(x, return_counts=True))))
    values, times = np.unique(stream, return_counts=True)
    kept = s.frequent(100)
    assert np.isin(values[times >= 100], kept).all() and len(kept) < 50 and 0 < s.lost < 50
    assert len(s.values) <= s.capacity
