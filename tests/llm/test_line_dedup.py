from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.fixtures import LOWER, awkward_rows, documents, key, rows_of
from waferline.llm import line_dedup as ld


def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def brute(rows):
    holders = defaultdict(set)
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            if len(line_key(line)) >= 10:
                holders[line_key(line)].add((i is None, i or 0))
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        gone = [n for n, line in enumerate(lines)
                if len(holders[line_key(line)]) > 1 and min(holders[line_key(line)]) != (i is None, i or 0)]
        out.append((i, "\n".join(x for n, x in enumerate(lines) if n not in gone), len(lines), gone))
    return out


def check(spark, rows, **kw):
    got = rows_of(ld.drop_repeated_lines(documents(spark, rows), **kw), "doc_id", "text", "n_lines", "dropped")
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def many(seed, n):
    r = random.Random(seed)
    line = lambda: f" {'Xx'[r.randrange(2)]}line number {int(r.paretovariate(0.5)) % 500}\t"
    return [(r.choice([None, 3, *range(100, 160)]), "\n".join(line() for _ in range(r.randrange(12))), "en", "a") for _ in range(n)]


@pytest.mark.parametrize("kw", [{}, {"line_bits": 1 << 16, "round_slices": 2, "piece": 64}])
def test_against_brute_force(spark, kw):
    """Also with many slices, several rounds and small pieces."""
    check(spark, awkward_rows() + many(1, 120), **kw)


def test_defined_cases(spark):
    check(spark, [])
    check(spark, [(None, None, None, None), (1, "", None, None), (None, "\n\n", None, None)])
    same = "a line of ten\n\n a LINE of ten \nshort\nother words here"
    check(spark, [(5, same, "en", "a"), (5, same, "en", "a"), (2, same, "en", "a"), (None, same, None, None)])
    check(spark, [(7, "only in seven\nonly in seven", "en", "a"), (None, "nowhere else\nnowhere else", "en", "a"), (None, "nowhere else", "en", "a")])
    check(spark, [(1, "äöüßéèêçñó", "de", "a"), (2, "ÄÖÜßéèêçñó\näöüßéèêçñó", "de", "a"), (3, "日本語テキストの行", "ja", "a"), (4, "日本語テキストの行", "ja", "a")])


def test_a_line_in_every_document(spark):
    """Its key is more than a thousandth of all rows: joined by broadcast."""
    check(spark, [(i, f"the common line\nline of pair {i // 2}\nonly {i} has this line", "en", "a") for i in range(600)])


def test_filters_have_no_false_negatives():
    r = np.random.default_rng(5)
    h = r.integers(0, 1 << 63, 3000, dtype=np.uint64)
    pieces = [(np.unique(r.choice(h, 900)), None) for _ in range(4)]
    pieces = [(p, np.zeros(len(p), bool)) for p, _ in pieces]
    pieces[0][1][:5] = True
    bits = ld.merge_filters(iter(pieces))
    seen = np.concatenate([p for p, _ in pieces])
    values, times = np.unique(seen, return_counts=True)
    must = np.union1d(values[times > 1], pieces[0][0][:5])
    hit = lambda x: bits[ld.places(x)].all(axis=0)
    assert hit(must).all()
    once = np.setdiff1d(values, must)
    assert hit(once).mean() < 0.01
