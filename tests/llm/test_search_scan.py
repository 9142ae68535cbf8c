from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.fixtures import ALNUM, awkward_rows, documents, key, prose, rows_of, words
from waferline.llm import decontaminate as dc
from waferline.llm import language_id as li
from waferline.llm import licenses as lic
from waferline.llm import vector_search as vs


# ------------------------------------------------------------------ operator 10

def brute_hits(rows, items, size=13):
    found = {}
    for item, text in items:
        w = words(text, ALNUM)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            found.setdefault(tuple(w[i:i + size]), set()).add(item)
    out = []
    for i, text, *_ in rows:
        w, hit, got = words(text, ALNUM), set(), set()
        for n in {len(k) for k in found}:
            for s in range(len(w) - n + 1):
                if (own := found.get(tuple(w[s:s + n]))) is not None:
                    hit.update(range(s, s + n))
                    got |= own
        names = sorted(str(x) for x in got if x is not None)
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


ITEMS = [(1, prose(50, 30)), (2, prose(51, 13)), (10, "short item here"), (3, None), (4, ""), (5, prose(50, 30)), (None, prose(52, 20)),
         (6, "Only"), (7, prose(53, 40) + " " + prose(53, 40)), (7, "short item here"), (8, "the the the the")]


def contaminated_rows():
    r = random.Random(1)
    rows = awkward_rows() + [(100 + i, prose(500 + i, 200), "en", "a") for i in range(20)]
    for k, (_, t) in enumerate(ITEMS * 3):
        w = prose(900 + k, 100).split()
        at = r.randrange(len(w))
        part = (t or "").split()[: r.choice([5, 13, 14, 99])]
        rows.append((200 + k, " ".join([*w[:at], *part, *w[at:]]).upper(), "en", "a"))
    rows += [(300, "the the the the the the", "en", "a"), (301, ITEMS[0][1] + "," + ITEMS[0][1], "en", "a"), (301, ITEMS[0][1], "en", "a")]
    return rows


@pytest.mark.parametrize("segment,block", [(1 << 20, 1 << 20), (300, 60)])
def test_decontamination_against_brute_force(spark, segment, block):
    rows = contaminated_rows()
    bench = spark.createDataFrame([(i, t, "x", 1) for i, t in ITEMS], "item_id long, text string, doc_id string, hits int")
    got = rows_of(dc.digest(dc.decontaminate(documents(spark, rows), bench, segment_words=segment, block_bytes=block)),
                  "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted(got, key=key) == sorted(brute_hits(rows, ITEMS), key=key)


def test_decontamination_edge_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    rows = awkward_rows()
    got = rows_of(dc.digest(dc.decontaminate(documents(spark, rows), none)), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted(got, key=key) == sorted(brute_hits(rows, []), key=key)
    assert rows_of(dc.decontaminate(documents(spark, []), none)) == []
    nothing = spark.createDataFrame([(1, "never there at all")], "item_id long, text string")
    assert rows_of(dc.decontaminate(documents(spark, []), nothing)) == []


def test_proximity(spark):
    index = dc.build_index(documents(spark, [(1, "a b x c", "en", "s"), (2, "a b c", "en", "s"), (3, "c b a", "en", "s"), (4, "a q q q q b q q c", "en", "s")]))
    phrase = [[b"a", b"b", b"c"]]
    exact = {r[0] for r in rows_of(dc.phrase_hits(index, phrase, [["p"]], all_documents=False), "doc_id")}
    near = {r[0] for r in rows_of(dc.phrase_hits(index, phrase, [["p"]], slop=1, all_documents=False), "doc_id")}
    assert exact == {2} and {1, 2} <= near and 4 not in near


# ------------------------------------------------------------------ operator 8

def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, score int, rank int")


def brute_top(rows, k, every):
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in ok if i % every == 0}):
        best = set()
        for qv in [v for i, v in ok if i == q]:
            s = [(-sum(a * b for a, b in zip(qv, v)), i) for i, v in ok if i != q and len(v) == len(qv)]
            best |= {(*x, n) for n, x in enumerate(s)}
        out += [(q, r, i, -s) for r, (s, i, _) in enumerate(sorted(best)[:k], 1)]
    return out


@pytest.mark.parametrize("block", [4096, 3])
def test_top_k_against_brute_force(spark, block):
    r = random.Random(6)
    rows = [(i, [r.gauss(0, 0.2) for _ in range(24)]) for i in range(300)]
    rows += [(400 + i, rows[5][1]) for i in range(20)]  # copies: ties
    rows += [(1000, None), (1001, [None] * 24), (1002, [float("nan")] * 24), (1050, [float("inf")] * 24), (None, rows[3][1]),
             (2000, [0.5] * 7), (2001, [0.25] * 7), (2050, []), (3000, [1e4] * 24), (2002, rows[8][1]), (2002, rows[8][1])]
    df = vectors(spark, rows).repartition(3)
    got = rows_of(vs.top_k(df, vs.every_nth(df, 10), block=block), "query_id", "rank", "vec_id", "score")
    assert sorted(got) == sorted(brute_top(rows, 5, 10))


def test_top_k_edge_tables_and_bounds(spark):
    assert rows_of(vs.top_k(vectors(spark, []), vectors(spark, []))) == []
    one = vectors(spark, [(0, [1.0, 2.0])])
    assert rows_of(vs.top_k(one, one)) == []
    two = vectors(spark, [(0, [1.0, 2.0]), (1, [1.0, 0.0])])
    assert rows_of(vs.top_k(two, vs.every_nth(two))) == [(0, 1, 1, 256 * 256)]
    rng = np.random.default_rng(2)
    a, b = np.floor(256 * rng.normal(0, 1, (50, 64))), np.floor(256 * rng.normal(0, 1, (50, 64)))
    exact, before = a @ b.T, None
    for level in vs.LEVELS:  # bounds hold, and finer ones are tighter
        bound = vs.statistics(a, level) @ vs.statistics(b, level).T
        assert (bound >= exact - 1e-6).all() and (before is None or (bound <= before + 1e-6).all())
        before = bound


# ------------------------------------------------------------------ operator 6

def language_rows():
    r = random.Random(4)
    parts = {"aa": "ka lo mi tu ra sen", "bb": "stro plen griff wun eck", "cc": "ouai eau ille éré ç"}
    rows = []
    for i in range(600):
        lang = r.choice(sorted(parts))
        text = " ".join("".join(r.choice(parts[lang].split()) for _ in range(3)) for _ in range(r.randrange(3, 40)))
        rows.append((i, text, lang if i % 10 else None, "s"))
    return rows


def test_languages(spark):
    rows = language_rows() + [(1000, None, "aa", "s"), (1001, "", "bb", "s"), (1002, "123 --- 4", "cc", "s"), (1003, "Привет мир как дела", None, "s"),
                              (None, "kalo mitura", "aa", "s"), (1004, "kalo " * 20_000, "aa", None), (5, rows_text(5), "aa", "s"), (5, rows_text(5), "aa", "s")]
    got = {r[0]: r for r in rows_of(li.identify_documents(documents(spark, rows)), "doc_id", "held_out", "lang_pred", "score", "rejected")}
    right = [got[i][2] == lang for i, _, lang, _ in language_rows() if lang and got[i][1]]
    assert len(right) > 80 and np.mean(right) >= 0.99
    assert all(got[i][2:] == ("und", 0.0, True) for i in (1000, 1001, 1002))
    assert got[1003][2] != "und" and got[1003][4] and not got[1004][4]
    assert all(0 <= r[3] <= 1 for r in got.values()) and all(r[1] == li.crc_fold(r[0]) for r in got.values())
    # Held-out labels are not looked at.
    other = [(i, t, "xx" if li.crc_fold(i) else lang, s) for i, t, lang, s in rows]
    again = {r[0]: r for r in rows_of(li.identify_documents(documents(spark, other)), "doc_id", "held_out", "lang_pred", "score", "rejected")}
    assert {k: v[2] for k, v in again.items()} == {k: v[2] for k, v in got.items()}


def rows_text(i):
    return language_rows()[i][1]


def test_language_edge_tables(spark):
    assert rows_of(li.identify_documents(documents(spark, []))) == []
    got = rows_of(li.identify_documents(documents(spark, [(1, "words", None, "a"), (None, None, None, None)])), "lang_pred", "score", "rejected")
    assert got == [("und", 0.0, True)] * 2
    docs = documents(spark, language_rows() + [(1000, None, "aa", "s"), (1003, "Привет мир", None, "s")])
    kept = li.accepted_documents(docs)
    assert kept.columns == docs.columns and sorted(r[0] for r in rows_of(kept, "doc_id")) == list(range(600))


@pytest.mark.parametrize("unseen", ["aa", "bb", "cc"])
def test_a_language_left_out_of_training_is_rejected(spark, unseen):
    """All in one script; known texts pass, short ones too."""
    rows = [(i, t, lang if lang != unseen else None, s) for i, t, lang, s in language_rows() if lang]
    of = {i: (lang, len(t.split())) for i, t, lang, _ in language_rows()}
    short = [(5000 + i, " ".join(t.split()[:1 + i % 2]), None, "s") for i, t, lang, _ in language_rows()[:200] if lang and lang != unseen]
    got = {r[0]: r[1] for r in rows_of(li.identify_documents(documents(spark, rows + short)), "doc_id", "rejected")}
    strange = [got[i] for i, *_ in rows if of[i][0] == unseen and of[i][1] >= 10]
    known = [got[i] for i, *_ in rows if of[i][0] != unseen]
    assert len(strange) > 80 and np.mean(strange) >= 0.95
    assert np.mean(known) <= 0.01 and np.mean([got[i] for i, *_ in short]) <= 0.02


def test_the_sample_is_bounded_whatever_the_ids(spark, monkeypatch):
    """Null and repeated ids, and repeated rows, do not fill one language's group."""
    sizes, means = spark.sparkContext.accumulator(0), li.spherical_means

    def counted(x, k, rounds=li.ROUNDS):
        sizes.add(len(x))
        return means(x, k, rounds)

    monkeypatch.setattr(li, "spherical_means", counted)
    monkeypatch.setattr(li, "least_cosines", lambda *a: li.np.zeros(li.CLASSES))
    texts = [" ".join(t.split()[:3]) + f" {prose(i, 3)}" for i, t, *_ in language_rows()]
    for ids in ([None] * 600, [7] * 600, range(600)):
        before = sizes.value
        li.fit(documents(spark, [(i, t, "aa", "s") for i, t in zip(ids, texts, strict=True)]).select("doc_id", "text", "lang"), sample=50)
        assert 20 <= sizes.value - before <= 100
    before = sizes.value
    li.fit(documents(spark, [(None, "the same row", "aa", "s")] * 600).select("doc_id", "text", "lang"), sample=600)
    assert sizes.value - before == 1


def test_against_a_plain_dictionary_version(spark):
    """Same hashes and centroids, weights and cosines in dictionaries: the same predictions."""
    rows = [r for r in awkward_rows()] + [(i, t, lang, s) for i, t, lang, s in language_rows()[:150]]
    docs = documents(spark, rows)
    model = li.fit(li.training_rows(docs))
    learned = [(t or "", lang) for i, t, lang, _ in rows if lang is not None and not li.crc_fold(i)]

    def grams(text):
        out, border = Counter(), True
        chars = []
        for c in (text or "").lower():
            if c.isalpha():
                chars.append(ord(c))
                border = False
            elif not border or not chars:
                chars.append(0)
                border = True
        if not any(chars):
            return out
        chars = [0, *chars, 0]
        for n in range(1, li.GRAMS + 1):
            for i in range(len(chars) - n + 1):
                if n == 1 and not chars[i]:
                    continue
                code = 0
                for k in range(n):
                    code = (code * 0x110003 + chars[i + k] + k + 1) % 2**64
                out[(code * 0x9E3779B97F4A7C15 % 2**64) >> (64 - li.DIMENSIONS.bit_length() + 1)] += 1
        return out

    df = Counter(d for t, _ in learned for d in grams(t))
    centroids = model.by_dimension.T
    want = []
    for i, text, *_ in rows:
        g = grams(text)
        if not g:
            want.append((i, "und", 0.0, True))
            continue
        w = {d: (1 + math.log(c)) * (math.log((len(learned) + 1) / (df[d] + 1)) + 1) for d, c in g.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        scores = [sum(x * v[d] for d, x in w.items()) / norm for v in centroids]
        k = max(range(len(scores)), key=scores.__getitem__)
        want.append((i, model.languages[k], min(1.0, max(0.0, scores[k])), bool(scores[k] < model.least[k, li.length_class(len(g))])))
    got = rows_of(li.identify_documents(docs), "doc_id", "lang_pred", "score", "rejected")
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert (g[0], g[1], g[3]) == (w[0], w[1], w[3]) and g[2] == pytest.approx(w[2], abs=1e-4)


def test_means_of_sparse_rows_are_those_of_dense_rows():
    r = li.np.random.default_rng(4)
    vectors = []
    for _ in range(60):
        at = li.np.sort(r.choice(li.DIMENSIONS, r.integers(1, 40), replace=False))
        w = r.random(len(at))
        vectors.append((at, w / li.np.linalg.norm(w)))
    x = li.Rows(vectors)
    dense = li.np.array([x.dense(i) for i in range(len(x))])
    v = r.random(li.DIMENSIONS).astype(li.np.float32)
    some = r.random(60) < 0.5
    assert x.cosines(v) == pytest.approx(dense @ v, abs=1e-4) and x.sum(some) == pytest.approx(dense[some].sum(axis=0), abs=1e-4)
    assert li.spherical_means(x, 4).shape == (4, li.DIMENSIONS)


# ------------------------------------------------------------------ operator 7

NOTICE = {"Apache-2.0": "Licensed under the Apache License, Version 2.0.", "MIT": "Released under the MIT License.",
          "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.", "GPL-3.0": "This work is licensed under the GNU General Public License, version 3."}


def test_license_scan(spark):
    rows = [(i, prose(i, 120) + "\n" + prose(i + 1, 30), "en", "a") for i in range(150)]
    rows += [(1000 + k, prose(k, 50) + "\n" + NOTICE[f] + "\n" + prose(k, 20), "en", "a") for k, f in enumerate(sorted(NOTICE) * 5)]
    rows += awkward_rows()[1:4] + [(2000, NOTICE["MIT"] + "\n" + NOTICE["GPL-3.0"], None, None), (2001, prose(3, 40_000) + "\n" + NOTICE["MIT"], "en", "a"),
                                   (2002, "The license fee is due.\n\n\nYou need a driver's license", "en", "a"), (None, NOTICE["MIT"], "en", "a")]
    found = lic.scan_documents(documents(spark, rows))
    got = {r[0]: r for r in rows_of(lic.digest(found), "doc_id", "n_paragraphs", "n_license", "n_unconfirmed", "licenses", "family", "score")}
    assert all(got[i][2] == 0 and got[i][4] == "" and got[i][5] is None and got[i][6] == 0.0 for i in range(150))
    for k, f in enumerate(sorted(NOTICE) * 5):
        assert got[1000 + k][1:6] == (3, 1, 0, f, f)
    assert got[2][1:] == (0, 0, 0, "", None, 0.0) and got[4][1] == 0
    assert got[2000][4] == "GPL-3.0,MIT" and got[2001][4] == "MIT" and got[2002][2] == 0 and got[None][4] == "MIT"
    text = dict((i, t) for i, t, *_ in rows)[2001]
    spans = found.filter("doc_id = 2001").first()["spans"]
    assert [text[s["start"]:s["end"]] for s in spans if s["confirmed"]] == [NOTICE["MIT"]]
    # Every paragraph scored, without the look at 3-grams, gives the same confirmed families.
    model = lic.Classifier([])
    for i, t, *_ in rows[:20] + rows[150:160]:
        for line in (t or "").split("\n"):
            w = lic.words_of(line)[:lic.WIDE]
            if model.classify(w)[2]:
                assert any(len(g) == 3 and g in model.feature for g in lic.grams(w))


@pytest.mark.parametrize("width,mark", [(72, ""), (80, " * "), (76, "# ")])
def test_wrapped_notices(spark, width, mark):
    """Hard-wrapped notices, in comments and without, are found as whole lines."""
    import textwrap

    wrap = lambda t: "\n".join(mark + x for x in textwrap.wrap(t, width - len(mark)))
    cases = [(f, p) for f in ("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "Apache-2.0") for p in lic.PARAGRAPHS[f]]
    # Set among prose: a blank line (or an empty comment) before, none after.
    blank = "\n" + mark.rstrip() + "\n"
    rows = [(k, prose(k, 40) + blank + wrap(p) + "\n" + prose(k + 50, 30), "en", "a") for k, (_, p) in enumerate(cases)]
    mit = "Copyright (c) 2020 A. N. Other" + blank + blank.join(wrap(p) for p in lic.PARAGRAPHS["MIT"])
    rows += [(100, mit, "en", "a"), (101, blank.join(wrap(p).replace("\n", blank) for p in lic.PARAGRAPHS["MIT"]), "en", "a"),
             (102, wrap("Licensed under the Apache") + "\n" + wrap("License, Version 2.0."), "en", "a")]
    found = lic.scan_documents(documents(spark, rows))
    got = {r[0]: r[1:] for r in rows_of(lic.digest(found), "doc_id", "n_license", "licenses")}
    assert {k: got[k][1] for k in range(len(cases))} == {k: f for k, (f, _) in enumerate(cases)}
    assert all(got[k][0] == 1 for k, (f, _) in enumerate(cases) if f in ("MIT", "ISC", "BSD-3-Clause"))
    assert got[100] == (2, "MIT") and got[102] == (1, "Apache-2.0")
    spans = found.filter("doc_id = 0").first()["spans"]
    assert [rows[0][1][s["start"]:s["end"]] for s in spans if s["confirmed"]] == [wrap(cases[0][1])]


@pytest.mark.parametrize("before", [0, 10, 20, 40])
def test_every_notice_at_every_offset(spark, before):
    """Each paragraph among other words on one line, wrapped, and alone; prose has none."""
    import textwrap

    cases = [(f, p) for f in lic.FAMILIES for p in lic.PARAGRAPHS[f]]
    rows = [(i, prose(i, 90) + "\n" + prose(i + 7, 300), "en", "a") for i in range(200)]
    for k, (_, p) in enumerate(cases):
        line = (prose(k, before) + " " if before else "") + p + " " + prose(k + 1, 15)
        rows += [(1000 + k, line, "en", "a"), (2000 + k, prose(k, before) + "\n\n" + "\n".join(textwrap.wrap(p, 72)), "en", "a")]
    got = {r[0]: r[1] for r in rows_of(lic.digest(lic.scan_documents(documents(spark, rows))), "doc_id", "licenses")}
    assert {(i, got[i]) for i in range(200)} == {(i, "") for i in range(200)}
    assert {(i + k, got[i + k]) for k in range(len(cases)) for i in (1000, 2000)} == {
        (i + k, f) for k, (f, _) in enumerate(cases) for i in (1000, 2000)}


def test_license_edge_tables(spark):
    assert rows_of(lic.scan_documents(documents(spark, []))) == []
    assert lic.windows(np.array([0, 1, 64, 65, 96, 97]))[2].tolist() == [1, 64, 64, 33, 64, 64, 64, 64, 33]


def test_large_finite_components_take_no_part(spark):
    """256 times 1e308 is no number; the other rows are searched as ever."""
    rows = [(0, [1e308, 1.0]), (50, [1.0, 2.0]), (51, [3.0, -1e200]), (52, [2.0, 1.0]), (100, [1e149, -1e149])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = rows_of(vs.top_k(v, vs.every_nth(v)), "query_id", "rank", "vec_id")
    assert {r[0] for r in got} == {50, 100} and {r[2] for r in got if r[0] == 50} == {52, 100}
