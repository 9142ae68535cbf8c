from __future__ import annotations

import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tests.llm.fixtures import awkward_rows, documents, key, prose, rows_of, words
from waferline.llm import mix, shard


def targets(sizes):
    """Rounds of sharing: who is above twice his size stays there."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full, total = set(), 1.5 * sum(sizes.values())
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        left = [s for s in names if s not in full]
        t = {s: 2.0 * sizes[s] for s in full} | {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = {s for s in left if t[s] > 2 * sizes[s]}
        if not over:
            return t
        full |= over


def check_mix(spark, rows, block=16):
    m = mix.mix(documents(spark, rows), block_words=block)
    got = rows_of(mix.digest(m), "doc_id", "size", "source_size", "target", "taken")
    sizes, of = defaultdict(int), defaultdict(list)
    for i, t, _, s in rows:
        sizes[s] += len(words(t))
        of[i].append((len(words(t)), s))
    want = targets(sizes)
    assert sorted((r[0], r[1]) for r in got if r[0] is not None) == sorted((i, n) for i in of if i is not None for n, _ in of[i])
    assert all(0 <= r[4] <= 2 * r[1] for r in got)
    per = Counter()
    for r in got:
        per[r[2], round(r[3], 6)] += r[4]
    for s, t in want.items():
        if sizes[s]:
            assert abs(per[sizes[s], round(t, 6)] - sum(round(want[x]) for x in want if (sizes[x], round(want[x], 6)) == (sizes[s], round(t, 6)))) <= 2
    return m, got


def test_mix_takes_targets(spark):
    check_mix(spark, awkward_rows())
    rows = [(i, prose(i, 5 + i % 40), "en", "hot" if i % 3 == 0 else f"s{i % 11}") for i in range(400)]
    m, got = check_mix(spark, rows)
    again = rows_of(mix.digest(mix.mix(documents(spark, rows).repartition(7), block_words=16)), "doc_id", "size", "source_size", "target", "taken")
    assert sorted(got) == sorted(again)
    # Every slot takes one block of its source, in an order that keeps all sources near their shares.
    slots = sorted(rows_of(m.slots, "slot", "src", "block", "first_word", "end_word"))
    need = Counter(s[1] for s in slots)
    seen = Counter()
    for k, s in enumerate(slots, 1):
        seen[s[1]] += 1
        assert 0 < s[4] - s[3] <= 16
        assert all(abs(seen[x] - k * need[x] / len(slots)) <= 12 for x in need)
    assert {(s[1], s[2]) for s in slots} == {(x, b) for x in need for b in range(need[x])}
    pieces = m.pieces.filter("n_words > 0").groupBy("slot").agg(F.sum("n_words")).collect()
    assert {r[0]: r[1] for r in pieces} == {s[0]: s[4] - s[3] for s in slots}


def test_mix_edge_tables(spark):
    assert rows_of(mix.digest(mix.mix(documents(spark, [])))) == []
    got = rows_of(mix.digest(mix.mix(documents(spark, [(1, None, None, None), (2, "", "en", "a")]))), "doc_id", "size", "target", "taken")
    assert sorted(got) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_mixed_documents_repeat_whole_rows(spark):
    rows = awkward_rows()
    docs = documents(spark, rows)
    out = mix.mixed_documents(docs)
    assert out.columns == docs.columns
    times = Counter(rows_of(out, "doc_id", "text"))
    for (i, t), n in times.items():
        assert words(t) and n <= 2 * sum(1 for r in rows if r[:2] == (i, t))
    assert times[1, rows[0][1]] >= 1


def test_van_der_corput_and_one_source(spark):
    got = [r[0] for r in spark.range(6).select(mix.van_der_corput(F.col("id"))).collect()]
    assert got == [0.0, 0.5, 0.25, 0.75, 0.125, 0.625]
    m, got = check_mix(spark, [(i, "a b c d e", "en", "only") for i in range(10)])
    assert sum(r[4] for r in got) == 75


def check_shards(spark, rows, n=8):
    got = rows_of(shard.digest(shard.assign(documents(spark, rows), n)), "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    want = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _, _ in rows), key=key)
    assert sorted((r[:3] for r in got), key=key) == want
    slots = defaultdict(list)
    for r in got:
        assert r[3] == "rows" and r[6] is None
        slots[r[4]].append(r[5])
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    counts = [len(slots[s]) for s in range(n)]
    assert max(counts) - min(counts) <= 1
    return got


def test_shards_are_even(spark):
    check_shards(spark, awkward_rows())
    check_shards(spark, [])
    check_shards(spark, [(1, "x", None, None)])
    same = [(7, "copy", "en", "a")] * 50 + [(i, "copy", "en", "a") for i in range(40)] + [(None, None, None, None)] * 20
    got = check_shards(spark, same)
    again = rows_of(shard.digest(shard.assign(documents(spark, same).repartition(5))), "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    assert sorted(got, key=key) == sorted(again, key=key)


def test_plan_against_one_key_at_a_time():
    """Rounds of single keys in ring order give the same counts per cell and shard."""
    n, layout = 5, shard.cells(5, 8, 64)
    counts = {k: (k * 37) % 23 for k, *_ in layout}
    total = sum(counts.values())
    room = [total // n + (s < total % n) for s in range(n)]
    used, per = Counter(), Counter()
    left = dict(counts)
    for step in range(n):
        for k, _, _, prefer in layout:
            for _ in range(left[k]):
                if used[prefer[step]] < room[prefer[step]]:
                    used[prefer[step]] += 1
                    per[k, prefer[step]] += 1
                    left[k] -= 1
    got = Counter()
    for k, a, b, s, _ in shard.plan(counts, layout, n):
        got[k, s] += b - a
    assert got == per and not any(left.values())


def test_one_more_shard_moves_little(spark):
    rows = [(i, f"text {i}", "en", "a") for i in range(3000)]
    a = dict(rows_of(shard.assign(documents(spark, rows), 8), "doc_id", "shard"))
    b = dict(rows_of(shard.assign(documents(spark, rows), 9), "doc_id", "shard"))
    assert sum(a[i] != b[i] for i in a) < 0.2 * len(a)


def test_written_shards_hold_the_texts(spark, tmp_path):
    rows = awkward_rows()
    shard.write_shards(documents(spark, rows), str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(rows_of(back, "doc_id", "text"), key=key) == sorted(((i, t) for i, t, *_ in rows), key=key)


def test_shards_keep_every_one_of_rows_alike_in_id_and_text(spark, tmp_path):
    """Rows that differ in other columns only, nulls among them."""
    rows = [(1, "same", lang, src) for lang, src in (("en", "x"), (None, "y"), ("x", None), (None, "x"))]
    rows += [(None, "same", None, str(i)) for i in range(40)] + [(1, "same", "en", "x")] * 3
    shard.write_shards(documents(spark, rows), str(tmp_path / "out"), 3)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert Counter(rows_of(out, "doc_id", "text", "lang", "source")) == Counter(rows)
    assert sorted(out.columns) == sorted([*documents(spark, []).columns, "shard", "slot"] if "shard" not in documents(spark, []).columns
                                         else documents(spark, []).columns)
    places = rows_of(out, "shard", "slot")
    assert len(set(places)) == len(rows) and all({s for k, s in places if k == x} == set(range(sum(k == x for k, _ in places))) for x in range(3))


def test_mixed_documents_tell_apart_which_column_is_null(spark):
    rows = [(1, "a few words", "x", None), (1, "a few words", None, "x"), (None, "a few words", None, None)]
    docs = documents(spark, rows)
    out = mix.mixed_documents(docs)
    assert out.columns == docs.columns
    assert set(rows_of(out, "doc_id", "text", "lang", "source")) == set(rows)
    assert {r[0] for r in rows_of(out, "mix_mark")} == {"x"}
