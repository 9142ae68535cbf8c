from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tests.llm.fixtures import EXTRA, key, rows_of
from waferline.llm import prefix_trie as pt

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
CLASHING = (*EXTRA, "depth", "n1", "block", "items", "pos", "bucket", "h", "k")


def conversations(spark, rows):
    extra = tuple(dict.fromkeys(CLASHING))
    return spark.createDataFrame([(*r, *["x"] * len(extra)) for r in rows],
                                 "conv_id long, turn long, role string, text string, " + ", ".join(f"{c} string" for c in extra))


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), role, hashlib.md5(text.encode()).hexdigest(), text))
    own = {c: [(r, x) for _, r, _, x in sorted(t)] for c, t in own.items()}
    whole = {}
    for c, t in own.items():
        base, h = c - (abs(c) % 100) * (1 if c >= 0 else -1), zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(own.get(base, [])[:h] + t[h:])
    members = defaultdict(list)
    for c, t in sorted(whole.items()):
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[x] for x in kids[p]) or 1
        saved[p] = sum(saved[x] for x in kids[p]) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
    return [(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
             hashlib.sha256(",".join(str(c) for c in m if len(whole[c]) == len(p)).encode()).hexdigest()) for p, m in members.items()]


def check(spark, rows, **kw):
    got = rows_of(pt.digest(pt.prefix_trie(conversations(spark, rows), **kw)), *COLUMNS)
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def talk(seed, ids, most, texts=3):
    r = random.Random(seed)
    return [(c, t, "user" if t % 2 == 0 else "assistant", f"t{r.randrange(texts)}" * r.randrange(1, 3))
            for c in ids for t in range(r.randrange(most + 1))]


@pytest.mark.parametrize("block", [1, 3, 8])
def test_against_brute_force(spark, block):
    """Every block length gives the same trie; siblings part in every place of a block."""
    check(spark, talk(1, [*range(100, 160), *range(-120, -90), 205], 20, 2), block=block)


def test_awkward_rows(spark):
    check(spark, [])
    check(spark, [(None, 1, "user", "x")])
    check(spark, [(1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (1, 0, "assistant", "b"), (1, 0, "user", "ä日"),
                  (2, 5, None, None), (None, 3, "user", "lost"), (100, 2, "", "x"), (100, None, "user", "first"),
                  (105, 1, "user", "a"), (9223372036854775807, 1, "user", "a"), (-9223372036854775808, 1, "user", "a"),
                  *[(200, t, "user", "long " * 3) for t in range(700)], *[(203, t, "user", "long " * 3) for t in range(690)]])


def test_conversations_left_without_turns(spark):
    """Own turns within the first h and no first conversation of the hundred: root members."""
    check(spark, [(c, 0, "user", "only") for c in range(301, 340)])


def test_one_opening_and_one_conversation_for_most(spark):
    """Common parents, groups and ends: joined by broadcast, counted by partial aggregates."""
    check(spark, [(c, t, "user", f"t{t}" if c % 3 else f"t{t} of {c if t > 1 else 0}") for c in range(400) for t in range(10)])
