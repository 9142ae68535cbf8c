"""The kept type-2 dimension against a history built day by day."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest

from conftest import rows

from waferline.plans import dimension as D
from waferline.plans.layers import scd2

SCHEMA = "k string, a string, b int, snapshot_date date"
DAYS = [date(2024, 1, 1) + timedelta(days=d) for d in (0, 1, 2, 4, 5, 9)]


def snapshots(seed):
    rng = random.Random(seed)
    return {d: {k: (rng.choice(["x", "y", None]), rng.choice([1, 1, None])) for k in ("p", "q", None) if rng.random() < 0.7} for d in DAYS}


def brute(snaps, close):
    out = []
    for k in {k for s in snaps.values() for k in s}:
        open_ = None
        for d in sorted(snaps):
            if k in snaps[d]:
                if open_ is None or open_[1] != snaps[d][k]:
                    if open_ is not None:
                        out.append((k, *open_[1], open_[0], d - timedelta(days=1), False))
                    open_ = (d, snaps[d][k])
            elif close and open_ is not None:
                out.append((k, *open_[1], open_[0], d - timedelta(days=1), False))
                open_ = None
        if open_ is not None:
            out.append((k, *open_[1], open_[0], None, True))
    return sorted(out, key=repr)


def frame(spark, snaps, dates):
    return spark.createDataFrame([(k, *v, d) for d in dates for k, v in snaps[d].items()], SCHEMA)


@pytest.mark.parametrize("close", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_gives_the_whole_history(spark, tmp_path, close, seed):
    snaps, root = snapshots(seed), f"{tmp_path}/dim"
    order = [[DAYS[4]], [DAYS[0], DAYS[5]], [DAYS[2], DAYS[1]], [DAYS[3]]]
    done = set()
    for dates in order:
        D.merge_snapshots(spark, root, frame(spark, snaps, dates), "k", ["a", "b"], dates=dates, close=close)
        done |= set(dates)
        got = sorted(rows(D.read_dimension(spark, root)), key=repr)
        assert got == brute({d: snaps[d] for d in done}, close)
    if not close:
        assert got == sorted(rows(scd2(frame(spark, snaps, DAYS), "k", ["a", "b"])), key=repr)


def test_a_date_again_replaces_its_rows(spark, tmp_path):
    snaps, wrong, root = snapshots(3), snapshots(4), f"{tmp_path}/dim"
    D.merge_snapshots(spark, root, frame(spark, {**snaps, DAYS[2]: wrong[DAYS[2]]}, DAYS), "k", ["a", "b"], dates=DAYS, close=True)
    D.merge_snapshots(spark, root, frame(spark, snaps, [DAYS[2]]), "k", ["a", "b"], dates=[DAYS[2]], close=True)
    assert sorted(rows(D.read_dimension(spark, root)), key=repr) == brute(snaps, True)
    assert sorted(rows(D.read_dimension(spark, root, 1)), key=repr) == brute({**snaps, DAYS[2]: wrong[DAYS[2]]}, True)


def test_empty_null_dates_copies_and_facts(spark, tmp_path):
    root = f"{tmp_path}/dim"
    none = spark.createDataFrame([], SCHEMA)
    assert D.merge_snapshots(spark, root, none, "k", ["a", "b"]) is None and D.read_dimension(spark, root) is None
    df = spark.createDataFrame([("p", "x", 1, DAYS[0]), ("p", "x", 2, DAYS[0]), ("p", "z", 9, None), ("p", "y", 1, DAYS[3])], SCHEMA)
    D.merge_snapshots(spark, root, df, "k", ["a", "b"])
    assert sorted(rows(D.read_dimension(spark, root))) == [("p", "x", 2, DAYS[0], DAYS[3] - timedelta(days=1), False), ("p", "y", 1, DAYS[3], None, True)]
    D.merge_snapshots(spark, root, none, "k", ["a", "b"], dates=[DAYS[5]], close=True)
    assert ("p", "y", 1, DAYS[3], DAYS[5] - timedelta(days=1), False) in rows(D.read_dimension(spark, root))
    facts = spark.createDataFrame([("p", DAYS[1], "f"), ("p", DAYS[5], "g"), ("q", DAYS[1], "h"), ("p", None, "i")], "k string, on date, a string")
    got = {r.a: (r.a_then, r.b) for r in D.at_date(facts, D.read_dimension(spark, root), "k", "on").collect()}
    assert got == {"f": ("x", 2), "g": (None, None), "h": (None, None), "i": (None, None)}
