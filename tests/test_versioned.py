"""Upserts that appear whole or not at all."""

from __future__ import annotations

import os
from datetime import date

import pytest

from conftest import rows

from waferline.sources import versioned as V

SCHEMA = "k long, day date, version long, status string"


def change(spark, root, data):
    return V.write_upsert_versioned(spark, spark.createDataFrame(data, SCHEMA), root, ["k"], ["version"], "day")


def table(spark, root, version=None):
    return sorted(rows(V.read_version(spark, root, version)), key=str)


def d(n):
    return date(2024, 1, n)


FIRST = [(None, d(1), 1, "no key"), (1, d(1), 1, "a"), (2, d(1), 1, "b"), (3, d(2), 1, "c"), (4, None, 1, "n"), (5, d(3), 1, "e")]
LATER = [(None, d(4), 2, "no key, later"), (1, d(2), 2, "moved"), (3, d(2), 0, "too old"), (4, d(4), 2, "got a day"), (6, d(2), 1, "new"), (6, d(2), 3, "newer")]
AFTER = [(None, d(4), 2, "no key, later"), (1, d(2), 2, "moved"), (2, d(1), 1, "b"), (3, d(2), 1, "c"), (4, d(4), 2, "got a day"), (5, d(3), 1, "e"), (6, d(2), 3, "newer")]


def test_merge_moves_and_repeats(spark, tmp_path):
    root = str(tmp_path / "t")
    assert V.read_version(spark, root) is None
    assert change(spark, root, FIRST) == 1 and table(spark, root) == sorted(FIRST, key=str)
    assert change(spark, root, LATER) == 2 and table(spark, root) == sorted(AFTER, key=str)
    assert change(spark, root, LATER) == 3 and table(spark, root) == sorted(AFTER, key=str)
    assert table(spark, root, 1) == sorted(FIRST, key=str)            # a reader of the old version
    held = V._listed(spark, root, 2)["partitions"]
    assert "000000000001-" in held["day=2024-01-03"]                  # not touched: not written
    assert not any(V.NULL_PARTITION in p for p in held)               # lost its only row
    assert change(spark, root, []) == 4 and table(spark, root) == sorted(AFTER, key=str)


@pytest.mark.parametrize("step", ["write", "publish"])
def test_a_change_that_dies_leaves_the_old_table(spark, tmp_path, monkeypatch, step):
    """Killed before the list of partitions is written, and between writing and renaming it."""
    root = str(tmp_path / "t")
    change(spark, root, FIRST)

    def die(*a):
        raise SystemExit

    with monkeypatch.context() as m:
        m.setattr(V._Files, step, die)
        with pytest.raises(SystemExit):
            change(spark, root, LATER)
    assert table(spark, root) == sorted(FIRST, key=str) and V.versions(spark, root) == [1]
    assert change(spark, root, LATER) == 2 and table(spark, root) == sorted(AFTER, key=str)
    folders = len(os.listdir(f"{root}/data"))
    assert len(V.drop_versions(spark, root, keep=2)) == folders - 2 and table(spark, root, 1) == sorted(FIRST, key=str)
    V.drop_versions(spark, root, keep=1)
    assert V.versions(spark, root) == [2] and table(spark, root) == sorted(AFTER, key=str)
    assert not [n for n in os.listdir(f"{root}/versions") if n.endswith(".tmp")]


def test_the_second_of_two_writers_fails_whole(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    change(spark, root, FIRST)
    inner = V._commit

    def overtaken(files, r, number, parts, schema):
        monkeypatch.setattr(V, "_commit", inner)
        change(spark, root, [(9, d(9), 1, "other writer")])
        inner(files, r, number, parts, schema)

    monkeypatch.setattr(V, "_commit", overtaken)
    with pytest.raises(RuntimeError, match="another writer"):
        change(spark, root, LATER)
    assert table(spark, root) == sorted([*FIRST, (9, d(9), 1, "other writer")], key=str)
    change(spark, root, LATER)
    assert table(spark, root) == sorted([*AFTER, (9, d(9), 1, "other writer")], key=str)


def test_empty_table_and_string_partitions(spark, tmp_path):
    root = str(tmp_path / "t")
    empty = spark.createDataFrame([], "k long, lot string, version long")
    assert V.write_upsert_versioned(spark, empty, root, ["k"], ["version"], "lot") == 1
    assert rows(V.read_version(spark, root)) == []
    for v, lot in ((1, "a:b/c d"), (2, "x%3Ay")):
        V.write_upsert_versioned(spark, spark.createDataFrame([(1, lot, v)], "k long, lot string, version long"), root, ["k"], ["version"], "lot")
        assert rows(V.read_version(spark, root)) == [(1, lot, v)]
