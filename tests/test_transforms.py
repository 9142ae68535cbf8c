"""Rows of several transform versions brought to the last one."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows

from waferline.plans import transforms as TR


def versions():
    b = F.col("b")
    return [TR.Version("v1", {"b": F.col("a") + 1}), TR.Version("v2", {"b": b * 10, "c": b}), TR.Version("v10", {"d": b + F.col("c")})]


LAST = [(1, 20, 2, 22, "v10"), (2, 30, 3, 33, "v10"), (None, None, None, None, "v10")]


def source(spark):
    return spark.createDataFrame([(1,), (2,), (None,)], "a int")


@pytest.mark.parametrize("name", ["v1", "v2", "v10", None])
def test_rows_of_any_version_come_out_alike(spark, name):
    old = TR.apply(source(spark), versions(), name) if name else source(spark)
    got = TR.backfill(old, versions())
    assert sorted(rows(got, "a", "b", "c", "d", "transform_version"), key=str) == sorted(LAST, key=str)
    assert sorted(rows(TR.backfill(got, versions()), "a", "b", "c", "d", "transform_version"), key=str) == sorted(LAST, key=str)


def test_mixed_and_unlisted_versions(spark):
    df = spark.createDataFrame([(1, 2, "v1", "x"), (1, 99, None, "y"), (1, 7, "v77", "z")], "a int, b int, transform_version string, more string")
    got = sorted(rows(TR.backfill(df, versions()), "more", "a", "b", "c", "d", "transform_version"))
    assert got == [("x", 1, 20, 2, 22, "v10"), ("y", 1, 20, 2, 22, "v10"), ("z", 1, 7, None, None, "v77")]


def test_versions_must_differ(spark):
    with pytest.raises(ValueError):
        TR.backfill(source(spark), [*versions(), *versions()])
