"""Versioned transforms and the backfill of rows that older versions wrote (PL11).

A :class:`Version` names the columns it derives, new ones or other definitions of earlier ones.
:func:`apply` derives the columns of a version for fresh rows; :func:`backfill` brings rows of
any mix of versions to the last one. Both are row-wise projections: no join, no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERSION = "transform_version"


@dataclass(frozen=True)
class Version:
    """``derive``: column -> expression over the source columns and the columns that earlier
    versions derive. Within a version every expression sees the row as it was before it."""

    name: str
    derive: Mapping[str, Column]


def _check(versions: Sequence[Version]) -> None:
    names = [v.name for v in versions]
    if not names or len(set(names)) < len(names):
        raise ValueError("versions need different names, and at least one")


def backfill(df: DataFrame, versions: Sequence[Version]) -> DataFrame:
    """``df`` with every row as the last of ``versions`` (in order) makes it.

    A row takes the steps after its ``transform_version``; one without (null, or no such column)
    takes all. Rows of a version that is not listed, say of a newer writer, stay as they are.
    Columns that ``df`` lacks are added; its other columns stay, in their order."""
    _check(versions)
    if VERSION not in df.columns:
        df = df.withColumn(VERSION, F.lit(None).cast("string"))
    unlisted = F.col(VERSION).isNotNull() & ~F.col(VERSION).isin([v.name for v in versions])
    for i, v in enumerate(versions):
        # Behind this version: no version yet, or an earlier one (the steps before may just have run).
        due = F.col(VERSION).isNull() | F.col(VERSION).isin([x.name for x in versions[:i]])
        steps = {c: F.when(due, e).otherwise(F.col(c)) if c in df.columns else F.when(due, e) for c, e in v.derive.items()}
        df = df.withColumns({**steps, VERSION: F.when(due & ~unlisted, F.lit(v.name)).otherwise(F.col(VERSION))})
    return df


def apply(df: DataFrame, versions: Sequence[Version], name: str | None = None) -> DataFrame:
    """Fresh rows as the version ``name`` (the last if None) writes them."""
    _check(versions)
    names = [v.name for v in versions]
    upto = names.index(name) + 1 if name is not None else len(names)
    return backfill(df.drop(VERSION), versions[:upto])
