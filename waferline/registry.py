"""Registry of the named queries: name -> fn(spark, sf_dir) -> DataFrame.

Every registered query reads the driver tables through
:func:`waferline.sources.driver.driver_tables`, so its work grows with them.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from waferline.sources.driver import driver_tables
from waferline.sources.tables import FabTables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


_TABLES: "weakref.WeakKeyDictionary[SparkSession, dict[str, FabTables]]" = weakref.WeakKeyDictionary()


def tables_for(spark: SparkSession, sf_dir: str) -> FabTables:
    """The table definitions of a folder, defined once per session (they are lazy
    plans: defining them once is what a catalog does; no data is cached)."""
    per = _TABLES.setdefault(spark, {})
    if sf_dir not in per:
        per[sf_dir] = driver_tables(spark, sf_dir)
    return per[sf_dir]


def use_tables(spark: SparkSession, sf_dir: str, tables: FabTables) -> None:
    """Serve the registered queries of ``sf_dir`` from other table definitions (e.g.
    the curated Parquet layer written by :func:`waferline.sources.layers.write_curated`)."""
    _TABLES.setdefault(spark, {})[sf_dir] = tables


def query(name: str):
    """Decorator: register ``fn(tables) -> DataFrame`` under ``name``."""
    def deco(fn: Callable[[FabTables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tables_for(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def raw_query(name: str):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` as is."""
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def load_all() -> None:
    from waferline import queries  # noqa: F401  (registers on import)
