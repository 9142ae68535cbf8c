"""Layer IO (IO1-IO4, IO6): raw / staging / curated folders of tables.

A layer is a folder with one table per sub-folder (Parquet) or per ``<stem>.csv``
file (the raw landing format). Reads use explicit schemas (no inference); writes
overwrite only the partitions they touch (dynamic partition overwrite, set by
:func:`waferline.session.get_spark`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from waferline.sources.schemas import RAW_TABLES
from waferline.sources.tables import FabTables

LAYERS = ("raw", "staging", "curated")


def _path(root: str, layer: str, table: str, fmt: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}" + (".csv" if fmt == "csv" else "")


def read_table(spark: SparkSession, root: str, layer: str, table: str,
               fmt: str = "parquet") -> DataFrame | None:
    path = _path(root, layer, table, fmt)
    try:
        if fmt == "csv":
            schema = RAW_TABLES[table][0] if table in RAW_TABLES else None
            r = spark.read.option("header", True)
            return (r.schema(schema) if schema is not None else r).csv(path)
        return spark.read.parquet(path)
    except AnalysisException as e:          # missing table -> absent, like an empty folder
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return None
        raise


def list_tables(spark: SparkSession, root: str, layer: str, fmt: str = "parquet") -> list[str]:
    """Names of the tables in a layer's folder (``<name>.csv`` files or folders; for
    Parquet, sub-folders), on whatever file system it lies."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{layer}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [(st.getPath().getName(), st.isDirectory()) for st in fs.listStatus(path)]
    if fmt == "csv":
        return sorted(n[:-4] for n, _ in names if n.endswith(".csv"))
    return sorted(n for n, folder in names if folder and not n.startswith(("_", ".")) and not n.endswith(".csv"))


def read_layer(spark: SparkSession, root: str, layer: str, fmt: str = "parquet",
               tables=None) -> dict[str, DataFrame]:
    """IO1: every table in the layer's folder, keyed by name (known ones with their schema);
    ``tables`` restricts them, and missing ones are skipped."""
    names = list(tables) if tables is not None else list_tables(spark, root, layer, fmt)
    out = {}
    for n in names:
        df = read_table(spark, root, layer, n, fmt)
        if df is not None:
            out[n] = df
    return out


def write_layer(df: DataFrame, root: str, layer: str, table: str, partition_by=None,
                fmt: str = "parquet", mode: str = "overwrite") -> str:
    """IO2/IO3/IO4: write one table; ``partition_by`` e.g. ``["event_date"]``."""
    path = _path(root, layer, table, "parquet" if fmt != "csv" else "csv")
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)
    return path


def with_event_date(df: DataFrame, ts: str = "event_timestamp", name: str = "event_date") -> DataFrame:
    """Raw-layer partition column (IO3): the event's calendar date."""
    return df.withColumn(name, F.to_date(ts))


#: Date partitions of the two large facts (IO3/IO4): column and the time it comes from.
PARTITIONS = {"fact_equipment_events": ("event_date", "event_timestamp"), "fact_wafer_tests": ("test_date", "test_timestamp")}


def write_curated(t: FabTables, root: str) -> None:
    for name, df in t.as_dict().items():
        part, ts = PARTITIONS.get(name, (None, None))
        write_layer(with_event_date(df, ts, part) if part else df, root, "curated", name, partition_by=[part] if part else None)


def read_curated(spark: SparkSession, root: str) -> FabTables:
    d = read_layer(spark, root, "curated", tables=list(FabTables.__dataclass_fields__))
    return FabTables(**d)


def store_results(results: DataFrame, root: str, run_date, layer: str) -> str:
    """IO6: store rule results, partitioned by run date and layer; a re-run of a date and
    layer replaces its rows."""
    out = (results.drop("layer").withColumn("run_date", F.lit(str(run_date)).cast("date"))
           .withColumn("layer", F.lit(layer)))
    path = f"{root.rstrip('/')}/dq_results"
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_date", "layer").parquet(path))
    return path


def store_watermarks(state: DataFrame, root: str) -> int:
    """Keep the incremental loads' marks (PL5): a new version beside the old ones, so that a
    failed write leaves the last good one. Returns its number."""
    spark = state.sparkSession
    done = [int(n.split("=")[1]) for n in list_tables(spark, root, "watermarks") if n.startswith("version=")]
    version = max(done, default=0) + 1
    state.write.mode("overwrite").parquet(f"{root.rstrip('/')}/watermarks/version={version}")
    return version


def read_watermarks(spark: SparkSession, root: str) -> DataFrame | None:
    """The last stored marks, or None before the first load."""
    done = [int(n.split("=")[1]) for n in list_tables(spark, root, "watermarks") if n.startswith("version=")]
    return spark.read.parquet(f"{root.rstrip('/')}/watermarks/version={max(done)}") if done else None
