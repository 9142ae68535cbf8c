"""CSV landings (IO1-IO4): typed rows into the raw layer by date, malformed lines kept apart.

:func:`waferline.sources.layers.read_table` reads CSV with a schema and turns what does not
fit into nulls. Here each line is parsed once against the schema, and a line that does not fit
(a value that is not of its type, too few or too many fields, an open quote) goes to the
quarantine with its text and file, and is not in the raw layer. Nothing else is judged: nulls
and odd values are the rules' business.

Lines end at a line feed; a quoted field with a line feed in it is two malformed lines. With
``header`` the lines that equal the schema's column names are left out, in each file. Blank lines
are left out. A load owns a folder of the raw table and of the quarantine: run again, it
replaces both, also where it no longer has such lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAD = "_malformed_line"


def read_lines(spark: SparkSession, path: str, schema: T.StructType, header: bool = False, sep: str = ",") -> DataFrame:
    """The columns of ``schema`` and, of malformed lines only, ``_malformed_line``; ``_source_file``."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_source_file")).filter(F.trim("value") != "")
    if header:
        lines = lines.filter(F.col("value") != sep.join(schema.names))
    whole = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    parsed = F.from_csv("value", _ddl(whole), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD, "sep": sep})
    return lines.select(parsed.alias("row"), "_source_file").select("row.*", "_source_file")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def land(spark: SparkSession, path: str, root: str, table: str, schema: T.StructType, load: str, date_from: str,
         date_name: str = "event_date", header: bool = False, sep: str = ",") -> None:
    """Bring the files of one load into ``raw/<table>`` (by load and by the date of ``date_from``) and
    its malformed lines into ``quarantine/<table>`` (by load)."""
    rows, base = read_lines(spark, path, schema, header, sep), root.rstrip("/")
    good = rows.filter(F.col(BAD).isNull()).select(*schema.names, F.to_date(date_from).alias(date_name))
    bad = rows.filter(F.col(BAD).isNotNull()).select(F.col(BAD).alias("line"), F.col("_source_file").alias("source_file"))
    good.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(date_name).parquet(f"{base}/raw/{table}/load={load}")
    bad.write.mode("overwrite").parquet(f"{base}/quarantine/{table}/load={load}")


def read_raw(spark: SparkSession, root: str, table: str, schema: T.StructType, date_name: str = "event_date") -> DataFrame:
    """The raw table of all loads with its partition columns ``load`` and ``date_name``; filters on these
    choose folders."""
    whole = T.StructType([*schema.fields, T.StructField("load", T.StringType()), T.StructField(date_name, T.DateType())])
    return spark.read.schema(whole).parquet(f"{root.rstrip('/')}/raw/{table}")


def read_quarantine(spark: SparkSession, root: str, table: str) -> DataFrame:
    """line, source_file, load of the malformed lines of all loads."""
    return spark.read.schema("line string, source_file string, load string").parquet(f"{root.rstrip('/')}/quarantine/{table}")
