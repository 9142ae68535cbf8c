"""CSV landings with malformed lines."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import types as T

from conftest import rows

from waferline.sources import landing as IO

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("at", T.TimestampNTZType()), T.StructField("v", T.DoubleType()),
                       T.StructField("note", T.StringType())])
GOOD = ["1,2024-01-01 10:00:00,1.5,fine", '2,2024-01-02 10:00:00,,"a, b"', "3,,2.5,", "1,2024-01-01 10:00:00,1.5,fine"]
BAD = ["x,2024-01-01 10:00:00,1.5,word", "5,yesterday,1.5,date", "6,2024-01-01 10:00:00", "7,2024-01-01 10:00:00,1,a,b"]


def write(folder, lines, name="part.csv"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder)


def test_rows_and_lines_go_their_ways(spark, tmp_path):
    root, src = str(tmp_path / "lake"), tmp_path / "src"
    path = write(src, ["id,at,v,note", *GOOD, "", *BAD])
    write(src, ["id,at,v,note", "9,2024-01-02 00:00:00,1.0,other"], "second.csv")
    IO.land(spark, path, root, "t", SCHEMA, "1", "at", header=True)
    got = rows(IO.read_raw(spark, root, "t", SCHEMA), "id", "at", "v", "note", "load", "event_date")
    first = (1, datetime(2024, 1, 1, 10), 1.5, "fine", "1", date(2024, 1, 1))
    assert sorted(got, key=repr) == sorted([first, first, (2, datetime(2024, 1, 2, 10), None, "a, b", "1", date(2024, 1, 2)),
                                            (3, None, 2.5, None, "1", None), (9, datetime(2024, 1, 2), 1.0, "other", "1", date(2024, 1, 2))], key=repr)
    held = IO.read_quarantine(spark, root, "t").collect()
    assert sorted(r.line for r in held) == sorted(BAD) and all(r.source_file.endswith("part.csv") and r.load == "1" for r in held)
    assert IO.read_raw(spark, root, "t", SCHEMA).select("note").count() == 5             # pruned columns change no row
    assert IO.read_lines(spark, path, SCHEMA, header=True).filter(f"{IO.BAD} is null").count() == 5
    plan = IO.read_raw(spark, root, "t", SCHEMA).filter("event_date = date'2024-01-02' and load = '1'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan or "PartitionFilters: [isnotnull(load" in plan


def test_a_load_again_takes_its_place(spark, tmp_path):
    root = str(tmp_path / "lake")
    IO.land(spark, write(tmp_path / "a", GOOD + BAD), root, "t", SCHEMA, "1", "at")
    IO.land(spark, write(tmp_path / "b", GOOD[:1]), root, "t", SCHEMA, "2", "at")
    IO.land(spark, write(tmp_path / "c", GOOD[1:2]), root, "t", SCHEMA, "1", "at")
    assert sorted(rows(IO.read_raw(spark, root, "t", SCHEMA), "id", "load")) == [(1, "2"), (2, "1")]
    assert IO.read_quarantine(spark, root, "t").count() == 0
    IO.land(spark, write(tmp_path / "d", []), root, "t", SCHEMA, "2", "at")
    assert rows(IO.read_raw(spark, root, "t", SCHEMA), "id") == [(2,)]
