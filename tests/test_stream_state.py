"""State between micro-batches: rules (S5), two routes (S2), windows."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import ago, event_row, make_tables, rows, wt_row

from waferline.plans import quality as Q
from waferline.streaming import stateful as ST


def many_events():
    r, out = random.Random(3), []
    for k in range(160):
        t = ago(days=r.choice([0, 1, 2, 9, 10]), hours=r.randrange(24), minutes=r.randrange(3))
        late = None if k % 40 == 7 else t + timedelta(hours=r.choice([0, 0, 1, 20, 30]))
        row = event_row(r.choice(["T", "U", None]), None if k % 50 == 9 else t, r.choice(["RUNNING", "DOWN"]), ingest=t)
        out.append((*row[:-1], late))
    return out + out[:9]


def many_tests():
    r, out = random.Random(4), []
    for k in range(150):
        row = wt_row(r.choice(["W1", "W2", "W3", "W4", None]), r.choice(["B1", "B2", None]), r.choice([1, 2, 3, 99, None]), "T",
                     ago(days=r.randrange(3), hours=r.randrange(24)))
        out.append(row if k % 60 else (*row[:5], None, *row[6:]))
    return out


def batch_counts(t, rules):
    out = {}
    for rule in rules:
        x = Q.SET_RULES[rule](t, Q.Options()).agg(F.sum("w"), F.countDistinct("ex")).first()
        if x[0]:
            out[rule] = (x[0], x[1])
    return out


def counts(spark, root):
    return {r.rule_id: (r.violations, r.affected) for r in ST.rule_counts(spark, root).collect()}


@pytest.mark.parametrize("seed", [1])
def test_events_in_any_order_give_the_batch_rules(spark, tmp_path, seed):
    """Equal to the batch rules after every drop, with null tools and times, and a replayed drop."""
    ev, root = many_events(), str(tmp_path)
    random.Random(seed).shuffle(ev)
    sink, cut = ST.event_rules_sink(root), [0, 60, 61, len(ev)]
    for k in range(3):
        part = make_tables(spark, events=ev[cut[k]:cut[k + 1]]).fact_equipment_events
        for _ in range(2 if k == 1 else 1):
            sink(part, k)
        assert counts(spark, root) == batch_counts(make_tables(spark, events=ev[:cut[k + 1]]), ["DQ004", "DQ017"])
    assert set(counts(spark, root)) == {"DQ004", "DQ017"}


@pytest.mark.parametrize("every", [2, 16])
def test_tests_in_any_order_give_the_batch_rules(spark, tmp_path, every):
    te, root = many_tests(), str(tmp_path)
    sink, cut = ST.test_rules_sink(root, every), [0, 50, 50, 90, len(te)]      # the second drop is empty
    for k in range(4):
        part = make_tables(spark, tests=te[cut[k]:cut[k + 1]]).fact_wafer_tests
        for _ in range(2):                                                  # each one replayed
            sink(part, k)
        assert counts(spark, root) == batch_counts(make_tables(spark, tests=te[:cut[k + 1]]), ["DQ005", "DQ014"])
    assert set(counts(spark, root)) == {"DQ005", "DQ014"}


def test_an_unfinished_compaction_does_not_count(spark, tmp_path):
    te, root = many_tests(), str(tmp_path)
    sink = ST.test_rules_sink(root, 2)
    for k in range(2):
        sink(make_tables(spark, tests=te[k * 70:k * 70 + 70]).fact_wafer_tests, k)
    want = counts(spark, root)
    (tmp_path / "state/stream_steps/merged/upto=000000000001/_SUCCESS").unlink()
    assert counts(spark, root) == want


def test_nothing_arrived_and_unanswerable_options(spark, tmp_path):
    assert counts(spark, str(tmp_path)) == {}
    with pytest.raises(ValueError):
        ST.rule_items(spark, str(tmp_path), Q.Options(dq017_hours=12))


def test_routes_by_the_mark_of_each_source(spark, tmp_path):
    root, sink = str(tmp_path), ST.route_sink(str(tmp_path))
    drops = [[event_row("T", ago(hours=10)), event_row("U", ago(hours=90)), event_row(None, ago(hours=5))],
             [event_row("T", ago(hours=34)), event_row("T", ago(hours=34, seconds=1)),     # a day behind: on; beyond: late
              event_row("U", ago(hours=34, seconds=1)), event_row(None, ago(hours=40)),     # by the mark of its own source
              event_row("V", ago(days=20)), event_row("T", None, ingest=ago(hours=1))],     # a new source, no time
             [event_row("U", ago(hours=90))]]
    for k in (0, 1, 1, 2):                                                                # the second is replayed
        sink(make_tables(spark, events=drops[k]).fact_equipment_events, k)
    late = sorted(rows(ST.route(spark, root, "rescue"), "equipment_id", "event_timestamp"), key=str)
    assert late == sorted([("T", ago(hours=34, seconds=1)), (None, ago(hours=40)), ("U", ago(hours=90))], key=str)
    both = ST.route(spark, root, "main").unionByName(ST.route(spark, root, "rescue"))
    assert sorted(rows(both), key=str) == sorted(rows(make_tables(spark, events=sum(drops, [])).fact_equipment_events), key=str)
    # the look-back leaves out what the main route has loaded: U's repeated event
    back = sorted(rows(ST.rescued(spark, root, ["equipment_id", "event_timestamp"]), "equipment_id", "event_timestamp"), key=str)
    assert back == sorted([("T", ago(hours=34, seconds=1)), (None, ago(hours=40))], key=str)


def test_windows_one_file_at_a_time(spark, tmp_path):
    """A file a micro-batch, days mixed up, so that most rows are behind a watermark."""
    ev, src, root = many_events(), str(tmp_path / "in"), str(tmp_path / "kept")
    full = make_tables(spark, events=ev).fact_equipment_events
    for k in range(4):
        make_tables(spark, events=ev[k::4]).fact_equipment_events.coalesce(1).write.parquet(f"{src}/p={k}")
    (spark.readStream.schema(full.schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/p=*").writeStream
     .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).foreachBatch(ST.daily_windows_sink(root)).start().awaitTermination())
    got = sorted(rows(ST.daily_windows(spark, root), "window_start", "equipment_id", "events", "downs"), key=str)
    day = F.date_trunc("day", F.col("event_timestamp")).cast("timestamp_ntz")
    want = full.groupBy(day.alias("d"), "equipment_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "DOWN").alias("downs"))
    assert got == sorted(rows(want), key=str)
