import os
import tempfile
from datetime import datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import AS_OF, ago, batch_row, equipment_row, event_row, make_tables, rows, wt_row

from waferline.plans import layers as L
from waferline.plans import quality as Q


def _one(t, rid, **kw):
    r = Q.run_checks(t, rule_ids=[rid], options=Q.Options(**kw)).first()
    return r.violations, r.status, list(r.details)


def test_orphans_include_null_keys(spark):
    s = ago(days=1)
    tests = [wt_row("W1", "B1", 1, "T", s), wt_row("W2", "BX", 1, "T", s), wt_row("W3", None, 1, "T", s),
             wt_row("W4", "B1", 7, "T", s)]
    t = make_tables(spark, tests=tests, batches=[batch_row("B1", s, seq="T,U")],
                    equipment=[equipment_row("T")])
    assert _one(t, "DQ001") == (2, "FAIL", ["BX"])
    assert _one(t, "DQ002") == (1, "FAIL", ["B1"])          # planned tool U is unknown
    assert _one(t, "DQ003") == (1, "FAIL", ["W4"])          # step 7 is not a routed step


def test_pass_fail_completeness_counts_each_row_once(spark):
    s = ago(days=1)
    tests = [wt_row("W1", "B1", 1, "T", s, result=None), wt_row("W2", "B1", 1, "T", s, result=""),
             wt_row("W3", "B1", 1, "T", s, result="MAYBE"), wt_row("W4", "B1", 1, "T", s)]
    assert _one(make_tables(spark, tests=tests), "DQ013") == (3, "FAIL", ["W1", "W2", "W3"])


def test_thresholds_and_verdicts(spark):
    df = spark.createDataFrame([(5, 5, "CRITICAL", None), (6, 5, "CRITICAL", None), (6, 5, "HIGH", None), (6, 5, "MEDIUM", None),
                                (6, 5, "LOW", None), (6, 5, "WARNING", None), (-1, 5, "HIGH", None), (None, 5, "HIGH", None),
                                (0, 5, "HIGH", "Error: x")], "v long, th long, sev string, err string")
    got = [r[0] for r in df.select(Q.verdict(F.col("v"), F.col("th"), F.col("sev"), F.col("err"))).collect()]
    assert got == ["PASS", "FAIL", "FAIL", "WARNING", "WARNING", "WARNING", "PASS", "FAIL", "ERROR"]


def test_lateness_downtime_and_duration_boundaries(spark):
    t0 = ago(days=10)
    events = [event_row("A", t0, ingest=t0 + timedelta(hours=24)),
              event_row("A", t0 + timedelta(seconds=1), ingest=t0 + timedelta(hours=24, seconds=2)),
              event_row("D1", t0, "DOWN"), event_row("D1", t0 + timedelta(hours=72), "DOWN"),
              event_row("D2", t0, "DOWN"), event_row("D2", t0 + timedelta(hours=73), "DOWN")]
    tests = [wt_row(f"W{s}", "B1", 1, "T", t0, minutes=0) for s in (9, 10, 3600, 3601)]
    tests = [(w, b, st, n, tool, start, start + timedelta(seconds=int(w[1:])), r, dd, bc, tt)
             for (w, b, st, n, tool, start, _, r, dd, bc, tt) in tests]
    t = make_tables(spark, events=events, tests=tests)
    assert _one(t, "DQ019")[:1] == (1,)
    assert _one(t, "DQ017") == (1, "PASS", ["D2"])          # threshold 2
    assert _one(t, "DQ018") == (2, "PASS", ["W3601", "W9"])  # threshold 100


def test_event_order_rule_uses_arrival_order(spark):
    t0 = ago(days=2)
    events = [event_row("A", t0, ingest=t0 + timedelta(minutes=10)),
              event_row("A", t0 - timedelta(hours=1), ingest=t0 + timedelta(minutes=20))]
    t = make_tables(spark, events=events)
    assert _one(t, "DQ004")[0] == 1
    assert _one(t, "DQ004", dq004_order="event_timestamp")[0] == 0   # the rule as written never fires


def test_row_rules_of_a_table_share_one_scan(spark):
    from waferline.sources.driver import driver_tables
    t = driver_tables(spark, "/root/testdata/sf0.001")
    res = Q.run_checks(t, rule_ids=["DQ008", "DQ011", "DQ013", "DQ018"], options=Q.Options(examples=0))
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1
    assert res.count() == 4


def test_standardize_splits_rejects(spark):
    raw = spark.createDataFrame([("A1", "2024-01-01 00:00:00", "RUNNING", "1.5"),
                                 ("A2", "not a time", "RUNNING", "2"),
                                 (None, "2024-01-01 00:00:00", "IDLE", "x"),
                                 ("A3", "2024-01-02 00:00:00", "BROKEN", None)],
                                "equipment_id string, event_timestamp string, status string, temperature_c string")
    schema = T.StructType([T.StructField("equipment_id", T.StringType()),
                           T.StructField("event_timestamp", T.TimestampNTZType()),
                           T.StructField("status", T.StringType()),
                           T.StructField("temperature_c", T.DoubleType())])
    good, bad = L.standardize(raw, schema, required=["equipment_id"],
                              allowed={"status": ["RUNNING", "IDLE", "ALARM", "DOWN"]})
    assert rows(good) == [("A1", datetime(2024, 1, 1), "RUNNING", 1.5)]
    reasons = {r.equipment_id: sorted(r.reject_reasons) for r in bad.collect()}
    assert reasons == {"A2": ["cast:event_timestamp"], None: ["cast:temperature_c", "null:equipment_id"],
                       "A3": ["domain:status"]}


def test_dedupe_and_upsert_idempotent(spark):
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    target = spark.createDataFrame([("k1", 1, t1), ("k2", 2, t1)], "k string, v int, ing timestamp_ntz")
    upd = spark.createDataFrame([("k1", 10, t2), ("k3", 3, t2), ("k3", 4, t1)], "k string, v int, ing timestamp_ntz")
    once = L.upsert(target, upd, ["k"], ["ing"])
    twice = L.upsert(once, upd, ["k"], ["ing"])
    assert sorted(rows(once)) == sorted(rows(twice)) == [("k1", 10, t2), ("k2", 2, t1), ("k3", 3, t2)]


def test_write_upsert_rewrites_touched_partitions_only(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="wl-upsert-"), "events")
    schema = "k string, v int, ing timestamp_ntz, d string"
    a = spark.createDataFrame([("k1", 1, datetime(2024, 1, 1), "d1"), ("k2", 2, datetime(2024, 1, 1), "d2")], schema)
    L.write_upsert(spark, a, path, ["k"], ["ing"], "d")
    b = spark.createDataFrame([("k1", 5, datetime(2024, 1, 3), "d1"), ("k9", 9, datetime(2024, 1, 3), "d1")], schema)
    L.write_upsert(spark, b, path, ["k"], ["ing"], "d")
    L.write_upsert(spark, b, path, ["k"], ["ing"], "d")          # re-run: no duplicates
    got = sorted(rows(spark.read.parquet(path), "k", "v", "d"))
    assert got == [("k1", 5, "d1"), ("k2", 2, "d2"), ("k9", 9, "d1")]


def test_watermark_advance_and_rollback(spark):
    a, b, c = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)
    state = spark.createDataFrame([("s1", b, a), ("s2", c, b), ("s3", b, a)],
                                  "source string, current_ts timestamp_ntz, previous_ts timestamp_ntz")
    new = spark.createDataFrame([("s1", c), ("s2", a), ("s4", a)], "source string, new_ts timestamp_ntz")
    got = sorted(rows(L.advance_watermark(state, new)))
    assert got == [("s1", c, b, "ADVANCE"), ("s2", b, b, "ROLLBACK"), ("s3", b, a, "UNCHANGED"),
                   ("s4", a, None, "ADVANCE")]


def test_scd2_history(spark):
    d = [datetime(2024, 1, i).date() for i in range(1, 5)]
    snaps = spark.createDataFrame([("T", d[0], "RUNNING"), ("T", d[1], "RUNNING"), ("T", d[2], "DOWN"),
                                   ("T", d[3], "RUNNING")], "equipment_id string, snapshot_date date, status string")
    got = rows(L.scd2(snaps, "equipment_id", ["status"]).orderBy("effective_start_date"),
               "status", "effective_start_date", "effective_end_date", "current_flag")
    assert got == [("RUNNING", d[0], d[1], False), ("DOWN", d[2], d[2], False), ("RUNNING", d[3], None, True)]


def test_schema_evolution_union(spark):
    v1 = spark.createDataFrame([("A", 1.0)], "equipment_id string, temperature_c double")
    v2 = spark.createDataFrame([("B", 2.0, 0.5)], "equipment_id string, temperature_c double, rf_power_w double")
    got = sorted(rows(L.evolve([(v1, "v1"), (v2, "v2")]), "equipment_id", "rf_power_w", "transform_version"))
    assert got == [("A", None, "v1"), ("B", 0.5, "v2")]


def test_gate_blocks_on_critical_failure(spark):
    s = ago(days=1)
    t = make_tables(spark, tests=[wt_row("W1", "BX", 1, "T", s)], batches=[batch_row("B1", s)])
    g = Q.gate(Q.run_checks(t, rule_ids=["DQ001", "DQ008"])).first()
    assert g.promote is False and list(g.blocking_rules) == ["DQ001"]
    flagged = L.with_dq_warning(t.fact_wafer_tests.withColumn("defect_density", F.lit(-1.0)), "tests")
    assert rows(flagged, "dq_warning") == [(["DQ008"],)]
    assert L.promote(t.fact_wafer_tests, Q.gate(Q.run_checks(t, rule_ids=["DQ001"]))).count() == 0
    _ = AS_OF


def test_failing_rule_is_isolated_as_error(spark):
    s = ago(days=1)
    t = make_tables(spark, tests=[wt_row("W1", "B1", 1, "T", s, result="MAYBE")])
    broken = t.with_(fact_wafer_tests=t.fact_wafer_tests.drop("defect_density"))
    res = {r.rule_id: (r.status, r.violations, list(r.details))
           for r in Q.run_checks(broken, rule_ids=["DQ008", "DQ013", "DQ016"]).collect()}
    assert res["DQ008"][0] == "ERROR" and res["DQ008"][1] == -1 and res["DQ008"][2][0].startswith("Error:")
    assert res["DQ013"] == ("FAIL", 1, ["W1"])
    assert res["DQ016"][:2] == ("PASS", 1)


def test_curated_layer_roundtrip_pushes_time_filters(spark):
    from waferline.plans.yields import y1_yield_by_equipment
    from waferline.sources.driver import driver_tables
    from waferline.sources.layers import read_curated, write_curated
    root = tempfile.mkdtemp(prefix="wl-layer-")
    t = driver_tables(spark, "/root/testdata/sf0.001")
    write_curated(t, root)
    c = read_curated(spark, root)
    a = y1_yield_by_equipment(t, AS_OF, days=30, min_wafers=1)
    b = y1_yield_by_equipment(c, AS_OF, days=30, min_wafers=1)
    assert sorted(rows(a)) == sorted(rows(b))
    scan = [ln for ln in b._jdf.queryExecution().executedPlan().toString().splitlines()
            if "fact_wafer_tests" in ln and "FileScan" in ln][0]
    assert "PushedFilters: [IsNotNull(test_timestamp), GreaterThanOrEqual(test_timestamp" in scan
    from waferline.plans.equipment import e1_uptime
    plan = e1_uptime(c, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "PushedFilters: [IsNotNull(event_timestamp)" in plan
    assert sorted(rows(e1_uptime(c, AS_OF))) == sorted(rows(e1_uptime(t, AS_OF)))


def test_dq005_aggregate_form_equals_lag_form(spark):
    import random
    from pyspark.sql import Window
    rng = random.Random(3)
    base = datetime(2024, 1, 10)
    rowsx = []
    for w in range(60):
        for _ in range(rng.randrange(1, 9)):
            st = rng.randrange(1, 7)
            start = None if rng.random() < 0.05 else base + timedelta(minutes=rng.randrange(0, 400))
            rowsx.append((f"W{w}", f"B{w % 7}", st, None, "T", start, start, "PASS", 0.1, "b", start))
    t = make_tables(spark, tests=rowsx)
    got = _one(t, "DQ005")[0]
    w = Window.partitionBy("batch_id", "wafer_id").orderBy("process_step_id", "start_time")
    lagged = t.fact_wafer_tests.select("start_time", F.lag("start_time").over(w).alias("p"))
    assert got == lagged.filter(F.col("start_time") < F.col("p")).count()


def test_dq017_option_excludes_gaps_with_maintenance(spark):
    from conftest import maint_row
    t0 = ago(days=10)
    events = [event_row("D1", t0, "DOWN"), event_row("D1", t0 + timedelta(hours=80), "DOWN"),
              event_row("D2", t0, "DOWN"), event_row("D2", t0 + timedelta(hours=80), "DOWN")]
    t = make_tables(spark, events=events, maintenance=[maint_row("PM", "D1", t0 + timedelta(hours=5))])
    assert _one(t, "DQ017")[0] == 2
    assert _one(t, "DQ017", dq017_exclude_maintained=True) == (1, "PASS", ["D2"])


def test_raw_csv_layer_roundtrip_and_result_sink(spark):
    from conftest import maint_row
    from waferline.sources.layers import read_layer, store_results, write_layer
    root = tempfile.mkdtemp(prefix="wl-raw-")
    t0 = ago(days=1)
    t = make_tables(spark, events=[event_row("A", t0, "ALARM", temp=600.0)],
                    maintenance=[maint_row("PM1", "A", t0)])
    write_layer(t.fact_equipment_events, root, "raw", "equipment_logs", fmt="csv")
    write_layer(t.maintenance_events, root, "raw", "maintenance_events", fmt="csv")
    raw = read_layer(spark, root, "raw", fmt="csv")
    assert set(raw) == {"equipment_logs", "maintenance_events"}          # missing tables are skipped
    assert rows(raw["equipment_logs"], "equipment_id", "event_timestamp", "temperature_c") == [("A", t0, 600.0)]
    assert read_layer(spark, root, "staging", fmt="csv") == {}          # empty layer
    res = Q.run_checks(t, layer="raw")
    path = store_results(res, root, "2024-01-31", "raw")
    store_results(res, root, "2024-02-01", "raw")
    stored = spark.read.parquet(path)
    assert stored.count() == 2 * res.count()
    assert rows(stored.filter("rule_id = 'DQ009'").select("violations").distinct()) == [(1,)]


def test_freshness_of_empty_and_future_events(spark):
    assert _one(make_tables(spark), "DQ020")[:2] == (None, "FAIL")
    ahead = [event_row("A", AS_OF + timedelta(hours=1, minutes=30))]
    assert _one(make_tables(spark, events=ahead), "DQ020")[:2] == (-1, "PASS")
    assert _one(make_tables(spark, events=[event_row("A", ago(hours=5))]), "DQ020")[:2] == (5, "FAIL")


def test_event_order_rule_sees_null_tools_across_days(spark):
    rows_ = lambda tool: [event_row(tool, ago(days=1), ingest=ago(days=3)),
                          event_row(tool, ago(days=2), ingest=ago(days=1))]
    assert _one(make_tables(spark, events=rows_("A")), "DQ004")[0] == 1
    assert _one(make_tables(spark, events=rows_(None)), "DQ004")[0] == 1


def test_upsert_dedupes_the_first_load_and_moves_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k string, v int, ing timestamp_ntz, d string"
    at = lambda n: datetime(2024, 1, n)
    first = spark.createDataFrame([("k1", 1, at(1), "d1"), ("k1", 2, at(2), "d1"), ("k2", 1, at(1), "d1"), ("k3", 1, at(1), None)], schema)
    L.write_upsert(spark, first, path, ["k"], ["ing"], "d")
    assert sorted(rows(spark.read.parquet(path), "k", "v")) == [("k1", 2), ("k2", 1), ("k3", 1)]
    moved = spark.createDataFrame([("k1", 3, at(3), "d2"), ("k2", 2, at(3), "d2"), ("k3", 2, at(3), "d2")], schema)
    for _ in range(2):
        L.write_upsert(spark, moved, path, ["k"], ["ing"], "d")
        assert sorted(rows(spark.read.parquet(path), "k", "v", "d")) == [("k1", 3, "d2"), ("k2", 2, "d2"), ("k3", 2, "d2")]


def test_sampled_checks_judge_the_estimate(spark):
    s = ago(days=1)
    tests = [wt_row(f"W{i}", f"B{i}", 99, "T", s) for i in range(400)]
    r = L.sampled_checks(make_tables(spark, tests=tests), 0.25).filter("rule_id = 'DQ003'").first()
    assert r.status == "FAIL" and 200 < r.violations < 700 and r.violations % 4 == 0


def test_incremental_checks_see_old_neighbours(spark):
    old, new = ago(days=9), ago(days=1)
    tests = [wt_row("W1", "B1", 2, "T", old), wt_row("W1", "B1", 2, "T", new), wt_row("W2", "B1", 2, "T", old),
             wt_row("W2", "B1", 2, "T", old)]
    t = make_tables(spark, tests=tests, batches=[batch_row("B1", old)],
                    events=[event_row("D", old, "DOWN"), event_row("D", new, "DOWN")])
    got = {r.rule_id: r.violations for r in L.incremental_checks(t, ago(days=7)).collect()}
    assert got["DQ014"] == 1 and got["DQ017"] == 1 and got["DQ001"] == 0 and got["DQ016"] == 1


def test_clean_share_counts_all_batch_rules(spark):
    s = ago(days=1)
    good = [wt_row(f"W{i}", "B0", 1, "T", s) for i in range(25)]
    bad_end = ("B1", "L", "R", s, s - timedelta(hours=1), "T", 25)
    tests = good + [wt_row(f"V{i}", "B1", 1, "T", s) for i in range(25)] + [wt_row(f"U{i}", "B2", 42, "T", s) for i in range(25)]
    t = make_tables(spark, tests=tests, equipment=[equipment_row("T")], batches=[batch_row("B0", s, seq="T"), bad_end, batch_row("B2", s, seq="T")])
    assert rows(L.clean_batch_share(t)) == [(3, 1, 33.33)]


def test_errors_keep_their_whole_text_and_own_rules_run(spark):
    t = make_tables(spark, tests=[wt_row("W1", "B1", 1, "T", ago(days=1), dd=0.5)])
    def broken(tables, o):
        raise ValueError("first line\n" + "x" * 500)
    own = [Q.Rule("XX1", "n", "c", "HIGH", "staging", 0, "i", builder=broken),
           Q.Rule("XX2", "n", "c", "LOW", "staging", 0, "i", table="tests", predicate=F.col("defect_density") > 0.4, example="wafer_id")]
    got = {r.rule_id: r for r in Q.run_checks(t, rule_ids=["XX1", "XX2", "DQ008"], rules=own).collect()}
    assert got["XX1"].status == "ERROR" and got["XX1"].violations == -1 and got["XX1"].details == ["Error: first line\n" + "x" * 500]
    assert (got["XX2"].status, got["XX2"].violations, got["XX2"].details) == ("WARNING", 1, ["W1"])
    assert got["DQ008"].status == "PASS"


def test_results_and_watermarks_are_stored_once(spark, tmp_path):
    from waferline.sources import layers as IO
    t = make_tables(spark, tests=[wt_row("W1", "B1", 1, "T", ago(days=1))])
    res = Q.run_checks(t, rule_ids=["DQ008", "DQ011"])
    for day in ("2024-01-01", "2024-01-02", "2024-01-02"):
        path = IO.store_results(res, str(tmp_path), day, "staging")
    stored = spark.read.parquet(path)
    assert stored.count() == 4 and L.stored_trend(stored).filter("prev_violations = 0").count() == 2
    assert IO.read_watermarks(spark, str(tmp_path)) is None
    for n in (1, 2):
        IO.store_watermarks(spark.createDataFrame([("s", n)], "source string, current_ts long"), str(tmp_path))
    assert rows(IO.read_watermarks(spark, str(tmp_path))) == [("s", 2)]


def test_every_csv_of_a_folder_is_read(spark, tmp_path):
    from waferline.sources import layers as IO
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "extra_table.csv").write_text("a,b\n1,x\n")
    assert list(IO.read_layer(spark, str(tmp_path), "raw", "csv")) == ["extra_table"]
