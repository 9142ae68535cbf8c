"""Layer pipelines (PL1-PL11) and the rule-driven checks around them.

All functions are DataFrame -> DataFrame. Deduplication and "latest row per key"
use ``row_number() = 1``, which Spark limits to one row per key and task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
import uuid
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waferline.functions.exprs import as_datetime, flag, pct, since, ts_lit, window_start
from waferline.plans.quality import (RULE_BY_ID, RULES, SET_RULES, Options, Rule, _items, down_gaps_forward,
                                     dq005_pairs, layer_tables, row_rules, run_checks, verdict)
from waferline.session import checkpoint_dir
from waferline.sources.tables import DEFAULT_AS_OF, FabTables


# ------------------------------------------------------------------ PL1 standardize
def standardize(df: DataFrame, schema: T.StructType, renames: dict | None = None,
                required: Sequence[str] = (), allowed: dict | None = None
                ) -> tuple[DataFrame, DataFrame]:
    """Rename, cast every column to the schema with ``try_cast`` and split rows into
    (good, rejects). A row is rejected when a non-null source value does not cast,
    a required column is null, or a value is outside its allowed set. Rejects keep
    the source values and a ``reject_reasons`` array."""
    renames = renames or {}
    src = df.select(*[F.col(c).alias(renames.get(c, c)) for c in df.columns])
    casts, reasons = [], []
    for f in schema.fields:
        if f.name not in src.columns:
            casts.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        raw = F.col(f.name)
        c = F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})")
        casts.append(c.alias(f.name))
        reasons.append(F.when(raw.isNotNull() & c.isNull(), F.lit(f"cast:{f.name}")))
        if f.name in required:
            reasons.append(F.when(raw.isNull(), F.lit(f"null:{f.name}")))
        if allowed and f.name in allowed:
            reasons.append(F.when(raw.isNotNull() & ~raw.isin(list(allowed[f.name])),
                                  F.lit(f"domain:{f.name}")))
    why = F.filter(F.array(*reasons), lambda x: x.isNotNull()) if reasons else F.array()
    tagged = src.select("*", why.alias("reject_reasons"))
    good = tagged.filter(F.size("reject_reasons") == 0).select(*casts)
    rejects = tagged.filter(F.size("reject_reasons") > 0)
    return good, rejects


def as_raw_strings(df: DataFrame) -> DataFrame:
    """How a CSV landing holds a table: every column as text."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


# ------------------------------------------------------------------ PL2 dedupe
def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep one row per ``keys``: the one with the greatest ``order`` (then the
    greatest remaining columns, so exact ties resolve deterministically; NULL is least).
    ``row_number() = 1`` keeps one row per key and task before the shuffle (window group
    limit), so a hot key is no more than one row from each task."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in [*order, *rest] if c not in keys])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


# ------------------------------------------------------------------ PL3/PL4/PL5 incremental
def incremental(df: DataFrame, watermark, ts: str = "event_timestamp") -> DataFrame:
    """Rows strictly after the high-water mark."""
    return df.filter(F.col(ts) > ts_lit(watermark))


def high_water_mark(df: DataFrame, ts: str = "event_timestamp", by: Sequence[str] = ()) -> DataFrame:
    return (df.groupBy(*by) if by else df.groupBy()).agg(F.max(ts).alias("watermark"))


def lookback(df: DataFrame, loaded: DataFrame, keys: Sequence[str], watermark,
             ts: str = "event_timestamp", hours: int = 24,
             order: Sequence[str] = ("ingestion_timestamp",)) -> DataFrame:
    """PL4: re-read from ``watermark - hours`` to catch stragglers, drop the keys
    already loaded (anti join) and deduplicate the rest (PL2)."""
    lo = as_datetime(watermark) - timedelta(hours=hours)
    fresh = df.filter(F.col(ts) > ts_lit(lo)).join(loaded.select(*keys), list(keys), "left_anti")
    return dedupe_latest(fresh, keys, order)


def advance_watermark(state: DataFrame, batch_max: DataFrame, source: str = "source") -> DataFrame:
    """PL5: state (source, current_ts, previous_ts) + batch maxima (source, new_ts).
    Forward move: previous <- current, current <- new. A backward jump rolls the
    mark back to the previous value so that window is reprocessed."""
    j = state.join(batch_max, source, "full")
    cur, prev, new = F.col("current_ts"), F.col("previous_ts"), F.col("new_ts")
    action = (F.when(new.isNull(), "UNCHANGED").when(cur.isNull() | (new >= cur), "ADVANCE")
              .otherwise("ROLLBACK"))
    return j.select(
        source,
        F.when(action == "ADVANCE", new).when(action == "ROLLBACK", prev).otherwise(cur).alias("current_ts"),
        F.when(action == "ADVANCE", cur).otherwise(prev).alias("previous_ts"),
        action.alias("action"))


# ------------------------------------------------------------------ PL6 upsert
def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str],
           order: Sequence[str]) -> DataFrame:
    """Merge: the latest version of every key from target and updates. Running it
    again with the same updates gives the same table (idempotent)."""
    return dedupe_latest(target.unionByName(updates, allowMissingColumns=True), keys, order)


def write_upsert(spark, updates: DataFrame, path: str, keys: Sequence[str], order: Sequence[str],
                 partition_col: str) -> None:
    """Upsert into a Parquet table partitioned by ``partition_col``. Rewritten are the
    partitions that receive updates and those that hold an older version of an updated
    key; a partition that loses its last row is removed. Parquet cannot overwrite what it
    reads in one plan, so the merged partitions are first written to a staging path in the
    shared checkpoint folder, then swapped in with dynamic partition overwrite. Running it
    again with the same updates gives the same table."""
    stage = f"{checkpoint_dir(spark)}/upsert-{uuid.uuid4().hex}"
    try:
        target = spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        (dedupe_latest(updates, keys, order).write.mode("overwrite")
         .partitionBy(partition_col).parquet(path))   # first load
        return
    target = target.withColumn(partition_col, F.col(partition_col).cast(updates.schema[partition_col].dataType))
    held = target.join(updates.select(*keys).distinct(), list(keys), "left_semi").select(partition_col)
    touched = updates.select(partition_col).union(held).distinct()
    merged = upsert(target.join(touched.withColumnRenamed(partition_col, "_p"),
                                F.col(partition_col).eqNullSafe(F.col("_p")), "left_semi"), updates, keys, order)
    merged.write.mode("overwrite").partitionBy(partition_col).parquet(stage)
    # Partition values that lost all rows: listed from the folders (a folder per value).
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    fs = fs_path(path).getFileSystem(conf)

    def folders(root):
        f = fs_path(root).getFileSystem(conf)
        return {st.getPath().getName() for st in f.listStatus(fs_path(root)) if st.isDirectory()}

    names = touched.select(F.coalesce(F.col(partition_col).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")).alias("v"))
    gone = (folders(path) - folders(stage)) & {f"{partition_col}={r.v}" for r in names.collect()}
    staged = spark.read.schema(merged.schema).parquet(stage)
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path)
    for g in sorted(gone):
        fs.delete(fs_path(f"{path}/{g}"), True)


# ------------------------------------------------------------------ PL7 curated build
def build_curated(raw: dict[str, DataFrame]) -> FabTables:
    """Raw/staging file tables -> star schema (names of SURVEY §1.3)."""
    steps = raw["process_steps"]
    if "step_id" in steps.columns:
        steps = steps.withColumnRenamed("step_id", "process_step_id").withColumnRenamed(
            "name", "process_step_name")
    return FabTables(dim_equipment=raw["equipment_master"], dim_process_steps=steps,
                     dim_wafer_batches=raw["wafer_batches"], fact_wafer_tests=raw["test_results"],
                     fact_equipment_events=raw["equipment_logs"],
                     maintenance_events=raw["maintenance_events"])


# ------------------------------------------------------------------ PL8 SCD type 2
def scd2(snapshots: DataFrame, key: str, attrs: Sequence[str], date_col: str = "snapshot_date"
         ) -> DataFrame:
    """Type-2 history from dated snapshots: one row per run of unchanged attributes
    with ``effective_start_date``, ``effective_end_date`` (day before the next
    version; NULL while current) and ``current_flag``. The per-key windows run over
    one row per key and snapshot date (bounded by the calendar)."""
    w = Window.partitionBy(key).orderBy(date_col)
    cur = F.struct(*attrs)
    changed = snapshots.select(key, date_col, *attrs, F.lag(cur).over(w).alias("_prev")).filter(
        F.col("_prev").isNull() | (F.col("_prev") != cur))
    nxt = F.lead(date_col).over(w)
    return changed.select(
        key, *attrs, F.col(date_col).alias("effective_start_date"),
        F.date_sub(nxt, 1).alias("effective_end_date"), nxt.isNull().alias("current_flag"))


def daily_status_snapshots(t: FabTables) -> DataFrame:
    """Each tool's status at the end of every day it reported (last event of the day)."""
    ev = t.fact_equipment_events
    tie = [c for c in ("event_id",) if c in ev.columns]
    return (ev.groupBy("equipment_id", F.to_date("event_timestamp").alias("snapshot_date"))
            .agg(F.max_by("status", F.struct("event_timestamp", *tie)).alias("status")))


# ------------------------------------------------------------------ PL9 daily KPIs
def daily_yield(t: FabTables, as_of=DEFAULT_AS_OF, days: int = 30, by_recipe: bool = False) -> DataFrame:
    tests = since(t.fact_wafer_tests, "test_timestamp", as_of, days=days)
    keys = [F.to_date("test_timestamp").alias("test_date")]
    if by_recipe:
        tests = tests.join(t.dim_wafer_batches.select("batch_id", "recipe"), "batch_id")
        keys.append(F.col("recipe"))
    g = tests.groupBy(*keys).agg(F.count(F.lit(1)).alias("tests"),
                                 F.countDistinct("wafer_id").alias("wafers"),
                                 F.sum(flag(F.col("pass_fail") == "PASS")).alias("passed"))
    return g.withColumn("yield_pct", F.round(pct("passed", "tests"), 2)).orderBy(
        *[k for k in ("test_date", "recipe") if k in g.columns])


def daily_uptime(t: FabTables, as_of=DEFAULT_AS_OF, days: int = 30) -> DataFrame:
    ev = since(t.fact_equipment_events, "event_timestamp", as_of, days=days)
    st = F.col("status")
    g = (ev.groupBy("equipment_id", F.to_date("event_timestamp").alias("date"))
         .agg(F.count(F.lit(1)).alias("events"), F.sum(flag(st == "RUNNING")).alias("running"),
              F.sum(flag(st == "ALARM")).alias("alarms"), F.sum(flag(st == "DOWN")).alias("downs")))
    return g.withColumn("uptime_pct", F.round(pct("running", "events"), 2)).orderBy("equipment_id", "date")


# ------------------------------------------------------------------ PL10 / C11 row flags
def with_dq_warning(df: DataFrame, table: str, options: Options | None = None,
                    rule_ids: Sequence[str] | None = None) -> DataFrame:
    """Add ``dq_warning``: the ids of the row-level rules this row violates - by default
    those of HIGH and MEDIUM severity (CRITICAL ones block, lesser ones are only logged)."""
    rr = row_rules(options or Options())
    wanted = rule_ids if rule_ids is not None else [r.rule_id for r in RULES if r.severity in ("HIGH", "MEDIUM")]
    ids = [r for r, (tab, _, _) in rr.items() if tab == table and r in wanted]
    flags = F.filter(F.array(*[F.when(rr[r][1], F.lit(r)) for r in ids]), lambda x: x.isNotNull())
    return df.withColumn("dq_warning", flags)


def promote(df: DataFrame, gate_row: DataFrame) -> DataFrame:
    """PL10 gate: rows pass only when the gate says ``promote`` (one-row DataFrame,
    broadcast - its size is one row)."""
    return df.join(F.broadcast(gate_row.select("promote")).filter("promote"), how="left_semi")


# ------------------------------------------------------------------ PL11 schema evolution
def evolve(versions: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Union table versions by column name; columns a version lacks are NULL and
    every row records the transform version that produced it."""
    out = None
    for df, v in versions:
        d = df.withColumn("transform_version", F.lit(v))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


# ------------------------------------------------------------------ C8 sampled checks
#: The rules that need joins, groups or sequences, and so are worth sampling.
EXPENSIVE_RULES = ["DQ001", "DQ002", "DQ003", "DQ004", "DQ005", "DQ007", "DQ014", "DQ015", "DQ016", "DQ017"]


def sampled_key(key: str, fraction: float):
    """Keys of the sample: by a hash of the key (NULL: of the empty text), so that a key's
    rows are all in or all out, whatever the file layout and engine."""
    h = F.conv(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), 1, 4), 16, 10)
    return h.cast("long") < int(round(fraction * 65536))


def sampled(t: FabTables, fraction: float) -> FabTables:
    """Tests and batches of a sample of batches, events of a sample of tools."""
    return t.with_(fact_wafer_tests=t.fact_wafer_tests.filter(sampled_key("batch_id", fraction)),
                   fact_equipment_events=t.fact_equipment_events.filter(sampled_key("equipment_id", fraction)))


def sampled_checks(t: FabTables, fraction: float, options: Options | None = None) -> DataFrame:
    """The expensive rules on a key sample. Violations are estimates (scaled by the
    fraction), and the verdict follows from the estimate."""
    some = sampled(t, fraction)
    few = lambda build: lambda _, o: build(some.with_(  # noqa: E731 - rules over batches sample them too
        dim_wafer_batches=t.dim_wafer_batches.filter(sampled_key("batch_id", fraction))), o)
    own = [_with_builder(r, few(SET_RULES[r]) if r in ("DQ002", "DQ015") else (lambda _, o, b=SET_RULES[r]: b(some, o)))
           for r in EXPENSIVE_RULES]
    res = run_checks(t, rule_ids=EXPENSIVE_RULES, options=options, rules=own)
    scaled = F.when(F.col("violations") < 0, F.col("violations")).otherwise(
        F.round(F.col("violations") / F.lit(fraction)).cast("long"))
    error = F.when(F.col("status") == "ERROR", F.lit("error"))
    return (res.withColumn("violations", scaled)
            .withColumn("status", verdict(F.col("violations"), F.col("threshold"), F.col("severity"), error))
            .withColumn("estimated", F.lit(True)))


def _with_builder(rule_id: str, build) -> Rule:
    r = RULE_BY_ID[rule_id]
    return Rule(r.rule_id, r.name, r.category, r.severity, r.layer, r.threshold, r.impact, builder=build)


# ------------------------------------------------------------------ C9 incremental checks
INCREMENTAL_RULES = ["DQ001", "DQ003", "DQ004", "DQ005", "DQ007", "DQ008", "DQ009", "DQ010", "DQ011", "DQ012",
                     "DQ013", "DQ014", "DQ016", "DQ017", "DQ018", "DQ019"]


def incremental_checks(t: FabTables, watermark, options: Options | None = None) -> DataFrame:
    """The rules over fact rows newer than the mark. Row-level rules see the new rows;
    groups and sequences are judged whole (old rows included) where a new row touches them:
    a duplicate of an older row, a step before an older one, an old gap that a new event
    ends. Old rows of keys that no new row has are not read into any shuffle."""
    new = t.with_(fact_wafer_tests=incremental(t.fact_wafer_tests, watermark, "test_timestamp"),
                  fact_equipment_events=incremental(t.fact_equipment_events, watermark))
    mark = ts_lit(watermark)

    def of_touched(keys: Sequence[str], df: DataFrame, fresh: DataFrame) -> DataFrame:
        k = fresh.select(*[F.col(c).alias(f"_n{i}") for i, c in enumerate(keys)]).distinct()
        same = F.lit(True)
        for i, c in enumerate(keys):
            same = same & F.col(c).eqNullSafe(F.col(f"_n{i}"))
        return df.join(k, same, "left_semi")

    tests = lambda keys: t.with_(fact_wafer_tests=of_touched(
        keys, t.fact_wafer_tests, new.fact_wafer_tests))

    def dq004(_, o):
        from waferline.operators.sequence import keyed_lag
        ev = of_touched(["equipment_id"], t.fact_equipment_events, new.fact_equipment_events).select(
            "equipment_id", "event_timestamp", "ingestion_timestamp")
        tie = [c for c in ("ingestion_timestamp", "event_timestamp") if c != o.dq004_order]
        seq = keyed_lag(ev, "equipment_id", o.dq004_order, ["event_timestamp"], tie=tie, prefix="prev_")
        bad = seq.filter((F.col("event_timestamp") < F.col("prev_event_timestamp")) & (F.col("event_timestamp") > mark))
        return _items(bad, "equipment_id")

    def dq005(_, o):
        return _items(dq005_pairs(tests(["batch_id", "wafer_id"])).filter(
            F.greatest("last_test", "prev_test") > mark), "batch_id")

    def dq017(_, o):
        some = t.with_(fact_equipment_events=of_touched(["equipment_id"], t.fact_equipment_events,
                                                        new.fact_equipment_events))
        g = (down_gaps_forward(some).filter(F.col("next_event_timestamp") > mark)
             .groupBy("equipment_id").agg(F.max("gap_hours").alias("h")).filter(F.col("h") > o.dq017_hours))
        return _items(g, "equipment_id")

    own = [_with_builder("DQ001", lambda _, o: SET_RULES["DQ001"](new, o)),
           _with_builder("DQ003", lambda _, o: SET_RULES["DQ003"](new, o)),
           _with_builder("DQ004", dq004), _with_builder("DQ005", dq005),
           _with_builder("DQ007", lambda _, o: SET_RULES["DQ007"](tests(["batch_id"]), o)),
           _with_builder("DQ014", lambda _, o: SET_RULES["DQ014"](tests(list(o.dq014_keys)), o)),
           _with_builder("DQ016", lambda _, o: SET_RULES["DQ016"](tests(["batch_id"]), o)),
           _with_builder("DQ017", dq017)]
    return run_checks(new, rule_ids=INCREMENTAL_RULES, options=options, rules=own)


# ------------------------------------------------------------------ C10 trend
def dated_violations(t: FabTables, options: Options | None = None) -> DataFrame:
    """rule_id, date, w of every violation of every rule: the day of the test, event or
    batch start at fault; of the last test for groups of tests; of the event that ends a
    gap. DQ020 gives, for each day with events, the whole hours from its last event to
    midnight."""
    o = options or Options()
    parts = []

    def add(rule: str, df: DataFrame, ts, w=None) -> None:
        parts.append(df.select(F.lit(rule).alias("rule_id"), F.to_date(ts).alias("date"),
                               (F.lit(1) if w is None else w).cast("long").alias("w")))

    tests, events, batches = t.fact_wafer_tests, t.fact_equipment_events, t.dim_wafer_batches
    stamp = {"tests": "test_timestamp", "events": "event_timestamp", "batches": "start_time"}
    rr = row_rules(o)
    for table, ts in stamp.items():
        broken = F.filter(F.array(*[F.when(p, F.lit(r)) for r, (tab, p, _) in rr.items() if tab == table]),
                          lambda x: x.isNotNull())
        parts.append(layer_tables(t)[table].select(F.explode(broken).alias("rule_id"), F.to_date(ts).alias("date"),
                                                   F.lit(1).cast("long").alias("w")))
    add("DQ001", tests.join(batches.select("batch_id"), "batch_id", "left_anti"), "test_timestamp")
    from waferline.operators.routes import explode_route
    route = explode_route(batches).join(t.dim_equipment.select(F.col("equipment_id").cast("string").alias("equipment_id")),
                                        "equipment_id", "left_anti")
    add("DQ002", route.select("batch_id").join(batches.select("batch_id", "start_time"), "batch_id"), "start_time")
    add("DQ003", tests.join(t.dim_process_steps.select("process_step_id"), "process_step_id", "left_anti"), "test_timestamp")
    from waferline.operators.sequence import keyed_lag
    tie = [c for c in ("ingestion_timestamp", "event_timestamp") if c != o.dq004_order]
    seq = keyed_lag(events.select("equipment_id", "event_timestamp", "ingestion_timestamp"), "equipment_id",
                    o.dq004_order, ["event_timestamp"], tie=tie, prefix="prev_")
    add("DQ004", seq.filter(F.col("event_timestamp") < F.col("prev_event_timestamp")), "event_timestamp")
    add("DQ005", dq005_pairs(t), "last_test")
    per_batch = tests.groupBy("batch_id").agg(
        F.countDistinct("wafer_id").alias("wafers"), F.max("test_timestamp").alias("ts"),
        F.round(pct(F.sum(flag(F.col("pass_fail") == "PASS")), F.count("wafer_id") if o.dq007_denominator == "tests"
                    else F.countDistinct("wafer_id")), 2).alias("y"))
    add("DQ007", per_batch.filter((F.col("y") < 0) | (F.col("y") > 100)), "ts")
    lo, hi = o.dq016_range
    add("DQ016", per_batch.filter((F.col("wafers") < lo) | (F.col("wafers") > hi)), "ts")
    add("DQ014", tests.groupBy(*o.dq014_keys).agg(F.count(F.lit(1)).alias("n"), F.max("test_timestamp").alias("ts"))
        .filter("n > 1"), "ts")
    add("DQ015", batches.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.max("start_time").alias("ts"))
        .filter("n > 1"), "ts")
    add("DQ017", down_gaps_forward(t).filter(F.col("gap_hours") > o.dq017_hours), "next_event_timestamp")
    days = events.groupBy(F.to_date("event_timestamp").alias("d")).agg(F.max("event_timestamp").alias("ts"))
    left = F.timestamp_diff("HOUR", F.col("ts"), F.date_add("d", 1).cast("timestamp_ntz"))
    add("DQ020", days.filter(F.col("d").isNotNull()), "ts", left)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def violation_trend(daily: DataFrame, window_days: int = 7) -> DataFrame:
    """Per rule and day (rule_id, date, violations - stored results or
    :func:`daily_violations`) the previous day and the trailing average. The per-rule
    windows run over one row per rule and day."""
    w = Window.partitionBy("rule_id").orderBy("date")
    return daily.select(
        "rule_id", "date", "violations", F.lag("violations").over(w).alias("prev_violations"),
        F.round(F.avg("violations").over(w.rowsBetween(-(window_days - 1), 0)), 4).alias("trailing_avg"),
    ).orderBy("rule_id", "date")


def daily_violations(t: FabTables, as_of=DEFAULT_AS_OF, days: int = 30, options: Options | None = None) -> DataFrame:
    """rule_id, date, violations of every rule on every day of the window on which the
    facts have rows (0 where a rule is not broken)."""
    since_ = window_start(as_of, days=days)
    d = (t.fact_wafer_tests.filter(F.col("test_timestamp") >= since_).select(F.to_date("test_timestamp").alias("date"))
         .union(t.fact_equipment_events.filter(F.col("event_timestamp") >= since_).select(F.to_date("event_timestamp")))
         .distinct())
    zero = d.select(F.explode(F.array(*[F.lit(r.rule_id) for r in RULES])).alias("rule_id"), "date",
                    F.lit(0).cast("long").alias("w"))
    found = dated_violations(t, options).join(d, "date", "left_semi").select("rule_id", "date", "w")
    return zero.unionByName(found).groupBy("rule_id", "date").agg(F.sum("w").alias("violations"))


def stored_trend(results: DataFrame, window_days: int = 7) -> DataFrame:
    """C10 on stored results (IO6): run_date, rule_id, violations of earlier runs."""
    return violation_trend(results.select("rule_id", F.to_date("run_date").alias("date"), "violations"), window_days)


# ------------------------------------------------------------------ C12 clean batches
def batches_at_fault(t: FabTables, options: Options | None = None) -> DataFrame:
    """Distinct batch_ids that break a rule which concerns batches: their own rows (DQ002,
    DQ006, DQ015), one of their tests (DQ003, DQ008, DQ011, DQ013, DQ018) or their tests
    together (DQ005, DQ007, DQ014, DQ016)."""
    o = options or Options()
    rr = row_rules(o)
    any_of = None
    for r, (table, p, _) in rr.items():
        if table == "tests":
            any_of = p if any_of is None else any_of | p
    tests, batches = t.fact_wafer_tests, t.dim_wafer_batches
    sets = [tests.filter(any_of).select("batch_id"), batches.filter(rr["DQ006"][1]).select("batch_id"),
            tests.join(t.dim_process_steps.select("process_step_id"), "process_step_id", "left_anti").select("batch_id"),
            tests.groupBy("batch_id", *[k for k in o.dq014_keys if k != "batch_id"]).agg(F.count(F.lit(1)).alias("n"))
            .filter("n > 1").select("batch_id")]
    sets += [SET_RULES[r](t, o).select(F.col("ex").cast(tests.schema["batch_id"].dataType).alias("batch_id"))
             for r in ("DQ002", "DQ005", "DQ007", "DQ015", "DQ016")]
    out = sets[0]
    for x in sets[1:]:
        out = out.unionByName(x)
    return out.distinct()


def clean_batch_share(t: FabTables, options: Options | None = None) -> DataFrame:
    """Share of batches that break no rule which concerns batches."""
    batches = t.dim_wafer_batches.select("batch_id")
    bad = batches_at_fault(t, options).select("batch_id", F.lit(1).alias("bad"))
    n = batches.join(bad, "batch_id", "left").agg(F.count(F.lit(1)).alias("batches"),
                                                  F.count_if(F.col("bad").isNull()).alias("clean_batches"))
    return n.select("batches", "clean_batches", F.round(pct("clean_batches", "batches"), 2).alias("clean_pct"))
