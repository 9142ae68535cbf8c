"""Declarative data-quality rules (DQ001-DQ020) and the rule runner.

Execution model (C1): the rules about tests share one aggregate per (batch, wafer, step), so
ten rules read the tests once; the row-level predicates of any other table are fused into one
scan of it, which yields an item per broken rule; the remaining grouped, orphan (anti-join) and
metric rules are one small plan each over their own table. All items are united into one pipeline that
counts them and picks the five smallest distinct example ids per rule (``details``); the
verdict (C2) is a column expression - nothing is collected to the driver.

Rules of one's own: a :class:`Rule` with a ``predicate`` (row-level, over ``table``) or a
``builder`` (any DataFrame of ``ex``, ``w``), passed to ``run_checks(rules=...)``, is
fused, isolated and reported like the built-in ones; one with a built-in's id replaces it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waferline.functions.exprs import ts_diff, ts_lit
from waferline.operators.routes import explode_route
from waferline.operators.sequence import keyed_lag
from waferline.sources.tables import DEFAULT_AS_OF, FabTables


@dataclass(frozen=True)
class Rule:
    rule_id: str
    name: str
    category: str
    severity: str
    layer: str
    threshold: int
    impact: str
    #: Rules of one's own: a row-level predicate over ``table`` with the column that names
    #: examples, or a builder ``(tables, options) -> DataFrame(ex, w)``.
    table: str | None = None
    predicate: Column | None = None
    example: str | None = None
    builder: Callable[[FabTables, Options], DataFrame] | None = None


# The rule catalogue (id, name, category, severity, layer, threshold,
# impact) exactly as the source rule file declares them, in its order.
RULES: list[Rule] = [
    Rule("DQ001", "Wafer-to-Batch Integrity", "REFERENTIAL_INTEGRITY", "CRITICAL", "staging", 0,
         "Breaks traceability chain, blocks curated layer build"),
    Rule("DQ002", "Batch-to-Equipment Integrity", "REFERENTIAL_INTEGRITY", "CRITICAL", "staging", 0,
         "Cannot perform equipment-level yield analysis"),
    Rule("DQ003", "Process Step Validity", "REFERENTIAL_INTEGRITY", "HIGH", "staging", 0,
         "Invalid process routing analysis"),
    Rule("DQ004", "No Time Travel - Equipment Events", "TEMPORAL", "HIGH", "staging", 0,
         "Data corruption, unreliable equipment history"),
    Rule("DQ005", "Process Step Sequence Order", "TEMPORAL", "HIGH", "staging", 0,
         "Invalid process flow, audit compliance failure"),
    Rule("DQ006", "Batch Start Before End", "TEMPORAL", "CRITICAL", "staging", 0,
         "Invalid duration calculations"),
    Rule("DQ007", "Yield Percentage Bounds", "RANGE", "CRITICAL", "staging", 0,
         "Invalid business metrics, reporting errors"),
    Rule("DQ008", "Defect Density Non-Negative", "RANGE", "HIGH", "staging", 0,
         "Invalid quality metrics"),
    Rule("DQ009", "Equipment Temperature Range", "RANGE", "MEDIUM", "raw", 100,
         "Potential sensor malfunction, data quality warning"),
    Rule("DQ010", "Pressure Range Validity", "RANGE", "MEDIUM", "raw", 50,
         "Sensor calibration may be needed"),
    Rule("DQ011", "Wafer ID Not Null", "COMPLETENESS", "CRITICAL", "staging", 0,
         "Cannot perform wafer-level analysis"),
    Rule("DQ012", "Equipment ID Not Null", "COMPLETENESS", "CRITICAL", "raw", 0,
         "Cannot attribute events to equipment"),
    Rule("DQ013", "Test Result Not Null", "COMPLETENESS", "HIGH", "staging", 0,
         "Cannot calculate yield metrics"),
    Rule("DQ014", "Wafer ID Uniqueness", "UNIQUENESS", "CRITICAL", "staging", 0,
         "Duplicate test results, inflated yield calculations"),
    Rule("DQ015", "Batch ID Uniqueness", "UNIQUENESS", "CRITICAL", "staging", 0,
         "Batch data corruption"),
    Rule("DQ016", "Wafer Count Per Batch", "MANUFACTURING", "MEDIUM", "staging", 5,
         "Potential incomplete batch processing"),
    Rule("DQ017", "Equipment Downtime Reasonableness", "MANUFACTURING", "MEDIUM", "staging", 2,
         "Unreported maintenance or data gap"),
    Rule("DQ018", "Test Cycle Time Reasonableness", "MANUFACTURING", "LOW", "staging", 100,
         "Anomalous test durations - investigate equipment"),
    Rule("DQ019", "Late Arriving Data Detection", "TIMELINESS", "WARNING", "raw", 1000,
         "Monitor for systemic pipeline delays"),
    Rule("DQ020", "Data Freshness", "TIMELINESS", "HIGH", "raw", 2,
         "Potential data pipeline failure"),
]
RULE_BY_ID = {r.rule_id: r for r in RULES}


@dataclass(frozen=True)
class Options:
    as_of: object = DEFAULT_AS_OF
    dq004_order: str = "ingestion_timestamp"   # T10: "event_timestamp" reproduces the vacuous original
    dq007_denominator: str = "tests"            # the shipped checker's per-batch pass share
    dq014_keys: tuple = ("batch_id", "wafer_id")  # T2: add "process_step_id" for the fact's grain
    dq016_range: tuple = (24, 26)
    dq017_hours: int = 72
    dq017_exclude_maintained: bool = False
    dq018_range: tuple = (10, 3600)
    dq019_hours: int = 24
    examples: int = 5


def s(c) -> Column:
    return F.col(c).cast("string")


def _blank(c: str) -> Column:
    return F.col(c).isNull() | (F.col(c).cast("string") == "")


# ------------------------------------------------------------------ row predicates
# rule id -> (table, predicate, example column or None)
def row_rules(o: Options) -> dict[str, tuple[str, Column, str | None]]:
    lo, hi = o.dq018_range
    dur = ts_diff("SECOND", "start_time", "end_time")
    return {
        "DQ006": ("batches", F.col("start_time") >= F.col("end_time"), "batch_id"),
        "DQ008": ("tests", F.col("defect_density") < 0, "wafer_id"),
        "DQ009": ("events", (F.col("temperature_c") < -50) | (F.col("temperature_c") > 500), "equipment_id"),
        "DQ010": ("events", (F.col("pressure_torr") < 0.001) | (F.col("pressure_torr") > 1000), "equipment_id"),
        "DQ011": ("tests", _blank("wafer_id"), "batch_id"),
        "DQ012": ("events", _blank("equipment_id"), None),
        "DQ013": ("tests", F.col("pass_fail").isNull() | ~F.col("pass_fail").isin("PASS", "FAIL"), "wafer_id"),
        "DQ018": ("tests", (dur < lo) | (dur > hi), "wafer_id"),
        "DQ019": ("events", F.col("ingestion_timestamp") >
                  F.col("event_timestamp") + F.expr(f"INTERVAL {o.dq019_hours} HOURS"), "equipment_id"),
    }


def layer_tables(t: FabTables) -> dict[str, DataFrame]:
    """Logical rule tables -> DataFrames (staging and raw both read the given layer)."""
    return {"tests": t.fact_wafer_tests, "batches": t.dim_wafer_batches,
            "events": t.fact_equipment_events, "equipment": t.dim_equipment,
            "steps": t.dim_process_steps, "maintenance": t.maintenance_events}


# ------------------------------------------------------------------ set-based rules
# Each returns (violating items with columns `ex` string and `w` long weight).
def _items(df: DataFrame, ex: str | None, w: Column | None = None) -> DataFrame:
    return df.select((s(ex) if ex else F.lit(None).cast("string")).alias("ex"),
                     (w if w is not None else F.lit(1)).cast("long").alias("w"))


def dq001(t, o):
    return _items(t.fact_wafer_tests.join(t.dim_wafer_batches.select("batch_id"), "batch_id",
                                          "left_anti"), "batch_id")


def dq002(t, o):
    route = explode_route(t.dim_wafer_batches)
    known = t.dim_equipment.select(s("equipment_id").alias("equipment_id"))
    return _items(route.join(known, "equipment_id", "left_anti"), "batch_id")


def dq003(t, o):
    steps = t.dim_process_steps.select("process_step_id")
    return _items(t.fact_wafer_tests.join(steps, "process_step_id", "left_anti"), "wafer_id")


def dq004(t, o):
    ev = t.fact_equipment_events.select("equipment_id", "event_timestamp", "ingestion_timestamp")
    order, tie = o.dq004_order, [c for c in ("ingestion_timestamp", "event_timestamp") if c != o.dq004_order]
    seq = keyed_lag(ev, "equipment_id", order, ["event_timestamp"], tie=tie, prefix="prev_")
    g = (seq.filter(F.col("event_timestamp") < F.col("prev_event_timestamp"))
         .groupBy("equipment_id").agg(F.count(F.lit(1)).alias("violations")))
    return _items(g, "equipment_id", F.col("violations"))


def dq005_pairs(t: FabTables) -> DataFrame:
    """LAG(start_time) per wafer ordered by (step, start_time): inside one step the
    order is by start time, so only the first row of a step can be earlier than its
    predecessor, the last row of the previous step. That is exactly
    ``min(start of step) < max(start of previous step)`` - a partial aggregate per
    (wafer, step) followed by a LAG over at most route-length rows per wafer, so even
    a wafer with millions of duplicate rows stays one small group. ``last_test`` and
    ``prev_test``: the last test times of the two steps."""
    per_step = (t.fact_wafer_tests.groupBy("batch_id", "wafer_id", "process_step_id")
                .agg(F.min("start_time").alias("first_start"), F.max("start_time").alias("last_start"),
                     F.max("test_timestamp").alias("last_test"), F.count_if(F.col("start_time").isNull()).alias("nulls")))
    w = Window.partitionBy("batch_id", "wafer_id").orderBy(F.col("process_step_id").asc_nulls_first())
    seq = per_step.select("*", F.lag("last_start").over(w).alias("prev_last"), F.lag("last_test").over(w).alias("prev_test"))
    return seq.filter((F.col("nulls") == 0) & (F.col("first_start") < F.col("prev_last")))


def dq005(t, o):
    g = dq005_pairs(t).groupBy("batch_id").agg(F.count(F.lit(1)).alias("violations"))
    return _items(g, "batch_id", F.col("violations"))


def dq007(t, o):
    from waferline.plans.trace import batch_yield
    y = batch_yield(t.fact_wafer_tests, o.dq007_denominator)
    return _items(y.filter((F.col("yield_pct") < 0) | (F.col("yield_pct") > 100)), "batch_id")


def dq014(t, o):
    g = (t.fact_wafer_tests.groupBy(*o.dq014_keys).agg(F.count(F.lit(1)).alias("duplicates"))
         .filter(F.col("duplicates") > 1))
    return _items(g, "wafer_id")


def dq015(t, o):
    g = (t.dim_wafer_batches.groupBy("batch_id").agg(F.count(F.lit(1)).alias("duplicates"))
         .filter(F.col("duplicates") > 1))
    return _items(g, "batch_id")


def dq016(t, o):
    lo, hi = o.dq016_range
    g = (t.fact_wafer_tests.groupBy("batch_id").agg(F.countDistinct("wafer_id").alias("wafer_count"))
         .filter((F.col("wafer_count") < lo) | (F.col("wafer_count") > hi)))
    return _items(g, "batch_id")


def down_gaps_forward(t: FabTables) -> DataFrame:
    down = t.fact_equipment_events.filter(F.col("status") == "DOWN").select("equipment_id",
                                                                           "event_timestamp")
    nxt = keyed_lag(down, "equipment_id", "event_timestamp", ["event_timestamp"], prefix="next_",
                    direction="lead")
    return nxt.select("equipment_id", "event_timestamp", "next_event_timestamp",
                      ts_diff("HOUR", "event_timestamp", "next_event_timestamp").alias("gap_hours"))


def dq017(t, o):
    gaps = down_gaps_forward(t)
    if o.dq017_exclude_maintained:
        # The rule text: long DOWN gaps "without maintenance event" in between.
        from waferline.operators.intervals import interval_sums
        m = interval_sums(gaps.filter(F.col("next_event_timestamp").isNotNull()), t.maintenance_events,
                          "equipment_id", "event_timestamp", "next_event_timestamp", "event_timestamp",
                          {"n_maint": F.lit(1).cast("long")}, bucket_seconds=86400)
        gaps = (gaps.join(m, ["equipment_id", "event_timestamp", "next_event_timestamp"], "left")
                .filter(F.coalesce(F.col("n_maint"), F.lit(0)) == 0))
    g = (gaps.groupBy("equipment_id").agg(F.max("gap_hours").alias("downtime_hours"))
         .filter(F.col("downtime_hours") > o.dq017_hours))
    return _items(g, "equipment_id")


def dq020(t, o):
    last = t.fact_equipment_events.agg(F.max("event_timestamp").alias("m"))
    return last.select(F.lit(None).cast("string").alias("ex"),
                       ts_diff("HOUR", "m", ts_lit(o.as_of)).cast("long").alias("w"))


SET_RULES: dict[str, Callable[[FabTables, Options], DataFrame]] = {
    "DQ001": dq001, "DQ002": dq002, "DQ003": dq003, "DQ004": dq004, "DQ005": dq005,
    "DQ007": dq007, "DQ014": dq014, "DQ015": dq015, "DQ016": dq016, "DQ017": dq017,
    "DQ020": dq020,
}


# ------------------------------------------------------------------ shared grain of the test rules
#: The rules that one aggregate of the tests per (batch, wafer, step) answers.
GRAIN_RULES = ("DQ001", "DQ003", "DQ005", "DQ007", "DQ008", "DQ011", "DQ013", "DQ014", "DQ016", "DQ018")


def grain_rules(rules: list[Rule], o: Options) -> list[str]:
    """Which of ``rules`` share the grain: the built-in ones, if there are two or more."""
    out = [r.rule_id for r in rules if r.rule_id in GRAIN_RULES and r.builder is None and r.predicate is None
           and (r.rule_id != "DQ014" or set(o.dq014_keys) in ({"batch_id", "wafer_id"}, {"batch_id", "wafer_id", "process_step_id"}))]
    return out if len(out) > 1 else []


def grain_items(t: FabTables, rids: list[str], o: Options) -> DataFrame:
    """Items (rule_id, ex, w) of the test rules ``rids`` from ONE scan of the tests.

    Rows are added up per (batch, wafer, step), those per (batch, wafer), where the rules about
    rows, steps and wafers become items with their counts. Each (batch, wafer) also yields what
    it adds to its batch; items and batch parts are summed in one aggregate by example, and the
    rules about batches follow from the parts' sums. Every step is combined before its shuffle,
    so a batch or wafer with a third of all rows is a few rows from each task."""
    of_rows = {r: p for r, (table, p, _) in row_rules(o).items() if table == "tests" and r in rids and r != "DQ011"}
    keys = ["batch_id", "wafer_id", "process_step_id"]
    count = lambda c: F.count_if(c).alias
    steps = t.fact_wafer_tests.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("start_time").alias("first_start"), F.max("start_time").alias("last_start"),
        count(F.col("start_time").isNull())("nulls"), count(F.col("pass_fail") == "PASS")("passed"),
        *[count(p)(r) for r, p in of_rows.items()])
    known = t.dim_process_steps.select("process_step_id", F.lit(True).alias("known")).distinct()
    wafers = steps.join(known, "process_step_id", "left").groupBy("batch_id", "wafer_id").agg(
        F.sum("n").alias("n"), F.sum("passed").alias("passed"), F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0)).alias("DQ003"),
        count(F.col("n") > 1)("repeated_steps"), *[F.sum(r).alias(r) for r in of_rows],
        F.array_sort(F.collect_list(F.struct("process_step_id", "first_start", "last_start", "nulls"))).alias("route"))
    back = F.expr("size(filter(sequence(1, size(route)), i -> i > 1 and route[i - 1].nulls = 0 and route[i - 1].first_start < route[i - 2].last_start))")
    repeated = F.col("repeated_steps") if "process_step_id" in o.dq014_keys else (F.col("n") > 1).cast("long")
    batch, wafer, has_wafer = s("batch_id"), s("wafer_id"), F.col("wafer_id").isNotNull()
    weights = {"DQ003": (wafer, F.col("DQ003")), "DQ005": (batch, back), "DQ011": (batch, F.when(_blank("wafer_id"), F.col("n")).otherwise(0)),
               "DQ014": (wafer, repeated), **{r: (wafer, F.col(r)) for r in of_rows}}
    zero = F.lit(0).cast("long")

    def item(rid, ex, w, n=zero, passed=zero, with_wafer=zero, wafer_count=zero):
        return F.struct(F.lit(rid).alias("rule_id"), ex.alias("ex"), w.cast("long").alias("w"), n.alias("n"), passed.alias("passed"),
                        with_wafer.alias("with_wafer"), wafer_count.alias("wafer_count"))

    found = [F.when(w > 0, item(r, ex, w)) for r, (ex, w) in weights.items() if r in rids]
    found.append(item("batch", batch, zero, F.col("n"), F.col("passed"), F.when(has_wafer, F.col("n")).otherwise(0).cast("long"), has_wafer.cast("long")))
    each = wafers.select(F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("i")).select("i.*")
    sums = each.groupBy("rule_id", "ex").agg(*[F.sum(c).alias(c) for c in ("w", "n", "passed", "with_wafer", "wafer_count")])
    batches = t.dim_wafer_batches.select(F.lit("batch").alias("rule_id"), s("batch_id").alias("ex"), F.lit(True).alias("listed")).distinct()
    of_batch, lo_hi = F.col("rule_id") == "batch", o.dq016_range
    share = F.round(F.try_divide(F.lit(100.0) * F.col("passed").cast("double"),
                                 F.col("wafer_count" if o.dq007_denominator == "wafers" else "with_wafer").cast("double")), 2)
    rules = {"DQ001": F.when(F.col("listed").isNull(), F.col("n")), "DQ007": F.when((share < 0) | (share > 100), 1),
             "DQ016": F.when((F.col("wafer_count") < lo_hi[0]) | (F.col("wafer_count") > lo_hi[1]), 1)}
    out = F.when(of_batch, F.array(*[F.struct(F.lit(r).alias("rule_id"), w.cast("long").alias("w")) for r, w in rules.items() if r in rids]
                                   or [F.struct(F.lit("").alias("rule_id"), F.lit(None).cast("long").alias("w"))])
                 ).otherwise(F.array(F.struct("rule_id", "w")))
    return (sums.join(batches, ["rule_id", "ex"], "left").select("ex", F.explode(out).alias("i")).filter(F.col("i.w").isNotNull())
            .select("i.rule_id", "ex", "i.w"))


def _rule_catalog(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    from waferline.sources.driver import literal_table
    rows = [(r.rule_id, r.name, r.category, r.severity, r.layer, r.threshold, r.impact) for r in rules]
    return literal_table(spark, rows, "rule_id string, rule_name string, category string, severity string, "
                                      "layer string, threshold bigint, impact string")


def violation_stream(t: FabTables, rules: list[Rule], o: Options) -> DataFrame:
    """All violating items of the rules as one stream (rule_id, ex, w, err).

    The row-level rules of a table are evaluated in ONE scan of it: each row yields
    one item per rule it breaks (rows that break nothing yield nothing). A rule whose plan
    cannot be built yields one item with its error text, and the others still run."""
    tabs = layer_tables(t)
    built_in = row_rules(o)
    row: dict[str, tuple[str, Column, str | None]] = {}
    sets: dict[str, Callable[[FabTables, Options], DataFrame]] = {}
    parts: list[DataFrame] = []
    shared = grain_rules(rules, o)
    if shared:
        try:
            parts.append(grain_items(t, shared, o).withColumn("err", F.lit(None).cast("string")))
        except Exception:  # noqa: BLE001 - a column is missing: each rule by itself, to isolate it
            shared = []
    for r in rules:
        if r.rule_id in shared:
            continue
        if r.builder is not None:
            sets[r.rule_id] = r.builder
        elif r.predicate is not None:
            row[r.rule_id] = (r.table, r.predicate, r.example)
        elif r.rule_id in built_in:
            row[r.rule_id] = built_in[r.rule_id]
        else:
            sets[r.rule_id] = SET_RULES[r.rule_id]
    by_table: dict[str, list[str]] = {}
    for rid, (table, _, _) in row.items():
        by_table.setdefault(table, []).append(rid)
    spark = t.fact_wafer_tests.sparkSession
    none = F.lit(None).cast("string")

    def row_items(table: str, rids: list[str]) -> DataFrame:
        # A NULL predicate is no violation; flags and examples leave the scan as arrays.
        broken = F.filter(F.array(*[F.when(row[r][1], F.struct(
            F.lit(r).alias("rule_id"), (s(row[r][2]) if row[r][2] else none).alias("ex"))) for r in rids]),
            lambda x: x.isNotNull())
        out = (tabs[table].select(F.explode(broken).alias("i"))
               .select("i.rule_id", "i.ex", F.lit(1).cast("long").alias("w"), none.alias("err")))
        out.schema          # analyse now, so a broken rule is caught here (C3)
        return out

    def error_item(rid: str, e: Exception) -> DataFrame:
        return spark.createDataFrame([(rid, None, None, f"Error: {e}")], "rule_id string, ex string, w long, err string")

    for table, rids in by_table.items():
        try:
            parts.append(row_items(table, rids))
        except Exception:  # noqa: BLE001 - isolate the failing rule(s), keep the others fused
            ok = []
            for r in rids:
                try:
                    row_items(table, [r])
                    ok.append(r)
                except Exception as e:  # noqa: BLE001
                    parts.append(error_item(r, e))
            if ok:
                parts.append(row_items(table, ok))
    for rid, build in sets.items():
        try:
            items = build(t, o).select(F.lit(rid).alias("rule_id"), F.col("ex").cast("string").alias("ex"),
                                       F.col("w").cast("long").alias("w"), none.alias("err"))
            items.schema
            parts.append(items)
        except Exception as e:  # noqa: BLE001
            parts.append(error_item(rid, e))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


EXAMPLE_BUCKETS = 1024


def rule_outcomes(t: FabTables, rules: list[Rule], o: Options) -> DataFrame:
    """(rule_id, violations, details, error) for the rules that have any item. A metric
    without a value (DQ020 on an empty table) has NULL violations.

    One linear pipeline over the items:
    1. partial aggregate per (rule, example id) - shuffled on the id, so no rule is
       concentrated in one task;
    2. a window per (rule, hash bucket of the id) - each bucket's total weight and
       its k smallest ids (a bucket holds 1/EXAMPLE_BUCKETS of a rule's ids);
    3. per rule: the sum of the bucket totals and the k smallest of the at most
       k * EXAMPLE_BUCKETS surviving ids."""
    items = violation_stream(t, rules, o)
    per_ex = items.groupBy("rule_id", "ex").agg(F.sum("w").alias("w"), F.max("err").alias("err"))
    k = max(o.examples, 1)
    bucket = Window.partitionBy("rule_id", F.pmod(F.hash("ex"), F.lit(EXAMPLE_BUCKETS)))
    ranked = per_ex.select("rule_id", "ex", "err",
                           F.row_number().over(bucket.orderBy(F.col("ex").asc_nulls_last())).alias("_r"),
                           F.sum("w").over(bucket).alias("_bucket_w"))
    kept = ranked.filter(F.col("_r") <= k)
    details = (F.slice(F.array_sort(F.collect_list("ex")), 1, o.examples) if o.examples
               else F.array().cast("array<string>"))
    return kept.groupBy("rule_id").agg(
        F.sum(F.when(F.col("_r") == 1, F.col("_bucket_w"))).alias("violations"),
        details.alias("details"), F.max("err").alias("error"), F.lit(True).alias("found"))


def verdict(violations: Column, threshold: Column, severity: Column, error: Column | None = None) -> Column:
    """An error -> ERROR; <= threshold -> PASS; CRITICAL/HIGH -> FAIL; otherwise
    WARNING. NULL violations (a metric without a value) never pass."""
    failed = F.lit(False) if error is None else error.isNotNull()
    return (F.when(failed, "ERROR").when(violations <= threshold, "PASS")
            .when(severity.isin("CRITICAL", "HIGH"), "FAIL").otherwise("WARNING"))


def chosen_rules(layer: str | None, rule_ids: list[str] | None, rules: list[Rule] | None) -> list[Rule]:
    catalogue = {r.rule_id: r for r in [*RULES, *(rules or [])]}
    return [r for r in catalogue.values()
            if (layer is None or r.layer == layer) and (rule_ids is None or r.rule_id in rule_ids)]


def run_checks(t: FabTables, layer: str | None = None, rule_ids: list[str] | None = None,
               options: Options | None = None, rules: list[Rule] | None = None) -> DataFrame:
    """Result rows (rule_id, rule_name, category, severity, status, violations,
    threshold, impact, details, layer) for the selected rules (``layer`` equal, as
    the three layer names make the reference's substring test an equality). ``rules`` adds
    rules of one's own to the catalogue, or replaces built-in ones of the same id. A rule in
    error has -1 violations and its whole error text as details."""
    o = options or Options()
    chosen = chosen_rules(layer, rule_ids, rules)
    spark = t.fact_wafer_tests.sparkSession
    if not chosen:
        return _rule_catalog(spark, RULES[:1]).filter(F.lit(False)).select(
            "*", F.lit(None).cast("string").alias("status"), F.lit(None).cast("long").alias("violations"),
            F.array().cast("array<string>").alias("details"))
    return _judged(_rule_catalog(spark, chosen), rule_outcomes(t, chosen, o))


def _judged(catalogue: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Result rows of a rule list (a literal table) and its rules' outcomes."""
    res = F.broadcast(catalogue).join(outcomes, "rule_id", "left")
    v = F.when(F.col("found"), F.col("violations")).otherwise(0).cast("long")
    return res.select(
        "rule_id", "rule_name", "category", "severity",
        verdict(v, F.col("threshold"), F.col("severity"), F.col("error")).alias("status"),
        F.when(F.col("error").isNotNull(), F.lit(-1).cast("long")).otherwise(v).alias("violations"), "threshold", "impact",
        F.when(F.col("error").isNotNull(), F.array("error"))
        .otherwise(F.coalesce("details", F.array().cast("array<string>"))).alias("details"), "layer",
    ).orderBy("rule_id")


OUTCOME = "rule_id string, violations bigint, details array<string>, error string, found boolean"


def run_isolated(t: FabTables, layer: str | None = None, rule_ids: list[str] | None = None,
                 options: Options | None = None, rules: list[Rule] | None = None) -> DataFrame:
    """C3 at run time: :func:`run_checks`, run now, where a rule that fails while it runs (an
    ANSI cast, a division by zero) is ERROR with its message and takes no other rule with it.

    The rules run fused, as ever. When a group fails, its halves run, until the guilty rules
    are alone: one of n rules in error costs about 2 log2(n) smaller runs, none costs nothing.
    A rule's outcome is one row of at most ``examples`` ids, so outcomes are collected."""
    o = options or Options()
    spark = t.fact_wafer_tests.sparkSession
    chosen = chosen_rules(layer, rule_ids, rules)
    if not chosen:
        return run_checks(t, layer, rule_ids, o, rules)

    def outcomes(group: list[Rule]) -> list[tuple]:
        try:
            return [tuple(r) for r in rule_outcomes(t, group, o).select("rule_id", "violations", "details", "error", "found").collect()]
        except Exception as e:  # noqa: BLE001 - whatever a rule raises is that rule's result
            if len(group) == 1:
                return [(group[0].rule_id, None, [], f"Error: {e}", True)]
            half = len(group) // 2
            return outcomes(group[:half]) + outcomes(group[half:])

    return _judged(_rule_catalog(spark, chosen), spark.createDataFrame(outcomes(chosen), OUTCOME))


def as_text(results: DataFrame) -> DataFrame:
    """Results with ``details`` rendered as one comma-separated string."""
    return results.withColumn("details", F.array_join("details", ", "))


# ------------------------------------------------------------------ reports
def summary(results: DataFrame) -> DataFrame:
    """C4: number of rules per layer and status."""
    return (results.groupBy("layer", "status").agg(F.count(F.lit(1)).alias("rules"))
            .orderBy("layer", "status"))


SEVERITIES = ["CRITICAL", "HIGH", "MEDIUM", "LOW", "WARNING"]


def severity_rank(c) -> Column:
    return F.array_position(F.array(*[F.lit(x) for x in SEVERITIES]), F.col(c) if isinstance(c, str) else c)


def issues(results: DataFrame) -> DataFrame:
    """Failed and warned rules, most severe first."""
    return (results.filter(F.col("status").isin("FAIL", "WARNING", "ERROR"))
            .orderBy(severity_rank("severity"), "rule_id"))


def gate(results: DataFrame) -> DataFrame:
    """C7/PL10 promotion gate: one row; ``promote`` is false if any CRITICAL rule failed."""
    crit = F.col("severity") == "CRITICAL"
    bad = crit & (F.col("status") == "FAIL")
    return results.agg(
        (F.count_if(bad) == 0).alias("promote"),
        F.array_sort(F.collect_list(F.when(bad, F.col("rule_id")))).alias("blocking_rules"),
        F.array_sort(F.collect_list(F.when(~crit & F.col("status").isin("FAIL", "WARNING"),
                                           F.col("rule_id")))).alias("warning_rules"))

