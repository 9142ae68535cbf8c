"""The expensive rules on a sample of keys, with bounds.

:func:`waferline.plans.layers.sampled_checks` gives point estimates. Here a rule's violations are
added up per cluster, the key that is in the sample with all its rows or not at all (batch,
or tool for the rules about events), and the sample of clusters tells how far the estimate may
be off: a cluster sample of share f with totals y has the estimate sum(y) / f and the standard
error sqrt((1 - f) * sum(y^2)) / f. The bounds are ``z`` standard errors away, never below what the
sample itself holds. Clusters at fault of which none was drawn do not show in that error, so
the upper bound is at least that of the most clusters that a sample misses with the probability
``1 - confidence``, at the greatest total seen (one, where the sample holds no violation).
A verdict is ``UNCERTAIN`` where the rule's threshold lies between the bounds.

The tests are scanned once for the six rules about them; rows are added up per (batch, wafer,
step), (batch, wafer) and batch, each combined before its shuffle.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waferline.functions.exprs import flag, pct
from waferline.operators.routes import explode_route
from waferline.operators.sequence import keyed_lag
from waferline.plans.layers import EXPENSIVE_RULES
from waferline.plans.quality import RULE_BY_ID, Options, _rule_catalog, down_gaps_forward, verdict
from waferline.sources.tables import FabTables

UNCERTAIN = "UNCERTAIN"


def in_sample(key: str, fraction: float, salt: str = ""):
    """Keys of the sample, by a hash of the key behind ``salt`` (without one those of ``sampled_key``).
    A slash ends the salt, so that the samples of two salts never are those of other keys."""
    text = F.concat(F.lit(f"{salt}/" if salt else ""), F.coalesce(F.col(key).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 4), 16, 10).cast("long") < int(round(fraction * 65536))


def test_clusters(tests: DataFrame, t: FabTables, o: Options) -> DataFrame:
    """(rule_id, cluster, y) of the rules about tests, from one scan."""
    steps = tests.groupBy("batch_id", "wafer_id", "process_step_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("start_time").alias("lo"), F.max("start_time").alias("hi"),
        F.count_if(F.col("start_time").isNull()).alias("nulls"), F.sum(flag(F.col("pass_fail") == "PASS")).alias("passed"))
    known = t.dim_process_steps.select("process_step_id", F.lit(True).alias("known")).distinct()
    wafers = steps.join(known, "process_step_id", "left").groupBy("batch_id", "wafer_id").agg(
        F.sum("n").alias("n"), F.sum("passed").alias("passed"), F.max("n").alias("most"),
        F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0)).alias("unknown"), F.count_if(F.col("n") > 1).alias("steps_again"),
        F.array_sort(F.collect_list(F.struct("process_step_id", "lo", "hi", "nulls"))).alias("route"))
    pairs = F.transform(F.sequence(F.lit(1), F.size("route")), lambda i: F.struct(
        F.get("route", i - 2).alias("a"), F.get("route", i - 1).alias("b")))
    back = F.size(F.filter(pairs, lambda p: (p["b"]["nulls"] == 0) & (p["b"]["lo"] < p["a"]["hi"])))
    again = F.col("steps_again") if "process_step_id" in o.dq014_keys else (F.col("n") > 1).cast("long")
    has = F.col("wafer_id").isNotNull()
    batches = wafers.groupBy("batch_id").agg(
        F.sum("n").alias("n"), F.sum("passed").alias("passed"), F.sum("unknown").alias("DQ003"), F.sum(back).alias("DQ005"),
        F.sum(again).alias("DQ014"), F.sum(F.when(has, F.col("n")).otherwise(0)).alias("tested"), F.count_if(has).alias("wafers"))
    listed = t.dim_wafer_batches.select("batch_id", F.lit(True).alias("listed")).distinct()
    share, lo_hi = F.round(pct("passed", "wafers" if o.dq007_denominator == "wafers" else "tested"), 2), o.dq016_range
    y = {"DQ001": F.when(F.col("listed").isNull(), F.col("n")), "DQ003": F.col("DQ003"), "DQ005": F.col("DQ005"),
         "DQ007": F.when((share < 0) | (share > 100), 1), "DQ014": F.col("DQ014"),
         "DQ016": F.when((F.col("wafers") < lo_hi[0]) | (F.col("wafers") > lo_hi[1]), 1)}
    each = F.array(*[F.struct(F.lit(r).alias("rule_id"), v.cast("long").alias("y")) for r, v in y.items()])
    return (batches.join(listed, "batch_id", "left").select(F.col("batch_id").cast("string").alias("cluster"), F.explode(each).alias("i"))
            .select("i.rule_id", "cluster", "i.y").filter(F.col("y") > 0))


def clusters(t: FabTables, fraction: float = 1.0, options: Options | None = None, salt: str = "") -> DataFrame:
    """rule_id, cluster, y: the violations of each cluster at fault in the sample."""
    o = options or Options()
    some = lambda df, key: df.filter(in_sample(key, fraction, salt)) if fraction < 1 else df
    events, batches = some(t.fact_equipment_events, "equipment_id"), some(t.dim_wafer_batches, "batch_id")
    out = test_clusters(some(t.fact_wafer_tests, "batch_id"), t, o)

    def add(rule: str, df: DataFrame, key: str) -> None:
        nonlocal out
        out = out.unionByName(df.groupBy(F.col(key).cast("string").alias("cluster")).agg(F.count(F.lit(1)).alias("y"))
                              .select(F.lit(rule).alias("rule_id"), "cluster", "y"))

    known = t.dim_equipment.select(F.col("equipment_id").cast("string").alias("equipment_id"))
    add("DQ002", explode_route(batches).join(known, "equipment_id", "left_anti"), "batch_id")
    add("DQ015", batches.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "batch_id")
    tie = [c for c in ("ingestion_timestamp", "event_timestamp") if c != o.dq004_order]
    seq = keyed_lag(events.select("equipment_id", "event_timestamp", "ingestion_timestamp"), "equipment_id", o.dq004_order,
                    ["event_timestamp"], tie=tie, prefix="prev_")
    add("DQ004", seq.filter(F.col("event_timestamp") < F.col("prev_event_timestamp")), "equipment_id")
    gaps = down_gaps_forward(t.with_(fact_equipment_events=events)).filter(F.col("gap_hours") > o.dq017_hours)
    add("DQ017", gaps.select("equipment_id").distinct(), "equipment_id")
    return out


def bounds(found: DataFrame, by: str, fraction: float, confidence: float = 0.95) -> DataFrame:
    """by, clusters, found, estimate, std_error, low, high from clusters' totals ``y``."""
    z, f = round(NormalDist().inv_cdf((1 + confidence) / 2), 6), fraction
    hidden = math.ceil(math.log(1 - confidence) / math.log(1 - f)) if f < 1 else 0
    y = F.col("y").cast("decimal(38,0)")
    g = found.groupBy(by).agg(F.count(F.lit(1)).alias("clusters"), F.sum("y").alias("found"), F.sum(y * y).cast("double").alias("squares"),
                              F.max("y").alias("most"))
    at = F.col("found") / F.lit(float(f))
    error = F.sqrt(F.lit(1.0 - f) * F.col("squares")) / F.lit(float(f))
    return g.select(
        by, "clusters", "found", F.round(at).cast("long").alias("estimate"), F.round(error, 4).alias("std_error"),
        F.greatest(F.col("found"), F.floor(at - z * error)).alias("low"),
        F.greatest(F.ceil(at + z * error), F.col("most") * hidden).alias("high"))


def estimated_checks(t: FabTables, fraction: float, options: Options | None = None, confidence: float = 0.95, salt: str = "") -> DataFrame:
    """C8 with bounds, a row per expensive rule: rule_id, severity, threshold, clusters (at fault in
    the sample), found, estimate, std_error, low, high, status (``UNCERTAIN``: the threshold is
    between the bounds)."""
    hidden = math.ceil(math.log(1 - confidence) / math.log(1 - fraction)) if fraction < 1 else 0
    rules = _rule_catalog(t.fact_wafer_tests.sparkSession, [RULE_BY_ID[r] for r in EXPENSIVE_RULES])
    res = rules.select("rule_id", "severity", "threshold").join(
        bounds(clusters(t, fraction, options, salt), "rule_id", fraction, confidence), "rule_id", "left").fillna(
        {"clusters": 0, "found": 0, "estimate": 0, "std_error": 0.0, "low": 0, "high": hidden})
    judge = lambda n: verdict(F.col(n), F.col("threshold"), F.col("severity"), F.lit(None).cast("string"))
    return res.withColumn("status", F.when(judge("low") == judge("high"), judge("low")).otherwise(UNCERTAIN))
