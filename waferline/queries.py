"""The registered queries, with the parameters used on the driver tables.

Defaults are the reference constants; where the driver tables need a different
constant (SURVEY §7.3), a second key carries it and the default stays registered.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from waferline.plans import yields as Y
from waferline.registry import query

query("y1_yield_by_equipment")(Y.y1_yield_by_equipment)
query("y2_yield_trend")(Y.y2_yield_trend)
query("y3_step_failure")(Y.y3_step_failure)
query("y4_batch_yield")(Y.y4_batch_yield)
query("y5_defect_pareto")(Y.y5_defect_pareto)
query("y6_first_pass_yield")(Y.y6_first_pass_yield)
query("y7_utilization_yield_corr")(Y.y7_utilization_yield_corr)
query("r1_yield_tool_step")(Y.r1_yield_tool_step)

from waferline.plans import equipment as E  # noqa: E402

query("e1_uptime")(E.e1_uptime)
query("e2_mtbf")(E.e2_mtbf)
query("e3_alarm_severity")(E.e3_alarm_severity)
query("e4_degradation")(E.e4_degradation)
query("e5_maintenance_effect")(E.e5_maintenance_effect)
query("e6_criticality")(E.e6_criticality)
query("r2_health_status")(E.r2_health_status)

from waferline.plans import trace as B  # noqa: E402

query("b1_wafer_trace")(B.b1_wafer_trace)
# One wafer, one lot: the form in which the trace is mostly asked for.
query("b1_wafer_trace_one")(lambda t: B.b1_wafer_trace(
    t, [t.fact_wafer_tests.agg(F.min("wafer_id")).first()[0]]))
query("b6_lot_trace_one")(lambda t: B.b6_lot_trace(
    t, lots=[t.dim_wafer_batches.agg(F.min("lot_number")).first()[0]]))
query("b2_batch_root_cause")(B.b2_batch_root_cause)
# Driver tables: wafers repeat steps, so the wafer-denominator yield is far above 100 %
# and no batch is below 85; the test-row denominator with threshold 90.
query("b2_batch_root_cause_tests")(
    lambda t: B.b2_batch_root_cause(t, max_yield=90, denominator="tests"))
query("b3_failing_routes")(B.b3_failing_routes)
# Driver tables have no route shared by 5 failed wafers.
query("b3_failing_routes_min1")(lambda t: B.b3_failing_routes(t, min_wafers=1))
query("b4_first_failure_step")(B.b4_first_failure_step)
query("b5_yield_autocorrelation")(B.b5_yield_autocorrelation)
query("b6_lot_trace")(B.b6_lot_trace)
query("b6_lot_trace_tests")(lambda t: B.b6_lot_trace(t, denominator="tests"))
query("b7_contamination")(B.b7_contamination)
query("r3_wafer_lineage")(B.r3_wafer_lineage)
query("x5_route_explode")(B.x5_route_explode)
query("x6_route_conformance")(B.x6_route_conformance)

from waferline.plans import quality as Q  # noqa: E402


def _dq(rid):
    return lambda t: Q.as_text(Q.run_checks(t, rule_ids=[rid])).drop("layer")


for _r in Q.RULES:
    query(_r.rule_id.lower())(_dq(_r.rule_id))
query("dq_results")(lambda t: Q.as_text(Q.run_checks(t)))
query("dq_results_raw")(lambda t: Q.as_text(Q.run_checks(t, layer="raw")))
query("dq_summary")(lambda t: Q.summary(Q.run_checks(t)))
query("dq_issues")(lambda t: Q.as_text(Q.issues(Q.run_checks(t))))
query("dq_gate")(lambda t: Q.gate(Q.run_checks(t)).select(
    "promote", *[F.array_join(c, ",").alias(c) for c in ("blocking_rules", "warning_rules")]))

from waferline.plans import layer_queries as LQ  # noqa: E402
from waferline.plans import layers as L  # noqa: E402

for _n in ("pl1_standardize", "pl2_dedupe", "pl3_incremental", "pl3_watermark", "pl4_lookback",
           "pl5_watermark", "pl6_upsert", "pl8_scd2", "pl10_dq_warning", "c8_sampled_checks",
           "c9_incremental_checks", "c10_violation_trend", "c12_clean_batch_share"):
    query(_n)(getattr(LQ, _n))
for _n in ("pl6_write_upsert", "pl6_versioned_upsert", "pl7_conformed", "pl11_backfill", "pl9_kept_yield", "pl9_kept_uptime", "pl_incremental_run", "c3_isolated"):
    query(_n)(getattr(LQ, _n))
for _n in ("pl8_kept_dimension", "pl8_kept_dimension_closed", "c8_estimated_checks", "c10_stored_trend", "io_raw_landing"):
    query(_n)(getattr(LQ, _n))

from waferline.sources.dirty import dirty_tables  # noqa: E402

# The same plans over tables with faults, where every rule fires.
query("dq_results_dirty")(lambda t: Q.as_text(Q.run_checks(dirty_tables(t))))
query("e6_criticality_dirty")(lambda t: E.e6_criticality(dirty_tables(t)))
query("pl1_rejects")(lambda t: LQ.pl1_rejects(dirty_tables(t)))
query("pl10_dq_warning_dirty")(lambda t: LQ.pl10_dq_warning(dirty_tables(t)))
query("c10_violation_trend_dirty")(lambda t: LQ.c10_violation_trend(dirty_tables(t)))
query("c12_clean_batch_share_dirty")(lambda t: LQ.c12_clean_batch_share(dirty_tables(t)))
query("pl9_kept_yield_dirty")(lambda t: LQ.pl9_kept_yield(dirty_tables(t)))
query("pl7_conformed_dirty")(lambda t: LQ.pl7_conformed(dirty_tables(t)))
query("pl11_backfill_dirty")(lambda t: LQ.pl11_backfill(dirty_tables(t)))
query("c8_estimated_checks_dirty")(lambda t: LQ.c8_estimated_checks(dirty_tables(t)))
query("c10_stored_trend_dirty")(lambda t: LQ.c10_stored_trend(dirty_tables(t)))
query("io_raw_landing_dirty")(lambda t: LQ.io_raw_landing(dirty_tables(t)))
query("dq_custom")(LQ.dq_custom)
query("pl9_daily_yield")(L.daily_yield)
query("pl9_daily_yield_recipe")(lambda t: L.daily_yield(t, by_recipe=True))
query("pl9_daily_uptime")(L.daily_uptime)

from waferline.plans import kpi as X  # noqa: E402

query("x1_chamber_matching")(X.x1_chamber_matching)
query("x2_executive_kpis")(X.x2_executive_kpis)
query("x3_control_limits")(X.x3_control_limits)
query("x4_yield_excursion")(X.x4_yield_excursion)

from waferline.registry import raw_query  # noqa: E402
from waferline.streaming import queries as SQ  # noqa: E402

for _n in ("s1_ingest", "s2_late_data", "s3_stream_dedupe", "s3_stream_upsert", "s4_daily_metrics", "s5_stream_checks"):
    raw_query(_n)(getattr(SQ, _n))
for _n in ("s2_two_routes", "s4_daily_metrics_kept", "s5_stateful_checks"):
    query(_n)(getattr(SQ, _n))
query("s5_stateful_checks_dirty")(lambda t: SQ.s5_stateful_checks(dirty_tables(t)))

from waferline.plans import primitives as P  # noqa: E402

for _n in ("j4_interval_lookup", "ag9_route", "sf6_yearweek", "j7_orphans", "w4_moving_avg", "w7_share",
           "w8_cumulative"):
    query(_n)(getattr(P, _n))
