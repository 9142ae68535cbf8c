"""Oracle SQL for the fleet KPIs (decimal averages emulated in integer arithmetic)."""

from waferline.oracle import hu_div, register, round_avg
from waferline.oracle.layers import CLEAN, FAULTS

PASS = "CASE WHEN pass_fail = 'PASS' THEN 1 ELSE 0 END"


def _peer(col: str, prefix: str) -> str:
    """Spark: AVG(DECIMAL(20,2)) OVER w -> scale 6, then ROUND 2 and offset ROUND 2."""
    v = f"CAST(ROUND({col} * 100) AS HUGEINT)"
    a6 = hu_div(f"SUM({v}) OVER w * 10000", f"NULLIF(COUNT({col}) OVER w, 0)")
    return (f"CAST({hu_div(a6, '10000')} AS DOUBLE) / 100.0 AS peer_{prefix}, "
            f"CAST({hu_div(f'{v} * 10000 - {a6}', '10000')} AS DOUBLE) / 100.0 AS {prefix}_offset")


register("x1_chamber_matching", f"""
WITH per AS (
  SELECT b.recipe, t.equipment_id, COUNT(*) AS tests, SUM({PASS}) AS passed,
         ROUND(100.0 * CAST(SUM({PASS}) AS DOUBLE) / COUNT(*), 2) AS yield_pct
  FROM fact_wafer_tests t JOIN dim_wafer_batches b ON t.batch_id = b.batch_id
  WHERE t.test_timestamp >= {{AS_OF}} - INTERVAL 30 DAY
  GROUP BY 1, 2
), temp AS (
  SELECT equipment_id, {round_avg("temperature_c", 2)} AS avg_temp_c
  FROM fact_equipment_events WHERE event_timestamp >= {{AS_OF}} - INTERVAL 30 DAY GROUP BY 1
), j AS (
  SELECT e.equipment_type, per.recipe, per.equipment_id, per.tests, per.yield_pct, temp.avg_temp_c
  FROM per JOIN dim_equipment e ON per.equipment_id = e.equipment_id
  LEFT JOIN temp ON per.equipment_id = temp.equipment_id
)
SELECT equipment_type, recipe, equipment_id, tests, yield_pct, avg_temp_c, COUNT(*) OVER w AS peer_tools,
       {_peer("yield_pct", "yield_pct").replace("AS yield_pct_offset", "AS yield_offset")},
       {_peer("avg_temp_c", "temp_c").replace("AS temp_c_offset", "AS temp_offset")}
FROM j WINDOW w AS (PARTITION BY equipment_type, recipe)
ORDER BY equipment_type, recipe, equipment_id
""")

_secs = "date_sub('second', start_time, end_time)"
_a4 = hu_div(f"SUM(CAST({_secs} AS HUGEINT)) * 10000", f"COUNT({_secs})")
_q15 = hu_div(f"({_a4}) * CAST(1e11 AS HUGEINT)", "60")
register("x2_executive_kpis", f"""
WITH fab AS (
  SELECT ROUND(100.0 * CAST(SUM({PASS}) AS DOUBLE) / COUNT(*), 2) AS fab_yield_pct,
         CAST({hu_div(_q15, "CAST(1e13 AS HUGEINT)")} AS DOUBLE) / 100.0 AS avg_step_minutes
  FROM fact_wafer_tests WHERE test_timestamp >= {{AS_OF}} - INTERVAL 30 DAY
), daily AS (
  SELECT CAST(test_timestamp AS DATE) AS d,
         ROUND(100.0 * CAST(SUM({PASS}) AS DOUBLE) / COUNT(*), 2) AS yield_pct
  FROM fact_wafer_tests WHERE test_timestamp >= {{AS_OF}} - INTERVAL 7 DAY GROUP BY 1
), trend AS (SELECT {round_avg("yield_pct", 2)} AS yield_7day_avg FROM daily),
batches AS (
  SELECT ROUND(COUNT(*) / 30.0, 2) AS batches_per_day FROM dim_wafer_batches
  WHERE start_time >= {{AS_OF}} - INTERVAL 30 DAY
), util AS (
  SELECT ROUND(100.0 * CAST(SUM(CASE WHEN status = 'RUNNING' THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*), 2)
           AS utilization_pct
  FROM fact_equipment_events WHERE event_timestamp >= {{AS_OF}} - INTERVAL 30 DAY
), bad AS ({FAULTS}), c AS ({CLEAN}),
clean AS (SELECT ROUND(1e2 * clean_batches / batches, 2) AS batches_passing_all_rules_pct FROM c)
SELECT fab_yield_pct, yield_7day_avg, batches_per_day, avg_step_minutes, utilization_pct,
       batches_passing_all_rules_pct
FROM fab, trend, batches, util, clean
""")

register("x3_control_limits", f"""
WITH ev AS (SELECT * FROM fact_equipment_events WHERE event_timestamp >= {{AS_OF}} - INTERVAL 30 DAY),
lim AS (
  SELECT equipment_id, COUNT(temperature_c) AS n, {round_avg("temperature_c", 3)} AS mean_temp_c,
         ROUND(STDDEV_SAMP(temperature_c), 3) AS sd_temp_c,
         AVG(temperature_c) + 3.0 * STDDEV_SAMP(temperature_c) AS ucl,
         AVG(temperature_c) - 3.0 * STDDEV_SAMP(temperature_c) AS lcl
  FROM ev GROUP BY equipment_id
)
SELECT l.equipment_id, n, mean_temp_c, sd_temp_c, ROUND(ucl, 3) AS ucl_temp_c, ROUND(lcl, 3) AS lcl_temp_c,
       (SELECT COUNT(*) FROM ev WHERE ev.equipment_id = l.equipment_id
          AND (ev.temperature_c > l.ucl OR ev.temperature_c < l.lcl)) AS out_of_control
FROM lim l ORDER BY out_of_control DESC, equipment_id
""")

register("x4_yield_excursion", f"""
WITH tb AS (
  SELECT t.*, b.lot_number FROM fact_wafer_tests t JOIN dim_wafer_batches b ON t.batch_id = b.batch_id
), lot AS (
  SELECT lot_number, COUNT(DISTINCT batch_id) AS batches, COUNT(*) AS tests, SUM({PASS}) AS passed,
         COUNT(DISTINCT equipment_id) AS tools
  FROM tb GROUP BY lot_number
), base AS (
  SELECT 100.0 * CAST(SUM({PASS}) AS DOUBLE) / COUNT(*) AS b FROM fact_wafer_tests
), win AS (
  SELECT DISTINCT t.batch_id, t.equipment_id, b.lot_number, b.start_time, b.end_time
  FROM fact_wafer_tests t JOIN dim_wafer_batches b ON t.batch_id = b.batch_id
), per_win AS (
  SELECT w.lot_number,
    (SELECT COUNT(*) FROM fact_equipment_events ee WHERE ee.equipment_id = w.equipment_id
       AND ee.status = 'ALARM' AND ee.event_timestamp BETWEEN w.start_time AND w.end_time) AS n_alarms,
    (SELECT COUNT(*) FROM maintenance_events me WHERE me.equipment_id = w.equipment_id
       AND me.event_timestamp BETWEEN w.start_time - INTERVAL 24 HOUR AND w.start_time) AS n_maint
  FROM win w
), per_lot AS (
  SELECT lot_number, CAST(SUM(n_alarms) AS BIGINT) AS alarms_during_batches,
         CAST(SUM(n_maint) AS BIGINT) AS maintenance_before_batches
  FROM per_win GROUP BY lot_number
)
SELECT lot.lot_number, batches, tests,
       ROUND(100.0 * CAST(passed AS DOUBLE) / tests, 2) AS yield_pct, ROUND(base.b, 2) AS baseline_pct,
       (ROUND(100.0 * CAST(passed AS DOUBLE) / tests - base.b, 2) + 0.0) AS deviation_pts, tools,
       COALESCE(alarms_during_batches, 0) AS alarms_during_batches,
       COALESCE(maintenance_before_batches, 0) AS maintenance_before_batches,
       100.0 * CAST(passed AS DOUBLE) / tests < base.b - 5.0 AS excursion
FROM lot LEFT JOIN per_lot ON lot.lot_number = per_lot.lot_number, base
ORDER BY deviation_pts, lot.lot_number
""")
