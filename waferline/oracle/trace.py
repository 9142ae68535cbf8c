"""DuckDB statements for B1-B7, R3, X5 and X6.

Route: what happens inside a time window is a range join with the distinct windows and a
GROUP BY; neighbours are rank self joins; a batch's worst step is the first of an ordered list.
"""

from waferline.oracle import pick, register, round_avg, since
from waferline.plans import labels as L


def routes(keys: str, rows: str = "fact_wafer_tests") -> str:
    """Per ``keys``: each tool once, at its lowest step (ties by text)."""
    return f"""SELECT {keys}, array_to_string(list(tool ORDER BY step, tool), ',') AS route
      FROM (SELECT {keys}, equipment_id::VARCHAR AS tool, min(process_step_id) AS step FROM {rows} GROUP BY ALL)
      GROUP BY {keys}"""


def b1(only: str = "true") -> str:
    return f"""
WITH mine AS (SELECT * FROM fact_wafer_tests WHERE {only}),
     spans AS (SELECT DISTINCT equipment_id, start_time, end_time FROM mine),
     inside AS (SELECT s.equipment_id, s.start_time, s.end_time, {round_avg("e.temperature_c", 2)} AS warm,
                       {round_avg("e.pressure_torr", 3)} AS press, count(*) FILTER (e.status = 'ALARM') AS alarms
                FROM spans s JOIN fact_equipment_events e
                  ON e.equipment_id = s.equipment_id AND e.event_timestamp >= s.start_time AND e.event_timestamp <= s.end_time
                GROUP BY ALL)
SELECT t.wafer_id, b.batch_id, b.lot_number, b.recipe, b.start_time AS batch_start, b.end_time AS batch_end,
       p.process_step_id, p.process_step_name, p.equipment_type, d.equipment_id, d.manufacturer, t.start_time AS step_start,
       t.end_time AS step_end, date_sub('minute', t.start_time, t.end_time) AS duration_minutes, t.pass_fail, t.defect_density,
       t.bin_code, warm AS avg_temp_c, press AS avg_pressure_torr, coalesce(alarms, 0) AS alarms_during_process,
       {pick(L.B1_STATUS_INDICATOR, "t.pass_fail = 'FAIL'")} AS status_indicator
FROM mine t JOIN dim_process_steps p USING (process_step_id) JOIN dim_equipment d USING (equipment_id)
JOIN dim_wafer_batches b USING (batch_id)
LEFT JOIN inside i ON i.equipment_id = t.equipment_id AND i.start_time = t.start_time AND i.end_time = t.end_time
"""


register("b1_wafer_trace", b1())
register("b1_wafer_trace_one", b1("wafer_id = (SELECT min(wafer_id) FROM fact_wafer_tests)"))


def _b2(threshold: int, per: str) -> str:
    return f"""
WITH cells AS (SELECT batch_id, process_step_id AS step, equipment_id, count(*) AS n, count(*) FILTER (pass_fail = 'PASS') AS ok,
                      count(*) FILTER (pass_fail = 'FAIL') AS bad, list(wafer_id) AS ids FROM fact_wafer_tests GROUP BY ALL),
     rated AS (SELECT batch_id, round(1e2 * sum(ok) / {per}, 2) AS y FROM cells GROUP BY batch_id),
     low AS (SELECT * FROM rated JOIN dim_wafer_batches USING (batch_id) WHERE y < {threshold}),
     used AS (SELECT batch_id, equipment_id, sum(n) AS n FROM cells SEMI JOIN low USING (batch_id) GROUP BY ALL),
     alarmed AS (SELECT u.batch_id, count(DISTINCT u.equipment_id) AS k FROM used u JOIN low l USING (batch_id)
                 JOIN fact_equipment_events e ON e.equipment_id = u.equipment_id AND e.status = 'ALARM'
                  AND e.event_timestamp >= l.start_time AND e.event_timestamp <= l.end_time GROUP BY u.batch_id),
     served AS (SELECT u.batch_id, sum(u.n)::BIGINT AS k FROM used u JOIN low l USING (batch_id)
                JOIN maintenance_events m ON m.equipment_id = u.equipment_id
                 AND m.event_timestamp <= l.start_time AND m.event_timestamp >= l.start_time - INTERVAL 24 HOUR GROUP BY u.batch_id),
     failing AS (SELECT batch_id, step, sum(bad)::BIGINT AS bad FROM cells GROUP BY ALL HAVING sum(bad) > 0),
     worst AS (SELECT f.batch_id, max(f.bad) AS bad,
                      first(process_step_name ORDER BY f.bad DESC, f.step) FILTER (process_step_name IS NOT NULL) AS name
               FROM failing f LEFT JOIN dim_process_steps p ON p.process_step_id = f.step GROUP BY f.batch_id)
SELECT low.batch_id, lot_number, recipe, start_time, y AS yield_pct, coalesce(a.k, 0) AS equipment_with_alarms,
       coalesce(s.k, 0) AS recent_maintenance_count, w.name AS most_failed_step, w.bad AS failures_at_worst_step,
       {pick((L.B2_ROOT_CAUSE[0], L.B2_ROOT_CAUSE[1], L.B2_ROOT_CAUSE[2] + "@", L.B2_ROOT_CAUSE[3]),
             "a.k >= 3", "s.k >= 2", "w.bad >= 10").replace("@'", "' || w.name")} AS likely_root_cause
FROM low LEFT JOIN alarmed a ON a.batch_id = low.batch_id LEFT JOIN served s ON s.batch_id = low.batch_id
LEFT JOIN worst w ON w.batch_id = low.batch_id
"""


register("b2_batch_root_cause", _b2(85, "len(list_distinct(flatten(list(ids))))"))
register("b2_batch_root_cause_tests", _b2(90, "sum(len(list_filter(ids, lambda x: x IS NOT NULL)))"))


def _b3(least: int) -> str:
    return f"""
WITH recent AS (SELECT * FROM fact_wafer_tests WHERE {since("test_timestamp", 30)}),
     paths AS ({routes("wafer_id, batch_id", "recent")}),
     failed AS (SELECT DISTINCT wafer_id, batch_id FROM recent WHERE pass_fail = 'FAIL'),
     hits AS (SELECT route, len(list_distinct(list(wafer_id))) AS n, len(list_distinct(list(batch_id))) AS b
              FROM paths SEMI JOIN failed USING (wafer_id, batch_id) GROUP BY route)
SELECT route AS equipment_sequence, n::BIGINT AS failed_wafer_count, b::BIGINT AS affected_batches,
       round(1e2 * n / (SELECT count(DISTINCT wafer_id) FROM recent), 2) AS pct_of_all_wafers,
       {pick(L.B3_SEVERITY, "n >= 50", "n >= 20")} AS severity
FROM hits WHERE n >= {least} ORDER BY n DESC, route LIMIT 20
"""


register("b3_failing_routes", _b3(5))
register("b3_failing_routes_min1", _b3(1))

register("b4_first_failure_step", f"""
WITH recent AS (SELECT wafer_id, batch_id, process_step_id AS step, pass_fail FROM fact_wafer_tests WHERE {since("test_timestamp", 30)}),
     reach AS (SELECT wafer_id, batch_id, max(step) AS last FROM recent GROUP BY ALL),
     stop AS (SELECT wafer_id, batch_id, min(step) AS step FROM recent WHERE pass_fail = 'FAIL' GROUP BY ALL),
     stops AS (SELECT stop.step, stop.wafer_id, stop.step * 1e2 / last AS progress FROM stop JOIN reach
               ON reach.wafer_id IS NOT DISTINCT FROM stop.wafer_id AND reach.batch_id IS NOT DISTINCT FROM stop.batch_id)
SELECT process_step_id, process_step_name, equipment_type, count(DISTINCT wafer_id) AS wafers_failed_at_step,
       round(1e2 * count(DISTINCT wafer_id) / (SELECT count(DISTINCT wafer_id) FROM stop), 2) AS pct_of_total_failures,
       round(avg(progress), 1) AS avg_progress_pct_at_failure
FROM stops JOIN dim_process_steps ON process_step_id = step GROUP BY ALL
""")


def _turns(tests: str, batches: str = "dim_wafer_batches") -> str:
    """Each tool's batches in the order of their starts, with their yield."""
    return f"""runs AS (SELECT equipment_id, batch_id, start_time,
             round(1e2 * count(*) FILTER (pass_fail = 'PASS') / count(*), 2) AS y
             FROM (SELECT equipment_id, batch_id, pass_fail FROM fact_wafer_tests WHERE {tests})
             JOIN (SELECT batch_id, start_time FROM {batches}) USING (batch_id) GROUP BY ALL),
     turns AS (SELECT *, row_number() OVER (PARTITION BY equipment_id ORDER BY start_time, batch_id) AS k FROM runs),
     pairs AS (SELECT b.equipment_id, b.batch_id, b.start_time, b.y, a.batch_id AS old, a.start_time AS old_start, a.y AS old_y
               FROM turns a JOIN turns b ON a.equipment_id = b.equipment_id AND b.k = a.k + 1)"""


register("b5_yield_autocorrelation", f"""
WITH {_turns(since("test_timestamp", 14))},
     tools AS (SELECT equipment_id, count(*) AS n, {round_avg("y", 2)} AS m,
                      covar_pop(old_y, y) / nullif(stddev_pop(old_y) * stddev_pop(y), 0) AS r
               FROM pairs GROUP BY equipment_id HAVING count(*) >= 10)
SELECT equipment_id, n AS batch_pairs_analyzed, m AS avg_yield, round(r, 3) AS yield_autocorrelation,
       {pick(L.B5_INTERPRETATION, "r > 0.7", "r > 0.4")} AS interpretation
FROM tools
""")


def b6(per: str, lots: str = "true") -> str:
    return f"""
WITH mine AS (SELECT lot_number, batch_id, recipe, start_time, end_time FROM dim_wafer_batches WHERE {lots}),
     made AS (SELECT batch_id, len(list_distinct(list(wafer_id))) AS wafers, count(*) FILTER (pass_fail = 'PASS') AS ok,
                     count(wafer_id) AS tests FROM fact_wafer_tests GROUP BY batch_id),
     paths AS ({routes("batch_id")}),
     rated AS (SELECT *, 1e2 * ok / nullif({per}, 0) AS y FROM mine LEFT JOIN made USING (batch_id) LEFT JOIN paths USING (batch_id))
SELECT lot_number, batch_id, recipe, start_time, end_time, coalesce(wafers, 0)::BIGINT AS wafer_count,
       coalesce(ok, 0) AS passed_wafers, round(y, 2) AS batch_yield, route AS equipment_route,
       {pick(L.B6_DISPOSITION, "end_time > {AS_OF}", "y >= 90", "y >= 70")} AS disposition
FROM rated
"""


register("b6_lot_trace", b6("wafers"))
register("b6_lot_trace_tests", b6("tests"))
register("b6_lot_trace_one", b6("wafers", "lot_number = (SELECT min(lot_number) FROM dim_wafer_batches)"))

register("b7_contamination", f"""
WITH recent AS (SELECT * FROM dim_wafer_batches WHERE {since("start_time", 14)}),
     {_turns("true", "recent")},
     cleaned AS (SELECT p.equipment_id, p.batch_id, count(*) AS k FROM pairs p JOIN maintenance_events m
                 ON m.equipment_id = p.equipment_id AND m.event_timestamp >= p.old_start AND m.event_timestamp <= p.start_time GROUP BY ALL),
     judged AS (SELECT *, coalesce(k, 0) AS c FROM pairs LEFT JOIN cleaned USING (equipment_id, batch_id))
SELECT equipment_id, batch_id, old AS prev_batch, y AS current_yield, old_y AS prev_yield, round(y - old_y, 2) + 0.0 AS yield_delta,
       c AS maintenance_between,
       {pick(L.B7_CONTAMINATION_RISK, "old_y < 80 AND y < 80 AND c = 0", "old_y >= 90 AND y < 80 AND c = 0",
             "old_y < 85 AND y >= 90 AND c >= 1")} AS contamination_risk
FROM judged
""")

register("r3_wafer_lineage", """
WITH newest AS (SELECT equipment_id, last(event_type ORDER BY event_timestamp, event_id) AS kind FROM maintenance_events GROUP BY equipment_id),
     lots AS (SELECT batch_id, lot_number, recipe FROM dim_wafer_batches)
SELECT wafer_id, t.batch_id, lot_number, recipe, t.equipment_id, process_step_id, pass_fail AS test_result,
       status AS equipment_status_during_process, kind AS recent_maintenance
FROM fact_wafer_tests t JOIN lots USING (batch_id)
LEFT JOIN fact_equipment_events e
  ON e.equipment_id = t.equipment_id AND e.event_timestamp >= t.start_time AND e.event_timestamp <= t.end_time
LEFT JOIN newest n ON n.equipment_id = t.equipment_id
""")

register("x5_route_explode", """
SELECT batch_id, CAST(u.pos AS INTEGER) AS position, trim(u.tool) AS equipment_id
FROM dim_wafer_batches,
     LATERAL (SELECT unnest(string_split(equipment_sequence, ',')) AS tool,
                     generate_subscripts(string_split(equipment_sequence, ','), 1) AS pos) u
ORDER BY batch_id, position
""")

register("x6_route_conformance", """
WITH planned AS (
  SELECT batch_id, CAST(u.pos AS INTEGER) AS process_step_id, trim(u.tool) AS planned
  FROM dim_wafer_batches,
       LATERAL (SELECT unnest(string_split(equipment_sequence, ',')) AS tool,
                       generate_subscripts(string_split(equipment_sequence, ','), 1) AS pos) u
), j AS (
  SELECT wt.batch_id, wt.equipment_id, p.planned
  FROM fact_wafer_tests wt
  LEFT JOIN planned p ON wt.batch_id = p.batch_id AND wt.process_step_id = p.process_step_id
)
SELECT batch_id, COUNT(*) AS tests,
       COUNT(CASE WHEN CAST(equipment_id AS VARCHAR) = planned THEN 1 END) AS conforming_tests,
       COUNT(CASE WHEN planned IS NULL THEN 1 END) AS unplanned_steps,
       ROUND(100.0 * CAST(COUNT(CASE WHEN CAST(equipment_id AS VARCHAR) = planned THEN 1 END) AS DOUBLE)
             / COUNT(*), 2) AS conformance_pct
FROM j GROUP BY batch_id ORDER BY batch_id
""")
