"""Oracle SQL for the single-construct queries."""

from waferline.oracle import register, round_avg
from waferline.oracle.trace import routes

EV = "fact_equipment_events"

register("j4_interval_lookup", f"""
WITH w AS (SELECT DISTINCT equipment_id, start_time, end_time FROM fact_wafer_tests)
SELECT w.equipment_id, w.start_time, w.end_time,
       (SELECT COUNT(*) FROM {EV} ee WHERE ee.equipment_id = w.equipment_id
          AND ee.event_timestamp BETWEEN w.start_time AND w.end_time) AS events_in_window,
       (SELECT {round_avg("temperature_c", 2)} FROM {EV} ee WHERE ee.equipment_id = w.equipment_id
          AND ee.event_timestamp BETWEEN w.start_time AND w.end_time) AS avg_temp_c
FROM w
""")

register("ag9_route", f"""
WITH r AS ({routes("wafer_id, batch_id")})
SELECT wafer_id, batch_id, route AS equipment_sequence FROM r
""")

register("sf6_yearweek", f"""
SELECT CAST(year(CAST(event_timestamp AS DATE) - CAST(dayofweek(event_timestamp) AS INTEGER)) * 100
            + (dayofyear(CAST(event_timestamp AS DATE) - CAST(dayofweek(event_timestamp) AS INTEGER)) + 6) // 7
            AS INTEGER) AS year_week,
       COUNT(*) AS events
FROM {EV} GROUP BY 1 ORDER BY 1
""")

register("j7_orphans", f"""
SELECT ee.equipment_id, COUNT(*) AS events FROM {EV} ee
LEFT JOIN dim_equipment e ON ee.equipment_id = e.equipment_id
WHERE e.equipment_id IS NULL GROUP BY ee.equipment_id ORDER BY 1
""")

register("w4_moving_avg", f"""
WITH d AS (
  SELECT equipment_id, CAST(event_timestamp AS DATE) AS date,
         ROUND(100.0 * CAST(SUM(CASE WHEN status = 'RUNNING' THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*), 2)
           AS uptime_pct
  FROM {EV} WHERE event_timestamp >= {{AS_OF}} - INTERVAL 30 DAY GROUP BY 1, 2
)
SELECT equipment_id, date, uptime_pct,
       ROUND(AVG(uptime_pct) OVER (PARTITION BY equipment_id ORDER BY date
                                   ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 9) AS uptime_7row_avg
FROM d
""")

register("w7_share", f"""
SELECT status, COUNT(*) AS events,
       ROUND(100.0 * CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM {EV}), 2) AS share_pct
FROM {EV} GROUP BY status
""")

register("w8_cumulative", f"""
SELECT CAST(event_timestamp AS DATE) AS date, COUNT(*) AS events,
       CAST(SUM(COUNT(*)) OVER (ORDER BY CAST(event_timestamp AS DATE)) AS BIGINT) AS cumulative_events
FROM {EV} GROUP BY 1
""")
