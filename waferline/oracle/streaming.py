"""Oracle SQL for the streaming queries: the batch answer over the same input."""

from waferline.oracle import register, register_dirty
from waferline.oracle.quality import ITEMS

EV = "fact_equipment_events"
COLS = "equipment_id, event_timestamp, status, temperature_c, pressure_torr, ingestion_timestamp, event_id"

register("s1_ingest", f"SELECT {COLS} FROM {EV}")
register("s2_late_data", f"""
SELECT {COLS}, date_sub('hour', event_timestamp, ingestion_timestamp) AS delay_hours
FROM {EV} WHERE ingestion_timestamp > event_timestamp + INTERVAL 24 HOUR
""")
register("s3_stream_dedupe", f"SELECT {COLS} FROM {EV}")
register("s3_stream_upsert", f"SELECT {COLS} FROM {EV}")
_windows = (f"""
SELECT date_trunc('day', event_timestamp) AS window_start,
       date_trunc('day', event_timestamp) + INTERVAL 1 DAY AS window_end, equipment_id,
       COUNT(*) AS events, COUNT(CASE WHEN status = 'RUNNING' THEN 1 END) AS running,
       COUNT(CASE WHEN status = 'ALARM' THEN 1 END) AS alarms,
       COUNT(CASE WHEN status = 'DOWN' THEN 1 END) AS downs
FROM {EV}
GROUP BY 1, 2, 3
""")
register("s5_stream_checks", f"""
SELECT * FROM (VALUES
  ('DQ009', (SELECT COUNT(*) FROM {EV} WHERE temperature_c < -50 OR temperature_c > 500)),
  ('DQ010', (SELECT COUNT(*) FROM {EV} WHERE pressure_torr < 0.001 OR pressure_torr > 1000)),
  ('DQ012', (SELECT COUNT(*) FROM {EV} WHERE equipment_id IS NULL OR CAST(equipment_id AS VARCHAR) = '')),
  ('DQ019', (SELECT COUNT(*) FROM {EV} WHERE ingestion_timestamp > event_timestamp + INTERVAL 24 HOUR))
) t(rule_id, violations)
""")
register("s4_daily_metrics", _windows)
register("s4_daily_metrics_kept", _windows)

# Rows after three drops: late is what lies a day behind the tool's newest event of earlier drops.
register("s2_two_routes", f"""
SELECT {COLS}, if(coalesce(event_timestamp < newest - INTERVAL 24 HOUR, false), 'rescue', 'main') AS route FROM (
  SELECT *, max(event_timestamp) OVER (PARTITION BY equipment_id ORDER BY drop_no RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
  FROM (SELECT *, CASE WHEN event_id % 10 = 0 THEN 2 WHEN ingestion_timestamp <= {{AS_OF}} - INTERVAL 14 DAY THEN 0
                       WHEN ingestion_timestamp <= {{AS_OF}} - INTERVAL 7 DAY THEN 1 ELSE 2 END AS drop_no FROM {EV}))
""")

_state = " UNION ALL ".join(
    f"SELECT '{r}' AS rule_id, sum(w)::BIGINT AS violations, count(DISTINCT ex) AS affected FROM ({ITEMS[r]}) HAVING count(*) > 0"
    for r in ("DQ004", "DQ005", "DQ014", "DQ017"))
register("s5_stateful_checks", _state)
register_dirty("s5_stateful_checks_dirty", _state)
