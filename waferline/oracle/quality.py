"""DuckDB statements for the data-quality rules.

Every rule is one relation of items (ex, w): an example id and how much it counts. A rule's
row sums them. Sequences are rank self joins, groups with copies are found by their second
row, orphans by anti joins.
"""

from waferline.oracle import register, register_dirty
from waferline.plans.quality import RULES

EV, TE, BA = "fact_equipment_events", "fact_wafer_tests", "dim_wafer_batches"


def where(table: str, ex: str, condition: str) -> str:
    return f"SELECT {ex}::VARCHAR AS ex, 1 AS w FROM {table} WHERE {condition}"


def neighbours(table: str, keys: str, order: str, columns: str, rows: str = "true") -> str:
    """Pairs (a, b) of rows that follow each other within ``keys`` (NULL is a key)."""
    same = " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in keys.split(", "))
    ranked = f"(SELECT {columns}, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS k FROM {table} WHERE {rows})"
    return f"{ranked} a JOIN {ranked} b ON {same} AND b.k = a.k + 1"


def second(table: str, keys: str, ex: str) -> str:
    """One item per group of ``keys`` that has a second row."""
    return (f"SELECT {ex}::VARCHAR AS ex, 1 AS w FROM (SELECT {ex}, row_number() OVER (PARTITION BY {keys}) AS k FROM {table}) "
            "WHERE k = 2")


LONG = "epoch(end_time) - epoch(start_time)"
ITEMS = {
    "DQ001": f"SELECT batch_id::VARCHAR AS ex, 1 AS w FROM {TE} t WHERE batch_id IS NULL OR batch_id NOT IN (SELECT batch_id FROM {BA})",
    "DQ002": f"""SELECT batch_id::VARCHAR AS ex, 1 AS w FROM (SELECT batch_id, trim(unnest(string_split(equipment_sequence, ','))) AS tool FROM {BA})
                 ANTI JOIN (SELECT equipment_id::VARCHAR AS tool FROM dim_equipment) USING (tool)""",
    "DQ003": f"SELECT wafer_id::VARCHAR AS ex, 1 AS w FROM {TE} ANTI JOIN dim_process_steps USING (process_step_id)",
    "DQ004": "SELECT b.equipment_id::VARCHAR AS ex, 1 AS w FROM "
             + neighbours(EV, "equipment_id", "ingestion_timestamp NULLS FIRST, event_timestamp NULLS FIRST",
                          "equipment_id, event_timestamp") + " AND b.event_timestamp < a.event_timestamp",
    "DQ005": "SELECT b.batch_id::VARCHAR AS ex, 1 AS w FROM "
             + neighbours(TE, "batch_id, wafer_id", "process_step_id NULLS FIRST, start_time NULLS FIRST",
                          "batch_id, wafer_id, start_time") + " AND b.start_time < a.start_time",
    "DQ006": where(BA, "batch_id", "end_time <= start_time"),
    "DQ007": f"""SELECT batch_id::VARCHAR AS ex, 1 AS w FROM (SELECT batch_id, count(*) FILTER (pass_fail = 'PASS') AS ok, count(wafer_id) AS n
                 FROM {TE} GROUP BY batch_id) WHERE n > 0 AND NOT round(1e2 * ok / n, 2) BETWEEN 0 AND 100""",
    "DQ008": where(TE, "wafer_id", "defect_density < 0"),
    "DQ009": where(EV, "equipment_id", "temperature_c NOT BETWEEN -50 AND 500"),
    "DQ010": where(EV, "equipment_id", "pressure_torr NOT BETWEEN 0.001 AND 1000"),
    "DQ011": where(TE, "batch_id", "coalesce(wafer_id::VARCHAR, '') = ''"),
    "DQ012": where(EV, "NULL", "coalesce(equipment_id::VARCHAR, '') = ''"),
    "DQ013": where(TE, "wafer_id", "coalesce(pass_fail, '') NOT IN ('PASS', 'FAIL')"),
    "DQ014": second(TE, "batch_id, wafer_id", "wafer_id"),
    "DQ015": second(BA, "batch_id", "batch_id"),
    "DQ016": f"""SELECT batch_id::VARCHAR AS ex, 1 AS w FROM (SELECT batch_id, count(wafer_id) AS n FROM
                 (SELECT DISTINCT batch_id, wafer_id FROM {TE}) GROUP BY batch_id) WHERE n NOT BETWEEN 24 AND 26""",
    "DQ017": "SELECT DISTINCT b.equipment_id::VARCHAR AS ex, 1 AS w FROM "
             + neighbours(EV, "equipment_id", "event_timestamp", "equipment_id, event_timestamp", "status = 'DOWN'")
             + " AND date_sub('hour', a.event_timestamp, b.event_timestamp) > 72",
    "DQ018": where(TE, "wafer_id", f"{LONG} NOT BETWEEN 10 AND 3600"),
    "DQ019": where(EV, "equipment_id", "ingestion_timestamp - INTERVAL 24 HOUR > event_timestamp"),
    "DQ020": f"SELECT NULL::VARCHAR AS ex, date_sub('hour', max(event_timestamp), {{AS_OF}}) AS w FROM {EV}",
}


def rule_row(rule_id: str, items: str | None = None, scale: str = "v") -> str:
    """The result row of a rule (``scale``: its violations from the summed items v)."""
    r = next(x for x in RULES if x.rule_id == rule_id)
    bad = "FAIL" if r.severity in ("CRITICAL", "HIGH") else "WARNING"
    total = "sum(w)" if rule_id == "DQ020" else "coalesce(sum(w), 0)"
    return f"""SELECT '{r.rule_id}' AS rule_id, '{r.name}' AS rule_name, '{r.category}' AS category, '{r.severity}' AS severity,
       if(coalesce(n <= {r.threshold}, false), 'PASS', '{bad}') AS status, n AS violations, {r.threshold}::BIGINT AS threshold,
       '{r.impact}' AS impact, array_to_string(list_sort(list_distinct(xs))[:5], ', ') AS details, '{r.layer}' AS layer
FROM (SELECT ({scale})::BIGINT AS n, xs FROM
      (SELECT {total} AS v, coalesce(list(ex) FILTER (ex IS NOT NULL), []) AS xs FROM ({items or ITEMS[rule_id]})))"""


ALL = " UNION ALL ".join(f"({rule_row(r.rule_id)})" for r in RULES)
_PLAIN = "rule_id, rule_name, category, severity, status, violations, threshold, impact, details"

for _r in RULES:
    register(_r.rule_id.lower(), f"SELECT {_PLAIN} FROM ({rule_row(_r.rule_id)})")
register("dq_results", ALL)
register("dq_results_raw", f"SELECT * FROM ({ALL}) WHERE layer = 'raw'")
register("dq_summary", f"SELECT layer, status, count(*) AS rules FROM ({ALL}) GROUP BY ALL")
register("dq_issues", f"SELECT * FROM ({ALL}) WHERE status <> 'PASS'")
register("dq_gate", f"""
WITH r AS ({ALL})
SELECT NOT bool_or(severity = 'CRITICAL' AND status = 'FAIL') AS promote,
       coalesce(string_agg(rule_id, ',' ORDER BY rule_id) FILTER (severity = 'CRITICAL' AND status = 'FAIL'), '') AS blocking_rules,
       coalesce(string_agg(rule_id, ',' ORDER BY rule_id) FILTER (severity <> 'CRITICAL' AND status IN ('FAIL', 'WARNING')), '')
         AS warning_rules
FROM r""")
register_dirty("dq_results_dirty", ALL)
register("dq_custom", """
SELECT 'XR001' AS rule_id, if(a <= 10, 'PASS', 'WARNING') AS status, a AS violations FROM
  (SELECT count(*) AS a FROM fact_wafer_tests WHERE defect_density > 0.09)
UNION ALL
SELECT 'XR002', if(b <= 0, 'PASS', 'FAIL'), b FROM
  (SELECT count(*) AS b FROM (SELECT equipment_id FROM dim_equipment EXCEPT SELECT equipment_id FROM fact_equipment_events))
UNION ALL SELECT 'XR003', 'ERROR', -1""")
