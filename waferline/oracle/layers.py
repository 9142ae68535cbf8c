"""Oracle SQL for the layer-pipeline queries."""

from waferline.oracle import register, register_dirty
from waferline.oracle.quality import ALL, ITEMS, neighbours, rule_row
from waferline.plans.quality import RULES

WM = "TIMESTAMP '2024-01-24 00:00:00'"
EV = "fact_equipment_events"

register("pl1_standardize", f"""
SELECT COUNT(*) FILTER (WHERE equipment_id IS NOT NULL AND event_timestamp IS NOT NULL
                          AND (status IS NULL OR status IN ('RUNNING', 'IDLE', 'ALARM', 'DOWN'))) AS good_rows,
       COUNT(*) FILTER (WHERE NOT (equipment_id IS NOT NULL AND event_timestamp IS NOT NULL
                          AND (status IS NULL OR status IN ('RUNNING', 'IDLE', 'ALARM', 'DOWN')))) AS rejected_rows
FROM {EV}
""")

register("pl2_dedupe", """
SELECT wafer_id, batch_id, process_step_id, process_step_name, equipment_id, start_time, end_time,
       pass_fail, defect_density, bin_code, test_timestamp
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY wafer_id, process_step_id
        ORDER BY test_timestamp DESC NULLS LAST, batch_id DESC NULLS LAST, process_step_name DESC NULLS LAST,
                 equipment_id DESC NULLS LAST, start_time DESC NULLS LAST, end_time DESC NULLS LAST,
                 pass_fail DESC NULLS LAST, defect_density DESC NULLS LAST, bin_code DESC NULLS LAST) AS rn
      FROM fact_wafer_tests) x
WHERE rn = 1
""")

register("pl3_incremental", f"SELECT * FROM {EV} WHERE event_timestamp > {WM}")
register("pl3_watermark", f"SELECT MAX(event_timestamp) AS watermark FROM {EV} WHERE event_timestamp > {WM}")

register("pl4_lookback", f"""
SELECT * FROM {EV} e
WHERE e.event_timestamp > {WM} - INTERVAL 24 HOUR
  AND NOT EXISTS (SELECT 1 FROM {EV} l
                  WHERE l.ingestion_timestamp <= {WM} AND l.equipment_id = e.equipment_id
                    AND l.event_timestamp = e.event_timestamp AND l.event_id = e.event_id)
""")

register("pl5_watermark", f"""
WITH s AS (
  SELECT equipment_id AS source,
         MAX(CASE WHEN ingestion_timestamp <= {WM} THEN event_timestamp END) AS current_ts,
         MAX(CASE WHEN ingestion_timestamp <= {WM} - INTERVAL 1 DAY THEN event_timestamp END) AS previous_ts
  FROM {EV} GROUP BY 1
), b AS (
  SELECT equipment_id AS source, MAX(event_timestamp) AS new_ts FROM {EV}
  WHERE ingestion_timestamp > {WM} AND ingestion_timestamp <= {{AS_OF}} GROUP BY 1
), j AS (
  SELECT COALESCE(s.source, b.source) AS source, current_ts, previous_ts, new_ts,
         CASE WHEN new_ts IS NULL THEN 'UNCHANGED' WHEN current_ts IS NULL OR new_ts >= current_ts THEN 'ADVANCE'
              ELSE 'ROLLBACK' END AS action
  FROM s FULL JOIN b ON s.source = b.source
)
SELECT source,
       CASE action WHEN 'ADVANCE' THEN new_ts WHEN 'ROLLBACK' THEN previous_ts ELSE current_ts END AS current_ts,
       CASE action WHEN 'ADVANCE' THEN current_ts ELSE previous_ts END AS previous_ts,
       action
FROM j
""")

register("pl6_upsert", f"""
SELECT equipment_id, event_timestamp, status, temperature_c, pressure_torr, ingestion_timestamp, event_id
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY ingestion_timestamp DESC) AS rn
      FROM (SELECT * FROM {EV} WHERE ingestion_timestamp <= {WM}
            UNION ALL
            SELECT * FROM {EV} WHERE ingestion_timestamp > {WM} - INTERVAL 24 HOUR) u) x
WHERE rn = 1
""")

_scd2 = (f"""
WITH snap AS (
  SELECT equipment_id, snapshot_date, status FROM (
    SELECT equipment_id, CAST(event_timestamp AS DATE) AS snapshot_date, status,
           ROW_NUMBER() OVER (PARTITION BY equipment_id, CAST(event_timestamp AS DATE)
                              ORDER BY event_timestamp DESC, event_id DESC) AS rn
    FROM {EV}) x WHERE rn = 1
), ch AS (
  SELECT * FROM (SELECT *, LAG(status) OVER (PARTITION BY equipment_id ORDER BY snapshot_date) AS prev
                 FROM snap) y
  WHERE prev IS NULL OR prev <> status
)
SELECT equipment_id, status, snapshot_date AS effective_start_date,
       CAST(LEAD(snapshot_date) OVER w - 1 AS DATE) AS effective_end_date,
       LEAD(snapshot_date) OVER w IS NULL AS current_flag
FROM ch WINDOW w AS (PARTITION BY equipment_id ORDER BY snapshot_date)
""")
register("pl8_scd2", _scd2)
register("pl8_kept_dimension", _scd2)
# Every tool on every day that has a snapshot: islands of the same status, where none is a status too.
register("pl8_kept_dimension_closed", f"""
WITH snap AS (SELECT equipment_id, event_timestamp::DATE AS d, arg_max(status, (event_timestamp, event_id)) AS status FROM {EV} GROUP BY ALL),
     grid AS (SELECT k.tool, x.d, s.status FROM (SELECT DISTINCT equipment_id AS tool FROM snap) k CROSS JOIN (SELECT DISTINCT d FROM snap) x
              LEFT JOIN snap s ON s.equipment_id IS NOT DISTINCT FROM k.tool AND s.d = x.d),
     ch AS (SELECT * FROM (SELECT *, lag(status) OVER w AS before FROM grid WINDOW w AS (PARTITION BY tool ORDER BY d))
            WHERE status IS DISTINCT FROM before),
     v AS (SELECT *, lead(d) OVER (PARTITION BY tool ORDER BY d) AS next FROM ch)
SELECT tool AS equipment_id, status, d AS effective_start_date, (next - 1)::DATE AS effective_end_date, next IS NULL AS current_flag
FROM v WHERE status IS NOT NULL
""")

PASS = "CASE WHEN pass_fail = 'PASS' THEN 1 ELSE 0 END"
register("pl9_daily_yield", f"""
SELECT CAST(test_timestamp AS DATE) AS test_date, COUNT(*) AS tests, COUNT(DISTINCT wafer_id) AS wafers,
       CAST(SUM({PASS}) AS BIGINT) AS passed,
       ROUND(100.0 * CAST(SUM({PASS}) AS DOUBLE) / COUNT(*), 2) AS yield_pct
FROM fact_wafer_tests WHERE test_timestamp >= {{AS_OF}} - INTERVAL 30 DAY
GROUP BY 1 ORDER BY 1
""")
register("pl9_daily_yield_recipe", f"""
SELECT CAST(t.test_timestamp AS DATE) AS test_date, b.recipe, COUNT(*) AS tests,
       COUNT(DISTINCT t.wafer_id) AS wafers, CAST(SUM({PASS}) AS BIGINT) AS passed,
       ROUND(100.0 * CAST(SUM({PASS}) AS DOUBLE) / COUNT(*), 2) AS yield_pct
FROM fact_wafer_tests t JOIN dim_wafer_batches b ON t.batch_id = b.batch_id
WHERE t.test_timestamp >= {{AS_OF}} - INTERVAL 30 DAY
GROUP BY 1, 2 ORDER BY 1, 2
""")
register("pl9_daily_uptime", f"""
SELECT equipment_id, CAST(event_timestamp AS DATE) AS date, COUNT(*) AS events,
       CAST(SUM(CASE WHEN status = 'RUNNING' THEN 1 ELSE 0 END) AS BIGINT) AS running,
       CAST(SUM(CASE WHEN status = 'ALARM' THEN 1 ELSE 0 END) AS BIGINT) AS alarms,
       CAST(SUM(CASE WHEN status = 'DOWN' THEN 1 ELSE 0 END) AS BIGINT) AS downs,
       ROUND(100.0 * CAST(SUM(CASE WHEN status = 'RUNNING' THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*), 2)
         AS uptime_pct
FROM {EV} WHERE event_timestamp >= {{AS_OF}} - INTERVAL 30 DAY
GROUP BY 1, 2 ORDER BY 1, 2
""")

# The kept tables after all loads are those of one full build.
_kept_yield = f"""
SELECT CAST(t.test_timestamp AS DATE) AS test_date, b.recipe, COUNT(*) AS tests, COUNT(DISTINCT t.wafer_id) AS wafers,
       CAST(SUM({PASS}) AS BIGINT) AS passed, ROUND(100.0 * CAST(SUM({PASS}) AS DOUBLE) / COUNT(*), 2) AS yield_pct
FROM fact_wafer_tests t JOIN dim_wafer_batches b ON t.batch_id = b.batch_id GROUP BY 1, 2
"""
register("pl9_kept_yield", _kept_yield)
register_dirty("pl9_kept_yield_dirty", _kept_yield)


def _uptime(rows: str) -> str:
    n = lambda s: f"CAST(SUM(CASE WHEN status = '{s}' THEN 1 ELSE 0 END) AS BIGINT)"
    return (f"SELECT CAST(event_timestamp AS DATE) AS date, equipment_id, COUNT(*) AS events, {n('RUNNING')} AS running, {n('ALARM')} AS alarms, "
            f"{n('DOWN')} AS downs, ROUND(100.0 * CAST({n('RUNNING')} AS DOUBLE) / COUNT(*), 2) AS uptime_pct FROM {EV} {rows} GROUP BY 1, 2")


register("pl9_kept_uptime", _uptime(""))
# Three runs of the raw rules; the last takes what has arrived by the as-of instant.
register("pl_incremental_run", f"""
SELECT *, 3::BIGINT AS runs, {3 * sum(r.layer == 'raw' for r in RULES)}::BIGINT AS results
FROM ({_uptime("WHERE ingestion_timestamp <= {AS_OF}")})
""")
register("c3_isolated", f"""
SELECT * FROM ({ALL}) UNION ALL BY NAME
SELECT * FROM (VALUES ('XR004', 'Bin as number', 'RANGE', 'LOW', 'ERROR', -1, 0, 'None', NULL, 'staging'),
                      ('XR005', 'Broken share', 'RANGE', 'LOW', 'ERROR', -1, 0, 'None', NULL, 'raw'))
     v(rule_id, rule_name, category, severity, status, violations, threshold, impact, details, layer)
""")

FLAGS = {"DQ008": "defect_density < 0", "DQ013": "coalesce(pass_fail, '') NOT IN ('PASS', 'FAIL')"}
_pl10 = f"""
SELECT wafer_id, batch_id, process_step_id, equipment_id, start_time,
       concat_ws(',', {", ".join(f"if({p}, '{r}', NULL)" for r, p in FLAGS.items())}) AS dq_warning
FROM fact_wafer_tests WHERE {" OR ".join(f"coalesce({p}, false)" for p in FLAGS.values())}
"""
register("pl10_dq_warning", _pl10)
register_dirty("pl10_dq_warning_dirty", _pl10)

register_dirty("pl1_rejects", f"""
SELECT event_id, concat_ws(',', if(event_id % 223 = 2, 'cast:temperature_c', NULL), if(equipment_id IS NULL, 'null:equipment_id', NULL),
                           if(event_id % 211 = 1, 'domain:status', NULL)) AS reasons
FROM {EV} WHERE event_id % 223 = 2 OR equipment_id IS NULL OR event_id % 211 = 1
""")

_NEWEST = """FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingestion_timestamp DESC) AS k FROM u) WHERE k = 1"""
_upserted = (f"""
WITH u AS (SELECT * FROM {EV} WHERE ingestion_timestamp <= {WM}
           UNION ALL SELECT * REPLACE (event_timestamp + INTERVAL 36 HOUR AS event_timestamp,
                                       ingestion_timestamp + INTERVAL 36 HOUR AS ingestion_timestamp) FROM {EV} WHERE event_id % 5 = 0)
SELECT event_id, event_timestamp, ingestion_timestamp, event_timestamp::DATE AS event_date {_NEWEST}
""")
register("pl6_write_upsert", _upserted)
register("pl6_versioned_upsert", _upserted)

# The sample of keys that Spark takes, by the same hash
_LOT = "('0x' || substr(md5(coalesce({0}::VARCHAR, '')), 1, 4))::BIGINT < 3277"
_SOME = {"fact_wafer_tests": _LOT.format("batch_id"), EV: _LOT.format("equipment_id"), "dim_wafer_batches": _LOT.format("batch_id")}


def _swap(items: str, names: dict) -> str:
    for a, b in names.items():
        items = items.replace(a, b)
    return items


_SAMPLED = ["DQ001", "DQ002", "DQ003", "DQ004", "DQ005", "DQ007", "DQ014", "DQ015", "DQ016", "DQ017"]
_TE, _EV, _BA = "some_tests", "some_events", "some_batches"
_rows = " UNION ALL ".join("(" + rule_row(r, _swap(ITEMS[r], {"fact_wafer_tests": _TE, EV: _EV} | (
    {"dim_wafer_batches": _BA} if r in ("DQ002", "DQ015") else {})), "round(v / 0.05)") + ")" for r in _SAMPLED)
register("c8_sampled_checks", f"""
WITH some_tests AS (SELECT * FROM fact_wafer_tests WHERE {_SOME["fact_wafer_tests"]}),
     some_events AS (SELECT * FROM {EV} WHERE {_SOME[EV]}),
     some_batches AS (SELECT * FROM dim_wafer_batches WHERE {_SOME["dim_wafer_batches"]})
SELECT *, true AS estimated FROM ({_rows})
""")

# Rows after the mark, judged with all rows of the groups and sequences they touch
_NEW_ROWS = ["DQ001", "DQ003", "DQ008", "DQ009", "DQ010", "DQ011", "DQ012", "DQ013", "DQ018", "DQ019"]
_new = {r: _swap(ITEMS[r], {"fact_wafer_tests": "new_tests", EV: "new_events"}) for r in _NEW_ROWS}
_new["DQ004"] = ("SELECT b.equipment_id::VARCHAR AS ex, 1 AS w FROM "
                 + neighbours(EV, "equipment_id", "ingestion_timestamp, event_timestamp", "equipment_id, event_timestamp")
                 + f" AND b.event_timestamp < a.event_timestamp AND b.event_timestamp > {WM}")
_steps = """(SELECT batch_id, wafer_id, process_step_id, min(start_time) AS lo, max(start_time) AS hi, max(test_timestamp) AS ts
             FROM fact_wafer_tests GROUP BY ALL)"""
_bad_steps = ("SELECT b.batch_id, b.ts, greatest(a.ts, b.ts) AS newest FROM "
              + neighbours(_steps, "batch_id, wafer_id", "process_step_id NULLS FIRST", "batch_id, wafer_id, lo, hi, ts")
              + " AND b.lo < a.hi")
_new["DQ005"] = f"SELECT batch_id::VARCHAR AS ex, 1 AS w FROM ({_bad_steps}) WHERE newest > {WM}"
for _r in ("DQ007", "DQ016"):
    _new[_r] = _swap(ITEMS[_r], {"fact_wafer_tests": "(SELECT * FROM fact_wafer_tests WHERE batch_id IN (SELECT batch_id FROM new_tests))"})
_new["DQ014"] = _swap(ITEMS["DQ014"], {"fact_wafer_tests": """(SELECT * FROM fact_wafer_tests t SEMI JOIN (SELECT batch_id AS nb, wafer_id AS nw
  FROM new_tests) ON batch_id IS NOT DISTINCT FROM nb AND wafer_id IS NOT DISTINCT FROM nw)"""})
_new["DQ017"] = ITEMS["DQ017"] + f" AND b.event_timestamp > {WM}"
_rows = " UNION ALL ".join(f"({rule_row(r, _new[r])})" for r in sorted(_new))
register("c9_incremental_checks", f"""
WITH new_tests AS (SELECT * FROM fact_wafer_tests WHERE test_timestamp > {WM}),
     new_events AS (SELECT * FROM {EV} WHERE event_timestamp > {WM})
SELECT * FROM ({_rows})
""")

# A date for every violation
_T, _E, _B = "fact_wafer_tests", EV, "dim_wafer_batches"
_LATE = "SELECT batch_id, max(test_timestamp) AS ts, count(DISTINCT wafer_id) AS n, round(1e2 * count(*) FILTER (pass_fail = 'PASS') / nullif(count(wafer_id), 0), 2) AS y FROM fact_wafer_tests GROUP BY batch_id"
_dated = {
    "DQ001": f"SELECT test_timestamp AS ts, 1 AS w FROM {_T} WHERE batch_id IS NULL OR batch_id NOT IN (SELECT batch_id FROM {_B})",
    "DQ002": f"""SELECT start_time AS ts, 1 AS w FROM (SELECT batch_id, trim(unnest(string_split(equipment_sequence, ','))) AS tool FROM {_B})
                 ANTI JOIN (SELECT equipment_id::VARCHAR AS tool FROM dim_equipment) USING (tool) JOIN {_B} USING (batch_id)""",
    "DQ003": f"SELECT test_timestamp AS ts, 1 AS w FROM {_T} ANTI JOIN dim_process_steps USING (process_step_id)",
    "DQ004": "SELECT b.event_timestamp AS ts, 1 AS w FROM "
             + neighbours(_E, "equipment_id", "ingestion_timestamp, event_timestamp", "equipment_id, event_timestamp")
             + " AND b.event_timestamp < a.event_timestamp",
    "DQ005": f"SELECT ts, 1 AS w FROM ({_bad_steps})",
    "DQ006": f"SELECT start_time AS ts, 1 AS w FROM {_B} WHERE end_time <= start_time",
    "DQ007": f"SELECT ts, 1 AS w FROM ({_LATE}) WHERE y NOT BETWEEN 0 AND 100",
    "DQ014": f"SELECT max(test_timestamp) AS ts, 1 AS w FROM {_T} GROUP BY batch_id, wafer_id HAVING count(*) > 1",
    "DQ015": f"SELECT max(start_time) AS ts, 1 AS w FROM {_B} GROUP BY batch_id HAVING count(*) > 1",
    "DQ016": f"SELECT ts, 1 AS w FROM ({_LATE}) WHERE n NOT BETWEEN 24 AND 26",
    "DQ017": "SELECT b.event_timestamp AS ts, 1 AS w FROM "
             + neighbours(_E, "equipment_id", "event_timestamp", "equipment_id, event_timestamp", "status = 'DOWN'")
             + " AND date_sub('hour', a.event_timestamp, b.event_timestamp) > 72",
    "DQ020": f"""SELECT max(event_timestamp) AS ts, date_sub('hour', max(event_timestamp), event_timestamp::DATE + INTERVAL 1 DAY) AS w
                 FROM {_E} WHERE event_timestamp IS NOT NULL GROUP BY event_timestamp::DATE""",
}
for _r in ("DQ008", "DQ011", "DQ013", "DQ018"):
    _dated[_r] = f"SELECT test_timestamp AS ts, 1 AS w FROM {_T} WHERE {ITEMS[_r].split(' WHERE ', 1)[1]}"
for _r in ("DQ009", "DQ010", "DQ012", "DQ019"):
    _dated[_r] = f"SELECT event_timestamp AS ts, 1 AS w FROM {_E} WHERE {ITEMS[_r].split(' WHERE ', 1)[1]}"
_found = " UNION ALL ".join(f"SELECT '{r}' AS rule_id, ts::DATE AS date, w FROM ({q})" for r, q in sorted(_dated.items()))
_trend = f"""
WITH days AS (SELECT DISTINCT test_timestamp::DATE AS date FROM {_T} WHERE test_timestamp >= {{AS_OF}} - INTERVAL 30 DAY
              UNION SELECT DISTINCT event_timestamp::DATE FROM {_E} WHERE event_timestamp >= {{AS_OF}} - INTERVAL 30 DAY),
     rules AS (SELECT unnest([{", ".join(f"'{r}'" for r in sorted(_dated))}]) AS rule_id),
     n AS (SELECT rule_id, date, sum(w)::BIGINT AS n FROM ({_found}) GROUP BY ALL),
     d AS (SELECT rule_id, date, coalesce(n, 0) AS n, row_number() OVER (PARTITION BY rule_id ORDER BY date) AS k
           FROM rules CROSS JOIN days LEFT JOIN n USING (rule_id, date)),
     m AS (SELECT a.rule_id, a.k, round(avg(b.n), 4) AS m, any_value(b.n) FILTER (b.k = a.k - 1) AS p
           FROM d a JOIN d b ON b.rule_id = a.rule_id AND a.k - b.k BETWEEN 0 AND 6 GROUP BY a.rule_id, a.k)
SELECT rule_id, date, n AS violations, p AS prev_violations, m AS trailing_avg FROM d JOIN m USING (rule_id, k)
"""
register("c10_violation_trend", _trend)
register_dirty("c10_violation_trend_dirty", _trend)

# Batches at fault
_of_batch = ["DQ002", "DQ005", "DQ006", "DQ007", "DQ015", "DQ016"]
_faults = " UNION ".join([f"SELECT ex FROM ({ITEMS[r]})" for r in _of_batch] + [
    f"SELECT batch_id::VARCHAR FROM {_T} WHERE {ITEMS[r].split(' WHERE ', 1)[1]}" for r in ("DQ008", "DQ011", "DQ013", "DQ018")] + [
    f"SELECT batch_id::VARCHAR FROM {_T} ANTI JOIN dim_process_steps USING (process_step_id)",
    f"SELECT batch_id::VARCHAR FROM {_T} GROUP BY batch_id, wafer_id HAVING count(*) > 1"])
CLEAN = f"""SELECT count(*) AS batches, count(*) FILTER (batch_id::VARCHAR NOT IN (SELECT ex FROM bad WHERE ex IS NOT NULL)) AS clean_batches
            FROM dim_wafer_batches"""
_clean_share = f"""
WITH bad AS ({_faults}), c AS ({CLEAN})
SELECT batches, clean_batches, round(1e2 * clean_batches / batches, 2) AS clean_pct FROM c
"""
register("c12_clean_batch_share", _clean_share)
register_dirty("c12_clean_batch_share_dirty", _clean_share)
FAULTS = _faults

# PL7: rows by policy and by the keys that no dimension has
_fks = {"fact_wafer_tests": (("batch_id", "dim_wafer_batches"), ("process_step_id", "dim_process_steps"), ("equipment_id", "dim_equipment")),
        "fact_equipment_events": (("equipment_id", "dim_equipment"),), "maintenance_events": (("equipment_id", "dim_equipment"),)}
_lacks = " UNION ALL ".join(
    f"""SELECT '{fact}' AS fact, concat_ws(',', {", ".join(f"CASE WHEN {c} IS NULL OR {c} NOT IN (SELECT {c} FROM {d} WHERE {c} IS NOT NULL) THEN '{c}' END"
        for c, d in keys)}) AS orphan_keys FROM {fact}""" for fact, keys in _fks.items())
_conformed = f"""
WITH r AS ({_lacks})
SELECT policy, fact, CASE WHEN orphan_keys = '' OR policy = 'keep' THEN 'curated' ELSE policy END AS route, orphan_keys, count(*) AS rows
FROM r CROSS JOIN (SELECT unnest(['keep', 'drop', 'quarantine']) AS policy) GROUP BY ALL
"""
register("pl7_conformed", _conformed)
register_dirty("pl7_conformed_dirty", _conformed)

# PL11: every row as the last version makes it
_backfilled = f"""
SELECT wafer_id, batch_id, process_step_id, start_time, end_time, pass_fail, if(c BETWEEN 10 AND 3600, c, NULL) AS cycle_s,
       CASE WHEN pass_fail = 'PASS' THEN 1 ELSE 0 END::BIGINT AS passed, if(c BETWEEN 10 AND 3600, c, NULL) > 1800 AS slow, 'v3' AS transform_version
FROM (SELECT *, date_sub('second', start_time, end_time) AS c FROM {_T})
"""
register("pl11_backfill", _backfilled)
register_dirty("pl11_backfill_dirty", _backfilled)

# C8 with bounds: totals per batch or tool in the sample
_per = {r: q.replace("::VARCHAR AS ex", " AS c") for r, q in ITEMS.items() if r in ("DQ001", "DQ002", "DQ004", "DQ005", "DQ007", "DQ015", "DQ016", "DQ017")}
_per["DQ003"] = f"SELECT batch_id AS c, 1 AS w FROM {_T} ANTI JOIN dim_process_steps USING (process_step_id)"
_per["DQ014"] = f"SELECT batch_id AS c, 1 AS w FROM {_T} GROUP BY batch_id, wafer_id HAVING count(*) > 1"
_y = " UNION ALL ".join(f"SELECT '{r}' AS rule_id, c, sum(w) AS y FROM (" + _swap(_per[r], {"fact_wafer_tests": _TE, EV: _EV} | (
    {"dim_wafer_batches": _BA} if r in ("DQ002", "DQ015") else {})) + ") GROUP BY c" for r in _SAMPLED)
_names = ", ".join(f"('{r.rule_id}', '{r.severity}', {r.threshold}::BIGINT)" for r in RULES if r.rule_id in _SAMPLED)
_judged = lambda n: f"CASE WHEN {n} <= threshold THEN 'PASS' WHEN severity IN ('CRITICAL', 'HIGH') THEN 'FAIL' ELSE 'WARNING' END"
_estimated = f"""
WITH some_tests AS (SELECT * FROM fact_wafer_tests WHERE {_SOME["fact_wafer_tests"]}),
     some_events AS (SELECT * FROM {EV} WHERE {_SOME[EV]}),
     some_batches AS (SELECT * FROM dim_wafer_batches WHERE {_SOME["dim_wafer_batches"]}),
     g AS (SELECT rule_id, count(*) AS k, sum(y)::BIGINT AS s, sum(y * y)::DOUBLE AS q, max(y)::BIGINT AS m FROM ({_y}) GROUP BY rule_id),
     b AS (SELECT rule_id, severity, threshold, coalesce(k, 0) AS clusters, coalesce(s, 0) AS found, coalesce(round(s / 0.05), 0)::BIGINT AS estimate,
                  coalesce(round(sqrt(0.95 * q) / 0.05, 4), 0) AS std_error,
                  coalesce(greatest(s, floor(s / 0.05 - 1.959964 * sqrt(0.95 * q) / 0.05)::BIGINT), 0) AS low,
                  coalesce(greatest(ceil(s / 0.05 + 1.959964 * sqrt(0.95 * q) / 0.05)::BIGINT, 59 * m), 59) AS high
           FROM (VALUES {_names}) r(rule_id, severity, threshold) LEFT JOIN g USING (rule_id))
SELECT *, if(({_judged('low')}) = ({_judged('high')}), {_judged('low')}, 'UNCERTAIN') AS status FROM b
"""
register("c8_estimated_checks", _estimated)
register_dirty("c8_estimated_checks_dirty", _estimated)

# C10 from the ledger: every rule over the rows of the week before each run
_runs = {0: "2024-01-31", 7: "2024-01-24", 14: "2024-01-17"}
_weeks = ", ".join(f"""tests_{k} AS (SELECT * FROM {_T} WHERE test_timestamp > TIMESTAMP '{d}' - INTERVAL 7 DAY AND test_timestamp <= TIMESTAMP '{d}'),
     events_{k} AS (SELECT * FROM {_E} WHERE ingestion_timestamp > TIMESTAMP '{d}' - INTERVAL 7 DAY AND ingestion_timestamp <= TIMESTAMP '{d}')"""
                   for k, d in _runs.items())
_ran = " UNION ALL ".join(f"SELECT rule_id, DATE '{d}' AS date, violations FROM ({rule_row(r.rule_id, _swap(ITEMS[r.rule_id], {_T: f'tests_{k}', _E: f'events_{k}'}))})"
                          for k, d in _runs.items() for r in RULES)
_ledger = f"""
WITH {_weeks}, r AS ({_ran})
SELECT a.rule_id, a.date, any_value(a.violations) AS violations, max(b.violations) FILTER (b.date = a.date - 7) AS prev_violations,
       round(avg(b.violations), 4) AS trailing_avg
FROM r a JOIN r b ON a.rule_id = b.rule_id AND b.date <= a.date GROUP BY a.rule_id, a.date
"""
register("c10_stored_trend", _ledger)
register_dirty("c10_stored_trend_dirty", _ledger)

# IO1-IO4: which lines the landing breaks
_landed = f"""
SELECT event_id, equipment_id, event_timestamp, status, event_timestamp::DATE AS event_date, NULL::BIGINT AS fields FROM {_E}
WHERE event_id % 101 <> 3 AND event_id % 103 <> 4 AND event_id % 107 <> 5 AND event_timestamp::DATE >= DATE '2024-01-21'
UNION ALL
SELECT event_id, NULL, NULL, NULL, NULL, CASE WHEN event_id % 103 = 4 THEN 2 WHEN event_id % 107 = 5 THEN 5 ELSE 4 END
FROM {_E} WHERE event_id % 101 = 3 OR event_id % 103 = 4 OR event_id % 107 = 5
"""
register("io_raw_landing", _landed)
register_dirty("io_raw_landing_dirty", _landed)
