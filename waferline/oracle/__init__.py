"""Independent DuckDB SQL for every registered query (the correctness oracle).

``VIEWS`` spells out the same star-schema mapping as
:func:`waferline.sources.driver.driver_tables` over the driver's pre-registered
tables; each query is ``WITH <VIEWS>, <query CTEs> SELECT ...``. Oracle rules:
DOUBLE ratios, BIGINT counts, ``date_sub`` for whole-unit TIMESTAMPDIFF, the
Sunday-week formula for YEARWEEK, ``nullif`` for ANSI-safe division, NaN -> NULL
for correlations, literal as-of instant.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"

VIEWS = """
dim_equipment AS (
  SELECT s.s_suppkey AS equipment_id,
         ['ETCH','LITHO','IMPLANT','CVD','PVD','CMP','TEST'][1 + s.s_nationkey % 7] AS equipment_type,
         n.n_name AS manufacturer,
         CAST(DATE '2024-01-01' - CAST(365 + (s.s_suppkey * 37) % 1460 AS INTEGER) AS DATE) AS install_date,
         CASE WHEN s.s_acctbal < 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
),
dim_process_steps AS (
  SELECT * FROM (VALUES
    (1, 'Photolithography', 'LITHO', 45),
    (2, 'Plasma Etch', 'ETCH', 30),
    (3, 'Ion Implantation', 'IMPLANT', 60),
    (4, 'CVD Deposition', 'CVD', 40),
    (5, 'Chemical Mechanical Polish', 'CMP', 25),
    (6, 'Electrical Test', 'TEST', 15)
  ) t(process_step_id, process_step_name, equipment_type, duration_min)
),
fact_wafer_tests AS (
  SELECT wafer_id, batch_id, process_step_id, process_step_name, equipment_id, start_time,
         start_time + CAST(12 + l_quantity AS INTEGER) * INTERVAL 1 MINUTE AS end_time,
         pass_fail, defect_density, bin_code,
         start_time + CAST(12 + l_quantity AS INTEGER) * INTERVAL 1 MINUTE AS test_timestamp
  FROM (
    SELECT l_orderkey AS wafer_id, l_orderkey // 25 AS batch_id,
           l_linenumber AS process_step_id,
           CASE l_linenumber WHEN 1 THEN 'Photolithography' WHEN 2 THEN 'Plasma Etch'
                WHEN 3 THEN 'Ion Implantation' WHEN 4 THEN 'CVD Deposition'
                WHEN 5 THEN 'Chemical Mechanical Polish' WHEN 6 THEN 'Electrical Test' END
             AS process_step_name,
           l_suppkey AS equipment_id,
           TIMESTAMP '2024-01-01 00:00:00'
             + ((l_orderkey // 25) * 7919 % 43200 + (l_linenumber - 1) * 45) * INTERVAL 1 MINUTE
             AS start_time,
           l_quantity,
           CASE WHEN l_tax >= 0.075 THEN 'FAIL' ELSE 'PASS' END AS pass_fail,
           l_discount AS defect_density,
           l_returnflag || l_linestatus AS bin_code
    FROM lineitem
  ) x
),
dim_wafer_batches AS (
  SELECT b.batch_id,
         printf('LOT_2024_%04d', b.batch_id // 4) AS lot_number,
         ['CMOS_28nm_v3','FinFET_14nm_v2','GAA_7nm_v1'][1 + b.batch_id % 3] AS recipe,
         TIMESTAMP '2024-01-01 00:00:00' + (b.batch_id * 7919 % 43200) * INTERVAL 1 MINUTE AS start_time,
         TIMESTAMP '2024-01-01 00:00:00' + (b.batch_id * 7919 % 43200 + 195 + b.batch_id * 13 % 80)
           * INTERVAL 1 MINUTE AS end_time,
         r.equipment_sequence,
         b.wafer_count
  FROM (SELECT o_orderkey // 25 AS batch_id, CAST(COUNT(*) AS INTEGER) AS wafer_count
        FROM orders GROUP BY 1) b
  LEFT JOIN (
    SELECT batch_id, string_agg(CAST(tool AS VARCHAR), ',' ORDER BY pos) AS equipment_sequence
    FROM (SELECT l_orderkey // 25 AS batch_id, l_linenumber AS pos, MIN(l_suppkey) AS tool
          FROM lineitem GROUP BY 1, 2) p
    GROUP BY batch_id
  ) r ON b.batch_id = r.batch_id
),
fact_equipment_events AS (
  SELECT user_id AS equipment_id, ts AS event_timestamp,
         CASE event_type WHEN 'view' THEN 'RUNNING' WHEN 'click' THEN 'RUNNING'
              WHEN 'purchase' THEN 'IDLE' WHEN 'error' THEN 'ALARM' WHEN 'signup' THEN 'DOWN' END
           AS status,
         value AS temperature_c,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS pressure_torr,
         ts + (event_id * 9973 % 93600) * INTERVAL 1 SECOND AS ingestion_timestamp,
         event_id
  FROM events
),
maintenance_events AS (
  SELECT event_id, equipment_id,
         CASE WHEN event_id % 2 = 0 THEN 'PREVENTIVE' ELSE 'CORRECTIVE' END AS event_type,
         event_timestamp,
         CAST(1 + event_id % 8 AS INTEGER) AS duration_hours
  FROM fact_equipment_events WHERE pressure_torr < 10
)"""


_FACTS = ("dim_equipment", "fact_wafer_tests", "dim_wafer_batches", "fact_equipment_events", "maintenance_events")


def _clean(text: str) -> str:
    for name in _FACTS:
        text = text.replace(name, "clean_" + name)
    return text


#: The faults of :mod:`waferline.sources.dirty` over the clean views.
DIRTY_VIEWS = _clean(VIEWS) + """,
dim_equipment AS (
  SELECT * FROM clean_dim_equipment
  UNION ALL SELECT -1, 'ETCH', 'NONE', DATE '2020-01-01', 'ACTIVE'
),
fact_wafer_tests AS (
  SELECT * REPLACE (
    CASE WHEN (wafer_id + process_step_id) % 997 = 1 OR (batch_id % 79 = 5 AND process_step_id <= 3) THEN NULL ELSE wafer_id END AS wafer_id,
    CASE WHEN wafer_id % 983 = 3 THEN batch_id + 1000000 ELSE batch_id END AS batch_id,
    CASE WHEN wafer_id % 977 = 4 THEN 99 ELSE process_step_id END AS process_step_id,
    CASE WHEN wafer_id % 991 = 2 THEN NULL ELSE equipment_id END AS equipment_id,
    CASE WHEN wafer_id % 937 = 11 AND process_step_id = 3 THEN start_time - INTERVAL 2 DAY ELSE start_time END AS start_time,
    CASE WHEN wafer_id % 953 = 8 THEN start_time + INTERVAL 5 SECOND ELSE end_time END AS end_time,
    CASE WHEN wafer_id % 967 = 6 THEN 'MAYBE' WHEN wafer_id % 967 = 7 THEN NULL ELSE pass_fail END AS pass_fail,
    CASE WHEN wafer_id % 971 = 5 THEN -defect_density - 1 ELSE defect_density END AS defect_density)
  FROM (SELECT * FROM clean_fact_wafer_tests
        UNION ALL SELECT * FROM clean_fact_wafer_tests WHERE wafer_id % 947 = 9
        UNION ALL SELECT * REPLACE (batch_id + 1 AS batch_id) FROM clean_fact_wafer_tests WHERE wafer_id % 941 = 10)
),
dim_wafer_batches AS (
  SELECT * REPLACE (
    CASE WHEN batch_id % 97 = 1 THEN start_time ELSE end_time END AS end_time,
    CASE WHEN batch_id % 83 = 3 THEN equipment_sequence || ',X99' ELSE equipment_sequence END AS equipment_sequence)
  FROM (SELECT * FROM clean_dim_wafer_batches UNION ALL SELECT * FROM clean_dim_wafer_batches WHERE batch_id % 89 = 2)
),
fact_equipment_events AS (
  SELECT * REPLACE (
    CASE WHEN event_id % 499 = 3 THEN NULL ELSE equipment_id END AS equipment_id,
    CASE WHEN event_id % 37 = 1 THEN 900.0 ELSE temperature_c END AS temperature_c,
    CASE WHEN event_id % 41 = 2 THEN 5000.0 ELSE pressure_torr END AS pressure_torr,
    event_timestamp - INTERVAL 5 HOUR AS event_timestamp)
  FROM clean_fact_equipment_events
),
maintenance_events AS (
  SELECT * REPLACE (CASE WHEN event_id % 499 = 3 THEN NULL ELSE equipment_id END AS equipment_id,
                    event_timestamp - INTERVAL 5 HOUR AS event_timestamp)
  FROM clean_maintenance_events
)"""


def with_views(body: str, views: str = VIEWS) -> str:
    """Prefix a query that may start with its own ``WITH`` CTEs by the star-schema views."""
    b = body.strip()
    if b[:4].upper() == "WITH":
        return "WITH " + views + ",\n" + b[4:]
    return "WITH " + views + "\n" + b


QUERIES: dict[str, str] = {}


def register(name: str, body: str) -> None:
    QUERIES[name] = with_views(body.replace("{AS_OF}", AS_OF))


def register_dirty(name: str, body: str) -> None:
    """The same statement over the tables with faults."""
    QUERIES[name] = with_views(body.replace("{AS_OF}", AS_OF), DIRTY_VIEWS)


def load_all() -> dict[str, str]:
    from waferline.oracle import yields  # noqa: F401
    for mod in ("equipment", "trace", "quality", "layers", "kpi", "streaming", "primitives"):
        try:
            __import__(f"waferline.oracle.{mod}")
        except ModuleNotFoundError as e:
            if e.name != f"waferline.oracle.{mod}":
                raise
    return dict(QUERIES)


def since(ts: str, days: int) -> str:
    """``ts`` within the last ``days`` days before the as-of instant."""
    return f"{ts} >= {AS_OF} - INTERVAL {days} DAY"


def pick(labels, *conditions: str) -> str:
    """The label of the first condition that holds; the last label if none does."""
    names = ", ".join("'" + x.replace("'", "''") + "'" for x in labels)
    tests = ", ".join(f"coalesce({c}, false)" for c in conditions)
    return f"[{names}][list_position([{tests}, true], true)]"


def round_avg(expr: str, digits: int, scale: int = 6) -> str:
    """Exact half-up ROUND(AVG(expr), digits) in integer arithmetic (DuckDB divides
    DECIMALs in DOUBLE)."""
    s = f"SUM(CAST(ROUND(({expr}) * 1e{scale}) AS HUGEINT))"
    n = f"(NULLIF(CAST(COUNT({expr}) AS HUGEINT), 0) * CAST(1e{scale} AS HUGEINT))"
    return round_ratio(s, n, digits)


def round_ratio(num: str, den: str, digits: int) -> str:
    """Exact half-up ROUND(num / den, digits) for integer num and positive integer den."""
    m = 10 ** digits
    return (f"(CAST(sign({num}) * ((2 * abs({num}) * {m} + {den}) // (2 * {den})) AS DOUBLE)"
            f" / {m}.0)")


def hu_div(num: str, den: str) -> str:
    """Integer division rounding half away from zero (den > 0)."""
    return f"(sign({num}) * ((2 * abs({num}) + ({den})) // (2 * ({den}))))"


def dec_avg(expr: str, scale: int = 6) -> str:
    """Spark's AVG over DECIMAL(p, scale) values as an integer scaled by 10^(scale+4)
    (Spark keeps 4 more digits and rounds half up)."""
    s = f"SUM(CAST(ROUND(({expr}) * 1e{scale}) AS HUGEINT))"
    return hu_div(f"{s} * 10000", f"NULLIF(CAST(COUNT({expr}) AS HUGEINT), 0)")


YEARWEEK = ("(year(CAST({ts} AS DATE) - CAST(dayofweek({ts}) AS INTEGER)) * 100 + "
            "(dayofyear(CAST({ts} AS DATE) - CAST(dayofweek({ts}) AS INTEGER)) + 6) // 7)")


def yearweek(ts: str) -> str:
    return "CAST(" + YEARWEEK.format(ts=ts) + " AS INTEGER)"
