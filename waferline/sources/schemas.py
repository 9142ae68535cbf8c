"""Explicit schemas of the fab tables (raw file names and curated names)."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, TS, DT = (T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(),
                      T.TimestampNTZType(), T.DateType())


def _st(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


EQUIPMENT = _st(("equipment_id", S), ("equipment_type", S), ("manufacturer", S),
                ("install_date", DT), ("status", S))
PROCESS_STEPS = _st(("process_step_id", I), ("process_step_name", S), ("equipment_type", S),
                    ("duration_min", I))
EQUIPMENT_EVENTS = _st(("equipment_id", S), ("event_timestamp", TS), ("status", S),
                       ("temperature_c", D), ("pressure_torr", D), ("rf_power_w", D),
                       ("ingestion_timestamp", TS))
WAFER_BATCHES = _st(("batch_id", S), ("lot_number", S), ("recipe", S), ("start_time", TS),
                    ("end_time", TS), ("equipment_sequence", S), ("wafer_count", I))
WAFER_TESTS = _st(("wafer_id", S), ("batch_id", S), ("process_step_id", I),
                  ("process_step_name", S), ("equipment_id", S), ("start_time", TS),
                  ("end_time", TS), ("pass_fail", S), ("defect_density", D), ("bin_code", S),
                  ("test_timestamp", TS))
MAINTENANCE = _st(("event_id", S), ("equipment_id", S), ("event_type", S),
                  ("event_timestamp", TS), ("duration_hours", I), ("parts_replaced", S),
                  ("technician_id", S))

RULE_RESULT = T.StructType([
    T.StructField("rule_id", S), T.StructField("rule_name", S), T.StructField("category", S),
    T.StructField("severity", S), T.StructField("status", S), T.StructField("violations", L),
    T.StructField("threshold", L), T.StructField("impact", S),
    T.StructField("details", T.ArrayType(S)),
])

# Raw file stem -> (schema, curated name). Curated names are the ones the analytics use.
RAW_TABLES = {
    "equipment_master": (EQUIPMENT, "dim_equipment"),
    "process_steps": (PROCESS_STEPS, "dim_process_steps"),
    "equipment_logs": (EQUIPMENT_EVENTS, "fact_equipment_events"),
    "wafer_batches": (WAFER_BATCHES, "dim_wafer_batches"),
    "test_results": (WAFER_TESTS, "fact_wafer_tests"),
    "maintenance_events": (MAINTENANCE, "maintenance_events"),
}

# Fixed values of the process: the six routed steps of the fab (step id, name, tool type,
# nominal minutes). These must equal the source data's values.
PROCESS_STEP_ROWS = [
    (1, "Photolithography", "LITHO", 45),
    (2, "Plasma Etch", "ETCH", 30),
    (3, "Ion Implantation", "IMPLANT", 60),
    (4, "CVD Deposition", "CVD", 40),
    (5, "Chemical Mechanical Polish", "CMP", 25),
    (6, "Electrical Test", "TEST", 15),
]
# Tool types in the order the source data enumerates them.
EQUIPMENT_TYPES = ["ETCH", "LITHO", "IMPLANT", "CVD", "PVD", "CMP", "TEST"]
# The three recipes of the source data.
RECIPES = ["CMOS_28nm_v3", "FinFET_14nm_v2", "GAA_7nm_v1"]
