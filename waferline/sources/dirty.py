"""The driver tables with fixed arithmetic faults, so that every rule fires.

The same faults are spelled out in DuckDB SQL in :mod:`waferline.oracle` (``DIRTY_VIEWS``).
All expressions are row-wise; copies are unions of a filter of the same scan.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from waferline.sources.tables import FabTables


def dirty_tables(t: FabTables) -> FabTables:
    w, b, step, e = F.col("wafer_id"), F.col("batch_id"), F.col("process_step_id"), F.col("event_id")
    tests = t.fact_wafer_tests
    cols = tests.columns
    tests = (tests.unionByName(tests.filter(w % 947 == 9))                                      # repeated rows
             .unionByName(tests.filter(w % 941 == 10).withColumn("batch_id", b + 1)))           # a wafer in two batches
    start = F.when((w % 937 == 11) & (step == 3), F.col("start_time") - F.expr("INTERVAL 2 DAYS")).otherwise(F.col("start_time"))
    faulty = {
        "wafer_id": F.when((w + step) % 997 == 1, None).when((b % 79 == 5) & (step <= 3), None).otherwise(w),
        "batch_id": F.when(w % 983 == 3, b + 1000000).otherwise(b),
        "process_step_id": F.when(w % 977 == 4, 99).otherwise(step),
        "equipment_id": F.when(w % 991 == 2, None).otherwise(F.col("equipment_id")),
        "start_time": start,
        "end_time": F.when(w % 953 == 8, F.col("start_time") + F.expr("INTERVAL 5 SECONDS")).otherwise(F.col("end_time")),
        "pass_fail": F.when(w % 967 == 6, "MAYBE").when(w % 967 == 7, None).otherwise(F.col("pass_fail")),
        "defect_density": F.when(w % 971 == 5, -F.col("defect_density") - 1).otherwise(F.col("defect_density")),
    }
    tests = tests.select(*[faulty.get(c, F.col(c)).alias(c) for c in cols])
    batches = t.dim_wafer_batches
    batches = batches.unionByName(batches.filter(b % 89 == 2)).select(*[{
        "end_time": F.when(b % 97 == 1, F.col("start_time")).otherwise(F.col("end_time")),
        "equipment_sequence": F.when(b % 83 == 3, F.concat("equipment_sequence", F.lit(",X99")))
        .otherwise(F.col("equipment_sequence"))}.get(c, F.col(c)).alias(c) for c in batches.columns])

    def events(df, ts):
        return df.select(*[{
            "equipment_id": F.when(e % 499 == 3, None).otherwise(F.col("equipment_id")),
            "temperature_c": F.when(e % 37 == 1, 900.0).otherwise(F.col("temperature_c")) if "temperature_c" in df.columns else None,
            "pressure_torr": F.when(e % 41 == 2, 5000.0).otherwise(F.col("pressure_torr")) if "pressure_torr" in df.columns else None,
            "event_timestamp": F.col(ts) - F.expr("INTERVAL 5 HOURS")}.get(c, F.col(c)).alias(c) for c in df.columns])

    idle = t.dim_equipment.limit(1).select(*[{
        "equipment_id": F.lit(-1).cast("long"), "equipment_type": F.lit("ETCH"), "manufacturer": F.lit("NONE"),
        "status": F.lit("ACTIVE"), "install_date": F.lit("2020-01-01").cast("date")}[c].alias(c) for c in t.dim_equipment.columns])
    return t.with_(fact_wafer_tests=tests, dim_wafer_batches=batches, dim_equipment=t.dim_equipment.unionByName(idle),
                   fact_equipment_events=events(t.fact_equipment_events, "event_timestamp"),
                   maintenance_events=events(t.maintenance_events, "event_timestamp"))
