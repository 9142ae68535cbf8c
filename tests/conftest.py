from __future__ import annotations

import os
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from waferline.session import get_spark  # noqa: E402
from waferline.sources import schemas as S  # noqa: E402
from waferline.sources.tables import FabTables  # noqa: E402

AS_OF = datetime(2024, 1, 31)


@pytest.fixture(scope="session")
def spark():
    s = get_spark("waferline-tests", master="local[4]", shuffle_partitions=4)
    yield s


def ts(*a) -> datetime:
    return datetime(*a)


def ago(days=0, hours=0, minutes=0, seconds=0, micros=0) -> datetime:
    return AS_OF - timedelta(days=days, hours=hours, minutes=minutes, seconds=seconds, microseconds=micros)


def equipment_row(eid, etype="ETCH", manufacturer="M1", install=datetime(2022, 1, 1).date(),
                  status="ACTIVE"):
    return (eid, etype, manufacturer, install, status)


def wt_row(wafer, batch, step, tool, start, minutes=20, result="PASS", dd=0.1, bin_code="B0",
             test_ts=None, name=None):
    end = start + timedelta(minutes=minutes)
    return (wafer, batch, step, name, tool, start, end, result, dd, bin_code, test_ts or end)


def event_row(tool, t, status="RUNNING", temp=100.0, pressure=5.0, ingest=None):
    return (tool, t, status, temp, pressure, None, ingest or t)


def batch_row(bid, start, hours=4, lot="LOT_2024_0001", recipe="R1", seq="", wafers=25):
    return (bid, lot, recipe, start, start + timedelta(hours=hours), seq, wafers)


def maint_row(eid, tool, t, etype="PREVENTIVE", hours=2):
    return (eid, tool, etype, t, hours, None, None)


def make_tables(spark, equipment=(), batches=(), tests=(), events=(), maintenance=(),
                steps=None) -> FabTables:
    def df(rows, schema):
        return spark.createDataFrame(list(rows), schema)
    return FabTables(
        dim_equipment=df(equipment, S.EQUIPMENT),
        dim_process_steps=df(steps if steps is not None else S.PROCESS_STEP_ROWS, S.PROCESS_STEPS),
        dim_wafer_batches=df(batches, S.WAFER_BATCHES),
        fact_wafer_tests=df(tests, S.WAFER_TESTS),
        fact_equipment_events=df(events, S.EQUIPMENT_EVENTS),
        maintenance_events=df(maintenance, S.MAINTENANCE),
    )


def rows(df, *cols):
    """Collect a small test result as a list of tuples (tests only)."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
