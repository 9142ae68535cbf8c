"""The curated star schema as a bundle of DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace
from datetime import datetime

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class FabTables:
    dim_equipment: DataFrame
    dim_process_steps: DataFrame
    dim_wafer_batches: DataFrame
    fact_wafer_tests: DataFrame
    fact_equipment_events: DataFrame
    maintenance_events: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}

    def with_(self, **kw) -> "FabTables":
        return replace(self, **kw)

    def register(self) -> None:
        """Register every table as a temp view (for users who prefer spark.sql)."""
        for name, df in self.as_dict().items():
            df.createOrReplaceTempView(name)


# Wall-clock replacement used by tests and the driver tables.
DEFAULT_AS_OF = datetime(2024, 1, 31, 0, 0, 0)
