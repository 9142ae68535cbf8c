"""waferline: Spark-native yield, equipment-health, traceability and data-quality
operators for wafer-fabrication data.

Every operator takes DataFrames (usually a :class:`~waferline.sources.tables.FabTables`
bundle) and returns a lazy DataFrame. No operator collects data to the driver; the
only actions are the optional dimension-size checks in
:func:`waferline.operators.joins.dim_join` and the IO helpers.
"""

from waferline.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
