"""Row counts of the source tables (load verification)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def source_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row (table_name, row_count) per named DataFrame.

    Each count is a global aggregate (partial counts per task, one final
    row), unioned into one result."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), F.col("row_count"))
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
