"""tidemart: a Spark-native retail sales warehouse.

Sources (CSV / parquet feeds) -> enrichment against master data -> star
schema (customer, product, store, supplier, time dimensions + sales fact)
-> data-quality checks and sales reports.  Everything is DataFrame / SQL /
Structured Streaming; there is no engine code of our own.
"""

from tidemart.session import build_session, shared_scratch_dir

__all__ = ["build_session", "shared_scratch_dir"]
