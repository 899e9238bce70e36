"""CSV feeds of the operational sources.

Files are comma separated, ``"``-quoted, with one header line and CR LF
line ends.  Columns are bound by *position* to a declared schema (headers
such as ``productID`` are ignored), the trailing CR never reaches the last
column, prices such as ``1299.99$`` become decimal(10,2).  Spark splits
each file into byte ranges, so a large feed is read by many tasks.

``read_checked_csv`` also keeps what does not fit: a row with too few or too many
fields, or with a field that is no value of its column's type, goes with its
text to a quarantine table instead of losing fields silently.  Quoted fields may
hold line ends if ``multi_line`` is set; such files are read whole, a task each.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.measures import parse_price
from tidemart.schemas import CUSTOMERS_CSV, PRODUCTS_CSV, TRANSACTIONS_CSV
from tidemart.session import materialize

CSV_OPTIONS = {
    "header": "true",
    "enforceSchema": "true",   # positional: header names may differ
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",      # a malformed field becomes NULL, not a failed job
    "dateFormat": "yyyy-MM-dd",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}


def _strip_cr(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Drop a stray CR (a file written with CR LF but split on LF)."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            c = F.regexp_replace(c, "\r$", "").alias(f.name)
        cols.append(c)
    return df.select(*cols)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    reader = spark.read.schema(schema)
    for k, v in {**CSV_OPTIONS, **options}.items():
        reader = reader.option(k, v)
    return _strip_cr(reader.csv(path), schema)


class CheckedCsv(NamedTuple):
    """``rows``: the rows that fit; ``quarantine``: file and text of those that do not."""

    rows: DataFrame
    quarantine: DataFrame


def read_checked_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False, **options) -> CheckedCsv:
    """Read a CSV once and deal it into good rows and quarantine."""
    text, file = "_corrupt_text", "_file"
    whole = T.StructType([*schema.fields, T.StructField(text, T.StringType())])
    reader = spark.read.schema(whole)
    for k, v in {**CSV_OPTIONS, "multiLine": str(multi_line).lower(), "columnNameOfCorruptRecord": text, **options}.items():
        reader = reader.option(k, v)
    # stored: parsed once, and both parts see the same rows
    read = materialize(reader.csv(path).select("*", F.element_at(F.split("_metadata.file_path", "/"), -1).alias(file)), "csv-rows")
    rows = _strip_cr(read.where(F.col(text).isNull()).drop(text, file), schema)
    bad = read.where(F.col(text).isNotNull()).select(F.col(file).alias("file"), F.regexp_replace(text, "[\\r\\n]+$", "").alias("text"))
    return CheckedCsv(rows, bad)


def read_transactions_csv(spark: SparkSession, path: str, **options) -> DataFrame:
    """ORDER_ID, ORDER_DATE, PRODUCT_ID, QUANTITY, CUSTOMER_ID, TIME_ID."""
    return read_csv(spark, path, TRANSACTIONS_CSV, **options)


def read_customers_csv(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_csv(spark, path, CUSTOMERS_CSV, **options)


def read_products_csv(spark: SparkSession, path: str, **options) -> DataFrame:
    """Product master with the price text parsed to decimal(10,2); ``bad_price``
    marks text that is no price (a blank price is just unknown)."""
    return with_prices(read_csv(spark, path, PRODUCTS_CSV, **options))


def with_prices(raw: DataFrame) -> DataFrame:
    """The price text of a product master as decimal(10,2), and ``bad_price``."""
    price = parse_price("product_price")
    bad = F.coalesce(F.trim("product_price") != "", F.lit(False)) & price.isNull()
    return raw.withColumns({"product_price": price, "bad_price": bad})


def write_csv(df: DataFrame, path: str, crlf: bool = True) -> None:
    """Write in the same dialect (header, quoted where needed, CR LF)."""
    (df.write.mode("overwrite")
     .option("header", "true").option("quote", '"').option("escape", '"')
     .option("lineSep", "\r\n" if crlf else "\n")
     .option("dateFormat", "yyyy-MM-dd")
     .csv(path))
