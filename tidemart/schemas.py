"""Declared schemas of the source feeds and the star schema.

Keys are 64-bit: at warehouse scale order and product ids pass 2^31.
Money is exact ``decimal(10,2)`` end to end; doubles appear only in report
outputs, as the last step.
"""

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)

# --- operational sources -------------------------------------------------

# Transactions feed.  Column order is the positional CSV layout
# ORDER_ID, ORDER_DATE, PRODUCT_ID, QUANTITY, CUSTOMER_ID, TIME_ID.
TRANSACTIONS_CSV = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("time_id", T.IntegerType()),
])

# Product master CSV; the price arrives as text such as "1299.99$".
PRODUCTS_CSV = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("product_price", T.StringType()),
    T.StructField("supplier_id", T.LongType()),
    T.StructField("supplier_name", T.StringType()),
    T.StructField("store_id", T.IntegerType()),
    T.StructField("store_name", T.StringType()),
])

CUSTOMERS_CSV = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("gender", T.StringType()),
])

# The enrichment input: the CSV layout plus the order line number and the
# line's supplier (both optional; see operators.enrich.normalise_feed).
FEED_COLUMNS = (
    "order_id", "line_no", "order_date", "product_id", "supplier_id",
    "quantity", "customer_id", "time_id",
)

# --- warehouse star schema ----------------------------------------------

FACT_COLUMNS = (
    "order_id", "line_no", "quantity", "customer_id", "product_id",
    "store_id", "supplier_id", "time_id", "total_sales",
)

# Identity of one fact row.  (order_id, line_no) alone is not unique in
# the fixture feeds; these five columns are.  A feed with a real primary
# key passes its own key instead.
FACT_KEY = ("order_id", "line_no", "product_id", "supplier_id", "quantity")

# time dimension columns (the other dimensions: operators.dims.DIMENSIONS)
DIM_TIME = ("time_id", "order_date", "day", "week", "month", "year", "quarter")
