"""Hand-made edge fixtures in the reference's own layout."""

import datetime as dt
from decimal import Decimal

FEED_SCHEMA = ("order_id long, line_no int, order_date date, product_id long, "
               "supplier_id long, quantity int, customer_id long, time_id int")
CUSTOMER_SCHEMA = "customer_id long, customer_name string, gender string"
PRODUCT_SCHEMA = ("product_id long, product_name string, product_price decimal(10,2), "
                  "supplier_id long, supplier_name string, store_id int, store_name string")


def d(y, m, day):
    return dt.date(y, m, day)


def tid(date):
    return date.year * 10000 + date.month * 100 + date.day


def customers(spark):
    return spark.createDataFrame([
        (1, "Ann", "Female"), (2, "Bob", "Male"), (3, "Cy", "Male"),
    ], CUSTOMER_SCHEMA)


def products(spark):
    # product 10 and 11 share supplier 7 under two names (first row wins)
    return spark.createDataFrame([
        (10, "Laptop", Decimal("1000.00"), 7, "Alder Optics", 1, "Mill Lane"),
        (11, "Camera", Decimal("500.00"), 7, "Birch Imaging", 2, "Quay Street"),
        (12, "Cable", None, 8, "Wires Ltd", 1, "Mill Lane"),
        (13, "Mouse", Decimal("20.00"), 9, "Mice Co", 3, "High Square"),
    ], PRODUCT_SCHEMA)


def feed_rows():
    a, b = d(1998, 1, 15), d(1998, 2, 20)
    return [
        # matched
        (100, 1, a, 10, None, 2, 1, tid(a)),
        (100, 2, a, 11, None, 1, 1, tid(a)),
        (101, 1, b, 11, None, 3, 2, tid(b)),
        (102, 1, b, 12, None, 4, 3, tid(b)),          # NULL price -> 0.00
        (103, 1, b, 13, None, None, 2, tid(b)),       # NULL quantity -> 0
        # unmatched: customer, product, both
        (200, 1, a, 10, None, 1, 99, tid(a)),
        (201, 1, a, 77, None, 1, 1, tid(a)),
        (202, 1, a, 78, None, 1, 98, tid(a)),
        # NULL date: no time row
        (203, 1, None, 13, None, 1, 3, None),
    ]


def feed(spark, rows=None):
    return spark.createDataFrame(rows if rows is not None else feed_rows(), FEED_SCHEMA)
