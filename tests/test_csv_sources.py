import os
import tempfile
from decimal import Decimal

from tidemart.sources.counts import source_counts
from tidemart.schemas import CUSTOMERS_CSV, PRODUCTS_CSV, TRANSACTIONS_CSV
from tidemart.sources.csv_feeds import read_checked_csv, read_customers_csv, read_products_csv, read_transactions_csv, with_prices


def _write(text: str) -> str:
    d = tempfile.mkdtemp(prefix="tidemart-csv-")
    path = os.path.join(d, "feed.csv")
    with open(path, "wb") as fh:
        fh.write(text.replace("\n", "\r\n").encode())
    return path


def test_products_csv_price_quotes_and_crlf(spark):
    path = _write(
        "productID,productName,productPrice,supplierID,supplierName,storeID,storeName\n"
        '2,Tablet Pro,1299.99$,2,Gadget Works,2,Tech Corner\n'
        '5,"Speaker, Portable",69.99$,7,"Audio, Inc.",3,Sound Spot\n'
        "6,Odd Row,n/a,8,,4,\n7,Dots,\"1.299,99$\",8,S,4,T\n8,Commas,\"1,299.99$\",8,S,4,T\n9,Blank,,8,S,4,T\n")
    rows = {r.product_id: r for r in read_products_csv(spark, path).collect()}
    assert rows[2].product_price == Decimal("1299.99")
    assert rows[5].product_name == "Speaker, Portable" and rows[5].supplier_name == "Audio, Inc."
    assert rows[2].store_name == "Tech Corner"          # no trailing CR
    assert rows[6].product_price is None and rows[6].store_name is None
    assert rows[7].product_price is None and rows[8].product_price == Decimal("1299.99")
    assert [rows[i].bad_price for i in (2, 6, 7, 8, 9)] == [False, True, True, False, False]


def test_customers_and_transactions_csv(spark):
    cpath = _write("customer_id,customer_name,gender\n17,Ethan Marsh,Male\n50,Penny Reed,Female\n")
    cust = {r.customer_id: r.gender for r in read_customers_csv(spark, cpath).collect()}
    assert cust == {17: "Male", 50: "Female"}
    tpath = _write("ORDER_ID,ORDER_DATE,PRODUCT_ID,QUANTITY,CUSTOMER_ID,TIME_ID\n"
                   "1,2019-01-05,2,3,17,1\n2,,5,,50,\n")
    tx = {r.order_id: r for r in read_transactions_csv(spark, tpath).collect()}
    assert str(tx[1].order_date) == "2019-01-05" and tx[1].quantity == 3
    assert tx[2].order_date is None and tx[2].quantity is None and tx[2].time_id is None


def test_source_counts(spark):
    a = spark.range(3)
    b = spark.range(0)
    got = {r.table_name: r.row_count for r in source_counts({"a": a, "b": b}).collect()}
    assert got == {"a": 3, "b": 0}


def test_malformed_rows_go_to_quarantine(spark):
    path = _write("ORDER_ID,ORDER_DATE,PRODUCT_ID,QUANTITY,CUSTOMER_ID,TIME_ID\n"
                  "1,2019-01-05,2,3,17,1\n2,2019-13-45,5,1,50,2\n3,2019-01-05,two,3,17,1\n4,2019-01-05,2\n"
                  "5,2019-01-05,2,3,17,1,extra\n6,,5,,50,\n\n7,2019-01-06,2,99999999999,17,1\n")
    read = read_checked_csv(spark, path, TRANSACTIONS_CSV)
    assert sorted(r.order_id for r in read.rows.collect()) == [1, 6]
    bad = read.quarantine.collect()
    assert sorted(r.text for r in bad) == [
        "2,2019-13-45,5,1,50,2", "3,2019-01-05,two,3,17,1", "4,2019-01-05,2", "5,2019-01-05,2,3,17,1,extra", "7,2019-01-06,2,99999999999,17,1"]
    assert {r.file for r in bad} == {"feed.csv"}


def test_quoted_line_breaks(spark):
    path = _write('productID,productName,productPrice,supplierID,supplierName,storeID,storeName\n'
                  '2,"Tablet\nPro, ""new""",1299.99$,2,Gadget Works,2,Tech Corner\n3,"broken\nrow",1.00$\n4,Mouse,20.00$,9,Mice Co,3,High Square\n')
    read = read_checked_csv(spark, path, PRODUCTS_CSV, multi_line=True)
    rows = {r.product_id: r for r in with_prices(read.rows).collect()}
    assert set(rows) == {2, 4} and rows[2].product_name.replace("\r", "") == 'Tablet\nPro, "new"' and rows[2].product_price == Decimal("1299.99")
    assert [r.text.replace("\r", "") for r in read.quarantine.collect()] == ['3,"broken\nrow",1.00$']


def test_a_clean_file_has_an_empty_quarantine(spark):
    path = _write("customer_id,customer_name,gender\n17,Ethan Marsh,Male\n50,,\n")
    read = read_checked_csv(spark, path, CUSTOMERS_CSV)
    assert read.quarantine.count() == 0 and sorted(r.customer_id for r in read.rows.collect()) == [17, 50]
