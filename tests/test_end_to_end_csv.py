"""CSV files in the operational layout -> warehouse -> reports.

Product rows carry their supplier and store (no separate supplier master);
the transactions file is keyed by order id alone.
"""

import os
import tempfile

from tidemart.plans import reports as R
from tidemart.plans.load import load_warehouse, new_warehouse_root
from tidemart.sources.csv_feeds import read_customers_csv, read_products_csv, read_transactions_csv

PRODUCTS = (
    "productID,productName,productPrice,supplierID,supplierName,storeID,storeName\n"
    "1,Phone X,500.00$,7,Acme Devices,1,Central\n"
    '2,"Cable, USB-C",10.50$,8,Wire Co,1,Central\n'
    "3,Headset,80.00$,7,Acme Gadgets,2,Harbour\n"
    "4,Lamp,call us,8,Wire Co,1,Central\n"
)
CUSTOMERS = "customer_id,customer_name,gender\n1,Ann Lee,Female\n2,Bo Chan,Male\n"
TRANSACTIONS = (
    "ORDER_ID,ORDER_DATE,PRODUCT_ID,QUANTITY,CUSTOMER_ID,TIME_ID\n"
    "10,2019-01-05,1,1,1,1\n"
    "11,2019-01-05,2,4,2,1\n"
    "12,2019-02-10,3,2,1,2\n"
    "13,2019-07-01,1,2,2,3\n"
    "14,2019-07-01,9,1,2,3\n"      # unknown product -> reject
    "15,2019-08-15,2,1,5,4\n"      # unknown customer -> reject
    "16,2019-08-15,4,1,1,4\n"      # no readable price -> reject, no sale of 0.00
)


def _files():
    d = tempfile.mkdtemp(prefix="tidemart-e2e-")
    out = {}
    for name, text in (("products", PRODUCTS), ("customers", CUSTOMERS), ("transactions", TRANSACTIONS)):
        path = os.path.join(d, f"{name}.csv")
        with open(path, "wb") as fh:
            fh.write(text.replace("\n", "\r\n").encode())
        out[name] = path
    return out


def test_csv_layout_through_warehouse_and_reports(spark):
    f = _files()
    feed = read_transactions_csv(spark, f["transactions"])
    products = read_products_csv(spark, f["products"])
    customers = read_customers_csv(spark, f["customers"])
    root = new_warehouse_root(spark)
    star = load_warehouse(spark, root, feed, customers, products, fact_key=("order_id",))
    facts = {r.order_id: r for r in star.fact.collect()}
    assert set(facts) == {10, 11, 12, 13}
    assert float(facts[11].total_sales) == 42.0 and facts[11].supplier_id == 8
    rejects = {r.order_id: r.bad_amount for r in spark.read.parquet(f"{root}/rejects").collect()}
    assert rejects == {14: False, 15: False, 16: True}
    # supplier 7 arrives as "Acme Devices" first (smallest order id)
    assert star.supplier.where("supplier_id = 7").collect()[0].supplier_name == "Acme Devices"
    # time ids come from the feed (1..4), one row per (id, date)
    assert sorted(r.time_id for r in star.time.collect()) == [1, 2, 3, 4]

    q2 = {(r.store_id, r.quarters): r.totalrevenue for r in R.q2_store_quarter_revenue(star, year=2019).collect()}
    assert q2 == {(1, 1): 542.0, (2, 1): 160.0, (1, 3): 1000.0}
    q3 = {(r.store_name, r.supplier_name, r.product_name): r.totalsalescontribution
          for r in R.q3_store_supplier_product(star).collect()}
    assert q3[("Central", "Wire Co", "Cable, USB-C")] == 42.0

    # a second identical load adds nothing
    star = load_warehouse(spark, root, feed, customers, products, fact_key=("order_id",))
    assert star.fact.count() == 4
    assert spark.read.parquet(f"{root}/rejects").count() == 3
