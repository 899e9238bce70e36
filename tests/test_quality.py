from tests import fixtures as fx
from tidemart.operators.quality import dependency_violations, duplicate_keys, null_counts, orphan_report


def test_planted_faults_are_found(spark):
    a = fx.d(1998, 1, 1)
    rows = [
        (1, 1, a, 10, None, 1, 1, 19980101),
        (1, 1, a, 11, None, 1, 1, 19980101),     # duplicate (order, line)
        (2, 1, a, 99, None, 1, 42, 19980101),    # orphan product and customer
        (3, 1, None, None, None, None, 1, 19980101),  # NULL product / date / qty
        (4, 1, fx.d(1998, 1, 2), 10, None, 1, 1, 19980101),  # time id with 2nd date
    ]
    feed = fx.feed(spark, rows)
    dup = [tuple(r) for r in duplicate_keys(feed, ["order_id", "line_no"]).collect()]
    assert dup == [(1, 1, 2)]
    orphans = {(r.foreign_key, r.key_value): r.n_rows for r in orphan_report(feed, [
        ("customer_id", fx.customers(spark), "customer_id"),
        ("product_id", fx.products(spark), "product_id")]).collect()}
    assert orphans == {("customer_id", 42): 1, ("product_id", 99): 1}
    nulls = null_counts(feed, ["product_id", "order_date", "quantity"]).collect()[0]
    assert (nulls.n_rows, nulls.null_product_id, nulls.null_order_date, nulls.null_quantity) == (5, 1, 1, 1)
    fan = [tuple(r) for r in dependency_violations(feed, "time_id", "order_date").collect()]
    assert fan == [(19980101, 3)]   # two dates and a NULL date


def test_supplier_name_conflicts(spark):
    conflicts = [tuple(r) for r in dependency_violations(fx.products(spark), "supplier_id", "supplier_name").collect()]
    assert conflicts == [(7, 2)]


def test_key_report_over_tables(spark):
    from tidemart.operators.quality import key_report
    a = spark.createDataFrame([(1,), (2,), (2,), (None,), (None,)], "id long")
    b = spark.createDataFrame([(5,), (6,)], "k long")
    got = [tuple(r) for r in key_report({"a": (a, "id"), "b": (b, "k")}).collect()]
    assert got == [("a", 2, 2)]
