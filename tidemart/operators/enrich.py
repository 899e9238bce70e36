"""Enrichment of a transaction feed against customer / product master data.

The stream-against-masters join is a plain equi-join here: Spark chooses a
broadcast hash join while a master is under its broadcast threshold and a
shuffled sort-merge join beyond it; AQE re-decides at run time and splits
skewed feed partitions (one product may carry a third of all lines).  Unlike a paged in-memory buffer, no feed row is ever dropped
silently: rows without a master match come out of :func:`enrich_rejects`
with the missing side(s) flagged; rows whose price is no price, or whose amount
does not fit the money type, are rejected by the loaders too (``bad_amount``).

Two master layouts are supported:

* product rows carry supplier and store (``supplier_id, supplier_name,
  store_id, store_name``): pass ``suppliers=None``;
* the supplier comes with the feed line (``supplier_id``) and a separate
  supplier master carries ``supplier_name, store_id, store_name[, region]``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.dates import time_id_of
from tidemart.functions.measures import sales_amount, zero_if_null
from tidemart.operators.quality import duplicate_keys

SUPPLIER_SIDE = ("supplier_id", "supplier_name", "store_id", "store_name", "region")


def normalise_feed(feed: DataFrame) -> DataFrame:
    """Bring any feed to the enrichment layout.

    A feed keyed by order id alone gets ``line_no = 1``; a feed without a
    per-line supplier gets a NULL ``supplier_id``; a missing ``time_id`` is
    derived from the order date.  Unknown numeric values are kept as NULL
    here and read as 0 in the fact projection.
    """
    cols = set(feed.columns)
    out = feed
    if "line_no" not in cols:
        out = out.withColumn("line_no", F.lit(1))
    if "supplier_id" not in cols:
        out = out.withColumn("supplier_id", F.lit(None).cast("long"))
    if "time_id" not in cols:
        out = out.withColumn("time_id", time_id_of("order_date"))
    return out.select(
        F.col("order_id").cast("long"), F.col("line_no").cast("int"),
        F.col("order_date").cast("date"), F.col("product_id").cast("long"),
        F.col("supplier_id").cast("long"), F.col("quantity").cast("int"),
        F.col("customer_id").cast("long"), F.col("time_id").cast("int"),
    )


def _products_for(products: DataFrame, suppliers: DataFrame | None) -> DataFrame:
    if suppliers is None:
        return products
    return products.select(*[c for c in products.columns if c not in SUPPLIER_SIDE])


def _feed_for(feed: DataFrame, suppliers: DataFrame | None) -> DataFrame:
    return feed if suppliers is not None else feed.drop("supplier_id")


def _enriched_projection(df: DataFrame, extra: list[str]) -> list[Column]:
    head = [
        "order_id", "line_no", "order_date", "customer_id", "customer_name",
        "gender", "product_id", "product_name", "product_price",
        "supplier_id", "supplier_name", "store_id", "store_name",
    ]
    cols = [F.col(c) for c in head]
    cols += [
        zero_if_null("time_id", "int").alias("time_id"),
        zero_if_null("quantity", "int").alias("quantity"),
        sales_amount("product_price", "quantity").alias("total_sales"),
    ]
    cols += [F.col(c) for c in extra]
    return cols


def _bad_amount(products: DataFrame) -> Column:
    """The amount does not fit the money type, or the product's price text was
    no price (a master read from CSV says so in ``bad_price``)."""
    beyond = sales_amount("product_price", "quantity").isNull()
    return beyond | F.coalesce(F.col("bad_price"), F.lit(False)) if "bad_price" in products.columns else beyond


def _extra_columns(*frames: DataFrame) -> list[str]:
    known = {
        "order_id", "line_no", "order_date", "customer_id", "customer_name",
        "gender", "product_id", "product_name", "product_price",
        "supplier_id", "supplier_name", "store_id", "store_name", "time_id",
        "quantity", "bad_price",
    }
    extra: list[str] = []
    for f in frames:
        for c in f.columns:
            if c not in known and c not in extra:
                extra.append(c)
    return extra


class DuplicateMasterKeys(ValueError):
    """A master holds a key more than once, so a join would multiply facts."""


def require_unique_masters(customers: DataFrame, products: DataFrame, suppliers: DataFrame | None = None) -> None:
    """Raise if a master repeats a key; one aggregate over each master's key column."""
    masters = [("customers", customers, "customer_id"), ("products", products, "product_id")]
    if suppliers is not None:
        masters.append(("suppliers", suppliers, "supplier_id"))
    for name, df, key in masters:
        bad = duplicate_keys(df.where(F.col(key).isNotNull()), [key]).select(key).limit(5).collect()
        if bad:
            raise DuplicateMasterKeys(f"{name}: {key} is repeated, for example {[r[0] for r in bad]}")


def enrich(feed: DataFrame, customers: DataFrame, products: DataFrame,
           suppliers: DataFrame | None = None) -> DataFrame:
    """Matched feed rows with customer, product, supplier and store
    attributes and ``total_sales = price x quantity`` (exact decimal)."""
    f = _feed_for(normalise_feed(feed), suppliers)
    p = _products_for(products, suppliers)
    masters = [customers, p] + ([suppliers] if suppliers is not None else [])
    out = f.join(customers, "customer_id", "inner")
    out = out.join(p, "product_id", "inner")
    if suppliers is not None:
        out = out.join(suppliers, "supplier_id", "inner")
    good = ~_bad_amount(p)
    return out.where(good).select(*_enriched_projection(out, _extra_columns(*masters)))


def _flag_presence(df: DataFrame, master: DataFrame, key: str, flag: str) -> DataFrame:
    # one row per master key, so the left join never multiplies feed rows
    keys = master.select(key).where(F.col(key).isNotNull()).distinct().withColumn(flag, F.lit(True))
    return df.join(keys, key, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def enrich_rejects(feed: DataFrame, customers: DataFrame, products: DataFrame,
                   suppliers: DataFrame | None = None) -> DataFrame:
    """Feed rows that do not enrich, with the missing side(s) flagged.

    ``enrich(...)`` and ``enrich_rejects(...)`` partition the feed: every
    feed row is in exactly one of them (masters with unique keys), but for
    matched rows of a bad amount, which :func:`enrich_flagged` marks.
    """
    f = normalise_feed(feed)
    f = _flag_presence(f, customers, "customer_id", "_has_customer")
    f = _flag_presence(f, products, "product_id", "_has_product")
    if suppliers is not None:
        f = _flag_presence(f, suppliers, "supplier_id", "_has_supplier")
        has_supplier = F.col("_has_supplier")
    else:
        has_supplier = F.col("_has_product")
    ok = F.col("_has_customer") & F.col("_has_product") & has_supplier
    return f.filter(~ok).select(
        "order_id", "line_no", "order_date", "product_id", "supplier_id",
        "quantity", "customer_id", "time_id",
        (~F.col("_has_customer")).alias("missing_customer"),
        (~F.col("_has_product")).alias("missing_product"),
        (~has_supplier).alias("missing_supplier"),
    )


def enrich_flagged(feed: DataFrame, customers: DataFrame, products: DataFrame,
                   suppliers: DataFrame | None = None) -> DataFrame:
    """One pass over the feed giving matched and rejected rows together
    (``matched`` column).  Loaders write this once and split it, instead of
    joining the feed twice."""
    f = _feed_for(normalise_feed(feed), suppliers)
    p = _products_for(products, suppliers)
    c = customers.withColumn("_has_customer", F.lit(True))
    p = p.withColumn("_has_product", F.lit(True))
    out = f.join(c, "customer_id", "left").join(p, "product_id", "left")
    masters = [customers, _products_for(products, suppliers)]
    flags = [F.coalesce(F.col("_has_customer"), F.lit(False)), F.coalesce(F.col("_has_product"), F.lit(False))]
    if suppliers is not None:
        s = suppliers.withColumn("_has_supplier", F.lit(True))
        out = out.join(s, "supplier_id", "left")
        masters.append(suppliers)
        flags.append(F.coalesce(F.col("_has_supplier"), F.lit(False)))
    else:
        flags.append(flags[1])
    cols = _enriched_projection(out, _extra_columns(*masters))
    bad = _bad_amount(p)
    # ``source_time_id`` keeps the feed's own (possibly NULL) time id for the
    # time dimension; the fact reads a missing one as 0
    return out.select(
        *cols,
        F.col("time_id").alias("source_time_id"),
        (~flags[0]).alias("missing_customer"),
        (~flags[1]).alias("missing_product"),
        (~flags[2]).alias("missing_supplier"),
        bad.alias("bad_amount"),
        (flags[0] & flags[1] & flags[2] & ~bad).alias("matched"),
    )
