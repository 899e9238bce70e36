"""Plan-shape guards over every registered query (executed AQE plans)."""

import re

import pytest
from pyspark.sql import functions as F

from tidemart.plans import catalog

from .conftest import SF_SMALL

# lineitem orders customer part supplier nation region
SOURCE_SCANS = 7
# one-row global aggregates: their final step is one partition by definition
GLOBAL_AGGREGATES = {"source_counts", "dq_not_null"}


def _executed_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(catalog.all_queries()))
def test_plan_shape(spark, name):
    plan = _executed_plan(catalog.all_queries()[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert bad not in plan, f"{name}: {bad}"
    # nothing funnels all rows into one task: an unpartitioned window (or
    # any operator needing all rows together) plans an Exchange SinglePartition
    assert "Exchange SinglePartition" not in plan or name in GLOBAL_AGGREGATES, name
    scans = len(re.findall(r"FileScan parquet", plan))
    if name.startswith(("q", "v")):
        assert scans <= SOURCE_SCANS, f"{name}: {scans} scans"


def test_dimension_members_need_no_full_sort(spark):
    """Distinct members are hash aggregates: nothing sorts the feed before the
    partial step (only the few conflicting keys are ordered)."""
    from tidemart.operators.dims import DIMENSIONS, first_wins
    from tidemart.session import materialize

    star = catalog.loaded_warehouse(spark, SF_SMALL)
    rows = materialize(star.fact.join(star.product, "product_id").join(star.customer, "customer_id"), "rows")
    for name in ("dim_customer", "dim_product"):
        key, attrs = DIMENSIONS[name]
        values = rows.select(key, *attrs).distinct()
        plan = values._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "Sort" not in plan
        assert first_wins(rows, key, attrs).count() == values.count()


@pytest.mark.parametrize("name", ["q1_top_products_daytype", "q2_store_quarter_revenue"])
def test_a_year_is_a_date_range_of_the_orders_scan(spark, name, capsys):
    capsys.readouterr()
    catalog.all_queries()[name](spark, SF_SMALL).explain("formatted")
    plan = capsys.readouterr().out
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_orderdate,1998-01-01.*LessThan\(o_orderdate,1999-01-01", plan)


def test_year_filter_prunes_the_fact_by_the_time_dimension(spark):
    from tidemart.plans import reports as R

    plan = _executed_plan(R.q2_store_quarter_revenue(catalog.loaded_warehouse(spark, SF_SMALL)))
    assert "dynamicpruning" in plan.lower()


def test_clashing_members_do_not_shuffle_the_rows(spark, tmp_path):
    """Stores come from a supplier master that is itself joined (its size is not known beforehand): matched rows
    meet its clashing members without a shuffle or sort of their own."""
    from tidemart.operators.dims import carried_members
    from tidemart.schemas import FACT_KEY

    spark.range(4000).selectExpr("id as order_id", "1 as line_no", "id % 50 as product_id", "id % 40 as supplier_id", "1 as quantity").write.parquet(str(tmp_path / "rows"))
    spark.range(40).selectExpr("id as supplier_id", "id % 10 as nation").write.parquet(str(tmp_path / "suppliers"))
    spark.range(10).selectExpr("id as nation", "int(id) as store_id", "concat('N', id) as store_name", "id % 2 as rk").write.parquet(str(tmp_path / "nations"))
    spark.range(2).selectExpr("id as rk", "concat('R', id) as region").write.parquet(str(tmp_path / "regions"))
    rows, suppliers, nations, regions = (spark.read.parquet(str(tmp_path / n)) for n in ("rows", "suppliers", "nations", "regions"))
    master = suppliers.join(nations, "nation", "left").join(regions, "rk", "left")
    clash = master.withColumn("store_name", F.expr("if(store_id = 3, concat(store_name, '-', supplier_id), store_name)"))
    for side, expected in ((master, "N3"), (clash, "N3-3")):
        members = carried_members(rows, side, "supplier_id", "store_id", ["store_name", "region"], None, FACT_KEY)
        plan = members._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan
        found = {r.store_id: (r.store_name, r.region) for r in members.collect()}
        assert len(found) == 10 and found[3] == (expected, "R1")
