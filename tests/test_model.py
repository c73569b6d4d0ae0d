"""The model's sales: products join the lines before the orders do, with the rows of any other order."""

import pytest

from tallyforge.plans import QUERIES
from tallyforge.sources.model import Model
from tests.conftest import rows

LINES = """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double,
  l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"""
ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
PARTS = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


@pytest.fixture
def folder(frame, tmp_path):
    """Repeated, null and unknown keys on every side; user 7 buys Brand#1 first, user 8 last."""
    lines = [(1, 10, 1, 3, 2.0, 5.0, 0.1, 0.1, "N", "O", "1998-02-01"), (1, 11, 1, 4, 1.0, 7.0, 0.0, 0.0, "A", "F", "1998-02-01"),
             (1, 11, 1, 4, 1.0, 7.0, 0.0, 0.0, "A", "F", "1998-02-01"), (2, 11, 2, 1, 4.0, 9.0, 0.2, 0.1, None, "O", None),
             (3, 10, None, 2, 1.0, 3.0, 0.0, 0.1, "R", "F", "1998-02-03"), (4, 11, 1, 1, 1.0, 1.0, 0.0, 0.1, "R", "O", "1998-02-03"),
             (None, 10, 1, 1, 1.0, 1.0, 0.0, 0.1, "R", "O", None), (1, None, 1, 1, 1.0, 1.0, 0.0, 0.1, "R", "O", None), (1, 99, 1, 1, 1.0, 1.0, 0.0, 0.1, "R", "O", None)]
    orders = [(1, 7, "O", 1.0, "1998-01-02", "x"), (2, 7, "O", 1.0, "1998-01-03", "x"), (2, 7, "O", 1.0, "1998-01-03", "x"), (3, 8, "F", 1.0, "1998-01-10", "y"),
              (4, 8, "F", 1.0, "1998-01-09", "y"), (None, 7, "O", 1.0, "1998-01-01", "x"), (5, 9, "O", 1.0, None, "x")]
    parts = [(10, "a", "Brand#1", "SMALL", 5, 1.0), (11, "b", "Brand#2", "LARGE", 30, 2.0), (11, "c", "Brand#2", "LARGE", 30, 2.0), (None, "d", "Brand#1", "SMALL", 1, 1.0)]
    for name, ddl, made in (("lineitem", LINES, lines), ("orders", ORDERS, orders), ("part", PARTS, parts)):
        frame(ddl, *made).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def _optimized(df):
    """The plan's text without the tables, that name all their columns."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return "\n".join(line for line in plan.splitlines() if "Relation [" not in line)


def test_sales_equal_purchases_joined_with_their_products(spark, folder):
    model = Model(spark, folder)
    want = model.purchases.join(model.products, "product_id")
    assert rows(model.sales, *want.columns) == rows(want)
    assert model.sales.columns == model.purchases.columns + model.products.columns[1:]
    assert model.sales.count() == 12


def test_lines_of_other_products_do_not_reach_the_orders(spark, folder):
    plan = _optimized(Model(spark, folder).sales.where("event_name = 'Brand#1'"))
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert "o_orderkey" in joins[0] and "p_partkey" not in joins[0] and len(joins) == 2  # the outermost comes first


def test_after_event_moves_only_what_it_counts(spark, folder):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _optimized(got := QUERIES["after_event"](spark, folder))
        assert "l_extendedprice" not in plan and "l_returnflag" not in plan
        assert rows(got, "event_name", "lines", "users") == [("Brand#2", 8, 1)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
