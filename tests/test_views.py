"""What the views leave out of the joins and filters of orders, and what they stage first."""

import pytest

from salesmart.operators import quality
from salesmart.plans.views import RetailViews, check_orders

ORDERS = "row_id long, order_id string, order_date string, ship_date string, ship_mode string, customer_id string, " \
         "product_id string, quantity int, price double, discount double, profit double"
CUSTOMERS = "customer_id string, customer_name string, email string, phone string, address string, segment string, " \
            "country string, city string, state string, postal_code string, region string"
PRODUCTS = "product_id string, category string, sub_category string, product_name string, state string, price_per_product double"


def _order(row_id, **changes):
    row = dict(row_id=row_id, order_id="US-2019-1", order_date="1/2/2019", ship_date="3/2/2019", ship_mode="First Class",
               customer_id="MK-12345", product_id="TEC-AB-12345678", quantity=2, price=4.0, discount=0.1, profit=1.5)
    return tuple({**row, **changes}.values())


@pytest.fixture()
def views(spark):
    rows = [_order(1), _order(2, price=None), _order(3, price=-1.0), _order(4, customer_id=None), _order(5, customer_id="NO-00000"),
            _order(6), _order(6), _order(None), _order(7, order_date="2019-02-01"), _order(8, discount=None), _order(9, ship_date="31/1/2019"),
            _order(10), _order(11, product_id="TEC-AB-00000000"), _order(12, ship_mode=None), _order(13, quantity=0)]
    customer = ("MK-12345", "May Kay", "may@x.com", "1", "2 Road", "Consumer", "United States", "Town", "Ohio", "12345", "East")
    product = ("TEC-AB-12345678", "Technology", "Phones", "One", "Ohio", 3.0)
    return RetailViews(spark, {
        "customers": spark.createDataFrame([customer], CUSTOMERS),
        "products": spark.createDataFrame([product], PRODUCTS),
        "orders": spark.createDataFrame(rows, ORDERS),
    })


def _rows(df):
    return sorted(repr(tuple(r)) for r in df.drop("dq_checked_timestamp").collect())


@pytest.mark.parametrize("few", [quality.FEW_KEYS, 0])
def test_passed_orders_are_those_of_all_checked_and_filtered_at_the_scan(views, monkeypatch, few):
    monkeypatch.setattr(quality, "FEW_KEYS", few)
    passed, every = views.valid("orders"), check_orders(*views.orders_inputs(), views.rules("orders"))
    assert passed.columns == every.columns
    assert _rows(passed) == _rows(quality.split(every)[0])
    assert sorted(r["row_id"] for r in passed.collect()) == [1, 10]
    plan = passed._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [i for i, line in enumerate(plan) if "Join LeftOuter" in line]
    assert len(joins) == 3
    assert any("Filter" in line and "isnotnull(price" in line and "isnotnull(order_date" in line for line in plan[joins[-1]:])


def test_fact_stages_the_parents_beside_the_cleaned_orders(views, monkeypatch):
    begun = []
    real = RetailViews.orders_inputs
    monkeypatch.setattr(RetailViews, "orders_inputs", lambda self: begun.append(dict(self._staged)) or real(self))
    assert views.order_sales.count() == 2
    assert begun[0] == {}  # nothing was staged alone before
