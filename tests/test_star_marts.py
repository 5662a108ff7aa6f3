"""Enrichment joins, cardinality guard, profit mart and reports."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesmart.operators import marts, star
from salesmart.schemas import ORDER_SALES_COLUMNS

CUSTOMER_COLS = "customer_id string, customer_name string, email string, phone string, address string, segment string, " \
                "country string, city string, state string, postal_code string, region string"
PRODUCT_COLS = "product_id string, category string, sub_category string, product_name string, state string, price_per_product double"
ORDER_COLS = "row_id long, order_id string, order_date date, ship_date date, ship_mode string, customer_id string, " \
             "product_id string, quantity long, price double, discount double, profit double"


def _frames(spark, customer_id="m-4", profit=0.335):
    customers = spark.createDataFrame([(i, f"name of {i}", *["-"] * 5, "-", f"state of {i}", "-", "-") for i in ("m-4", "m-5")], CUSTOMER_COLS)
    customers = customers.withColumn("country", F.concat(F.lit("land of "), "customer_id"))
    products = spark.createDataFrame([(i, f"kind {i}", f"sort {i}", "-", "elsewhere", 1.0) for i in ("b1", "b2")], PRODUCT_COLS)
    day = dt.date(2019, 5, 6)
    orders = spark.createDataFrame([(77, "o-77", day, day, "air", customer_id, "b2", 3, 12.5, 0.0, profit)], ORDER_COLS)
    return orders, customers, products


def test_fact_takes_each_attribute_from_its_dimension(spark):
    orders, customers, products = _frames(spark)
    out = star.order_sales(orders, star.dim_customers(customers), star.dim_products(products))
    assert out.columns == list(ORDER_SALES_COLUMNS)
    (row,) = out.collect()
    assert [row[c] for c in ("customer_name", "country", "category", "sub_category")] == ["name of m-4", "land of m-4", "kind b2", "sort b2"]
    assert row["profit"] == Decimal("0.34") and dict(out.dtypes)["profit"] == "decimal(18,2)"


@pytest.mark.parametrize("value,expected", [(10.125, "10.13"), (-10.125, "-10.13"), (1.005, "1.01"), (2.675, "2.68")])
def test_profit_rounds_half_up_on_decimal_text(spark, value, expected):
    orders, customers, products = _frames(spark, profit=value)
    out = star.order_sales(orders, customers, products)
    assert out.first()["profit"] == Decimal(expected)


def test_unknown_customer_is_dropped_by_inner_join(spark):
    orders, customers, products = _frames(spark, customer_id="m-6")
    assert star.order_sales(orders, customers, products).count() == 0


def test_cardinality_guard():
    star.check_cardinality(5, 5)
    with pytest.raises(ValueError, match="5 valid orders became 6"):
        star.check_cardinality(6, 5)


def _sales(spark, rows):
    return spark.createDataFrame(
        rows, "order_date date, category string, sub_category string, customer_id string, customer_name string, profit decimal(38,18)"
    )


def test_profit_mart_equals_a_plain_sum(spark):
    """Years, losses and groups of several sizes against sums in Python."""

    rows, want = [], {}
    for i in range(60):
        year, kind, who = 2018 + i % 3, f"kind{i % 2}", f"c{i % 5}"
        cents = Decimal(i * i - 900) / 100
        rows.append((dt.date(year, 1 + i % 12, 1), kind, "s", who, who.upper(), cents))
        want[year, kind, "s", who, who.upper()] = want.get((year, kind, "s", who, who.upper()), 0) + cents
    mart = marts.profit_mart(_sales(spark, rows))
    assert {tuple(r)[:5]: r["total_profit"] for r in mart.collect()} == want
    assert min(want.values()) < 0 < max(want.values())
    assert dict(mart.dtypes)["total_profit"] == "decimal(18,2)" and dict(mart.dtypes)["order_year"] == "int"


def _mart(spark, rows):
    return spark.createDataFrame(
        rows, "order_year int, category string, sub_category string, customer_id string, customer_name string, total_profit decimal(18,2)"
    )


def test_top_customers_breaks_ties_by_id(spark):
    rows = [(2024, "T", "P", f"C{i:02d}", f"N{i}", Decimal("5.00")) for i in range(25)]
    out = marts.report_top_customers(_mart(spark, rows)).collect()
    assert len(out) == 20 and [r["customer_id"] for r in out] == [f"C{i:02d}" for i in range(20)]


def test_customer_year_limit_is_global(spark):
    rows = [(2023, "T", "P", f"C{i:02d}", "N", Decimal(i)) for i in range(15)]
    rows += [(2024, "T", "P", f"C{i:02d}", "N", Decimal(100 + i)) for i in range(15)]
    out = marts.report_customer_year(_mart(spark, rows)).collect()
    assert len(out) == 20
    assert [r["order_year"] for r in out] == [2023] * 15 + [2024] * 5
    assert out[0]["total_profit"] == Decimal("14.00")


def test_reports_reaggregate_the_mart(spark):
    rows = [(2024, "A", "x", "C1", "N", Decimal("1.10")), (2024, "B", "y", "C1", "N", Decimal("2.20")),
            (2025, "A", "x", "C2", "M", Decimal("-1.00"))]
    mart = _mart(spark, rows)
    by_year = {r["order_year"]: r["total_profit"] for r in marts.report_profit_by_year(mart).collect()}
    assert by_year == {2024: Decimal("3.30"), 2025: Decimal("-1.00")}
    cats = [(r["order_year"], r["product_category"]) for r in marts.report_profit_by_year_category(mart).collect()]
    assert cats == [(2024, "A"), (2024, "B"), (2025, "A")]
    mart.createOrReplaceTempView("mart_t")
    sql = spark.sql(marts.REPORT_SQL["profit_by_year"].format(mart="mart_t")).collect()
    assert {r[0]: r[1] for r in sql} == by_year


def test_top_k_plans_without_full_sort(spark):
    rows = [(2024, "T", "P", f"C{i}", "N", Decimal(i)) for i in range(50)]
    plan = marts.report_top_customers(_mart(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
