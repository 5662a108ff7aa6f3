"""Profit mart and the report queries on it.

The mart is one hash aggregate (partial per map task, final after one
exchange on the five keys).  The reports re-aggregate the mart — a sum of
already-rounded sums, as the original reports do.  ``ORDER BY ... LIMIT``
reports plan as TakeOrderedAndProject (a per-task top-k, then a merge of
k rows per task), never a full sort.  Where the original ordering can tie,
``customer_id`` is added as the last sort key so the answer is repeatable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.operators.star import money
from salesmart.schemas import MART_KEYS

REPORT_LIMIT = 20


def profit_mart(order_sales: DataFrame) -> DataFrame:
    """Total profit per order year, category, sub-category and customer."""

    return (
        order_sales.withColumn("order_year", F.year("order_date"))
        .groupBy(*MART_KEYS)
        .agg(money(F.sum("profit")).alias("total_profit"))
        .select(*MART_KEYS, "total_profit")
    )


def _total(column: str = "total_profit") -> F.Column:
    return money(F.sum(column)).alias("total_profit")


def report_profit_by_year(mart: DataFrame) -> DataFrame:
    """Report 1: profit by year."""

    return mart.groupBy("order_year").agg(_total()).orderBy("order_year")


def report_profit_by_year_category(mart: DataFrame) -> DataFrame:
    """Report 2: profit by year and product category."""

    return (
        mart.groupBy("order_year", F.col("category").alias("product_category"))
        .agg(_total())
        .orderBy("order_year", "product_category")
    )


def report_top_customers(mart: DataFrame, limit: int = REPORT_LIMIT) -> DataFrame:
    """Report 3: the ``limit`` customers with the highest total profit."""

    return (
        mart.groupBy("customer_id", "customer_name")
        .agg(_total())
        .orderBy(F.col("total_profit").desc(), "customer_id")
        .limit(limit)
    )


def report_customer_year(mart: DataFrame, limit: int = REPORT_LIMIT) -> DataFrame:
    """Report 4: customer x year totals ordered by year, then profit
    descending, with ONE global limit — the top rows of the earliest
    year(s), not a top-k per year (kept as the original defines it)."""

    return (
        mart.groupBy("customer_id", "customer_name", "order_year")
        .agg(_total())
        .orderBy("order_year", F.col("total_profit").desc(), "customer_id")
        .limit(limit)
    )


REPORTS = {
    "profit_by_year": report_profit_by_year,
    "profit_by_year_category": report_profit_by_year_category,
    "top_customers": report_top_customers,
    "customer_year": report_customer_year,
}

# The same reports as SQL over the mart table (``{mart}`` is its name).
REPORT_SQL = {
    "profit_by_year": """
        SELECT order_year, CAST(ROUND(SUM(total_profit), 2) AS DECIMAL(18,2)) AS total_profit
        FROM {mart} GROUP BY order_year ORDER BY order_year""",
    "profit_by_year_category": """
        SELECT order_year, category AS product_category,
               CAST(ROUND(SUM(total_profit), 2) AS DECIMAL(18,2)) AS total_profit
        FROM {mart} GROUP BY order_year, category
        ORDER BY order_year, product_category""",
    "top_customers": """
        SELECT customer_id, customer_name,
               CAST(ROUND(SUM(total_profit), 2) AS DECIMAL(18,2)) AS total_profit
        FROM {mart} GROUP BY customer_id, customer_name
        ORDER BY total_profit DESC, customer_id LIMIT 20""",
    "customer_year": """
        SELECT customer_id, customer_name, order_year,
               CAST(ROUND(SUM(total_profit), 2) AS DECIMAL(18,2)) AS total_profit
        FROM {mart} GROUP BY customer_id, customer_name, order_year
        ORDER BY order_year, total_profit DESC, customer_id LIMIT 20""",
}


def preview(df: DataFrame, order_by: list[str] | None = None, n: int = REPORT_LIMIT) -> DataFrame:
    """``SELECT * ... LIMIT n``; with ``order_by`` it is a repeatable top-n."""

    return (df.orderBy(*order_by) if order_by else df).limit(n)
