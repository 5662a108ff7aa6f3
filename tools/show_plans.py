"""Run the file-to-mart pipeline on landed benchmark data, then print the
executed (AQE-final) physical plans of the production path: the orders
check over written tables, the order_sales fact, the guard count, the mart
and the four reports.

    python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salesmart.functions.cleaning import CLEANERS  # noqa: E402
from salesmart.operators import marts, star  # noqa: E402
from salesmart.operators.quality import load_rules  # noqa: E402
from salesmart.plans import pipeline  # noqa: E402
from salesmart.plans.views import check_orders  # noqa: E402
from salesmart.session import local_session  # noqa: E402
from salesmart.sources.landing import land_benchmark  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(
        "salesmart-plans", extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="salesmart-plans-wh-"),
                                  "spark.sql.debug.maxToStringFields": "200"},
    )
    s = land_benchmark(spark, sf_dir).with_(prefix="plans_")
    pipeline.run_pipeline(spark, s)
    rules = spark.table(s.rules_table)
    orders = check_orders(
        CLEANERS["orders"](spark.table(s.raw_table("orders"))),
        spark.table(s.valid_table("customers")), spark.table(s.valid_table("products")),
        load_rules(rules, "orders"), s.as_of, s.reference_strategy,
    )
    sales = star.order_sales(
        spark.table(s.valid_table("orders")),
        star.dim_customers(spark.table(s.valid_table("customers"))),
        star.dim_products(spark.table(s.valid_table("products"))),
    )
    shown = {
        "quality: orders check over tables": orders,
        "enrich: order_sales": sales,
        "enrich: guard count": sales.groupBy().count(),
        "mart": marts.profit_mart(spark.table(s.enriched_table("order_sales"))),
        **{f"report: {k}": df for k, df in pipeline.reports(spark, s).items()},
    }
    for name, df in shown.items():
        df.write.format("noop").mode("overwrite").save()
        print(f"===== {name}")
        print(df._jdf.queryExecution().executedPlan().toString())


if __name__ == "__main__":
    main()
