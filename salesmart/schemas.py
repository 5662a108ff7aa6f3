"""Fixed schemas: the three source files, the rule catalog and the column
contracts of the derived tables."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

# FIXED VALUES from here on: source headers, types and column contracts that
# the results must have, in their original order.

# Source schemas.  Field names are the source headers; they are bound by
# position for csv/xlsx and by exact name for json, then standardised to
# snake_case by ``sources.files.standardize``.
CUSTOMER_SOURCE = T.StructType([
    T.StructField(name, S, True)
    for name in (
        "Customer ID", "Customer Name", "email", "phone", "address",
        "Segment", "Country", "City", "State", "Postal Code", "Region",
    )
])

PRODUCT_SOURCE = T.StructType([
    T.StructField("Product ID", S, True),
    T.StructField("Category", S, True),
    T.StructField("Sub-Category", S, True),
    T.StructField("Product Name", S, True),
    T.StructField("State", S, True),
    T.StructField("Price per product", T.DoubleType(), True),
])

ORDER_SOURCE = T.StructType([
    T.StructField("Row ID", T.LongType(), True),
    T.StructField("Order ID", S, True),
    T.StructField("Order Date", S, True),
    T.StructField("Ship Date", S, True),
    T.StructField("Ship Mode", S, True),
    T.StructField("Customer ID", S, True),
    T.StructField("Product ID", S, True),
    T.StructField("Quantity", T.IntegerType(), True),
    T.StructField("Price", T.DoubleType(), True),
    T.StructField("Discount", T.DoubleType(), True),
    T.StructField("Profit", T.DoubleType(), True),
])

SOURCE_SCHEMAS = {
    "customers": CUSTOMER_SOURCE,
    "products": PRODUCT_SOURCE,
    "orders": ORDER_SOURCE,
}

RULES = T.StructType([
    T.StructField("rule_id", S, True),
    T.StructField("dataset_name", S, True),
    T.StructField("rule_group", S, True),
    T.StructField("rule_name", S, True),
    T.StructField("rule_type", S, True),
    T.StructField("column_name", S, True),
    T.StructField("rule_parameter", S, True),
    T.StructField("failure_reason", S, True),
    T.StructField("rule_order", T.IntegerType(), True),
    T.StructField("is_active", T.BooleanType(), True),
])

# Column contracts of the enriched tables.
CUSTOMER_DIM_COLUMNS = (
    "customer_id", "customer_name", "email", "phone", "address", "segment",
    "country", "city", "state", "postal_code", "region",
)
PRODUCT_DIM_COLUMNS = (
    "product_id", "category", "sub_category", "product_name", "state",
    "price_per_product",
)
ORDER_FACT_INPUT_COLUMNS = (
    "row_id", "order_id", "order_date", "ship_date", "ship_mode",
    "customer_id", "product_id", "quantity", "price", "discount", "profit",
)
ORDER_SALES_COLUMNS = (
    "row_id", "order_id", "order_date", "ship_date", "ship_mode",
    "customer_id", "customer_name", "country", "product_id", "category",
    "sub_category", "quantity", "price", "discount", "profit",
)
MART_KEYS = ("order_year", "category", "sub_category", "customer_id", "customer_name")

DQ_COLUMNS = ("dq_failure_reasons", "dq_status", "dq_checked_timestamp")
METADATA_COLUMNS = ("source_file_name", "ingestion_timestamp")
MONEY = T.DecimalType(18, 2)
