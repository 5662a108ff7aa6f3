"""The shipped data-quality rule catalog and its loader.

The catalog is control data (tens of rows); it is seeded into the rules
table (``quality.data_quality_rules``) and read back from there, so a user
can deactivate, add or change rules in the table without touching code.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema

from salesmart.schemas import RULES

# ---------------------------------------------------------------------------
# FIXED VALUES — these rows must equal the original rule configuration for the
# results to match.  Listed in their original order.  Columns:
# rule_id, dataset_name, rule_group, rule_name, rule_type, column_name,
# rule_parameter, failure_reason, rule_order, is_active
# ---------------------------------------------------------------------------
SHIPPED_RULES = [
    ("CUS_001", "customers", "COMPLETENESS", "Customer ID is required", "NOT_NULL", "customer_id", None, "CUSTOMER_ID_MISSING", 1, True),
    ("CUS_002", "customers", "UNIQUENESS", "Customer ID must be unique", "UNIQUE", "customer_id", None, "DUPLICATE_CUSTOMER_ID", 2, True),
    ("CUS_003", "customers", "VALIDITY", "Customer ID format", "REGEX", "customer_id", "^[A-Z]{2}-[0-9]{5}$", "CUSTOMER_ID_INVALID", 3, True),
    ("CUS_004", "customers", "COMPLETENESS", "Customer name is required", "NOT_NULL", "customer_name", None, "CUSTOMER_NAME_MISSING", 4, True),
    ("CUS_005", "customers", "VALIDITY", "Customer name must contain valid characters", "VALID_CUSTOMER_NAME", "customer_name", None, "CUSTOMER_NAME_INVALID", 5, True),
    ("CUS_006", "customers", "COMPLETENESS", "Email is required", "NOT_NULL", "email", None, "EMAIL_MISSING", 6, True),
    ("CUS_007", "customers", "VALIDITY", "Email format", "REGEX", "email", "^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}$", "EMAIL_INVALID", 7, True),
    ("CUS_008", "customers", "COMPLETENESS", "Customer segment is required", "NOT_NULL", "segment", None, "CUSTOMER_SEGMENT_MISSING", 8, True),
    ("CUS_009", "customers", "VALIDITY", "Customer segment domain", "ALLOWED_VALUES", "segment", '["Consumer","Corporate","Home Office"]', "CUSTOMER_SEGMENT_INVALID", 9, True),
    ("CUS_010", "customers", "COMPLETENESS", "Customer state is required", "NOT_NULL", "state", None, "CUSTOMER_STATE_MISSING", 10, True),
    ("CUS_011", "customers", "VALIDITY", "Customer state must be valid", "VALID_STATE", "state", None, "CUSTOMER_STATE_INVALID", 11, True),
    ("CUS_012", "customers", "COMPLETENESS", "Country is required", "NOT_NULL", "country", None, "CUSTOMER_COUNTRY_MISSING", 12, True),
    ("PRD_001", "products", "COMPLETENESS", "Product ID is required", "NOT_NULL", "product_id", None, "PRODUCT_ID_MISSING", 1, True),
    ("PRD_002", "products", "UNIQUENESS", "Product ID must be unique", "UNIQUE", "product_id", None, "DUPLICATE_PRODUCT_ID", 2, True),
    ("PRD_003", "products", "VALIDITY", "Product ID format", "REGEX", "product_id", "^(FUR|OFF|TEC)-[A-Z]{2}-[0-9]{8}$", "PRODUCT_ID_INVALID", 3, True),
    ("PRD_004", "products", "COMPLETENESS", "Product price is required", "NOT_NULL", "price_per_product", None, "PRODUCT_PRICE_MISSING", 4, True),
    ("PRD_005", "products", "VALIDITY", "Product price must be positive", "POSITIVE", "price_per_product", None, "PRODUCT_PRICE_NOT_POSITIVE", 5, True),
    ("PRD_006", "products", "COMPLETENESS", "Product category is required", "NOT_NULL", "category", None, "PRODUCT_CATEGORY_MISSING", 6, True),
    ("PRD_007", "products", "VALIDITY", "Product category domain", "ALLOWED_VALUES", "category", '["Furniture","Office Supplies","Technology"]', "PRODUCT_CATEGORY_INVALID", 7, True),
    ("PRD_008", "products", "COMPLETENESS", "Product subcategory is required", "NOT_NULL", "sub_category", None, "PRODUCT_SUBCATEGORY_MISSING", 8, True),
    ("PRD_009", "products", "COMPLETENESS", "Product name is required", "NOT_NULL", "product_name", None, "PRODUCT_NAME_MISSING", 9, True),
    ("PRD_010", "products", "COMPLETENESS", "Product state is required", "NOT_NULL", "state", None, "PRODUCT_STATE_MISSING", 10, True),
    ("PRD_011", "products", "VALIDITY", "Product state must be valid", "VALID_STATE", "state", None, "PRODUCT_STATE_INVALID", 11, True),
    ("ORD_001", "orders", "COMPLETENESS", "Row ID is required", "NOT_NULL", "row_id", None, "ROW_ID_MISSING", 1, True),
    ("ORD_002", "orders", "UNIQUENESS", "Row ID must be unique", "UNIQUE", "row_id", None, "DUPLICATE_ROW_ID", 2, True),
    ("ORD_003", "orders", "COMPLETENESS", "Order ID is required", "NOT_NULL", "order_id", None, "ORDER_ID_MISSING", 3, True),
    ("ORD_004", "orders", "VALIDITY", "Order ID format", "REGEX", "order_id", "^(CA|US)-[0-9]{4}-[0-9]+$", "ORDER_ID_INVALID", 4, True),
    ("ORD_005", "orders", "COMPLETENESS", "Order date must be present and parseable", "NOT_NULL", "order_date", None, "ORDER_DATE_INVALID", 5, True),
    ("ORD_006", "orders", "TIMELINESS", "Order date cannot be in the future", "NOT_FUTURE", "order_date", None, "ORDER_DATE_IN_FUTURE", 6, True),
    ("ORD_007", "orders", "COMPLETENESS", "Ship date must be present and parseable", "NOT_NULL", "ship_date", None, "SHIP_DATE_INVALID", 7, True),
    ("ORD_008", "orders", "CONSISTENCY", "Ship date must be on or after order date", "COLUMN_GTE", "ship_date", "order_date", "SHIP_DATE_BEFORE_ORDER_DATE", 8, True),
    ("ORD_009", "orders", "COMPLETENESS", "Customer ID is required", "NOT_NULL", "customer_id", None, "ORDER_CUSTOMER_ID_MISSING", 9, True),
    ("ORD_010", "orders", "COMPLETENESS", "Product ID is required", "NOT_NULL", "product_id", None, "ORDER_PRODUCT_ID_MISSING", 10, True),
    ("ORD_011", "orders", "COMPLETENESS", "Quantity is required", "NOT_NULL", "quantity", None, "ORDER_QUANTITY_MISSING", 11, True),
    ("ORD_012", "orders", "VALIDITY", "Quantity must be positive", "POSITIVE", "quantity", None, "ORDER_QUANTITY_NOT_POSITIVE", 12, True),
    ("ORD_013", "orders", "COMPLETENESS", "Order price is required", "NOT_NULL", "price", None, "ORDER_PRICE_MISSING", 13, True),
    ("ORD_014", "orders", "VALIDITY", "Order price must be positive", "POSITIVE", "price", None, "ORDER_PRICE_NOT_POSITIVE", 14, True),
    ("ORD_015", "orders", "COMPLETENESS", "Discount is required", "NOT_NULL", "discount", None, "ORDER_DISCOUNT_MISSING", 15, True),
    ("ORD_016", "orders", "VALIDITY", "Discount must be between zero and one", "BETWEEN", "discount", '{"min":0,"max":1}', "ORDER_DISCOUNT_INVALID", 16, True),
    ("ORD_017", "orders", "COMPLETENESS", "Profit must be numeric and non-null", "NOT_NULL", "profit", None, "ORDER_PROFIT_INVALID", 17, True),
    ("ORD_018", "orders", "COMPLETENESS", "Ship mode is required", "NOT_NULL", "ship_mode", None, "SHIP_MODE_MISSING", 18, True),
    ("ORD_019", "orders", "VALIDITY", "Ship mode domain", "ALLOWED_VALUES", "ship_mode", '["Standard Class","Second Class","First Class","Same Day"]', "SHIP_MODE_INVALID", 19, True),
    ("ORD_020", "orders", "REFERENTIAL_INTEGRITY", "Customer must exist in passed Customers", "REFERENCE", "customer_id", "_customer_reference_valid", "CUSTOMER_REFERENCE_INVALID", 20, True),
    ("ORD_021", "orders", "REFERENTIAL_INTEGRITY", "Product must exist uniquely in passed Products", "REFERENCE", "product_id", "_product_reference_valid", "PRODUCT_REFERENCE_INVALID", 21, True),
    ("ORD_005A", "orders", "VALIDITY", "Order date must use d/M/yyyy format", "DATE_FORMAT", "order_date_source", "d/M/yyyy", "ORDER_DATE_FORMAT_INVALID", 6, True),
    ("ORD_007A", "orders", "VALIDITY", "Ship date must use d/M/yyyy format", "DATE_FORMAT", "ship_date_source", "d/M/yyyy", "SHIP_DATE_FORMAT_INVALID", 9, True),
    ("CUS_013", "customers", "VALIDITY", "Customer country must be United States", "ALLOWED_VALUES", "country", '["United States"]', "CUSTOMER_COUNTRY_INVALID", 13, True),
    ("CUS_014", "customers", "COMPLETENESS", "Customer address is required", "NOT_NULL", "address", None, "CUSTOMER_ADDRESS_MISSING", 14, True),
    ("CUS_015", "customers", "COMPLETENESS", "Customer city is required", "NOT_NULL", "city", None, "CUSTOMER_CITY_MISSING", 15, True),
    ("CUS_016", "customers", "COMPLETENESS", "Customer postal code is required", "NOT_NULL", "postal_code", None, "CUSTOMER_POSTAL_CODE_MISSING", 16, True),
    ("CUS_017", "customers", "VALIDITY", "Customer postal code must contain five digits", "REGEX", "postal_code", "^[0-9]{5}$", "CUSTOMER_POSTAL_CODE_INVALID", 17, True),
    ("CUS_018", "customers", "COMPLETENESS", "Customer region is required", "NOT_NULL", "region", None, "CUSTOMER_REGION_MISSING", 18, True),
    ("CUS_019", "customers", "VALIDITY", "Customer region must be valid", "ALLOWED_VALUES", "region", '["West","East","Central","South"]', "CUSTOMER_REGION_INVALID", 19, True),
]
# ---------------------------------------------------------------------------

# Flag columns the REFERENCE rules read; ``operators.quality.flag_references``
# computes them from the passed parent datasets.
CUSTOMER_REFERENCE_FLAG = "_customer_reference_valid"
PRODUCT_REFERENCE_FLAG = "_product_reference_valid"


def shipped_rules_df(spark: SparkSession) -> DataFrame:
    """The shipped catalog as a DataFrame with the rules-table schema.

    The rows come as an Arrow table, which becomes a local relation: the
    optimizer itself evaluates filters and projections of it, so reading the
    catalog starts no Spark job."""

    columns = zip(*SHIPPED_RULES, strict=True)
    arrow = to_arrow_schema(RULES)
    table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)
    return spark.createDataFrame(table, RULES)


RULE_FIELDS = (
    "rule_id", "dataset_name", "rule_group", "rule_name", "rule_type", "column_name",
    "rule_parameter", "failure_reason", "rule_order", "is_active",
)


def rules_from_file(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """A rule catalog kept as a file (JSON lines, or CSV with a header),
    read with the fixed rules schema; seed it with ``tables.seed_rules``."""

    reader = spark.read.schema(RULES)
    if fmt == "json":
        return reader.json(path)
    if fmt == "csv":
        return reader.option("header", True).option("escape", '"').csv(path)
    raise ValueError(f"Unsupported rules file format: {fmt}")


def active_rules_df(rules: DataFrame, dataset_name: str) -> DataFrame:
    """Active rules of one dataset in evaluation order.

    A null ``is_active`` counts as inactive.  Ties on ``rule_order`` are
    broken by ``rule_id`` so the order of failure reasons is defined.
    """

    return (
        rules.where((rules.dataset_name == dataset_name) & rules.is_active)
        .orderBy("rule_order", "rule_id")
    )
