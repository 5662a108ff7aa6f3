"""Oracle SQL (DuckDB dialect) for every registered query.

An independent formulation of the same semantics in plain SQL over the
benchmark tables (views ``customer``, ``part``, ``orders``, ``lineitem``,
``nation``, ``region``): the source bridge, cleaning, the rule checks
(UNIQUE as a window count, REFERENCE as EXISTS against the passed
parents, reasons as a filtered list), the star join, the mart and the
reports.  The rule rows themselves are data (the shipped catalog); what
each rule *type* means is written out here again in SQL.
"""

from __future__ import annotations

from salesmart.functions.rules import CUSTOMER_NAME_PATTERN, US_STATES
from salesmart.sources.rule_catalog import SHIPPED_RULES

DATASETS = ("customers", "products", "orders")


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


STATES_LIST = "[" + ", ".join(_q(s) for s in US_STATES) + "]"
STATES_IN = "(" + ", ".join(_q(s) for s in US_STATES) + ")"

# --- source bridge ---------------------------------------------------------
SRC_CUSTOMERS = f"""
src_customers AS (
  SELECT
    CASE WHEN c_custkey % 251 = 7 THEN '  '
         ELSE 'cu-' || printf('%05d', CASE WHEN c_custkey % 211 = 5 THEN c_custkey + 1 ELSE c_custkey END) END AS customer_id,
    CASE WHEN c_acctbal < 0 THEN c_name
         WHEN c_custkey % 199 = 3 THEN '   '
         ELSE ' ' || translate(replace(c_name, '#', '   '), '0123456789', 'abcdefghij') || ' ' END AS customer_name,
    CASE WHEN c_custkey % 89 = 11 THEN lower(replace(c_name, '#', '.')) || '.example.com'
         ELSE upper(replace(c_name, '#', '.')) || '@EXAMPLE.COM' END AS email,
    '+1-555-' || printf('%07d', c_custkey) AS phone,
    CASE WHEN c_custkey % 131 = 17 THEN '   ' ELSE CAST(c_custkey AS VARCHAR) || ' Main Street' END AS address,
    CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Consumer'
         WHEN c_mktsegment = 'BUILDING' THEN 'Corporate'
         WHEN c_mktsegment = 'FURNITURE' THEN 'Home Office'
         WHEN c_mktsegment = 'MACHINERY' THEN 'Corporate'
         WHEN c_custkey % 23 = 4 THEN 'Automotive'
         ELSE 'Consumer' END AS segment,
    CASE WHEN c_nationkey = 24 THEN 'Canada' ELSE 'United States' END AS country,
    replace(n_name, 'NATION_', 'City ') AS city,
    CASE WHEN c_custkey % 101 = 9 THEN 'ontario' ELSE {STATES_LIST}[c_custkey % 51 + 1] END AS state,
    CAST((c_custkey * 7919) % 100000 AS VARCHAR) AS postal_code,
    CASE WHEN r_name = 'AFRICA' THEN 'South'
         WHEN r_name = 'AMERICA' THEN 'West'
         WHEN r_name = 'ASIA' THEN 'East'
         WHEN r_name = 'EUROPE' THEN 'Central'
         WHEN c_custkey % 7 = 0 THEN 'Middle East'
         ELSE 'East' END AS region,
    'Customer.xlsx' AS source_file_name
  FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
)"""

SRC_PRODUCTS = f"""
src_products AS (
  SELECT
    CASE WHEN p_partkey % 173 = 2 THEN 'gen' ELSE ['fur', 'off', 'tec'][p_partkey % 3 + 1] END
      || '-pt-' || printf('%08d', CASE WHEN p_partkey % 157 = 3 THEN p_partkey + 1 ELSE p_partkey END) AS product_id,
    CASE WHEN p_partkey % 61 = 8 THEN 'Toys'
         ELSE ['Furniture', 'Office Supplies', 'Technology'][p_partkey % 3 + 1] END AS category,
    CASE WHEN p_partkey % 149 = 1 THEN ' ' ELSE p_type END AS sub_category,
    p_name AS product_name,
    CASE WHEN p_partkey % 67 = 6 THEN lower({STATES_LIST}[(p_partkey * 13) % 51 + 1])
         ELSE {STATES_LIST}[(p_partkey * 13) % 51 + 1] END AS state,
    CASE WHEN p_partkey % 83 = 9 THEN -p_retailprice
         WHEN p_partkey % 89 = 10 THEN CAST(NULL AS DOUBLE)
         ELSE p_retailprice END AS price_per_product,
    'Products.csv' AS source_file_name
  FROM part
)"""

SRC_ORDERS = """
src_orders_base AS (
  SELECT l.*, o.*,
    CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P'
         THEN o_orderdate + INTERVAL 480 MONTH ELSE o_orderdate END AS order_day
  FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey
),
src_orders AS (
  SELECT
    l_orderkey * 10 + l_linenumber AS row_id,
    CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'MX'
         WHEN o_orderstatus = 'O' THEN 'us' ELSE 'CA' END
      || '-' || CAST(year(o_orderdate) AS VARCHAR) || '-' || CAST(o_orderkey AS VARCHAR) AS order_id,
    CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN strftime(order_day, '%Y-%m-%d')
         ELSE strftime(order_day, '%-d/%-m/%Y') END AS order_date,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' AND l_quantity >= 48 THEN '  '
         ELSE strftime(l_shipdate, '%-d/%-m/%Y') END AS ship_date,
    CASE WHEN l_linenumber = 1 THEN 'Standard Class'
         WHEN l_linenumber = 2 THEN 'Second Class'
         WHEN l_linenumber = 3 THEN 'First Class'
         WHEN l_linenumber = 4 THEN 'Same Day'
         WHEN l_linenumber = 5 THEN '  Standard Class '
         WHEN l_linenumber = 6 THEN 'Second Class'
         WHEN l_returnflag = 'A' THEN 'Drone'
         ELSE 'First Class' END AS ship_mode,
    'cu-' || printf('%05d', o_custkey) AS customer_id,
    ['fur', 'off', 'tec'][l_partkey % 3 + 1] || '-pt-' || printf('%08d', l_partkey) AS product_id,
    CASE WHEN l_quantity = 50 AND l_returnflag = 'N' THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS quantity,
    l_extendedprice AS price,
    CASE WHEN l_tax = CAST(0.08 AS DOUBLE) AND l_discount >= CAST(0.09 AS DOUBLE) THEN CAST(1.5 AS DOUBLE)
         ELSE l_discount END AS discount,
    CASE WHEN l_quantity = 1 AND l_returnflag = 'R' THEN CAST(NULL AS DOUBLE)
         ELSE CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2))
              * (CAST(0.05 AS DECIMAL(3,2)) + CAST(l_tax AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))), 2) AS DOUBLE)
    END AS profit,
    'Orders.json' AS source_file_name
  FROM src_orders_base
)"""

# --- cleaning --------------------------------------------------------------


def _blank(c: str) -> str:
    return f"CASE WHEN length(trim({c})) = 0 THEN NULL ELSE trim({c}) END"


CLN_CUSTOMERS = f"""
cln_customers AS (
  SELECT
    upper({_blank('customer_id')}) AS customer_id,
    regexp_replace({_blank('customer_name')}, '\\s+', ' ', 'g') AS customer_name,
    lower({_blank('email')}) AS email,
    {_blank('phone')} AS phone,
    {_blank('address')} AS address,
    {_blank('segment')} AS segment,
    {_blank('country')} AS country,
    {_blank('city')} AS city,
    {_blank('state')} AS state,
    CASE WHEN regexp_matches({_blank('postal_code')}, '^[0-9]{{4}}$') THEN lpad({_blank('postal_code')}, 5, '0')
         ELSE {_blank('postal_code')} END AS postal_code,
    {_blank('region')} AS region,
    source_file_name
  FROM src_customers
)"""

CLN_PRODUCTS = f"""
cln_products AS (
  SELECT
    upper({_blank('product_id')}) AS product_id,
    {_blank('category')} AS category,
    {_blank('sub_category')} AS sub_category,
    {_blank('product_name')} AS product_name,
    {_blank('state')} AS state,
    price_per_product,
    source_file_name
  FROM src_products
)"""

CLN_ORDERS = f"""
cln_orders AS (
  SELECT
    row_id,
    upper({_blank('order_id')}) AS order_id,
    CAST(try_strptime({_blank('order_date')}, '%d/%m/%Y') AS DATE) AS order_date,
    CAST(try_strptime({_blank('ship_date')}, '%d/%m/%Y') AS DATE) AS ship_date,
    {_blank('ship_mode')} AS ship_mode,
    upper({_blank('customer_id')}) AS customer_id,
    upper({_blank('product_id')}) AS product_id,
    quantity, price, discount, profit,
    source_file_name,
    {_blank('order_date')} AS order_date_source,
    {_blank('ship_date')} AS ship_date_source
  FROM src_orders
)"""

# --- rules -----------------------------------------------------------------

JAVA_TO_STRPTIME = {"d/M/yyyy": "%d/%m/%Y"}


def _rules(dataset: str, rule_type: str | None = None) -> list[dict]:
    keys = ("rule_id", "dataset_name", "rule_group", "rule_name", "rule_type", "column_name",
            "rule_parameter", "failure_reason", "rule_order", "is_active")
    rows = [dict(zip(keys, r)) for r in SHIPPED_RULES]
    rows = [r for r in rows if r["dataset_name"] == dataset and r["is_active"]]
    if rule_type:
        rows = [r for r in rows if r["rule_type"] == rule_type]
    return sorted(rows, key=lambda r: (r["rule_order"], r["rule_id"]))


def _cond(rule: dict) -> str:
    import json

    c, p, t = rule["column_name"], rule["rule_parameter"], rule["rule_type"]
    if t == "NOT_NULL":
        return f"{c} IS NOT NULL"
    if t == "UNIQUE":
        return f"({c} IS NULL OR _cnt_{c} = 1)"
    if t == "REGEX":
        return f"({c} IS NULL OR regexp_matches({c}, {_q(p)}))"
    if t == "VALID_CUSTOMER_NAME":
        return f"({c} IS NULL OR regexp_matches({c}, {_q(CUSTOMER_NAME_PATTERN)}))"
    if t == "ALLOWED_VALUES":
        return f"({c} IS NULL OR {c} IN ({', '.join(_q(v) for v in json.loads(p))}))"
    if t == "VALID_STATE":
        return f"({c} IS NULL OR {c} IN {STATES_IN})"
    if t == "POSITIVE":
        return f"({c} IS NULL OR {c} > 0)"
    if t == "BETWEEN":
        b = json.loads(p)
        return f"({c} IS NULL OR {c} BETWEEN {b['min']} AND {b['max']})"
    if t == "DATE_FORMAT":
        return f"({c} IS NULL OR try_strptime({c}, {_q(JAVA_TO_STRPTIME[p])}) IS NOT NULL)"
    if t == "NOT_FUTURE":
        return f"({c} IS NULL OR {c} <= current_date)"
    if t == "COLUMN_GTE":
        return f"({c} IS NULL OR {p} IS NULL OR {c} >= {p})"
    if t == "REFERENCE":
        return f"({c} IS NULL OR coalesce({p}, false))"
    raise ValueError(t)


def _unique_cols(dataset: str) -> list[str]:
    return list(dict.fromkeys(r["column_name"] for r in _rules(dataset) if r["rule_type"] == "UNIQUE"))


def _checkable(dataset: str) -> str:
    """CTE ``chk_<ds>``: cleaned rows + window counts + reference flags."""

    counts = "".join(f", count(*) OVER (PARTITION BY {c}) AS _cnt_{c}" for c in _unique_cols(dataset))
    if dataset == "orders":
        return f"""
chk_orders AS (
  SELECT o.*{counts},
    EXISTS (SELECT 1 FROM valid_customers v WHERE v.customer_id = o.customer_id) AS _customer_reference_valid,
    EXISTS (SELECT 1 FROM valid_products v WHERE v.product_id = o.product_id) AS _product_reference_valid
  FROM cln_orders o
)"""
    return f"""
chk_{dataset} AS (
  SELECT *{counts} FROM cln_{dataset}
)"""


def _annotated(dataset: str) -> str:
    checks = ", ".join(
        f"CASE WHEN NOT coalesce({_cond(r)}, false) THEN {_q(r['failure_reason'])} END" for r in _rules(dataset)
    )
    drop = [f"_cnt_{c}" for c in _unique_cols(dataset)]
    if dataset == "orders":
        drop += ["_customer_reference_valid", "_product_reference_valid"]
    exclude = f" EXCLUDE ({', '.join(drop)})" if drop else ""
    return f"""
ann_{dataset}_r AS (
  SELECT *{exclude}, list_filter([{checks}], lambda x: x IS NOT NULL) AS dq_failure_reasons
  FROM chk_{dataset}
),
ann_{dataset} AS (
  SELECT *, CASE WHEN len(dq_failure_reasons) = 0 THEN 'PASSED' ELSE 'REJECTED' END AS dq_status
  FROM ann_{dataset}_r
),
valid_{dataset} AS (SELECT * FROM ann_{dataset} WHERE dq_status = 'PASSED')"""


def _with(*datasets: str, extra: str = "") -> str:
    """WITH clause carrying everything the given datasets need."""

    need = set(datasets)
    if "orders" in need:
        need |= {"customers", "products"}
    ctes = []
    for ds in DATASETS:
        if ds in need:
            ctes.append({"customers": SRC_CUSTOMERS, "products": SRC_PRODUCTS, "orders": SRC_ORDERS}[ds])
            ctes.append({"customers": CLN_CUSTOMERS, "products": CLN_PRODUCTS, "orders": CLN_ORDERS}[ds])
            ctes.append(_checkable(ds))
            ctes.append(_annotated(ds))
    if extra:
        ctes.append(extra)
    return "WITH " + ",".join(ctes) + "\n"


ORDER_SALES = """
order_sales AS (
  SELECT o.row_id, o.order_id, o.order_date, o.ship_date, o.ship_mode,
         o.customer_id, c.customer_name, c.country,
         o.product_id, p.category, p.sub_category,
         o.quantity, o.price, o.discount,
         CAST(ROUND(o.profit, 2) AS DECIMAL(18,2)) AS profit
  FROM valid_orders o
  JOIN valid_customers c ON o.customer_id = c.customer_id
  JOIN valid_products p ON o.product_id = p.product_id
),
mart AS (
  SELECT CAST(year(order_date) AS INTEGER) AS order_year, category, sub_category, customer_id, customer_name,
         CAST(ROUND(SUM(profit), 2) AS DECIMAL(18,2)) AS total_profit
  FROM order_sales
  GROUP BY 1, 2, 3, 4, 5
)"""

MONEY_SUM = "CAST(ROUND(SUM(total_profit), 2) AS DECIMAL(18,2)) AS total_profit"


def _rule_failures(rule_type: str | None = None) -> str:
    parts = []
    for ds in DATASETS:
        for r in _rules(ds, rule_type):
            parts.append(
                f"SELECT {_q(r['rule_id'])} AS rule_id, {_q(ds)} AS dataset_name, {_q(r['rule_type'])} AS rule_type, "
                f"{_q(r['column_name'])} AS column_name, {_q(r['failure_reason'])} AS failure_reason, "
                f"CAST(count(*) FILTER (WHERE NOT coalesce({_cond(r)}, false)) AS BIGINT) AS failed_rows FROM chk_{ds}"
            )
    return _with(*DATASETS) + "\nUNION ALL\n".join(parts)


CUSTOMER_COLS = "customer_id, customer_name, email, phone, address, segment, country, city, state, postal_code, region"
PRODUCT_COLS = "product_id, category, sub_category, product_name, state, price_per_product"
ORDER_RAW_COLS = ("row_id, order_id, order_date, ship_date, ship_mode, customer_id, product_id, "
                  "quantity, price, discount, profit")


def build() -> dict[str, str]:
    sql: dict[str, str] = {}
    # sources (raw shape, run-time timestamp excluded)
    sql["raw_customers"] = "WITH " + SRC_CUSTOMERS + " SELECT * FROM src_customers"
    sql["raw_products"] = "WITH " + SRC_PRODUCTS + " SELECT * FROM src_products"
    sql["raw_orders"] = "WITH " + SRC_ORDERS + " SELECT * FROM src_orders"
    # file round trips (land in the source format, read back)
    sql["ingest_customers_xlsx"] = sql["raw_customers"]
    sql["ingest_products_csv"] = sql["raw_products"]
    sql["ingest_orders_json"] = sql["raw_orders"]
    # cleaning
    sql["clean_customers"] = "WITH " + SRC_CUSTOMERS + "," + CLN_CUSTOMERS + " SELECT * FROM cln_customers"
    sql["clean_products"] = "WITH " + SRC_PRODUCTS + "," + CLN_PRODUCTS + " SELECT * FROM cln_products"
    sql["clean_orders"] = "WITH " + SRC_ORDERS + "," + CLN_ORDERS + " SELECT * FROM cln_orders"
    # quality annotation + split
    for ds in DATASETS:
        sql[f"quality_{ds}"] = _with(ds) + f"SELECT * FROM ann_{ds}"
        sql[f"{ds}_valid"] = _with(ds) + f"SELECT * FROM ann_{ds} WHERE dq_status = 'PASSED'"
        sql[f"{ds}_rejected"] = _with(ds) + f"SELECT * FROM ann_{ds} WHERE dq_status = 'REJECTED'"
    sql["dq_status_counts"] = _with(*DATASETS) + "\nUNION ALL\n".join(
        f"SELECT {_q(ds)} AS dataset_name, dq_status, CAST(count(*) AS BIGINT) AS row_count FROM ann_{ds} GROUP BY dq_status"
        for ds in DATASETS
    )
    sql["dq_reason_counts"] = _with(*DATASETS) + "\nUNION ALL\n".join(
        f"SELECT {_q(ds)} AS dataset_name, failure_reason, CAST(count(*) AS BIGINT) AS row_count "
        f"FROM (SELECT unnest(dq_failure_reasons) AS failure_reason FROM ann_{ds}) GROUP BY failure_reason"
        for ds in DATASETS
    )
    sql["rule_failures"] = _rule_failures()
    for t in ("NOT_NULL", "UNIQUE", "REGEX", "VALID_CUSTOMER_NAME", "ALLOWED_VALUES", "VALID_STATE",
              "POSITIVE", "BETWEEN", "DATE_FORMAT", "NOT_FUTURE", "COLUMN_GTE", "REFERENCE"):
        sql[f"rule_{t.lower()}"] = _rule_failures(t)
    # enrichment
    sql["dim_customers"] = _with("customers") + f"SELECT {CUSTOMER_COLS} FROM valid_customers"
    sql["dim_products"] = _with("products") + f"SELECT {PRODUCT_COLS} FROM valid_products"
    sql["order_sales"] = _with(*DATASETS, extra=ORDER_SALES) + "SELECT * FROM order_sales"
    sql["enrichment_cardinality"] = _with(*DATASETS, extra=ORDER_SALES) + (
        "SELECT (SELECT CAST(count(*) AS BIGINT) FROM valid_orders) AS valid_orders, "
        "(SELECT CAST(count(*) AS BIGINT) FROM order_sales) AS order_sales_rows"
    )
    # mart + reports
    w = _with(*DATASETS, extra=ORDER_SALES)
    sql["profit_mart"] = w + "SELECT * FROM mart"
    sql["report_profit_by_year"] = w + f"SELECT order_year, {MONEY_SUM} FROM mart GROUP BY order_year ORDER BY order_year"
    sql["report_profit_by_year_category"] = w + (
        f"SELECT order_year, category AS product_category, {MONEY_SUM} FROM mart "
        "GROUP BY order_year, category ORDER BY order_year, product_category"
    )
    sql["report_top_customers"] = w + (
        f"SELECT customer_id, customer_name, {MONEY_SUM} FROM mart GROUP BY customer_id, customer_name "
        "ORDER BY total_profit DESC, customer_id LIMIT 20"
    )
    sql["report_customer_year"] = w + (
        f"SELECT customer_id, customer_name, order_year, {MONEY_SUM} FROM mart "
        "GROUP BY customer_id, customer_name, order_year "
        "ORDER BY order_year, total_profit DESC, customer_id LIMIT 20"
    )
    # one check time per dataset and run, inside the run; the rows it was written to
    sql["check_times"] = _with(*DATASETS) + "\nUNION ALL\n".join(
        f"SELECT {_q(ds)} AS dataset_name, TRUE AS within_run, CAST(count(*) AS BIGINT) AS row_count FROM ann_{ds}" for ds in DATASETS
    )
    # what the pipeline reports of itself: every output of its stages
    outputs = [("ingestion", ds, f"src_{ds}") for ds in DATASETS]
    for ds in DATASETS:
        outputs += [("data_quality", f"{ds}_valid", f"valid_{ds}"), ("data_quality", f"{ds}_rejected", f"(SELECT * FROM ann_{ds} WHERE dq_status = 'REJECTED')")]
    outputs += [("enrichment", "customers", "valid_customers"), ("enrichment", "products", "valid_products"), ("enrichment", "order_sales", "order_sales"), ("aggregation", "profit_mart", "mart")]
    sql["pipeline_summary"] = w + "\nUNION ALL\n".join(
        f"SELECT {_q(stage)} AS pipeline_stage, 'SUCCESS' AS status, {_q(name)} AS output, CAST(count(*) AS BIGINT) AS row_count FROM {table}" for stage, name, table in outputs
    )
    order_all = ", ".join(f"{c.strip()} NULLS FIRST" for c in ORDER_RAW_COLS.split(","))
    sql["preview_raw_orders"] = "WITH " + SRC_ORDERS + f" SELECT * FROM src_orders ORDER BY {order_all} LIMIT 20"
    order_c = ", ".join(f"{c.strip()} NULLS FIRST" for c in CUSTOMER_COLS.split(","))
    sql["preview_raw_customers"] = "WITH " + SRC_CUSTOMERS + f" SELECT * FROM src_customers ORDER BY {order_c} LIMIT 20"
    order_p = ", ".join(f"{c.strip()} NULLS FIRST" for c in PRODUCT_COLS.split(","))
    sql["preview_raw_products"] = "WITH " + SRC_PRODUCTS + f" SELECT * FROM src_products ORDER BY {order_p} LIMIT 20"
    return sql
