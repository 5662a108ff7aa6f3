"""Present the benchmark tables (TPC-H-like parquet) in the retail source
model, so every operator runs on data that grows with those tables.

``customer`` (+ ``nation``, ``region``) -> customers, ``part`` -> products,
``lineitem`` joined to ``orders`` -> order rows.  Every derived value is a
column expression of the row (no sampling, no row filters); a few
deterministic conditions on keys and measures plant the defects the rules
exist for — blanks, duplicate ids, bad formats, out-of-domain values,
dangling references, future and unparseable dates, negative prices, nulls.

The frames have the standardised raw-table shape (snake_case columns plus
``source_file_name`` and ``ingestion_timestamp``), i.e. what ingestion
writes to ``raw.*``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.rules import US_STATES

CUSTOMER_FILE, PRODUCT_FILE, ORDER_FILE = "Customer.xlsx", "Products.csv", "Orders.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values: list[str], index: Column) -> Column:
    """values[index] for a 0-based index column."""

    return F.element_at(F.lit(values), (index + 1).cast("int"))


def _every(key: Column, n: int, r: int) -> Column:
    return F.pmod(key, F.lit(n)) == r


def _metadata(df: DataFrame, file_name: str) -> DataFrame:
    return df.withColumns({
        "source_file_name": F.lit(file_name),
        "ingestion_timestamp": F.current_timestamp(),
    })


def zero_pad(key: Column, width: int) -> Column:
    """Decimal text of a non-negative key, left-padded with zeros to
    ``width`` and never truncated (same text as printf('%0<width>d'))."""

    text = key.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def customer_key_text(key: Column) -> Column:
    return F.concat(F.lit("cu-"), zero_pad(key, 5))


def product_prefix(key: Column) -> Column:
    return _pick(["fur", "off", "tec"], F.pmod(key, F.lit(3)))


def product_key_text(prefix: Column, key: Column) -> Column:
    return F.concat(prefix, F.lit("-pt-"), zero_pad(key, 8))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "customer")
    n = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    k = F.col("c_custkey")
    name = F.col("c_name")
    df = c.join(n, c.c_nationkey == n.n_nationkey, "left").join(r, F.col("n_regionkey") == r.r_regionkey, "left")
    out = df.select(
        F.when(_every(k, 251, 7), F.lit("  "))
        .otherwise(customer_key_text(F.when(_every(k, 211, 5), k + 1).otherwise(k)))
        .alias("customer_id"),
        F.when(F.col("c_acctbal") < 0, name)
        .when(_every(k, 199, 3), F.lit("   "))
        .otherwise(F.concat(F.lit(" "), F.translate(F.replace(name, F.lit("#"), F.lit("   ")), "0123456789", "abcdefghij"), F.lit(" ")))
        .alias("customer_name"),
        F.when(_every(k, 89, 11), F.concat(F.lower(F.replace(name, F.lit("#"), F.lit("."))), F.lit(".example.com")))
        .otherwise(F.concat(F.upper(F.replace(name, F.lit("#"), F.lit("."))), F.lit("@EXAMPLE.COM")))
        .alias("email"),
        F.concat(F.lit("+1-555-"), zero_pad(k, 7)).alias("phone"),
        F.when(_every(k, 131, 17), F.lit("   ")).otherwise(F.concat(k.cast("string"), F.lit(" Main Street"))).alias("address"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "Consumer")
        .when(F.col("c_mktsegment") == "BUILDING", "Corporate")
        .when(F.col("c_mktsegment") == "FURNITURE", "Home Office")
        .when(F.col("c_mktsegment") == "MACHINERY", "Corporate")
        .when(_every(k, 23, 4), "Automotive")
        .otherwise("Consumer")
        .alias("segment"),
        F.when(F.col("c_nationkey") == 24, "Canada").otherwise("United States").alias("country"),
        F.replace(F.col("n_name"), F.lit("NATION_"), F.lit("City ")).alias("city"),
        F.when(_every(k, 101, 9), F.lit("ontario")).otherwise(_pick(US_STATES, F.pmod(k, F.lit(51)))).alias("state"),
        F.pmod(k * 7919, F.lit(100000)).cast("string").alias("postal_code"),
        F.when(F.col("r_name") == "AFRICA", "South")
        .when(F.col("r_name") == "AMERICA", "West")
        .when(F.col("r_name") == "ASIA", "East")
        .when(F.col("r_name") == "EUROPE", "Central")
        .when(_every(k, 7, 0), "Middle East")
        .otherwise("East")
        .alias("region"),
    )
    return _metadata(out, CUSTOMER_FILE)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    state = _pick(US_STATES, F.pmod(k * 13, F.lit(51)))
    out = p.select(
        product_key_text(
            F.when(_every(k, 173, 2), F.lit("gen")).otherwise(product_prefix(k)),
            F.when(_every(k, 157, 3), k + 1).otherwise(k),
        ).alias("product_id"),
        F.when(_every(k, 61, 8), F.lit("Toys"))
        .otherwise(_pick(["Furniture", "Office Supplies", "Technology"], F.pmod(k, F.lit(3))))
        .alias("category"),
        F.when(_every(k, 149, 1), F.lit(" ")).otherwise(F.col("p_type")).alias("sub_category"),
        F.col("p_name").alias("product_name"),
        F.when(_every(k, 67, 6), F.lower(state)).otherwise(state).alias("state"),
        F.when(_every(k, 83, 9), -F.col("p_retailprice"))
        .when(_every(k, 89, 10), F.lit(None).cast("double"))
        .otherwise(F.col("p_retailprice"))
        .alias("price_per_product"),
    )
    return _metadata(out, PRODUCT_FILE)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    o = _table(spark, sf_dir, "orders")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    order_day = F.when((priority == "2-HIGH") & (status == "P"), F.add_months(F.col("o_orderdate"), 480)).otherwise(
        F.col("o_orderdate")
    )
    # made once an order, not for each of its lines
    heads = o.select(
        "o_orderkey",
        F.concat(
            F.when((priority == "5-LOW") & (status == "P"), F.lit("MX")).when(status == "O", F.lit("us")).otherwise(F.lit("CA")),
            F.lit("-"),
            F.year("o_orderdate").cast("string"),
            F.lit("-"),
            F.col("o_orderkey").cast("string"),
        ).alias("order_id"),
        F.when((priority == "1-URGENT") & (status == "P"), F.date_format(order_day, "yyyy-MM-dd"))
        .otherwise(F.date_format(order_day, "d/M/yyyy"))
        .alias("order_date"),
        customer_key_text(F.col("o_custkey")).alias("customer_id"),
    )
    df = li.join(heads, li.l_orderkey == heads.o_orderkey, "inner")
    flag, qty = F.col("l_returnflag"), F.col("l_quantity")
    money = F.col("l_extendedprice").cast("decimal(18,2)") * (
        F.lit(0.05).cast("decimal(3,2)") + F.col("l_tax").cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")
    )
    line = F.col("l_linenumber")
    out = df.select(
        (F.col("l_orderkey") * 10 + line).alias("row_id"),
        "order_id",
        "order_date",
        F.when((flag == "R") & (F.col("l_linestatus") == "F") & (qty >= 48), F.lit("  "))
        .otherwise(F.date_format("l_shipdate", "d/M/yyyy"))
        .alias("ship_date"),
        F.when(line == 1, "Standard Class")
        .when(line == 2, "Second Class")
        .when(line == 3, "First Class")
        .when(line == 4, "Same Day")
        .when(line == 5, "  Standard Class ")
        .when(line == 6, "Second Class")
        .when(flag == "A", "Drone")
        .otherwise("First Class")
        .alias("ship_mode"),
        "customer_id",
        product_key_text(product_prefix(F.col("l_partkey")), F.col("l_partkey")).alias("product_id"),
        F.when((qty == 50) & (flag == "N"), F.lit(0)).otherwise(qty.cast("int")).alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.when((F.col("l_tax") == 0.08) & (F.col("l_discount") >= 0.09), F.lit(1.5))
        .otherwise(F.col("l_discount"))
        .alias("discount"),
        F.when((qty == 1) & (flag == "R"), F.lit(None).cast("double"))
        .otherwise(F.round(money, 2).cast("double"))
        .alias("profit"),
    )
    return _metadata(out, ORDER_FILE)


SOURCES = {"customers": customers, "products": products, "orders": orders}


def raw_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three raw datasets derived from the benchmark tables."""

    return {name: build(spark, sf_dir) for name, build in SOURCES.items()}
