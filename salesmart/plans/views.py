"""Composable views of every stage over a set of raw datasets.

``RetailViews`` builds each stage's DataFrame once and hands out the same
object.  What several branches of one query read is staged (written once under
the shared checkpoint folder) when it is first needed: the cleaned orders that
the duplicate, reference and rule branches read, and the valid rows that the
reference flags, dimensions and the fact read.  So each chain is derived once a
query, and the fact joins plain scans: small dimensions are broadcast by their
known size, and AQE splits a hot customer or product of large ones.  A stage
that a single branch reads stays lazy.  The pipeline stages in
``plans.pipeline`` write these same views to tables, reading each parent back
from its written table.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.cleaning import CLEANERS
from salesmart.functions.rules import Rule
from salesmart.operators import marts, quality, star
from salesmart.operators.quality import RuleSets, annotate, exception_sets, flag_references, load_rule_sets, rule_failure_counts, split
from salesmart.session import session_conf, staged_copy
from salesmart.sources.rule_catalog import CUSTOMER_REFERENCE_FLAG, PRODUCT_REFERENCE_FLAG, shipped_rules_df

REFERENCE_FLAGS = (CUSTOMER_REFERENCE_FLAG, PRODUCT_REFERENCE_FLAG)
DATASETS = ("customers", "products", "orders")
# Of the cleaned orders: keys, amounts and row numbers, of which a dictionary would hold nearly every value.
DISTINCT_COLUMNS = (quality.ROW, "row_id", "order_id", "customer_id", "product_id", "price", "profit")
# Shuffled input of a task that cleans or marks orders, which takes many times as long as to read it.
# Set by one thread at a time: around jobs side by side, not in them.
SMALL_TASKS = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(16 << 20)}


def order_references(customers_valid: quality.Parent, products_valid: quality.Parent) -> list[quality.Reference]:
    """The foreign keys that the REFERENCE rules of orders read: key, parent, flag."""

    return [("customer_id", customers_valid, CUSTOMER_REFERENCE_FLAG), ("product_id", products_valid, PRODUCT_REFERENCE_FLAG)]


def staged_orders(orders_clean: DataFrame) -> DataFrame:
    """Cleaned orders, their rows numbered, written once for the branches that read them."""

    return staged_copy(quality.numbered(orders_clean), "clean-orders", "zstd", DISTINCT_COLUMNS)


def orders_sets(orders: DataFrame, rules: list[Rule], references: list[quality.Reference]) -> quality.ExceptionSets:
    """``exception_sets`` of orders, made by small tasks."""

    with session_conf(orders.sparkSession, SMALL_TASKS):
        return exception_sets(orders, rules, references)


def check_orders(
    orders_clean: DataFrame,
    customers_valid: quality.Parent,
    products_valid: quality.Parent,
    rules: list[Rule],
    as_of: _dt.date | None = None,
    strategy: str = "exceptions",
    passed_only: bool = False,
) -> DataFrame:
    """Annotated orders (reference flags computed, used, then dropped), all or the
    passed ones.  The duplicated and dangling keys come from the orders themselves,
    side by side, not from the flagged rows."""

    references = order_references(customers_valid, products_valid)
    sets = orders_sets(orders_clean, rules, references if strategy == "exceptions" else [])
    flagged = flag_references(orders_clean, references, strategy, sets)
    return annotate(flagged, rules, as_of, sets, passed_only).drop(*REFERENCE_FLAGS, quality.ROW)


class RetailViews:
    """Every stage as a lazy DataFrame over ``raw`` (dataset -> DataFrame)."""

    def __init__(
        self,
        spark: SparkSession,
        raw: Mapping[str, DataFrame | Callable[[], DataFrame]],
        rules: DataFrame | None = None,
        as_of: _dt.date | None = None,
        reference_strategy: str = "exceptions",
    ):
        self.spark = spark
        self.reference_strategy = reference_strategy
        self._raw_sources = dict(raw)
        self.raw: dict[str, DataFrame] = {}
        self.rules_df = rules
        self.as_of = as_of
        self._rules: RuleSets | None = None
        self._clean: dict[str, DataFrame] = {}
        self._checked: dict[str, DataFrame] = {}
        self._checking = {ds: Lock() for ds in DATASETS}  # checked once, whichever thread asks first
        self._flagged: dict[str, tuple[DataFrame, quality.ExceptionSets]] = {}
        self._staged: dict[str, DataFrame] = {}

    def rules(self, dataset: str) -> list[Rule]:
        """Active rules: from the given rules table, else the shipped catalog's rows."""

        if self._rules is None:
            self._rules = load_rule_sets(shipped_rules_df(self.spark) if self.rules_df is None else self.rules_df)
        return self._rules[dataset]

    def source(self, dataset: str) -> DataFrame:
        """The raw dataset (built on first use)."""

        if dataset not in self.raw:
            src = self._raw_sources[dataset]
            self.raw[dataset] = src() if callable(src) else src
        return self.raw[dataset]

    def clean(self, dataset: str) -> DataFrame:
        if dataset not in self._clean:
            self._clean[dataset] = CLEANERS[dataset](self.source(dataset))
        return self._clean[dataset]

    def orders_inputs(self) -> tuple[DataFrame, quality.Parent, quality.Parent]:
        """Cleaned orders, staged, and what gives the passed customers and products,
        which are staged beside them and beside what needs no parent."""

        pool = ThreadPoolExecutor(3)
        with session_conf(self.spark, SMALL_TASKS):
            orders = pool.submit(self.staged_clean_orders)
            parents = [pool.submit(self.staged_valid, ds) for ds in ("customers", "products")]
            pool.shutdown(wait=False)
            return orders.result(), *(p.result for p in parents)

    def checkable_orders(self) -> tuple[DataFrame, quality.ExceptionSets]:
        """What the rules of orders read: the cleaned orders with the reference
        flags against the passed customers and products, and the exception sets."""

        if "orders" not in self._flagged:
            orders, customers, products = self.orders_inputs()
            references = order_references(customers, products)
            sets = orders_sets(orders, self.rules("orders"), references if self.reference_strategy == "exceptions" else [])
            self._flagged["orders"] = flag_references(orders, references, self.reference_strategy, sets), sets
        return self._flagged["orders"]

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._staged:
            self._staged[name] = staged_copy(build(), name)
        return self._staged[name]

    def staged_clean_orders(self) -> DataFrame:
        if "clean-orders" not in self._staged:
            self._staged["clean-orders"] = staged_orders(self.clean("orders"))
        return self._staged["clean-orders"]

    def staged_valid(self, dataset: str) -> DataFrame:
        """The passed rows, written once for the flags, dimensions and fact."""

        return self._once(f"valid-{dataset}", lambda: self.valid(dataset))

    def checked(self, dataset: str) -> DataFrame:
        """Annotated dataset (all columns + dq_*)."""

        with self._checking[dataset]:
            if dataset not in self._checked:
                rules = self.rules(dataset)
                if dataset == "orders":
                    self._checked[dataset] = check_orders(*self.orders_inputs(), rules, self.as_of, self.reference_strategy)
                else:
                    self._checked[dataset] = annotate(self.clean(dataset), rules, self.as_of)
        return self._checked[dataset]

    def rule_failures(self, rule_type: str | None = None) -> DataFrame:
        """Failed rows per active rule (optionally of one type), all datasets."""

        parts = []
        for ds in ("customers", "products", "orders"):
            rules = [r for r in self.rules(ds) if rule_type is None or r.rule_type == rule_type]
            if rules:
                # only REFERENCE rules read the foreign-key flags (and their joins)
                needs_flags = any(r.rule_type == "REFERENCE" for r in rules)
                source, sets = self.checkable_orders() if needs_flags else (self.clean(ds), None)
                parts.append(rule_failure_counts(source, rules, self.as_of, sets))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def valid(self, dataset: str) -> DataFrame:
        if dataset == "orders":
            return check_orders(*self.orders_inputs(), self.rules(dataset), self.as_of, self.reference_strategy, passed_only=True)
        return split(self.checked(dataset))[0]

    def rejected(self, dataset: str) -> DataFrame:
        return split(self.checked(dataset))[1]

    @cached_property
    def dim_customers(self) -> DataFrame:
        return star.dim_customers(self.valid("customers"))

    @cached_property
    def dim_products(self) -> DataFrame:
        return star.dim_products(self.valid("products"))

    @cached_property
    def order_sales(self) -> DataFrame:
        orders = self.staged_valid("orders")  # first: it stages its parents beside the cleaned orders
        customers, products = star.dim_customers(self.staged_valid("customers")), star.dim_products(self.staged_valid("products"))
        return star.order_sales(orders, customers, products)

    @cached_property
    def staged_sales(self) -> DataFrame:
        """The fact, written once for what counts it and reads it."""

        return self._once("order-sales", lambda: self.order_sales)

    @cached_property
    def mart(self) -> DataFrame:
        return marts.profit_mart(self.order_sales)

    def report(self, name: str) -> DataFrame:
        return marts.REPORTS[name](self.mart)


def without_timestamps(df: DataFrame) -> DataFrame:
    """Drop run-time columns (check/ingestion time) for repeatable output."""

    return df.drop("dq_checked_timestamp", "ingestion_timestamp")


def check_times(views: RetailViews) -> DataFrame:
    """dataset_name, within_run, row_count: one row for each distinct check time
    of a dataset.  A run stamps all rows of a dataset with one time between its
    beginning and its end, however many tasks write them and whichever retry."""

    def stamped(ds):
        begun = _dt.datetime.now(_dt.UTC)
        # the stamped rows are written, so their time is that of the run that made them
        stamps = staged_copy(views.checked(ds).groupBy("dq_checked_timestamp").agg(F.count(F.lit(1)).alias("row_count")), "check-times")
        within = F.col("dq_checked_timestamp").between(F.lit(begun), F.lit(_dt.datetime.now(_dt.UTC)))
        return stamps.select(F.lit(ds).alias("dataset_name"), within.alias("within_run"), "row_count")

    with ThreadPoolExecutor(len(DATASETS)) as pool:  # the small datasets beside the orders
        customers, products, orders = pool.map(stamped, DATASETS)
    return customers.unionByName(products).unionByName(orders)


def _over_datasets(views: RetailViews, per_dataset) -> DataFrame:
    parts = [
        per_dataset(views.checked(ds)).select(F.lit(ds).alias("dataset_name"), "*")
        for ds in ("customers", "products", "orders")
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def status_counts(views: RetailViews) -> DataFrame:
    """Rows per dataset and status, over all three datasets."""

    return _over_datasets(views, quality.status_counts)


def reason_counts(views: RetailViews) -> DataFrame:
    """Rows per dataset and failure reason."""

    return _over_datasets(views, quality.reason_counts)
