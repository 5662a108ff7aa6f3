"""How the cleaned orders are made, written and flagged: what costs time in every query that checks them."""

import datetime as dt
import threading

import pyarrow.parquet as pq
import pytest

from salesmart.functions.rules import Rule
from salesmart.operators import quality
from salesmart.plans import views as views_module
from salesmart.plans.views import DISTINCT_COLUMNS, SMALL_TASKS, RetailViews, staged_orders
from salesmart.session import local_dir
from salesmart.sources import bridge

ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
ORDERS = "row_id long, order_id string, customer_id string, product_id string, price double, profit double, ship_mode string"
FRAMES = {
    "customers": "customer_id string, customer_name string, email string, phone string, address string, segment string, country string, "
                 "city string, state string, postal_code string, region string",
    "products": "product_id string, category string, sub_category string, product_name string, state string, price_per_product double",
    "orders": ORDERS + ", order_date string, ship_date string, quantity int, discount double",
}


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


@pytest.fixture()
def tables(spark, tmp_dir):
    day = dt.datetime(2019, 2, 3)
    spark.createDataFrame(
        [(1, 7, 1, 2.0, 100.0, 0.05, 0.02, "N", "O", day), (1, 8, 2, 3.0, 10.0, 0.0, 0.01, "A", "F", day), (2, 9, 1, 1.0, 1.0, 0.0, 0.0, "R", "F", None),
         (4, 9, 1, 1.0, 1.0, 0.0, 0.0, "R", "F", day), (None, 9, 1, 1.0, 1.0, 0.0, 0.0, "R", "F", day)],
        "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
        "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    ).write.parquet(f"{tmp_dir}/lineitem.parquet")
    spark.createDataFrame(
        [(1, 5, "O", day, "1-URGENT"), (2, 123456, "P", day, "1-URGENT"), (2, 6, "P", day, "2-HIGH"), (3, 6, "P", day, "5-LOW"), (None, 6, "P", day, "5-LOW")],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string",
    ).write.parquet(f"{tmp_dir}/orders.parquet")
    return tmp_dir


def test_texts_of_an_order_are_made_before_its_lines_join_it(spark, tables):
    df = bridge.orders(spark, tables)
    got = sorted(map(tuple, df.select("row_id", "order_id", "order_date", "customer_id", "product_id").collect()))
    assert got == [
        (11, "us-2019-1", "3/2/2019", "cu-00005", "off-pt-00000007"),
        (12, "us-2019-1", "3/2/2019", "cu-00005", "tec-pt-00000008"),
        (21, "CA-2019-2", "2019-02-03", "cu-123456", "fur-pt-00000009"),
        (21, "CA-2019-2", "3/2/2059", "cu-00006", "fur-pt-00000009"),
    ]
    assert df.columns[:8] == ["row_id", "order_id", "order_date", "ship_date", "ship_mode", "customer_id", "product_id", "quantity"]
    lines = _plan(df)
    join = next(i for i, line in enumerate(lines) if "Join Inner" in line)
    for made in ("AS order_id", "AS order_date", "AS customer_id"):
        assert not any(made in line for line in lines[:join]) and any(made in line for line in lines[join:])


def test_columns_that_hardly_repeat_are_written_without_a_dictionary(spark):
    rows = [(i, f"US-2019-{i}", f"C{i}", f"P{i}", i / 7, i / 9, "Same Day") for i in range(500)] + [(None,) * 7]
    df = staged_orders(spark.createDataFrame(rows, ORDERS).coalesce(1))
    assert sorted(map(repr, (tuple(r)[:-1] for r in df.collect()))) == sorted(map(repr, rows))
    (path,) = df.inputFiles()
    meta = pq.ParquetFile(local_dir(path)).metadata
    by_dictionary = {
        meta.row_group(g).column(c).path_in_schema
        for g in range(meta.num_row_groups) for c in range(meta.num_columns) if meta.row_group(g).column(c).has_dictionary_page
    }
    assert by_dictionary == {"ship_mode"} and set(DISTINCT_COLUMNS) <= set(df.columns)


def test_rows_with_a_null_key_are_dealt_by_their_number_without_reading_other_columns(spark):
    rows = [(i, f"US-2019-{i}", f"C{i % 3}" if i % 2 else None, "P", 1.0, 2.0, None) for i in range(60)]
    df = staged_orders(spark.createDataFrame(rows, ORDERS))
    known = quality.staged_copy(spark.createDataFrame([("C0", True), ("C1", True)], "customer_id string, seen boolean"), "known")
    out = quality.join_back(df, known, "customer_id")
    assert {r["row_id"] for r in out.where("seen").collect()} == {i for i in range(60) if i % 2 and i % 3 < 2}
    assert out.count() == 60 and set(out.columns) == {*df.columns, "seen"}
    scan = next(line for line in _plan(out.select("seen")) if "Relation" in line or "Project" in line and quality.ROW in line)
    assert "ship_mode" not in scan
    read = out.select("seen")._jdf.queryExecution().executedPlan().toString()
    assert "ship_mode" not in read and "order_id" not in read


def test_patterns_are_matched_after_all_other_rules_of_passed_orders(spark):
    rules = [Rule("REGEX", "a", "A", "^x+$"), Rule("DATE_FORMAT", "b", "B", "d/M/yyyy"), Rule("POSITIVE", "n", "N"), Rule("NOT_NULL", "b", "M")]
    df = quality.staged_copy(spark.createDataFrame([("x", "1/2/2019", 1), ("x", "1/2/2019", -1), ("y", "1/2/2019", 1), ("x", "9", 1), (None, None, 1)], "a string, b string, n int"), "rows")
    passed = quality.annotate(df, rules, passed_only=True)
    assert [tuple(r)[:3] for r in passed.collect()] == [("x", "1/2/2019", 1)]
    (line,) = [x for x in _plan(passed) if "Filter" in x]
    assert max(line.index("isnotnull(b"), line.index("> 0")) < line.index("RLIKE") < line.index("gettimestamp")
    failed = quality.annotate(df, rules)
    assert sorted(r["dq_failure_reasons"] for r in failed.collect()) == sorted([[], ["N"], ["A"], ["B"], ["M"]])  # in rule order


def test_orders_are_cleaned_and_marked_by_small_tasks_and_the_setting_is_given_back(spark, monkeypatch):
    seen, before = {}, spark.conf.get(ADVISORY, None)
    for module in (views_module, quality):
        real = module.staged_copy
        monkeypatch.setattr(module, "staged_copy", lambda df, name, *a, real=real: seen.setdefault(name, spark.conf.get(ADVISORY)) and real(df, name, *a))
    RetailViews(spark, {name: spark.createDataFrame([], schema) for name, schema in FRAMES.items()}).valid("orders").collect()
    assert {seen[n] for n in ("clean-orders", "duplicate-keys", "parent-keys")} == set(SMALL_TASKS.values())
    assert spark.conf.get(ADVISORY, None) == before


def test_check_times_of_the_datasets_are_made_side_by_side_and_each_is_checked_once(spark, monkeypatch):
    running, most, checked = set(), [], []
    real_copy, real_annotate = views_module.staged_copy, views_module.annotate

    def copy(df, name, *rest):
        if name != "check-times":
            return real_copy(df, name, *rest)
        running.add(id(df))
        most.append(len(running))
        together.wait(60)
        try:
            return real_copy(df, name, *rest)
        finally:
            running.discard(id(df))

    together = threading.Barrier(3)
    monkeypatch.setattr(views_module, "staged_copy", copy)
    monkeypatch.setattr(views_module, "annotate", lambda df, *rest: checked.append(1) or real_annotate(df, *rest))
    views = RetailViews(spark, {name: spark.createDataFrame([(None,) * (schema.count(",") + 1)] * 2, schema) for name, schema in FRAMES.items()})
    got = sorted(map(tuple, views_module.check_times(views).collect()))
    assert got == [("customers", True, 2), ("orders", True, 2), ("products", True, 2)]
    assert max(most) == 3 and len(checked) == 3


def test_duplicates_are_found_while_a_parent_is_not_there_yet(spark, monkeypatch):
    found, real = threading.Event(), quality.duplicate_keys
    monkeypatch.setattr(quality, "duplicate_keys", lambda *a: found.set() or real(*a))
    orders = spark.createDataFrame([(i % 4, "US-2019-1", c, "P", 1.0, 1.0, None) for i, c in enumerate("AABC")] + [(0, None, "A", "P", 1.0, 1.0, None)], ORDERS)

    def parent():
        assert found.wait(60), "the duplicates wait for the parent"
        return spark.createDataFrame([("A",), ("C",)], "customer_id string")

    rules = [Rule("UNIQUE", "row_id", "TWICE"), Rule("REFERENCE", "customer_id", "UNKNOWN", "known")]
    references = [("customer_id", parent, "known")]
    for strategy in quality.REFERENCE_STRATEGIES:
        sets = quality.exception_sets(orders, rules, references if strategy == "exceptions" else ())
        flagged = quality.flag_references(orders, references, strategy, sets)
        got = [(r["row_id"], r["customer_id"], r["dq_failure_reasons"]) for r in quality.annotate(flagged, rules, None, sets).collect()]
        assert sorted(got) == [(0, "A", ["TWICE"]), (0, "A", ["TWICE"]), (1, "A", []), (2, "B", ["UNKNOWN"]), (3, "C", [])]
