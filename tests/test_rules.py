"""Rule compiler: every type x pass / fail / null, loader validation."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from salesmart.functions.rules import Rule, condition, failure_reasons, validate
from salesmart.operators.quality import annotate, load_rules
from salesmart.sources.rule_catalog import SHIPPED_RULES, shipped_rules_df


def _passes(spark, rule, values, schema, extra=None, as_of=None):
    rows = [(v,) + tuple(extra or ()) for v in values]
    df = spark.createDataFrame(rows, schema)
    out = annotate(df, [rule], as_of)
    return [r["dq_status"] == "PASSED" for r in out.collect()]


@pytest.mark.parametrize(
    "rule_type,param,values,schema,expected",
    [
        ("NOT_NULL", None, ["x", None], "c string", [True, False]),
        ("REGEX", "^[A-Z]{2}-[0-9]{5}$", ["AB-12345", "ab-12345", None], "c string", [True, False, True]),
        ("VALID_CUSTOMER_NAME", None, ["José Núñez", "O'Brien-Smith Jr.", "Mia42 Stone", "\t", " ", None],
         "c string", [True, True, False, False, True, True]),
        ("ALLOWED_VALUES", '["Consumer","Corporate"]', ["Consumer", "consumer", None], "c string", [True, False, True]),
        ("VALID_STATE", None, ["Texas", "District of Columbia", "texas", "Ontario", None], "c string",
         [True, True, False, False, True]),
        ("POSITIVE", None, [1.0, 0.0, -2.0, None], "c double", [True, False, False, True]),
        ("BETWEEN", '{"min":0,"max":1}', [0.0, 1.0, 0.5, 1.5, -0.1, None], "c double",
         [True, True, True, False, False, True]),
        ("DATE_FORMAT", "d/M/yyyy", ["10/1/2024", "2024-01-10", None], "c string", [True, False, True]),
    ],
)
def test_truth_table(spark, rule_type, param, values, schema, expected):
    rule = Rule(rule_type, "c", "BAD", param)
    assert _passes(spark, rule, values, schema) == expected


def test_not_future_with_fixed_as_of(spark):
    today = dt.date(2024, 6, 1)
    rule = Rule("NOT_FUTURE", "c", "FUTURE")
    got = _passes(spark, rule, [today, today + dt.timedelta(days=1), None], "c date", as_of=today)
    assert got == [True, False, True]


def test_column_gte_null_sides_pass(spark):
    rows = [(dt.date(2024, 1, 2), dt.date(2024, 1, 1)), (dt.date(2024, 1, 1), dt.date(2024, 1, 2)),
            (None, dt.date(2024, 1, 1)), (dt.date(2024, 1, 1), None), (dt.date(2024, 1, 1), dt.date(2024, 1, 1))]
    df = spark.createDataFrame(rows, "ship_date date, order_date date")
    out = annotate(df, [Rule("COLUMN_GTE", "ship_date", "SHIP_BEFORE", "order_date")])
    assert [r["dq_status"] for r in out.collect()] == ["PASSED", "REJECTED", "PASSED", "PASSED", "PASSED"]


def test_reference_reads_flag_column(spark):
    df = spark.createDataFrame([("a", True), ("b", None), (None, None)], "k string, f boolean")
    out = annotate(df, [Rule("REFERENCE", "k", "DANGLING", "f")])
    assert [r["dq_status"] for r in out.collect()] == ["PASSED", "REJECTED", "PASSED"]


def test_unique_null_keys_pass_and_every_duplicate_fails(spark):
    df = spark.createDataFrame([(None,), (None,), ("x",), ("y",), ("y",)], "k string")
    out = annotate(df, [Rule("UNIQUE", "k", "DUP")]).orderBy("k").collect()
    assert [(r["k"], r["dq_status"]) for r in out] == [
        (None, "PASSED"), (None, "PASSED"), ("x", "PASSED"), ("y", "REJECTED"), ("y", "REJECTED")
    ]


def test_null_condition_counts_as_failure(spark):
    df = spark.createDataFrame([(0.5,)], "c double")
    out = annotate(df, [Rule("BETWEEN", "c", "RANGE", '{"min":null,"max":1}')])
    assert out.first()["dq_failure_reasons"] == ["RANGE"]


def test_reason_set_keeps_first_position(spark):
    df = spark.createDataFrame([(None, -1.0)], "a string, b double")
    rules = [Rule("NOT_NULL", "a", "R1"), Rule("POSITIVE", "b", "R2"), Rule("NOT_NULL", "a", "R1")]
    assert annotate(df, rules).first()["dq_failure_reasons"] == ["R1", "R2"]


def test_reasons_are_one_projection(spark):
    df = spark.createDataFrame([("a", 1.0)], "a string, b double")
    rules = [Rule("NOT_NULL", "a", f"R{i}") for i in range(6)]
    plan = annotate(df, rules)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") <= 2


def test_loader_orders_by_rule_order_then_id_and_skips_inactive(spark):
    rows = [
        ("B", "ds", "g", "n", "NOT_NULL", "c", None, "RB", 2, True),
        ("A", "ds", "g", "n", "NOT_NULL", "c", None, "RA", 2, True),
        ("C", "ds", "g", "n", "NOT_NULL", "c", None, "RC", 1, True),
        ("D", "ds", "g", "n", "NOT_NULL", "c", None, "RD", 0, False),
        ("E", "ds", "g", "n", "NOT_NULL", "c", None, "RE", 0, None),
        ("F", "other", "g", "n", "NOT_NULL", "c", None, "RF", 0, True),
    ]
    from salesmart.schemas import RULES

    rules = load_rules(spark.createDataFrame(rows, RULES), "ds")
    assert [r.rule_id for r in rules] == ["C", "A", "B"]


def test_shipped_order_ties(spark):
    rules = load_rules(shipped_rules_df(spark), "orders")
    ids = [r.rule_id for r in rules]
    assert ids.index("ORD_005A") < ids.index("ORD_006") and ids.index("ORD_007A") < ids.index("ORD_009")
    assert len(SHIPPED_RULES) == 53 and len(rules) == 23


def test_loader_validation_errors():
    with pytest.raises(ValueError, match="Unsupported rule type: NOPE"):
        validate(Rule("NOPE", "c", "R"))
    with pytest.raises(ValueError, match="failure_reason"):
        validate(Rule("NOT_NULL", "c", None))
    with pytest.raises(ValueError):
        validate(Rule("ALLOWED_VALUES", "c", "R", "not json"))
    with pytest.raises(ValueError):
        validate(Rule("BETWEEN", "c", "R", '{"min": 1}'))


def test_missing_column_is_an_analysis_error(spark):
    from pyspark.errors import AnalysisException

    df = spark.createDataFrame([("a",)], "x string")
    with pytest.raises(AnalysisException):
        annotate(df, [Rule("NOT_NULL", "nope", "R")]).collect()


def test_condition_accepts_dict_rules(spark):
    df = spark.createDataFrame([(1,)], "c long")
    cond = condition({"rule_type": "POSITIVE", "column_name": "c", "rule_parameter": None, "failure_reason": "R"})
    assert df.select(cond.alias("ok")).first()["ok"] is True
    assert df.select(failure_reasons([]).alias("r")).first()["r"] == []


def test_numeric_edge_semantics(spark):
    """NaN sorts above every number: it passes POSITIVE and fails BETWEEN."""

    df = spark.createDataFrame([(float("nan"),)], "c double")
    assert annotate(df, [Rule("POSITIVE", "c", "P")]).first()["dq_status"] == "PASSED"
    assert annotate(df, [Rule("BETWEEN", "c", "B", '{"min":0,"max":1}')]).first()["dq_status"] == "REJECTED"


def test_positive_on_text_is_a_cast_error_under_ansi(spark):
    df = spark.createDataFrame([("abc",)], "c string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        annotate(df, [Rule("POSITIVE", "c", "P")]).collect()


def test_regex_dollar_matches_before_final_newline(spark):
    """Java regex semantics (find, and $ before a trailing newline)."""

    df = spark.createDataFrame([("AB-12345\n",), ("xAB-12345",)], "c string")
    out = annotate(df, [Rule("REGEX", "c", "R", "^[A-Z]{2}-[0-9]{5}$")]).collect()
    assert [r["dq_status"] for r in out] == ["PASSED", "REJECTED"]


def test_rules_from_files_round_trip(spark, tmp_dir):
    import json

    from salesmart.sources.rule_catalog import RULE_FIELDS, rules_from_file

    rows = [dict(zip(RULE_FIELDS, r)) for r in SHIPPED_RULES]
    with open(f"{tmp_dir}/rules.jsonl", "w") as fh:
        fh.write("\n".join(json.dumps(r) for r in rows))
    shipped_rules_df(spark).write.option("header", True).option("escape", '"').csv(f"{tmp_dir}/rules_csv")
    for path, fmt in ((f"{tmp_dir}/rules.jsonl", "json"), (f"{tmp_dir}/rules_csv", "csv")):
        df = rules_from_file(spark, path, fmt)
        assert df.count() == 53
        assert [r.rule_id for r in load_rules(df, "orders")] == [r.rule_id for r in load_rules(shipped_rules_df(spark), "orders")]
        pattern = [r.rule_parameter for r in load_rules(df, "orders") if r.rule_id == "ORD_019"][0]
        assert pattern == '["Standard Class","Second Class","First Class","Same Day"]'
