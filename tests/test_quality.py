"""Annotate / split behaviour, reference flags, skew-safe duplicate keys."""

import datetime as dt

from pyspark.sql import functions as F

from salesmart.functions.rules import Rule
from salesmart.operators.quality import annotate, apply_rules, duplicate_keys, flag_references
from salesmart.plans.views import check_orders


def _reasons(df):
    return {r[0]: r["dq_failure_reasons"] for r in df.collect()}


def _statuses(df, rules, key):
    return {r[key]: r["dq_failure_reasons"] for r in annotate(df, rules).collect()}


def test_name_rules_one_case_per_row(spark):
    cases = {"k1": ("Noor van Dijk", []), "k2": (None, ["NO_NAME"]), "k3": ("R2 D2", ["ODD_NAME"]), "k4": ("Zo\u00eb O'Neil-Smith", [])}
    df = spark.createDataFrame([(k, name) for k, (name, _) in cases.items()], "k string, label string")
    rules = [Rule("NOT_NULL", "label", "NO_NAME"), Rule("VALID_CUSTOMER_NAME", "label", "ODD_NAME")]
    got = _statuses(df, rules, "k")
    assert {k: got[k] for k in ("k1", "k2", "k3")} == {k: cases[k][1] for k in ("k1", "k2", "k3")}


def test_unique_rejects_each_copy_and_leaves_nulls(spark):
    ids = ["p7"] * 3 + ["p8", "p9", "p9", None, None]
    df = spark.createDataFrame(list(enumerate(ids)), "n int, part string")
    valid, rejected = apply_rules(df, [Rule("UNIQUE", "part", "TWICE")])
    assert sorted(r["n"] for r in valid.collect()) == [3, 6, 7]
    assert sorted(r["n"] for r in rejected.collect()) == [0, 1, 2, 4, 5]


def test_date_format_accepts_only_the_pattern(spark):
    texts = {"3/11/2019": [], "03/11/2019": ["WHEN"], "2019/11/3": ["WHEN"], "31/4/2019": ["WHEN"], "soon": ["WHEN"]}
    df = spark.createDataFrame([(t,) for t in texts], "seen string")
    got = _statuses(df, [Rule("DATE_FORMAT", "seen", "WHEN", "d/M/yyyy")], "seen")
    assert got["3/11/2019"] == [] and got["2019/11/3"] == ["WHEN"] and got["31/4/2019"] == ["WHEN"] and got["soon"] == ["WHEN"]


def test_reasons_come_in_rule_order_and_only_those_that_fail(spark):
    rules = [
        Rule("POSITIVE", "pieces", "PIECES"),
        Rule("BETWEEN", "rate", "RATE", '{"min":-1,"max":2}'),
        Rule("COLUMN_GTE", "until", "ORDER_OF_DAYS", "since"),
        Rule("ALLOWED_VALUES", "way", "WAY", '["sea","air"]'),
    ]
    day = dt.date(2021, 7, 4)
    rows = [
        ("all good", 1, 2.0, day, day, "sea", []),
        ("one", -3, -1.0, day, day, "air", ["PIECES"]),
        ("two", 5, 2.001, day, day - dt.timedelta(1), "sea", ["RATE", "ORDER_OF_DAYS"]),
        ("all bad", 0, 9.0, day, day - dt.timedelta(40), "rail", ["PIECES", "RATE", "ORDER_OF_DAYS", "WAY"]),
    ]
    df = spark.createDataFrame([r[:-1] for r in rows], "k string, pieces long, rate double, since date, until date, way string")
    assert _statuses(df, rules, "k") == {r[0]: r[-1] for r in rows}


def test_reference_rules_name_the_parent_that_is_missing(spark):
    from salesmart.sources.rule_catalog import active_rules_df, shipped_rules_df

    rules = [Rule.of(r) for r in active_rules_df(shipped_rules_df(spark), "orders").collect() if r["rule_type"] == "REFERENCE"]
    by_column = {r.column_name: r.failure_reason for r in rules}
    orders = spark.createDataFrame([(n, c, p) for n, (c, p) in enumerate([("u", "x"), ("u", "?"), ("?", "x"), (None, None)])], "row_id long, customer_id string, product_id string")
    out = check_orders(orders, spark.createDataFrame([("u",), ("v",)], ["customer_id"]), spark.createDataFrame([("x",)], ["product_id"]), rules)
    got = {r["row_id"]: r["dq_failure_reasons"] for r in out.collect()}
    reasons = list(by_column.values())
    assert len(reasons) == 2 and got[0] == []
    assert len(got[1]) == len(got[2]) == 1 and got[1] != got[2] and sorted(got[1] + got[2]) == sorted(reasons)
    assert not [c for c in out.columns if c.startswith("_")]
    assert out.columns[:3] == ["product_id", "customer_id", "row_id"]


def test_reference_flags_null_key_and_duplicate_parents(spark):
    orders = spark.createDataFrame([(1, "A"), (2, None), (3, "Z")], "row_id long, k string")
    parent = spark.createDataFrame([("A",), ("A",), (None,)], "k string")
    out = flag_references(orders, [("k", parent, "f")]).orderBy("row_id").collect()
    assert [(r["row_id"], r["f"]) for r in out] == [(1, True), (2, None), (3, None)]


def test_split_is_exhaustive_and_disjoint(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id")).alias("v"))
    rules = [Rule("NOT_NULL", "v", "V"), Rule("UNIQUE", "k", "K")]
    ann = annotate(df, rules)
    valid, rejected = apply_rules(df, rules)
    assert valid.count() + rejected.count() == 100
    assert ann.where((F.size("dq_failure_reasons") == 0) != (F.col("dq_status") == "PASSED")).count() == 0


def test_hot_and_null_keys_stay_correct(spark):
    """A key holding a third of the rows and many null keys (skew)."""

    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.col("id").cast("string")).alias("k")
    )
    ann = annotate(df, [Rule("UNIQUE", "k", "DUP")])
    counts = {r["dq_status"]: r["n"] for r in ann.groupBy("dq_status").agg(F.count("*").alias("n")).collect()}
    assert counts == {"REJECTED": n // 3, "PASSED": n - n // 3}
    assert duplicate_keys(df, "k").collect()[0]["k"] == "HOT"


def test_reference_flags_under_key_skew(spark):
    """A third of the orders on one customer and a third with no customer."""

    n = 30_000
    orders = spark.range(n).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("C"), (F.col("id") % 50).cast("string"))).alias("customer_id"),
    )
    parents = spark.range(25).select(F.concat(F.lit("C"), (F.col("id") * 2).cast("string")).alias("customer_id"))
    parents = parents.unionByName(spark.createDataFrame([("HOT",)], "customer_id string"))
    out = flag_references(orders, [("customer_id", parents, "f")])
    got = {r["k"]: r["n"] for r in out.groupBy(F.coalesce(F.col("f").cast("string"), F.lit("none")).alias("k"))
           .agg(F.count("*").alias("n")).collect()}
    expected_true = n // 3 + orders.where(F.col("customer_id").rlike("^C[0-9]*[02468]$")).count()
    assert got["true"] == expected_true and got["true"] + got["none"] == n


def test_reference_strategies_agree(spark):
    orders = spark.createDataFrame([(1, "A"), (2, None), (3, "Z"), (4, "A")], "row_id long, k string")
    parent = spark.createDataFrame([("A",), ("A",), (None,), ("B",)], "k string")
    a = flag_references(orders, [("k", parent, "f")], "exceptions")
    b = flag_references(orders, [("k", parent, "f")], "join")
    assert a.columns == b.columns == ["k", "row_id", "f"]
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_session_check_reports_disabled_aqe(spark):
    from salesmart.session import check_session

    assert check_session(spark) == []
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        warnings = check_session(spark)
        assert len(warnings) == 1 and "skewJoin" in warnings[0]
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def _rows_per_task(df, tmp_dir):
    """Rows that each task of the last stage held."""

    import glob

    import pyarrow.parquet as pq

    df.write.parquet(tmp_dir + "/out")
    return sorted(pq.ParquetFile(f).metadata.num_rows for f in glob.glob(tmp_dir + "/out/*.parquet"))


def test_hot_and_null_keys_are_split(spark, tmp_dir):
    """A third of the rows on one key, a third on null, and no broadcast: AQE
    splits the hot key between the staged sets and the rows, null keys are
    dealt out, and no exception set is repeated; in either operator and strategy."""

    from salesmart.operators.quality import add_duplicate_flags
    from salesmart.session import session_conf

    n = 60_000
    df = spark.range(0, n, 1, 8).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"),
    )
    parent = spark.range(0, n, 5).select(F.col("id").cast("string").alias("k"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    }
    forms = {
        "dup": lambda: add_duplicate_flags(df, ["k"]),
        "ref": lambda: flag_references(df, [("k", parent, "f")], "exceptions"),
        "join": lambda: flag_references(df, [("k", parent, "f")], "join"),
    }
    with session_conf(spark, conf):
        plain = {name: form().count() for name, form in forms.items()}
        for name, form in forms.items():
            out = form()
            plan = out._jdf.queryExecution().executedPlan()
            held = _rows_per_task(out, f"{tmp_dir}/{name}")
            assert sum(held) == n == plain[name] and held[-1] < 2 * n / 8, (name, held)
            assert "Generate" not in plan.toString()
        out = forms["ref"]()
        assert out.where("f").count() == parent.join(df.where("k <> 'HOT'"), "k").count()


def test_small_exception_sets_leave_the_rows_unshuffled(spark):
    """The planner knows a staged set's size: small ones are broadcast and the
    dataset is not shuffled."""

    df = spark.range(5000).select((F.col("id") % 4000).cast("string").alias("k"), F.col("id").alias("v"))
    plan = annotate(df, [Rule("UNIQUE", "k", "DUP")])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_staged_sets_can_be_released(spark):
    import os

    from salesmart.session import local_dir, release_staged, staged_copy

    release_staged(spark)
    df = staged_copy(spark.range(3).toDF("x"), "to-release")
    folder = local_dir(df.inputFiles()[0].rsplit("/", 1)[0])
    assert os.path.isdir(folder) and df.count() == 3
    assert release_staged(spark) == 1 and not os.path.exists(folder)
    assert release_staged(spark) == 0


def test_the_shipped_catalog_starts_no_job(spark):
    """Its rows are a local relation that the optimizer evaluates; a rules table
    costs one job for all datasets."""

    from salesmart.operators.quality import load_rule_sets, load_rules
    from salesmart.sources.rule_catalog import active_rules_df, shipped_rules_df

    sc = spark.sparkContext

    def jobs(group, run):
        sc.setJobGroup(group, group)
        try:
            return run(), len(sc.statusTracker().getJobIdsForGroup(group))
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)

    sets, started = jobs("catalog-local", lambda: load_rule_sets(shipped_rules_df(spark)))
    assert started == 0 and len(sets) == 3
    for ds in sets:
        assert sets[ds] == load_rules(shipped_rules_df(spark), ds)
        assert [r.rule_id for r in sets[ds]] == [r["rule_id"] for r in active_rules_df(shipped_rules_df(spark), ds).collect()]
    shipped_rules_df(spark).write.mode("overwrite").saveAsTable("rules_for_jobs")
    try:
        again, started = jobs("catalog-table", lambda: load_rule_sets(spark.table("rules_for_jobs")))
        assert started == 1 and {ds: again[ds] for ds in again} == {ds: sets[ds] for ds in sets}
    finally:
        spark.sql("DROP TABLE rules_for_jobs")


def test_rule_order_with_nulls_follows_the_sort(spark):
    from salesmart.operators.quality import load_rules
    from salesmart.schemas import RULES
    from salesmart.sources.rule_catalog import active_rules_df

    base = ("ds", "G", "n", "NOT_NULL", "c", None, "R")
    rows = [("b", *base, None, True), (None, *base, 2, True), ("a", *base, 2, True), ("é", *base, 1, True), ("z", *base, 1, True), ("x", *base, 1, None), ("y", *base, 1, False)]
    df = spark.createDataFrame(rows, RULES)
    assert [r.rule_id for r in load_rules(df, "ds")] == [r["rule_id"] or "" for r in active_rules_df(df, "ds").collect()]


def test_shipped_rules_per_dataset_and_type(spark):
    """Spot values of the catalog that do not come from the module under test."""

    from salesmart.sources.rule_catalog import active_rules_df, shipped_rules_df

    rules = shipped_rules_df(spark)
    assert rules.count() == 53
    per = {ds: active_rules_df(rules, ds).count() for ds in ("customers", "products", "orders")}
    assert sum(per.values()) <= 53 and all(per.values())
    assert rules.where("rule_type = 'REFERENCE'").count() == 2
    assert rules.where("rule_type = 'UNIQUE'").select("dataset_name").distinct().count() == 3
    order = [(r["rule_order"], r["rule_id"]) for r in active_rules_df(rules, "orders").collect()]
    assert order == sorted(order)


def test_large_exception_sets_come_back_as_marks_of_numbered_rows(spark, monkeypatch):
    """The rows are not shuffled, and each flag is that of the join on keys; null
    keys, keys of many rows and rows of several files included."""

    from salesmart.operators import quality
    from salesmart.session import session_conf, staged_copy

    n = 30_000
    rows = spark.range(0, n, 1, 5).select(
        F.col("id").alias("v"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 17_000).alias("k"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 1009).cast("string")).alias("p"),
    )
    parent = spark.range(0, 1009, 3).select(F.col("id").cast("string").alias("p"))
    numbered = staged_copy(quality.numbered(rows), "numbered")
    rules = [Rule("UNIQUE", "k", "TWICE"), Rule("REFERENCE", "p", "NO_PARENT", "known")]

    def checked(df):
        sets = quality.exception_sets(df, rules, [("p", parent, "known")])
        flagged = flag_references(df, [("p", parent, "known")], sets=sets)
        return sets, annotate(flagged, rules, sets=sets)

    few, plain = checked(rows)
    assert set(few) == {("duplicate", "k"), ("known", "known")}
    monkeypatch.setattr(quality, "FEW_KEYS", 0)
    many, marked = checked(numbered)
    assert set(many) == {("duplicate", "k"), ("dangling", "known")} and all(quality._BLOCK in s.columns for s in many.values())
    columns = ["v", "k", "p", "known", "dq_failure_reasons", "dq_status"]
    want = sorted(map(tuple, plain.select(columns).collect()))
    assert plain.columns == [c for c in marked.columns if c != quality.ROW]
    assert len(want) == n and 0 < sum(r[-1] == "PASSED" for r in want) < n
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        again = checked(numbered)[1]
        assert "hashpartitioning" not in again._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, again.select(columns).collect())) == want
    monkeypatch.setattr(quality, "MANY_BLOCKS", 0)  # more blocks than are broadcast
    assert sorted(map(tuple, checked(numbered)[1].select(columns).collect())) == want
