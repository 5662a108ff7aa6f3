"""End to end on files landed from the sf0.001 benchmark tables."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesmart.plans import pipeline
from salesmart.sources.landing import land_benchmark
from salesmart.sources.rule_catalog import shipped_rules_df
from salesmart.sources.tables import overwrite_table

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def run(spark):
    settings = land_benchmark(spark, SF_SMALL).with_(prefix="e2e_")
    summary, details = pipeline.run_pipeline(spark, settings)
    return settings, summary, details


def test_all_stages_succeed(run):
    _, summary, _ = run
    assert [tuple(r) for r in summary.collect()] == [
        ("ingestion", "SUCCESS"), ("data_quality", "SUCCESS"), ("enrichment", "SUCCESS"), ("aggregation", "SUCCESS")
    ]


def test_valid_plus_rejected_is_raw(spark, run):
    s, _, details = run
    for ds in ("customers", "products", "orders"):
        raw = spark.table(s.raw_table(ds)).count()
        d = details["data_quality"][ds]
        assert d["valid"] + d["rejected"] == raw == details["ingestion"][ds]["rows_written"]
        assert spark.table(s.valid_table(ds)).count() == d["valid"]
        assert spark.table(s.rejected_table(ds)).where(F.size("dq_failure_reasons") == 0).count() == 0
        assert spark.table(s.valid_table(ds)).where(F.size("dq_failure_reasons") > 0).count() == 0


def test_table_contracts(spark, run):
    s, _, _ = run
    assert spark.table(s.valid_table("orders")).columns == [
        "product_id", "customer_id", "row_id", "order_id", "order_date", "ship_date", "ship_mode", "quantity",
        "price", "discount", "profit", "source_file_name", "ingestion_timestamp", "order_date_source",
        "ship_date_source", "dq_failure_reasons", "dq_status", "dq_checked_timestamp",
    ]
    assert spark.table(s.enriched_table("order_sales")).columns[-1] == "profit"
    assert dict(spark.table(s.mart_table).dtypes)["total_profit"] == "decimal(18,2)"
    assert spark.table(s.rules_table).count() == 53


def test_fact_and_mart_invariants(spark, run):
    s, _, details = run
    sales = spark.table(s.enriched_table("order_sales"))
    assert sales.count() == details["data_quality"]["orders"]["valid"]
    total_sales = sales.agg(F.sum("profit")).first()[0]
    total_mart = spark.table(s.mart_table).agg(F.sum("total_profit")).first()[0]
    assert total_sales == total_mart
    rep = pipeline.reports(spark, s)
    assert sum((r["total_profit"] for r in rep["profit_by_year"].collect()), Decimal(0)) == total_mart
    assert rep["top_customers"].count() <= 20


def test_rules_table_drives_the_checks(spark, run):
    """Deactivating a rule in the table changes the outcome on rerun."""

    s, _, details = run
    s2 = s.with_(prefix="e2e2_")
    pipeline.setup(spark, s2)
    for ds in ("customers", "products", "orders"):
        overwrite_table(spark.table(s.raw_table(ds)), s2.raw_table(ds), s2)
    rules = shipped_rules_df(spark).withColumn(
        "is_active", F.when(F.col("rule_id") == "ORD_002", F.lit(False)).otherwise(F.col("is_active"))
    )
    overwrite_table(rules, s2.rules_table, s2)
    out = pipeline.run_quality(spark, s2)
    assert out["orders"]["valid"] > details["data_quality"]["orders"]["valid"]
    reasons = spark.table(s2.rejected_table("orders")).select(F.explode("dq_failure_reasons")).distinct()
    assert "DUPLICATE_ROW_ID" not in [r[0] for r in reasons.collect()]


def test_cardinality_guard_stops_before_writing(spark, run):
    s, _, _ = run
    s3 = s.with_(prefix="e2e3_")
    pipeline.setup(spark, s3)
    for ds in ("customers", "products", "orders"):
        df = spark.table(s.valid_table(ds))
        if ds == "customers":
            df = df.unionByName(df.limit(1))  # duplicate customer in the lookup
        overwrite_table(df, s3.valid_table(ds), s3)
    with pytest.raises(ValueError, match="972 valid orders became 976"):
        pipeline.run_enrich(spark, s3)
    assert not spark.catalog.tableExists(s3.enriched_table("customers"))


@pytest.mark.parametrize("mode", ["checkpoint", "persist", "partitioned"])
def test_materialize_modes_give_the_same_split(spark, run, mode):
    s, _, details = run
    s4 = s.with_(prefix=f"e2e4{mode}_", materialize=mode)
    pipeline.setup(spark, s4)
    for ds in ("customers", "products", "orders"):
        overwrite_table(spark.table(s.raw_table(ds)), s4.raw_table(ds), s4)
    out = pipeline.run_quality(spark, s4)
    for ds in ("customers", "products", "orders"):
        assert (out[ds]["valid"], out[ds]["rejected"]) == (
            details["data_quality"][ds]["valid"], details["data_quality"][ds]["rejected"])


def test_sql_reports_equal_dataframe_reports(spark, run):
    from salesmart.operators import marts

    s, _, _ = run
    mart = spark.table(s.mart_table)
    for name, df in pipeline.reports(spark, s).items():
        expected = marts.REPORTS[name](mart)
        assert df.columns == expected.columns
        assert [tuple(r) for r in df.collect()] == [tuple(r) for r in expected.collect()]


def test_bucketed_tables_make_the_customer_join_shuffle_free(spark, run):
    """With both sides bucketed by customer_id (and broadcast off, as when
    the dimension is large), the enrichment join reads without an exchange
    on the order side."""

    s, _, _ = run
    s5 = s.with_(prefix="e2e5_", buckets={"customers_valid": (8, "customer_id"), "orders_valid": (8, "customer_id")})
    pipeline.setup(spark, s5)
    for ds in ("customers", "products", "orders"):
        overwrite_table(spark.table(s.valid_table(ds)), s5.valid_table(ds), s5)
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders = spark.table(s5.valid_table("orders")).select("customer_id", "row_id")
        customers = spark.table(s5.valid_table("customers")).select("customer_id", "customer_name")
        joined = orders.join(customers, "customer_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == spark.table(s.valid_table("orders")).join(
            spark.table(s.valid_table("customers")).select("customer_id"), "customer_id").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_partitioned_mode_views_prune_and_feed_enrichment(spark, run):
    s, _, details = run
    s6 = s.with_(prefix="e2e6_", materialize="partitioned")
    pipeline.setup(spark, s6)
    for ds in ("customers", "products", "orders"):
        overwrite_table(spark.table(s.raw_table(ds)), s6.raw_table(ds), s6)
    pipeline.run_quality(spark, s6)
    valid = spark.table(s6.valid_table("orders"))
    assert valid.columns == spark.table(s.valid_table("orders")).columns
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    plan = valid._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dq_status" in plan and "(dq_status" in plan and "= PASSED)" in plan
    out = pipeline.run_enrich(spark, s6)
    assert out["row_counts"]["order_sales"] == details["data_quality"]["orders"]["valid"]
    # switching back to tables replaces the views
    s7 = s6.with_(materialize="checkpoint")
    pipeline.run_quality(spark, s7)
    from salesmart.sources.tables import current_version

    assert current_version(spark, s6.valid_table("orders")).startswith(s6.valid_table("orders") + "__v_")


def test_command_line_runs_the_pipeline(spark, run, capsys):
    from salesmart.__main__ import main

    s, _, details = run
    assert main(["--landing", s.landing, "--prefix", "cli_"]) == 0
    out = capsys.readouterr().out
    assert "aggregation" in out and "SUCCESS" in out
    assert spark.table("cli_analytics.profit_by_year_category_subcategory_customer").count() == \
        details["aggregation"]["rows_written"]


def test_pipeline_outputs_equal_the_sql_oracle(spark, run):
    """The written tables (files -> raw -> quality -> enriched -> mart) agree
    with the independent DuckDB formulation over the same benchmark tables."""

    import duckdb

    from duck_oracle import build
    from test_entry import TABLES, _rows

    s, _, _ = run
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    sql = build()
    checks = {
        "orders_valid": spark.table(s.valid_table("orders")),
        "customers_rejected": spark.table(s.rejected_table("customers")),
        "order_sales": spark.table(s.enriched_table("order_sales")),
        "profit_mart": spark.table(s.mart_table),
    }
    for key, df in checks.items():
        df = df.drop("dq_checked_timestamp", "ingestion_timestamp")
        cur = con.execute(sql[key])
        cols = [c[0] for c in cur.description]
        assert sorted(df.columns) == sorted(cols), key
        assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(cols, cur.fetchall()), key


def test_previews(spark, run):
    from salesmart.operators import marts
    from salesmart.sources.tables import preview

    s, _, _ = run
    for table in (s.raw_table("orders"), s.raw_table("products"), s.rules_table, s.raw_table("customers")):
        assert preview(spark, table).count() == 20
    ordered = marts.preview(spark.table(s.raw_table("orders")), ["row_id"]).collect()
    assert [r["row_id"] for r in ordered] == sorted(r["row_id"] for r in ordered)


def test_partitioned_write_restores_session_settings(spark, run):
    s, _, _ = run
    before = spark.conf.get("spark.sql.optimizer.plannedWrite.enabled", None)
    s8 = s.with_(prefix="e2e8_")
    pipeline.setup(spark, s8)
    overwrite_table(spark.table(s.raw_table("products")), s8.raw_table("products"), s8)
    overwrite_table(spark.table(s.raw_table("customers")), s8.raw_table("customers"), s8)
    overwrite_table(spark.table(s.raw_table("orders")), s8.raw_table("orders"), s8)
    out = pipeline.run_quality(spark, s8)
    assert out["orders"]["valid"] + out["orders"]["rejected"] == spark.table(s.raw_table("orders")).count()
    assert spark.conf.get("spark.sql.optimizer.plannedWrite.enabled", None) == before


def test_failed_runs_publish_nothing_and_keep_the_old_tables(spark, run, monkeypatch):
    from salesmart.operators import star

    s, _, details = run
    before = {t: spark.table(s.enriched_table(t)).count() for t in ("customers", "products", "order_sales")}
    raw = spark.table(s.raw_table("customers")).count()
    original = star.order_sales
    monkeypatch.setattr(star, "order_sales", lambda o, c, p: original(o, c.union(c), p))
    with pytest.raises(star.CardinalityError):
        pipeline.run_enrich(spark, s)
    assert before == {t: spark.table(s.enriched_table(t)).count() for t in before}
    monkeypatch.setattr(pipeline, "read_source", lambda sp, ds, st: sp.table(st.raw_table(ds)).limit(0))
    with pytest.raises(RuntimeError, match="no rows"):
        pipeline.ingest(spark, s)
    assert spark.table(s.raw_table("customers")).count() == raw
    assert not [t.name for db in ("raw", "enriched") for t in spark.catalog.listTables(s.database(db)) if "__next_" in t.name]


def _versions(spark, table):
    database, name = table.rsplit(".", 1)
    return [t.name for t in spark.catalog.listTables(database) if t.name.startswith(f"{name}__v_")]


def test_readers_see_the_old_rows_until_the_new_version_stands(spark, run, monkeypatch):
    """A run that ends between the write and the replacement leaves the old
    rows readable; the next run drops what it left.  A query on the version
    before keeps its files for one more refresh."""

    from salesmart.sources import tables

    s = run[0].with_(prefix="versions_")
    tables.create_zones(spark, s)
    name = s.raw_table("products")
    for k in range(3):
        reading = spark.table(name) if k else None
        assert overwrite_table(spark.range(k + 1).withColumn("generation", F.lit(k)), name, s) == k + 1
        assert spark.table(name).count() == k + 1 and len(_versions(spark, name)) <= 2
        assert reading is None or reading.count() == k
    with monkeypatch.context() as m:
        m.setattr(tables, "publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            overwrite_table(spark.range(10), name, s)
    assert len(_versions(spark, name)) == 3 and spark.table(name).columns == ["id", "generation"] and spark.table(name).count() == 3
    overwrite_table(spark.range(5).toDF("other"), name, s)
    assert len(_versions(spark, name)) == 2 and spark.table(name).columns == ["other"]
    # a table written in place by an earlier release gives way to a view
    spark.sql(f"DROP VIEW {name}")
    spark.range(2).write.saveAsTable(name)
    overwrite_table(spark.range(4), name, s)
    assert spark.table(name).count() == 4
    tables.drop_zones(spark, s)


def test_enriched_tables_are_published_together(spark, run, monkeypatch):
    """A dimension or fact that fails leaves all three old tables, and so does a
    replacement that fails after the first of them."""

    from salesmart.operators import star
    from salesmart.sources import tables

    s = run[0]
    names = [s.enriched_table(t) for t in ("customers", "products", "order_sales")]
    before = {t: tables.current_version(spark, t) for t in names}
    assert all(before.values())
    broken = F.raise_error(F.lit("broken")).cast("string")
    for failing in ("dim_customers", "dim_products"):
        original = getattr(star, failing)
        with monkeypatch.context() as m:
            m.setattr(star, failing, lambda df, original=original: original(df).withColumn("state", broken))
            with pytest.raises(Exception, match="broken"):
                pipeline.run_enrich(spark, s)
        assert before == {t: tables.current_version(spark, t) for t in names}
    original = tables._repoint
    with monkeypatch.context() as m:
        m.setattr(tables, "_repoint", lambda sp, view, version: original(sp, view, version) if not (view == names[1] and version != before[view]) else (_ for _ in ()).throw(RuntimeError("catalog")))
        with pytest.raises(RuntimeError, match="catalog"):
            pipeline.run_enrich(spark, s)
    assert before == {t: tables.current_version(spark, t) for t in names}
    assert all(spark.table(t).count() for t in names)
    assert pipeline.run_enrich(spark, s)["status"] == "SUCCESS"
    assert all(tables.current_version(spark, t) != before[t] for t in names) and all(len(_versions(spark, t)) == 2 for t in names)


@pytest.mark.parametrize("stage", [pipeline.setup, pipeline.ingest, pipeline.run_quality, pipeline.run_enrich, pipeline.run_mart, pipeline.run_pipeline])
def test_every_stage_needs_a_session(run, stage):
    with pytest.raises(ValueError, match="spark must be provided"):
        stage(None, run[0])
