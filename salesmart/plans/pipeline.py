"""The four stages and the pipeline that runs them in order.

ingest    landed files -> raw.customers / raw.products / raw.orders
quality   raw.* -> quality.<ds>_valid / quality.<ds>_rejected
enrich    quality.*_valid -> enriched.customers / products / order_sales
mart      enriched.order_sales -> analytics.profit_by_year_category_subcategory_customer
reports   four SQL reports on the mart

Cost model (what differs from a naive stage-by-stage port):
* each dataset's quality plan is evaluated once, in one job: the checked
  rows are written to ``quality.<ds>_checked`` partitioned by status and
  the valid / rejected outputs are views over one partition each (or,
  with ``materialize="checkpoint"``, checkpointed once to the shared
  folder and written as two tables); row counts come from Observations on
  the writes, not from extra count jobs;
* orders are checked against the *written* valid parent tables, so the
  parents' rule plans are not re-run inside the orders plan;
* the empty-source and cardinality guards check the row counts of the writes
  themselves, before the written table takes its place.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.cleaning import CLEANERS
from salesmart.operators import marts, star
from salesmart.operators.quality import PASSED, REJECTED, annotate, load_rule_sets, split
from salesmart.plans.views import check_orders, staged_orders
from salesmart.session import check_session, ensure_checkpoint_dir, session_conf
from salesmart.settings import DATASETS, Settings
from salesmart.sources.files import read_source
from salesmart.sources.tables import Prepared, create_zones, discard, overwrite_table, prepare_table, publish, replace_view, seed_rules

SUCCESS = "SUCCESS"
UNSORTED_PARTITION_WRITE = {
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    "spark.sql.optimizer.plannedWrite.enabled": "false",
    # the two partitions are found by listing
    "spark.sql.hive.manageFilesourcePartitions": "false",
}


def setup(spark: SparkSession, settings: Settings) -> dict:
    """Create the zones and (re)seed the rules table."""

    zones = create_zones(_session(spark), settings)
    return {"zones": zones, "rules_table": settings.rules_table, "rules": seed_rules(spark, settings)}


def _session(spark: SparkSession | None) -> SparkSession:
    if spark is None:
        raise ValueError("spark must be provided.")
    return spark


def _some_rows(dataset: str):
    """Check of a write's row count: the source is not read a second time."""

    def check(rows: int) -> None:
        if rows == 0:
            raise ValueError(f"{dataset} file contains no rows.")

    return check


def ingest(spark: SparkSession, settings: Settings) -> dict:
    """Read customers, products, orders (in that order) into ``raw.*``.

    An empty source stops the stage with ``RuntimeError``; tables written
    before it stay written, later sources are not processed.
    """

    _session(spark)
    summary = {}
    for dataset in DATASETS:
        table = settings.raw_table(dataset)
        try:
            rows = overwrite_table(read_source(spark, dataset, settings), table, settings, check=_some_rows(dataset))
        except Exception as error:
            raise RuntimeError(f"Ingestion failed for {dataset}: {error}") from error
        summary[dataset] = {"table": table, "rows_written": rows, "status": SUCCESS}
    return summary


def write_checked(annotated: DataFrame, dataset: str, settings: Settings) -> dict:
    """Write valid and rejected rows of one annotated dataset.

    The rule plan is evaluated once.  ``materialize="partitioned"``
    (default): one partitioned write plus two views, see
    ``write_checked_partitioned``.  ``"checkpoint"``: an eager reliable
    checkpoint writes the rows to the shared checkpoint folder (one job,
    lineage cut) and two filtered table writes read that.  ``"persist"``:
    the rows are cached on the executors for the two writes.
    """

    if settings.materialize == "partitioned":
        return write_checked_partitioned(annotated, dataset, settings)
    if settings.materialize == "checkpoint":
        ensure_checkpoint_dir(annotated.sparkSession)
        held = annotated.checkpoint(eager=True)
    elif settings.materialize == "persist":
        held = annotated.persist(StorageLevel.MEMORY_AND_DISK)
    else:
        raise ValueError(f"Unknown materialize mode: {settings.materialize}")
    try:
        valid, rejected = split(held)
        valid_rows = overwrite_table(valid, settings.valid_table(dataset), settings)
        rejected_rows = overwrite_table(rejected, settings.rejected_table(dataset), settings)
    finally:
        if settings.materialize == "persist":
            held.unpersist()
    return {
        "valid": valid_rows,
        "rejected": rejected_rows,
        "valid_table": settings.valid_table(dataset),
        "rejected_table": settings.rejected_table(dataset),
    }


def write_checked_partitioned(annotated: DataFrame, dataset: str, settings: Settings) -> dict:
    """One job, one write: the checked dataset goes to ``quality.<ds>_checked``
    partitioned by ``dq_status``; ``<ds>_valid`` and ``<ds>_rejected`` are
    views whose status filter prunes to one partition directory.  Both row
    counts come from one Observation on that write."""

    spark = annotated.sparkSession
    checked = settings.table("quality", f"{dataset}_checked")
    # Two status values: each task keeps both output files open instead of
    # sorting its rows by status first (the planned-write sort costs a
    # per-task sort of every wide row).
    with session_conf(spark, UNSORTED_PARTITION_WRITE):
        got = overwrite_table(
            annotated, checked, settings, partition_by=("dq_status",),
            counts={"valid": F.col("dq_status") == PASSED, "rejected": F.col("dq_status") == REJECTED},
        )
    columns = ", ".join(f"`{c}`" for c in annotated.columns)
    for name, status in ((settings.valid_table(dataset), PASSED), (settings.rejected_table(dataset), REJECTED)):
        replace_view(spark, name, f"SELECT {columns} FROM {checked} WHERE dq_status = '{status}'")
    return {
        "valid": got["valid"],
        "rejected": got["rejected"],
        "valid_table": settings.valid_table(dataset),
        "rejected_table": settings.rejected_table(dataset),
        "checked_table": checked,
    }


def run_quality(spark: SparkSession, settings: Settings) -> dict:
    """Clean and check customers and products, then orders against the
    passed customers and products."""

    _session(spark)
    rules = load_rule_sets(spark.table(settings.rules_table))
    summary = {}
    for dataset in ("customers", "products"):
        clean = CLEANERS[dataset](spark.table(settings.raw_table(dataset)))
        summary[dataset] = write_checked(annotate(clean, rules[dataset], settings.as_of), dataset, settings)
    # numbered rows are flagged without a shuffle of all columns
    clean = CLEANERS["orders"](spark.table(settings.raw_table("orders")))
    orders = check_orders(
        staged_orders(clean),
        spark.table(settings.valid_table("customers")),
        spark.table(settings.valid_table("products")),
        rules["orders"],
        settings.as_of,
        settings.reference_strategy,
    )
    summary["orders"] = write_checked(orders, "orders", settings)
    summary["status"] = SUCCESS
    return summary


def run_enrich(spark: SparkSession, settings: Settings) -> dict:
    """Dimensions and the order_sales fact.  All three are written before any
    is published, and published together; the stage refuses to publish if the
    joins change the number of valid orders."""

    _session(spark)
    orders_valid = spark.table(settings.valid_table("orders"))
    customers = star.dim_customers(spark.table(settings.valid_table("customers")))
    products = star.dim_products(spark.table(settings.valid_table("products")))
    sales = star.order_sales(orders_valid, customers, products)
    outputs = {"customers": customers, "products": products, "order_sales": sales}
    tables = {name: settings.enriched_table(name) for name in outputs}
    # the count of a written table reads no column, and the fact is joined once, by its write
    valid_rows = orders_valid.count()
    prepared: list[Prepared] = []
    try:
        for name, df in outputs.items():
            prepared.append(prepare_table(df, tables[name], settings))
        star.check_cardinality(prepared[-1].rows, valid_rows)
    except BaseException:
        discard(spark, prepared)
        raise
    publish(spark, prepared)
    return {"status": SUCCESS, "tables": tables, "row_counts": {name: p.rows for name, p in zip(outputs, prepared, strict=True)}}


def run_mart(spark: SparkSession, settings: Settings) -> dict:
    """Profit by year, category, sub-category and customer."""

    _session(spark)
    source = settings.enriched_table("order_sales")
    rows = overwrite_table(marts.profit_mart(spark.table(source)), settings.mart_table, settings)
    return {"status": SUCCESS, "source_table": source, "target_table": settings.mart_table, "rows_written": rows}


def reports(spark: SparkSession, settings: Settings) -> dict[str, DataFrame]:
    """The four report queries, as SQL over the mart table."""

    return {name: spark.sql(sql.format(mart=settings.mart_table)) for name, sql in marts.REPORT_SQL.items()}


def run_pipeline(spark: SparkSession, settings: Settings, seed: bool = True) -> tuple[DataFrame, dict]:
    """setup -> ingest -> quality -> enrich -> mart, stopping at the first
    stage that does not succeed.  Returns a (stage, status) DataFrame and
    the per-stage summaries."""

    details = {"session_warnings": check_session(_session(spark))}
    details["setup"] = setup(spark, settings) if seed else create_zones(spark, settings)
    details["ingestion"] = ingest(spark, settings)
    stages = [("ingestion", SUCCESS)]
    for name, stage in (("data_quality", run_quality), ("enrichment", run_enrich), ("aggregation", run_mart)):
        result = stage(spark, settings)
        details[name] = result
        stages.append((name, result["status"]))
        if result["status"] != SUCCESS:
            raise RuntimeError(f"{name} failed.")
    return spark.createDataFrame(stages, ["pipeline_stage", "status"]), details


def run_summary(spark: SparkSession, details: dict) -> DataFrame:
    """The outputs of a run as rows: pipeline_stage, status, output, row_count
    (from the per-stage summaries of ``run_pipeline``: nothing is counted again).

    That a run reports ``SUCCESS`` says that its guards held: no source was
    empty and the fact has as many rows as there are valid orders."""

    rows = [("ingestion", d["status"], name, d["rows_written"]) for name, d in details["ingestion"].items()]
    checked = details["data_quality"]
    rows += [("data_quality", checked["status"], f"{ds}_{part}", checked[ds][part]) for ds in DATASETS for part in ("valid", "rejected")]
    rows += [("enrichment", details["enrichment"]["status"], name, n) for name, n in details["enrichment"]["row_counts"].items()]
    rows.append(("aggregation", details["aggregation"]["status"], "profit_mart", details["aggregation"]["rows_written"]))
    return spark.createDataFrame(rows, "pipeline_stage string, status string, output string, row_count long")
