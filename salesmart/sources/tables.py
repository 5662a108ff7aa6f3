"""Zones (databases), full-refresh table writes and the rules table.

A full refresh never leaves readers without a table.  The rows go to a version
of the table (``<table>__v_<id>``) and ``<table>`` is a view of one version,
repointed by a single catalog call when the write, and the caller's check of its
counts, have succeeded.  ``prepare_table`` and ``publish`` are the two halves, so
that several outputs can be written first and published together;
``overwrite_table`` is both in one.  The version before the current one is kept
for queries that still read it and goes with the next refresh, and so does what
a crashed run has left.  Two runs at a time may not refresh the same table.

Row counts come from an ``Observation`` on the write itself — no second
evaluation of the plan just to count it.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from salesmart.settings import ZONES, Settings
from salesmart.sources.rule_catalog import shipped_rules_df


def create_zones(spark: SparkSession, settings: Settings) -> list[str]:
    """CREATE DATABASE IF NOT EXISTS for raw, quality, enriched, analytics."""

    names = [settings.database(zone) for zone in ZONES]
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    return names


def drop_zones(spark: SparkSession, settings: Settings) -> None:
    """Drop the zones and all their tables."""

    for zone in ZONES:
        spark.sql(f"DROP DATABASE IF EXISTS {settings.database(zone)} CASCADE")


def drop_if(spark: SparkSession, name: str, kind: str) -> None:
    """Drop ``name`` if it exists as a ``"VIEW"`` or as a table (``"TABLE"``),
    so a run can switch an output between a table and a view."""

    if not spark.catalog.tableExists(name):
        return
    is_view = spark.catalog.getTable(name).tableType == "VIEW"
    if kind == "VIEW" and is_view:
        spark.sql(f"DROP VIEW {name}")
    elif kind == "TABLE" and not is_view:
        spark.sql(f"DROP TABLE {name}")


@dataclass
class Prepared:
    """A written version of ``table`` that nobody reads yet (``version`` is the
    table itself where the format replaces in place)."""

    table: str
    version: str
    rows: int
    counts: dict


def prepare_table(
    df: DataFrame, table: str, settings: Settings, partition_by: tuple[str, ...] = (), counts: dict | None = None, in_place: bool = False
) -> Prepared:
    """Write ``df`` as a new version of ``table``.

    ``counts`` maps names to boolean columns: the rows where each is true are
    counted by the Observation of the write."""

    spark = df.sparkSession
    version = table if in_place else f"{table}__v_{uuid.uuid4().hex[:8]}"
    observation = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    metrics = [F.count(F.lit(1)).alias("rows")] + [F.count_if(cond).alias(name) for name, cond in (counts or {}).items()]
    writer = df.observe(observation, *metrics).write.format(settings.table_format).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if settings.table_format == "delta":
        writer = writer.option("overwriteSchema", "true")
    for key, value in settings.extra_write_options.items():
        writer = writer.option(key, value)
    spec = settings.bucketing(table)
    if spec:
        num_buckets, *columns = spec
        writer = writer.bucketBy(num_buckets, *columns).sortBy(*columns)
    try:
        writer.saveAsTable(version)
    except BaseException:
        if not in_place:
            spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    got = observation.get
    return Prepared(table, version, int(got.get("rows", 0)), {name: int(got.get(name, 0)) for name in counts or {}})


def discard(spark: SparkSession, prepared: list[Prepared]) -> None:
    """Drop versions that are not to be published."""

    for p in prepared:
        if p.version != p.table:
            spark.sql(f"DROP TABLE IF EXISTS {p.version}")


def _repoint(spark: SparkSession, view: str, version: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {version}")


def current_version(spark: SparkSession, table: str) -> str | None:
    """The version that ``table`` shows, if it is a view of one."""

    if not spark.catalog.tableExists(table) or spark.catalog.getTable(table).tableType != "VIEW":
        return None
    text = [r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r["col_name"] == "View Text"]
    found = re.fullmatch(r"SELECT \* FROM (\S+__v_[0-9a-f]{8})", text[0]) if text else None
    return found[1] if found else None


def publish(spark: SparkSession, prepared: list[Prepared]) -> None:
    """Show the new versions: one catalog call a table, one after the other.  If
    one fails, those already repointed are set back and all versions dropped."""

    moved = [p for p in prepared if p.version != p.table]
    before = {p.table: current_version(spark, p.table) for p in moved}
    done: list[Prepared] = []
    try:
        for p in moved:
            drop_if(spark, p.table, "TABLE")  # a table that an earlier release wrote in place
            _repoint(spark, p.table, p.version)
            done.append(p)
    except BaseException:
        for p in done:
            if before[p.table]:
                _repoint(spark, p.table, before[p.table])
            else:
                drop_if(spark, p.table, "VIEW")
        discard(spark, moved)
        raise
    for p in moved:
        _drop_versions(spark, p.table, keep={p.version, before[p.table]})


def _drop_versions(spark: SparkSession, table: str, keep: set[str | None]) -> None:
    database, name = table.rsplit(".", 1)
    for row in spark.sql(f"SHOW TABLES IN {database} LIKE '{name}__v_*'").collect():
        version = f"{database}.{row['tableName']}"
        if version not in keep and re.fullmatch(re.escape(name) + "__v_[0-9a-f]{8}", row["tableName"]):
            spark.sql(f"DROP TABLE IF EXISTS {version}")


def overwrite_table(
    df: DataFrame,
    table: str,
    settings: Settings,
    partition_by: tuple[str, ...] = (),
    counts: dict | None = None,
    check: Callable[[int], None] | None = None,
) -> int | dict:
    """Replace ``table`` (data and schema) with ``df``; return rows written.

    ``counts`` maps names to boolean columns: the write then returns
    ``{name: rows where the column is true}`` from the same Observation.
    ``check`` gets the number of rows before the table is replaced and may raise.
    """

    spark = df.sparkSession
    # a transactional format replaces in place
    in_place = settings.table_format == "delta" and check is None
    if in_place:
        drop_if(spark, table, "VIEW")
    prepared = prepare_table(df, table, settings, partition_by, counts, in_place)
    try:
        if check is not None:
            check(prepared.rows)
    except BaseException:
        discard(spark, [prepared])
        raise
    publish(spark, [prepared])
    return prepared.counts if counts else prepared.rows


def replace_view(spark: SparkSession, view: str, sql: str) -> None:
    """CREATE OR REPLACE VIEW (a table of that name is dropped first)."""

    drop_if(spark, view, "TABLE")
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {sql}")


def seed_rules(spark: SparkSession, settings: Settings, rules: DataFrame | None = None) -> int:
    """Create or replace the rules table (the shipped catalog by default)."""

    return overwrite_table(rules if rules is not None else shipped_rules_df(spark), settings.rules_table, settings)


def preview(spark: SparkSession, table: str, n: int = 20) -> DataFrame:
    """``SELECT * FROM table LIMIT n``."""

    return spark.table(table).limit(n)
