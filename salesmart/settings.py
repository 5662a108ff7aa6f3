"""One settings object for zones, table names, source paths and formats.

Every stage reads its table names from here, so a run can be pointed at
another catalog, database prefix or storage format without touching code.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace

ZONES = ("raw", "quality", "enriched", "analytics")
DATASETS = ("customers", "products", "orders")
MART_TABLE = "profit_by_year_category_subcategory_customer"
RULES_TABLE = "data_quality_rules"


@dataclass(frozen=True)
class Settings:
    """Where things live and how they are written.

    ``catalog``      optional catalog name; ``None`` uses the session's
                     current catalog with two-level ``zone.table`` names.
    ``prefix``       optional string put in front of every zone name
                     (``"t1_"`` -> ``t1_raw.customers``); lets tests and
                     several runs share one metastore.
    ``landing``      directory (any Hadoop path) holding the source files.
    ``table_format`` format for every written table (``parquet`` default;
                     ``delta`` when that package is on the classpath).
    ``as_of``        optional fixed date for NOT_FUTURE checks; ``None``
                     means ``current_date()`` of the session time zone.
    ``buckets``      optional ``{table_key: (num_buckets, column, ...)}`` to
                     write tables bucketed (parquet only).  Keys are the
                     short names ``"customers_valid"``, ``"orders_valid"``,
                     ``"order_sales"`` ...  Bucketing the valid orders and
                     the valid customers by ``customer_id`` with the same
                     count (under ``materialize="partitioned"`` the keys are
                     ``"orders_checked"`` / ``"customers_checked"``)
                     count makes the enrichment join shuffle-free when the
                     customer side is too large to broadcast.
    ``reference_strategy``  how REFERENCE flags are computed: ``"exceptions"``
                     (default; dangling keys found on key-only data and
                     joined back, so the order rows are not shuffled) or
                     ``"join"`` (left join with the parents' key sets).
    ``materialize``  how a checked dataset is held for its two writes
                     (valid, rejected): ``"checkpoint"`` writes it
                     once to the shared ``spark.checkpoint.dir`` and cuts the
                     lineage, so a lost executor costs no recomputation;
                     ``"persist"`` caches it on the executors instead;
                     ``"partitioned"`` (default) writes it once to
                     ``quality.<ds>_checked`` partitioned by ``dq_status``
                     and makes ``<ds>_valid`` / ``<ds>_rejected`` views
                     over one partition each (one job, one write).
    """

    catalog: str | None = None
    prefix: str = ""
    landing: str = ""
    customers_file: str = "customers_volume_new/Customer.xlsx"
    products_file: str = "products_volume_new/Products.csv"
    orders_file: str = "orders_volume_new/Orders.json"
    xlsx_address: str = "'Worksheet'!A1"
    csv_escape: str = "\\"
    table_format: str = "parquet"
    as_of: _dt.date | None = None
    materialize: str = "partitioned"
    reference_strategy: str = "exceptions"
    buckets: dict = field(default_factory=dict)
    extra_write_options: dict = field(default_factory=dict)

    def bucketing(self, table: str) -> tuple | None:
        """Bucket spec for a fully qualified table name, if configured."""

        return self.buckets.get(table.rsplit(".", 1)[-1])

    def with_(self, **changes) -> "Settings":
        return replace(self, **changes)

    # ---- names --------------------------------------------------------
    def database(self, zone: str) -> str:
        if zone not in ZONES:
            raise ValueError(f"Unknown zone: {zone}")
        name = f"{self.prefix}{zone}"
        return f"{self.catalog}.{name}" if self.catalog else name

    def table(self, zone: str, name: str) -> str:
        return f"{self.database(zone)}.{name}"

    def raw_table(self, dataset: str) -> str:
        return self.table("raw", dataset)

    def valid_table(self, dataset: str) -> str:
        return self.table("quality", f"{dataset}_valid")

    def rejected_table(self, dataset: str) -> str:
        return self.table("quality", f"{dataset}_rejected")

    @property
    def rules_table(self) -> str:
        return self.table("quality", RULES_TABLE)

    def enriched_table(self, name: str) -> str:
        return self.table("enriched", name)

    @property
    def mart_table(self) -> str:
        return self.table("analytics", MART_TABLE)

    # ---- source paths -------------------------------------------------
    def source_path(self, dataset: str) -> str:
        rel = {
            "customers": self.customers_file,
            "products": self.products_file,
            "orders": self.orders_file,
        }[dataset]
        base = self.landing.rstrip("/")
        return f"{base}/{rel}" if base else rel

    def source_file_name(self, dataset: str) -> str:
        return self.source_path(dataset).rstrip("/").rsplit("/", 1)[-1]
