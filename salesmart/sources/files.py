"""Source file readers and the raw-table preparation step.

* csv  — header line skipped, fields bound to the fixed schema by position,
         PERMISSIVE (malformed values become NULL).
* json — one multi-line JSON array per file, fields bound by exact name.
* xlsx — see ``sources.xlsx``.

``prepare`` standardises the column names to snake_case (duplicates after
standardising are an error) and appends the file name and ingestion time.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from salesmart.schemas import SOURCE_SCHEMAS
from salesmart.settings import Settings

_NON_ALNUM = re.compile(r"[^a-zA-Z0-9]+")


def snake_case(name: str) -> str:
    """'Price per product' -> 'price_per_product', 'Sub-Category' -> 'sub_category'."""

    return _NON_ALNUM.sub("_", name.strip()).strip("_").lower()


def standardize(df: DataFrame) -> DataFrame:
    """Rename every column to snake_case; refuse names that collide."""

    names = [snake_case(c) for c in df.columns]
    if len(names) != len(set(names)):
        raise ValueError(f"Duplicate standardized columns: {names}")
    return df.toDF(*names)


def prepare(df: DataFrame, source_file_name: str) -> DataFrame:
    """Standardised names + ``source_file_name`` + ``ingestion_timestamp``."""

    return standardize(df).withColumns({
        "source_file_name": F.lit(source_file_name),
        "ingestion_timestamp": F.current_timestamp(),
    })


def read_csv(spark: SparkSession, path: str, schema: StructType, escape: str = "\\") -> DataFrame:
    """CSV with a header line and a fixed schema.

    ``escape`` is Spark's default backslash; RFC-4180 files that double
    quotes inside quoted fields need ``escape='"'``.
    """

    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
        .option("escape", escape)
        .csv(path)
    )


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A multi-line JSON array of objects (one file = one task: JSON arrays
    are not splittable; land many files for parallelism)."""

    return spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def read_source(spark: SparkSession, dataset: str, settings: Settings) -> DataFrame:
    """Read one dataset's landed file(s) and prepare them for ``raw.*``."""

    from salesmart.sources.xlsx import read_xlsx

    path = settings.source_path(dataset)
    schema = SOURCE_SCHEMAS[dataset]
    if dataset == "customers":
        df = read_xlsx(spark, path, schema, address=settings.xlsx_address)
    elif dataset == "products":
        df = read_csv(spark, path, schema, escape=settings.csv_escape)
    elif dataset == "orders":
        df = read_json(spark, path, schema)
    else:
        raise ValueError(f"Unknown dataset: {dataset}")
    return prepare(df, settings.source_file_name(dataset))
