"""Land the bridged benchmark data as source files in the original formats:
customers as xlsx workbooks, products as CSV, orders as JSON arrays.

Used to run the whole pipeline (readers included) on data derived from the
benchmark tables.  Every file is written by the task that owns the rows
and has a bounded number of them, nothing passes through the driver, and all go
through Spark's writers, to any Hadoop path and committed with the task.  A
workbook is made in its task's memory and written as one line of Spark's text
writer: the line's end is the zip file's one-byte comment.
"""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.schemas import SOURCE_SCHEMAS
from salesmart.session import scratch_path
from salesmart.settings import Settings
from salesmart.sources import bridge

WORKBOOK_ROWS = 20_000
ARRAY_ROWS = 100_000


def _source_shaped(df: DataFrame, dataset: str) -> DataFrame:
    """Raw-shaped frame -> source header names, in source column order."""

    names = [f.name for f in SOURCE_SCHEMAS[dataset].fields]
    from salesmart.sources.files import snake_case

    return df.select(*[F.col(snake_case(n)).alias(n) for n in names])


def _workbooks(df: DataFrame, directory: str) -> None:
    """Workbooks of about ``WORKBOOK_ROWS`` rows, dealt evenly: a workbook is
    written and read by one task, so their number grows with the rows."""

    columns = df.columns

    def write(batches):
        import pandas as pd

        from salesmart.sources.xlsx import write_workbook

        def row_batches():
            for pdf in batches:
                pdf = pdf.astype(object).where(pdf.notna(), None)
                yield [list(r) for r in pdf.itertuples(index=False, name=None)]

        fh = io.BytesIO()
        write_workbook(fh, columns, row_batches())
        with zipfile.ZipFile(fh, "a") as zf:
            zf.comment = b"\n"
        yield pd.DataFrame({"value": [fh.getvalue()[:-1]]})

    dealt = df.repartition(max(1, -(-df.count() // WORKBOOK_ROWS)))
    # the cast keeps the bytes as they are, and so does the text writer
    dealt.mapInPandas(write, "value binary").select(F.col("value").cast("string")).write.mode("overwrite").option("lineSep", "\n").text(directory)


def _json_arrays(df: DataFrame, directory: str) -> None:
    """JSON arrays of at most ``ARRAY_ROWS`` objects, a file each, written by
    Spark's text writer (any Hadoop path, committed with the task).  A reader
    holds an array whole, so its size is bounded, not its number.  Spark makes
    each object's text; the task only adds the brackets and commas: the writer
    begins a file every ``ARRAY_ROWS`` lines, as the brackets do."""

    objects = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    rows = ARRAY_ROWS

    def lines(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def closed(values, at, final):
            """Objects with the brackets and commas of their places, the first being object ``at``."""
            place = np.arange(at, at + len(values)) % rows
            ends = place == rows - 1
            if final:
                ends[-1] = True
            before, after = pa.array(np.where(place == 0, "[", ""), values.type), pa.array(np.where(ends, "]", ","), values.type)
            return pa.RecordBatch.from_arrays([pc.binary_join_element_wise(before, values, after, pa.scalar("", values.type))], ["value"])

        held, at = None, 0  # a batch is held until another shows that it is not the last
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                yield closed(held, at, False)
                at += len(held)
            held = batch.column(0)
        yield pa.RecordBatch.from_pydict({"value": ["[]"]}) if held is None else closed(held, at, True)

    arrays = objects.mapInArrow(lines, "value string")
    arrays.write.mode("overwrite").option("maxRecordsPerFile", rows).option("compression", "lz4").text(directory)


def land(spark: SparkSession, raw: dict[str, DataFrame], landing: str | None = None,
         datasets=("customers", "products", "orders")) -> Settings:
    """Write the given raw-shaped datasets as source files; return Settings
    pointing at them (each source path is a directory of part files)."""

    landing = landing or scratch_path(spark, "landing")
    settings = Settings(
        landing=landing,
        customers_file="customers_volume_new/Customer.xlsx",
        products_file="products_volume_new/Products.csv",
        orders_file="orders_volume_new/Orders.json",
    )
    if "customers" in datasets:
        _workbooks(_source_shaped(raw["customers"], "customers"), settings.source_path("customers"))
    if "products" in datasets:
        (
            _source_shaped(raw["products"], "products").write.mode("overwrite")
            .option("header", True)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(settings.source_path("products"))
        )
    if "orders" in datasets:
        _json_arrays(_source_shaped(raw["orders"], "orders"), settings.source_path("orders"))
    return settings


def land_benchmark(spark: SparkSession, sf_dir: str, landing: str | None = None,
                   datasets=("customers", "products", "orders")) -> Settings:
    """Land the bridged benchmark tables of ``sf_dir``."""

    raw = {ds: bridge.SOURCES[ds](spark, sf_dir) for ds in datasets}
    return land(spark, raw, landing, datasets)
