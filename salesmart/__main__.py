"""Run the pipeline from the command line (or ``spark-submit``).

    python -m salesmart --landing /mnt/landing [--prefix dev_] [--catalog c]
                        [--format parquet] [--materialize partitioned]
                        [--reference-strategy exceptions|join] [--reports]

Uses the active session if there is one (``spark-submit``), else a local
one.  Prints the stage summary and, with ``--reports``, the four reports.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from salesmart.plans import pipeline
from salesmart.settings import Settings


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="salesmart", description=__doc__.splitlines()[0])
    parser.add_argument("--landing", required=True, help="folder holding the source files")
    parser.add_argument("--prefix", default="", help="prefix for the zone databases")
    parser.add_argument("--catalog", default=None)
    parser.add_argument("--format", default="parquet", dest="table_format")
    parser.add_argument("--materialize", default="partitioned", choices=["partitioned", "checkpoint", "persist"])
    parser.add_argument("--reference-strategy", default="exceptions", choices=["exceptions", "join"],
                        help="how REFERENCE flags are computed (see operators.quality.flag_references)")
    parser.add_argument("--reports", action="store_true", help="print the four reports")
    args = parser.parse_args(argv)

    spark = SparkSession.getActiveSession()
    if spark is None:
        from salesmart.session import local_session

        spark = local_session("salesmart")
    settings = Settings(
        landing=args.landing, prefix=args.prefix, catalog=args.catalog,
        table_format=args.table_format, materialize=args.materialize,
        reference_strategy=args.reference_strategy,
    )
    summary, details = pipeline.run_pipeline(spark, settings)
    summary.show(truncate=False)
    print(json.dumps(details, indent=1, default=str))
    if args.reports:
        for name, df in pipeline.reports(spark, settings).items():
            print(name)
            df.show(20, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
