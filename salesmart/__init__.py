"""salesmart — a Spark-native retail data-quality and profit-mart engine.

Snapshot files of customers, products and orders are read with fixed
schemas, cleaned, checked against a table of data-quality rules (split into
valid and rejected rows, every failure reason kept), joined into an order
fact, rolled up into a profit mart and queried by report queries.  Every
step is DataFrame / SQL work that Catalyst plans; nothing passes through
the driver except the rule catalog (tens of rows of control data).

Layout
------
``sources``    file readers (csv, json, xlsx), the rule catalog, table
               reads/writes, and a bridge that presents the benchmark
               tables in the retail source model.
``functions``  column-expression builders: cleaning, rule conditions.
``operators``  DataFrame -> DataFrame operators: quality annotation and
               split, reference flags, duplicate-key flags, star join,
               profit mart and reports.
``plans``      the four pipeline stages and their orchestration.
"""

from salesmart.settings import Settings

__all__ = ["Settings"]
