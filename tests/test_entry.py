"""Driver contract: entry() runs; every registered query agrees with its
DuckDB oracle on sf0.001 (row count, column names, values)."""

import datetime as dt
import decimal
import re

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return repr(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["order_year", "total_profit"]
    assert df.count() > 0


def _optional(key):
    """Queries of the optional parts; their own tests hold them."""

    return bool(re.match(r"op\d+_", key)) or key == "pipeline"


def test_every_query_has_an_oracle():
    assert {k for k in entry.queries() if not _optional(k)} == {k for k in entry.oracle_sql() if not _optional(k)}


def test_answers_follow_the_tables(spark, tmp_path):
    """No plan is kept: halving a copied table between two calls of one session
    changes the answer, and two calls return different objects."""

    import shutil

    import pyarrow.parquet as pq

    folder = tmp_path / "sf"
    shutil.copytree(SF_SMALL, folder)
    for f in folder.rglob("*"):
        f.chmod(0o755 if f.is_dir() else 0o644)
    folder.chmod(0o755)
    keys = ("raw_customers", "dim_customers", "order_sales", "profit_mart")
    before = {k: entry.queries()[k](spark, str(folder)).count() for k in keys}
    first = entry.queries()["dim_customers"](spark, str(folder))
    assert first is not entry.queries()["dim_customers"](spark, str(folder))
    table = pq.read_table(folder / "customer.parquet")
    pq.write_table(table.slice(0, table.num_rows // 2), folder / "customer.parquet")
    after = {k: entry.queries()[k](spark, str(folder)).count() for k in keys}
    assert after["raw_customers"] == table.num_rows // 2 and all(after[k] < before[k] for k in keys)


@pytest.mark.parametrize("with_pipeline_file", [True, False])
def test_the_rest_stands_without_the_optional_parts(tmp_path, with_pipeline_file):
    """Without salesmart/llm and tests/llm (and with or without
    corpus_pipeline.py) the entry imports, answers and the other tests collect."""

    import pathlib
    import shutil
    import subprocess
    import sys

    root, copy = pathlib.Path(entry.__file__).parent, tmp_path / "copy"
    shutil.copytree(root, copy, ignore=lambda d, names: [n for n in names if n in ("llm", ".git", "__pycache__", ".pytest_cache") or (n == "corpus_pipeline.py" and not with_pipeline_file)])
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert q.keys() == s.keys() and 'pipeline' not in q, q.keys() ^ s.keys()"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True)
    found = subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q", "-p", "no:cacheprovider", "tests"], cwd=copy, capture_output=True, text=True)
    assert found.returncode == 0, found.stdout[-2000:]


@pytest.mark.parametrize("key", sorted(k for k in entry.queries() if not _optional(k)))
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry.oracle_sql()[key])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert _rows(df.columns, s_rows) == _rows(d_cols, d_rows)
