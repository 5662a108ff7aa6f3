"""Compare a registered query with its SQL in DuckDB, values and order aside."""

import duckdb

from salesmart.llm import entry

TABLES = ("documents", "pages", "benchmark", "labels", "conversations")


def norm(v):
    return round(v, 6) if isinstance(v, float) else v


def compare(spark, name, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    rel = con.sql(entry.oracle_sql()[name])
    names = sorted(rel.columns)
    want = sorted((tuple(norm(r[rel.columns.index(c)]) for c in names) for r in rel.fetchall()), key=repr)
    df = entry.queries()[name](spark, sf_dir)
    assert sorted(df.columns) == names
    got = sorted((tuple(norm(r[c]) for c in names) for r in df.collect()), key=repr)
    assert len(got) == len(want)
    assert got == want, [(a, b) for a, b in zip(got, want) if a != b][:5]
