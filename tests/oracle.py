"""A query's rows against the rows of its SQL in DuckDB."""

from __future__ import annotations

import os

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def database():
    import duckdb

    out = duckdb.connect()
    for name in TABLES:
        at = f"{FOLDER}/{name}.parquet"
        out.sql(f"CREATE VIEW {name} AS SELECT * FROM '{at}{'/*.parquet' if os.path.isdir(at) else ''}'")
    return out


def rows(names: list[str], values) -> list[tuple[str, ...]]:
    """Rows as texts, columns by name, floats to nine digits, in one order."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    text = lambda v: "NULL" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(text(r[i]) for i in order) for r in values)


def agree(spark, query, sql: str) -> None:
    df = query(spark, FOLDER)
    want = database().sql(sql)
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(want.columns, want.fetchall())
