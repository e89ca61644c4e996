"""Side-by-side run of a registered query and its SQL."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    """Value and a type family, so that 1, 1.0 and '1' stay apart."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else ("f", value + 0.0)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(map(repr, (tuple(plain(r[n]) for n in names) for r in df.select(*names).collect())))


def duck_rows(con, sql: str):
    result = con.execute(sql)
    found = [d[0] for d in result.description]
    names = sorted(found)
    index = [found.index(n) for n in names]
    return names, sorted(map(repr, (tuple(plain(row[i]) for i in index) for row in result.fetchall())))


def spark_types(df) -> dict[str, str]:
    return dict(df.dtypes)


def duck_types(con, sql: str) -> dict[str, str]:
    names = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
             "BOOLEAN": "boolean"}
    return {r[0]: names.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
