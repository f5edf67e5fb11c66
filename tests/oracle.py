"""Compare a query with its SQL: column names, types and every row."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return db


def _plain(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def differences(df, db, sql: str) -> list[str]:
    """What is not the same; empty when all is."""
    names = sorted(df.columns)
    described = {r[0]: r[1] for r in db.execute(f"DESCRIBE {sql}").fetchall()}
    if sorted(described) != names:
        return [f"columns {names} != {sorted(described)}"]
    found = [
        f"type of {n}: {t} != {described[n]}" for n, t in df.dtypes if _TYPES.get(t, t.upper()) != described[n]
    ]
    picked = ", ".join(f'"{n}"' for n in names)
    expected = Counter(tuple(map(_plain, r)) for r in db.execute(f"SELECT {picked} FROM ({sql})").fetchall())
    actual = Counter(tuple(map(_plain, r)) for r in df.select(*names).collect())
    if expected != actual:
        found.append(
            f"{actual.total()} rows against {expected.total()};"
            f" only in Spark {list((actual - expected).items())[:3]}; only in SQL {list((expected - actual).items())[:3]}"
        )
    return found
