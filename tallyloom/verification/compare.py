"""Run a registered query in Spark and its SQL in DuckDB and compare the rows as multisets."""

from __future__ import annotations

import math
from collections import Counter

from tallyloom.plans import registry
from tallyloom.sources.shapes import RAW
from tallyloom.verification.oracle import oracle_sql


def connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for name in RAW:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def rows_of(rows) -> Counter:
    return Counter(tuple(_norm(v) for v in row) for row in rows)


def compare(spark, con, sf_dir: str, name: str):
    """(rows in Spark, rows in DuckDB, rows only in Spark, rows only in DuckDB)."""
    cols = [c for c, _ in registry.parse_spec(registry.SPECS[name])]
    ours = rows_of(registry.queries()[name](spark, sf_dir).select(*cols).collect())
    theirs = rows_of(con.execute(f"SELECT {', '.join(cols)} FROM ({oracle_sql()[name]}) q").fetchall())
    return ours.total(), theirs.total(), ours - theirs, theirs - ours
