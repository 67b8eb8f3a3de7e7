"""Side-by-side comparison with DuckDB, independent of row order."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5)
    if isinstance(value, int):
        return float(value) if abs(value) < 2**53 else value
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql) -> str | None:
    got = rows_of(spark_df.columns, spark_df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    want = rows_of(names, result.fetchall())
    if got == want:
        return None
    extra, missing = got - want, want - got
    return (
        f"rows {sum(got.values())} != {sum(want.values())} or values; columns {sorted(names)}; "
        f"only here {list(extra)[:3]}; only there {list(missing)[:3]}"
    )
