"""Compare a Spark result with the same query in DuckDB, row by row."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def _sorted_rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    picked = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(picked, key=lambda r: tuple((v is None, str(v)) for v in r))


KINDS = {
    "tinyint": "int", "smallint": "int", "int": "int", "integer": "int", "bigint": "long", "hugeint": "huge",
    "string": "text", "varchar": "text", "double": "double", "boolean": "bool",
    "timestamp_ntz": "time", "timestamp": "time",
}


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list[str]]:
    """Row count and a list of differences (empty when equal)."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    types = {d[0]: KINDS.get(str(d[1]).lower(), str(d[1])) for d in expected.description}
    want = _sorted_rows(names, expected.fetchall())
    got = _sorted_rows(spark_df.columns, spark_df.collect())
    problems = []
    if sorted(names) != sorted(spark_df.columns):
        problems.append(f"columns {sorted(spark_df.columns)} != {sorted(names)}")
        return len(got), problems
    for name, kind in spark_df.dtypes:
        if KINDS.get(kind, kind) != types[name]:
            problems.append(f"type of {name}: {kind} != {types[name]}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    for mine, theirs in zip(got, want):
        if mine != theirs:
            problems.append(f"{mine} != {theirs}")
            break
    return len(got), problems
