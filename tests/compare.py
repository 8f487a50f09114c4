"""Run queries in Spark and their SQL twins in DuckDB and compare whole results."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


KINDS = {"INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}


def differences(spark, con, build, sql: str, sf_dir: str) -> list[str]:
    """What differs, as text; empty if results, column names and types agree."""
    df = build(spark, sf_dir)
    actual = [tuple(row) for row in df.collect()]
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in cursor.description}
    expected = cursor.fetchall()
    found = []
    if dict(df.dtypes) != kinds:
        found.append(f"columns {dict(df.dtypes)} but {kinds}")
    got, want = _rows(df.columns, actual), _rows(names, expected)
    if got != want:
        extra, missing = set(got) - set(want), set(want) - set(got)
        found.append(f"{len(got)} rows but {len(want)}; only here {sorted(extra)[:3]}, "
                     f"only there {sorted(missing)[:3]}")
    if not got:
        found.append("no rows")
    return found
