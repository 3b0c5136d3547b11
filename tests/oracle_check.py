"""Runs a query and its SQL over the same tables and compares the rows."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _kind(name: str) -> str:
    name = name.lower()
    if name.startswith(("bigint", "long")):
        return "whole"
    if name.startswith("double"):
        return "real"
    if name.startswith(("varchar", "string")):
        return "text"
    return name


def differences(frame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between the two results; empty when nothing does."""
    names = sorted(frame.columns)
    got = frame.select(*names)
    cursor = con.execute(sql)
    described = {c[0]: str(c[1]) for c in cursor.description}
    if sorted(described) != names:
        return [f"columns {names} against {sorted(described)}"]
    order = [list(described).index(n) for n in names]
    expected = Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    found = Counter(tuple(row) for row in got.collect())
    wrong = [f"only in Spark: {r}" for r in list((found - expected))[:3]]
    wrong += [f"only in SQL: {r}" for r in list((expected - found))[:3]]
    types = {f.name: _kind(f.dataType.simpleString()) for f in got.schema}
    wrong += [f"type of {n}: {types[n]} against {described[n]}" for n in names
              if types[n] != _kind(described[n])]
    return wrong
