"""Run a registered query and its SQL, and compare all rows."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def difference(frame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both give the same columns and the same rows, else what differs."""
    names = sorted(frame.columns)
    ours = Counter(tuple(row[name] for name in names) for row in frame.collect())
    result = connection.execute(sql)
    titles = [column[0] for column in result.description]
    if sorted(titles) != names:
        return f"columns {names} against {sorted(titles)}"
    order = [titles.index(name) for name in names]
    theirs = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    if ours == theirs:
        return None
    return (
        f"{ours.total()} rows against {theirs.total()}; "
        f"only here {list((ours - theirs).items())[:3]}; "
        f"only in SQL {list((theirs - ours).items())[:3]}"
    )
