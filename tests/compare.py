"""Order-insensitive comparison of a Spark result with DuckDB SQL."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            connection.execute(
                f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
            )
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _sorted(rows, order):
    picked = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(picked, key=lambda r: tuple((v is None, str(v)) for v in r))


def rows_of_spark(df):
    names = df.columns
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], _sorted(df.collect(), order)


def rows_of_sql(connection, sql):
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], _sorted(result.fetchall(), order)


def differences(spark_df, connection, sql, show: int = 3) -> list[str]:
    names, mine = rows_of_spark(spark_df)
    other_names, other = rows_of_sql(connection, sql)
    if names != other_names:
        return [f"columns {names} != {other_names}"]
    found = []
    if len(mine) != len(other):
        found.append(f"{len(mine)} rows != {len(other)}")
    unequal = [(a, b) for a, b in zip(mine, other, strict=False) if a != b]
    found += [f"{a}\n   != {b}" for a, b in unequal[:show]]
    if unequal:
        found.append(f"{len(unequal)} rows differ")
    return found
