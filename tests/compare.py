"""Side-by-side comparison of a Spark result and DuckDB SQL, on values and types."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark simple type -> DuckDB type; anything else must match by name.
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "float": "FLOAT", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else value


def _bag(rows, order) -> Counter:
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, sql: str, sf_dir: str) -> list[str]:
    """Empty when row bags, column names and column types agree."""
    connection = duck(sf_dir)
    cursor = connection.execute(sql)
    their = {d[0]: str(d[1]) for d in cursor.description}
    their_rows = cursor.fetchall()
    ours = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if sorted(ours) != sorted(their):
        return [f"columns {sorted(ours)} != {sorted(their)}"]
    found = [
        f"type of {name}: {ours[name]} != {their[name]}"
        for name in sorted(ours)
        if TYPES.get(ours[name], ours[name]) != their[name]
    ]
    names = sorted(ours)
    our_bag = _bag(df.collect(), [df.columns.index(n) for n in names])
    their_bag = _bag(their_rows, [list(their).index(n) for n in names])
    if our_bag != their_bag:
        found.append(
            f"{sum(our_bag.values())} rows against {sum(their_bag.values())}; "
            f"only ours {list((our_bag - their_bag).items())[:3]}, "
            f"only theirs {list((their_bag - our_bag).items())[:3]} of {names}"
        )
    return found
