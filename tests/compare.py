"""Compare query results with their SQL, order left aside."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

SPARK_TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def differences(spark_df, con, sql: str) -> list[str]:
    """What differs: names, types, row count or rows; nothing when all agree."""
    found = []
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    types = {c[0]: str(c[1]) for c in result.description}
    rows = result.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(names)}"]
    for name, kind in spark_df.dtypes:
        if SPARK_TYPES.get(kind, kind) != types[name]:
            found.append(f"type of {name}: {kind} != {types[name]}")
    ours = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    theirs = _rows(names, rows)
    if len(ours) != len(theirs):
        found.append(f"{len(ours)} rows != {len(theirs)}")
    elif ours != theirs:
        first = next((a, b) for a, b in zip(ours, theirs) if a != b)
        found.append(f"rows differ, e.g. {first[0]} != {first[1]}")
    return found
