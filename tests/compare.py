"""Order-free comparison of a Spark result with its SQL twin in DuckDB."""

from __future__ import annotations

import math
from collections import Counter
from datetime import datetime, timezone
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime) and value.tzinfo:
        return value.astimezone(timezone.utc).replace(tzinfo=None)
    return value


def _bag(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN", "string": "VARCHAR",
    "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def differences(spark_df, con, sql) -> list[str]:
    """What differs: column names, types or rows."""
    cursor = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in cursor.description}
    ours = {f.name: KINDS[f.dataType.simpleString()] for f in spark_df.schema.fields}
    found = []
    if sorted(ours) != sorted(theirs):
        return [f"columns {sorted(ours)} / {sorted(theirs)}"]
    found += [f"{n}: {ours[n]} / {theirs[n]}" for n in ours if ours[n] != theirs[n]]
    left = _bag([tuple(r) for r in spark_df.collect()], spark_df.columns)
    right = _bag(cursor.fetchall(), list(theirs))
    if left != right:
        found.append(f"rows {sum(left.values())} / {sum(right.values())}")
        found.append(f"only ours {list((left - right).items())[:3]}")
        found.append(f"only theirs {list((right - left).items())[:3]}")
    return found
