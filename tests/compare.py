"""Order-free, type-aware comparison of a Spark result with DuckDB."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Spark type -> DuckDB type of the same width.
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def differences(df, connection, sql: str) -> list[str]:
    expected = connection.sql(sql)
    spark_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    duck_types = dict(zip(expected.columns, map(str, expected.types)))
    if spark_types != duck_types:
        return [f"schema: {sorted(spark_types.items())} != {sorted(duck_types.items())}"]
    names = sorted(spark_types)
    order = [expected.columns.index(n) for n in names]
    ours = Counter(tuple(row) for row in df.select(*names).collect())
    theirs = Counter(tuple(row[i] for i in order) for row in expected.fetchall())
    problems = []
    for label, extra in (("only in spark", ours - theirs), ("only in duckdb", theirs - ours)):
        if extra:
            problems.append(f"{label}: {sum(extra.values())} rows, e.g. {extra.most_common(3)}")
    return problems
