"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import glob
import os

import duckdb


def connect(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE",
}


def differences(df, connection, sql):
    """A readable difference, or None when names, types and rows agree."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    for name, kind in df.dtypes:
        if TYPES[kind] != kinds[name]:
            return f"type of {name}: {kind} != {kinds[name]}"
    actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)} rows"
    wrong = [(a, e) for a, e in zip(actual, expected) if repr(a) != repr(e)]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
