"""Compares a registered query with its SQL on DuckDB, values and types."""

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def connect(folder):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _kind(dtype):
    names = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN",
             "double": "DOUBLE"}
    return names[dtype]


def mismatch(df, db, sql):
    """None if equal, else a text that says where they differ. Doubles must be equal to the bit."""
    result = db.execute(sql)
    columns = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    types = {name: _kind(kind) for name, kind in df.dtypes}
    if types != kinds:
        return f"types {[(c, types[c], kinds[c]) for c in columns if types[c] != kinds[c]]}"
    theirs = result.fetchall()
    ours = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    key = lambda row: tuple((v is not None, str(v)) for v in row)
    for a, b in zip(sorted(ours, key=key), sorted(theirs, key=key)):
        if a != b:
            return f"{dict(zip(columns, a))} != {dict(zip(columns, b))}"
    return None
