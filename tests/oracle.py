"""Side-by-side run of a registered query and its SQL."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def rows_of(columns: list[str], rows) -> list[tuple]:
    """Rows with columns in name order, sorted; missing values print alike."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        return None if isinstance(v, float) and math.isnan(v) else v

    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None where both agree, otherwise what differs first."""
    df = query(spark, sf_dir)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = {c[0]: str(c[1]).upper() for c in cur.description}
    want = {"long": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}
    for field in df.schema.fields:
        kind = want[{"bigint": "long"}.get(field.dataType.simpleString(), field.dataType.simpleString())]
        if kinds[field.name] not in (kind, "NUMBER" if kind != "VARCHAR" else "STRING"):
            return f"type of {field.name}: {kind} != {kinds[field.name]}"
    theirs = rows_of(names, cur.fetchall())
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)} rows"
    for left, right in zip(mine, theirs):
        if repr(left) != repr(right):
            return f"{left} != {right}"
    return None
