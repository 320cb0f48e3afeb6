"""Compare a registered query with its SQL twin: names, types, rows and values."""

from __future__ import annotations

import math

import duckdb

NAMES = ("region nation customer supplier part orders lineitem events documents embeddings "
         "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


_KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _rows(rows):
    return sorted((tuple(_plain(v) for v in row) for row in rows), key=repr)


def compare(df, con, sql: str) -> list[str]:
    """Empty when equal, else what differs."""
    names = sorted(df.columns)
    ours = df.select(*[f"`{n}`" for n in names])
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    theirs_kinds = {r[0]: r[1] for r in described}
    problems = []
    if sorted(theirs_kinds) != names:
        return [f"columns {names} != {sorted(theirs_kinds)}"]
    for name, kind in ours.dtypes:
        if _KINDS.get(kind, kind) != theirs_kinds[name]:
            problems.append(f"type of {name}: {kind} != {theirs_kinds[name]}")
    left = _rows(ours.collect())
    listed = ", ".join(f'"{n}"' for n in names)
    right = _rows(con.execute(f"SELECT {listed} FROM ({sql})").fetchall())
    if len(left) != len(right):
        problems.append(f"rows {len(left)} != {len(right)}")
    if not left:
        problems.append("no rows")
    if left != right:
        ours_set, theirs_set = set(left), set(right)
        gone = [r for r in right if r not in ours_set][:3]
        more = [r for r in left if r not in theirs_set][:3]
        problems.append(f"values differ: only here {more}; only there {gone}")
    return problems
