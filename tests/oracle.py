"""Side-by-side run of a query and its SQL form."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{round(v, 6) + 0.0:.6f}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    return str(v)


def _kind(name: str) -> str:
    n = name.lower()
    if "list" in n or "[]" in n or n.startswith("array"):
        return "array"
    for kind, keys in {
        "float": ("double", "float", "decimal"), "int": ("int", "long", "short", "byte"),
        "text": ("string", "varchar"), "time": ("timestamp",), "date": ("date",), "bool": ("bool",),
    }.items():
        if any(k in n for k in keys):
            return kind
    return n


def compare(df, con, sql: str) -> list[str]:
    """What differs between a Spark result and the SQL result; empty if nothing."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    types = {d[0]: _kind(str(d[1])) for d in found.description}
    theirs = found.fetchall()
    ours = df.collect()
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for f in df.schema.fields:
        if _kind(f.dataType.simpleString()) != types[f.name]:
            problems.append(f"type of {f.name}: {f.dataType.simpleString()} != {types[f.name]}")
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} != {len(theirs)}")
    order = sorted(names)
    a = sorted(tuple(_cell(r[c]) for c in order) for r in ours)
    at = [names.index(c) for c in order]
    b = sorted(tuple(_cell(r[i]) for i in at) for r in theirs)
    if a != b:
        left, right = set(a) - set(b), set(b) - set(a)
        problems.append(f"{len(left)}/{len(right)} rows differ: {sorted(left)[:2]} vs {sorted(right)[:2]} ({order})")
    return problems
