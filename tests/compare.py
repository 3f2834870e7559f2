"""Run a registered query and its SQL and compare columns, types and values."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{folder}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return repr(float(v))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return repr([norm(x) for x in v])
    if isinstance(v, dict):
        return repr(sorted((k, norm(x)) for k, x in v.items()))
    return repr(v)


def family(type_name: str) -> str:
    t = type_name.lower()
    for names, out in (
        (("bigint", "int", "long", "hugeint", "smallint"), "int"),
        (("double", "float", "decimal"), "float"),
        (("varchar", "string"), "text"),
        (("timestamp",), "time"),
        (("bool",), "bool"),
    ):
        if any(t.startswith(n) for n in names):
            return out
    return t


def differences(df, con, sql: str) -> list[str]:
    rel = con.sql(sql)
    columns = sorted(df.columns)
    if columns != sorted(rel.columns):
        return [f"columns {columns} != {sorted(rel.columns)}"]
    types = dict(zip(rel.columns, map(str, rel.types)))
    bad = [
        f"type of {f.name}: {f.dataType.simpleString()} != {types[f.name]}"
        for f in df.schema
        if family(f.dataType.simpleString()) != family(types[f.name]) and not f.dataType.simpleString().startswith(("array", "map"))
    ]
    mine = Counter(tuple(norm(row[c]) for c in columns) for row in df.select(*[f"`{c}`" for c in columns]).collect())
    place = [rel.columns.index(c) for c in columns]
    theirs = Counter(tuple(norm(row[i]) for i in place) for row in rel.fetchall())
    if mine != theirs:
        a, b = list((mine - theirs).items())[:3], list((theirs - mine).items())[:3]
        bad.append(f"rows {sum(mine.values())} vs {sum(theirs.values())}, differing {sum((mine - theirs).values())}")
        bad += [f"  spark {x}" for x in a] + [f"  sql   {x}" for x in b]
    elif not mine:
        bad.append("no rows")
    return bad
