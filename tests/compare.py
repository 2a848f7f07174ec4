"""Compare registered queries with their check statements in DuckDB."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, decimal.Decimal):
        return repr(float(value))
    if isinstance(value, int):
        return value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con, sql: str) -> str | None:
    rows = df.collect()
    cursor = con.execute(sql)
    want_cols, want = canonical([d[0] for d in cursor.description], cursor.fetchall())
    got_cols, got = canonical(df.columns, [tuple(r) for r in rows])
    if got_cols != want_cols:
        return f"columns: only Spark {set(got_cols) - set(want_cols)}, only SQL {set(want_cols) - set(got_cols)}"
    if got == want:
        return None
    lines = [f"rows {len(got)} vs {len(want)}"]
    if len(got) == len(want):
        for a, b in zip(got, want):
            if a != b:
                lines.append(str([(c, x, y) for c, x, y in zip(got_cols, a, b) if x != y][:6]) + f" in {a[:6]}")
            if len(lines) > 3:
                break
    else:
        extra, lost = sorted(set(got) - set(want), key=repr)[:2], sorted(set(want) - set(got), key=repr)[:2]
        lines += [f"only Spark {dict(zip(got_cols, r))}" for r in extra] + [f"only SQL {dict(zip(got_cols, r))}" for r in lost]
    return "\n    ".join(lines)
