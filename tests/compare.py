"""Exact comparison of a Spark result with the SQL result on the same tables."""

from __future__ import annotations

import math
from collections import Counter
from datetime import datetime, timezone

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime) and value.tzinfo is not None:
        return value.astimezone(timezone.utc).replace(tzinfo=None)
    return value


def _kind(value) -> str:
    return type(value).__name__


def rows(columns, values) -> Counter:
    """Rows with columns in name order, as a multiset of (type, value) tuples."""
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((_kind(r[i]), _plain(r[i])) for i in at) for r in values)


SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp": "TIMESTAMP",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def differences(df, connection, sql: str) -> list[str]:
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    want_types = sorted((d[0], str(d[1])) for d in result.description)
    got_types = sorted((n, SQL_TYPES[t]) for n, t in df.dtypes)
    if want_types != got_types:
        return [f"columns: {sorted(set(got_types) - set(want_types))} against {sorted(set(want_types) - set(got_types))}"]
    want = rows(names, result.fetchall())
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    missing, extra = want - got, got - want
    out = [f"rows: {sum(got.values())} against {sum(want.values())}"] if sum(got.values()) != sum(want.values()) else []
    if missing or extra:
        out.append(f"{sum(missing.values())} missing, e.g. {list(missing)[:1]}")
        out.append(f"{sum(extra.values())} extra, e.g. {list(extra)[:1]}")
    return out
