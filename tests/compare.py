"""Order-free comparison of a Spark result with rows from elsewhere."""

from datetime import datetime
from decimal import Decimal


def plain(value):
    if value is None:
        return "~"
    if isinstance(value, (bool, int, float, Decimal)):
        return f"{float(value):.6f}"
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def rows_of(df):
    names = sorted(df.columns)
    return names, sorted(tuple(plain(r[n]) for n in names) for r in df.collect())


def rows_of_duck(connection, sql):
    cursor = connection.execute(sql)
    found = [d[0] for d in cursor.description]
    names = sorted(found)
    at = [found.index(n) for n in names]
    return names, sorted(tuple(plain(r[i]) for i in at) for r in cursor.fetchall())


def values(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=repr)
