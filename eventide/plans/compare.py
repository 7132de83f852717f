"""Order-insensitive comparison of a Spark result with its DuckDB twin.

Used by the tests (and handy interactively): both sides are brought to
pandas, columns sorted by name, values normalised (decimals and floats to
rounded floats, timestamps to naive), rows sorted, then compared.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math

from .sql_inputs import with_  # noqa: F401  (re-export convenience)

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (decimal.Decimal, float)):
        return round(float(v), 6)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, bytes | bytearray):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def spark_rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return cols, sorted(rows, key=lambda r: tuple(str(x) for x in r))


def duck_rows(con, sql):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    data = rel.fetchall()
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    rows = [tuple(_norm(r[i]) for i in idx) for r in data]
    return cols, sorted(rows, key=lambda r: tuple(str(x) for x in r))


def compare(df, con, sql):
    """Return (ok, message)."""
    sc, sr = spark_rows(df)
    dc, dr = duck_rows(con, sql)
    if sc != dc:
        return False, f"columns differ: spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return False, f"row count differs: spark={len(sr)} duck={len(dr)}"
    for a, b in zip(sr, dr):
        if a != b:
            return False, f"first differing row:\n spark={a}\n duck ={b}"
    return True, f"{len(sr)} rows equal"


_SPARK_TO_DUCK = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "date": "DATE", "float": "FLOAT",
    "smallint": "SMALLINT", "tinyint": "TINYINT", "binary": "BLOB",
}


def type_diffs(df, con, sql) -> dict:
    """Columns whose Spark type differs from the DuckDB twin's type."""
    def st(t):
        return t.upper().replace(" ", "") if t.startswith("decimal") else _SPARK_TO_DUCK.get(t, t)

    s = {c: st(t) for c, t in df.dtypes}
    rel = con.sql(sql)
    d = {c: str(t).replace(" ", "") if str(t).startswith("DECIMAL") else str(t) for c, t in zip(rel.columns, rel.types)}
    return {c: (s.get(c), d.get(c)) for c in set(s) | set(d) if s.get(c) != d.get(c)}
