"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return "null"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, float):
        return repr(x + 0.0)
    return f"{type(x).__name__}:{x}"


def _table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def spark_table(df):
    return _table(df.columns, [tuple(r) for r in df.collect()])


def sql_table(con, sql):
    cur = con.execute(sql)
    return _table([d[0] for d in cur.description], cur.fetchall())


def difference(got, want):
    """Empty string if equal, else a short account."""
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    only_got = sorted((Counter(got[1]) - Counter(want[1])).elements())
    only_want = sorted((Counter(want[1]) - Counter(got[1])).elements())
    if not only_got:
        return ""
    g, w = only_got[0], only_want[0]
    cells = [(n, x[-80:], y[-80:]) for n, x, y in zip(got[0], g, w) if x != y]
    return f"{len(only_got)} of {len(got[1])} rows differ, e.g. {cells}"
