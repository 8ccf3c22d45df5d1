"""Order-insensitive comparison of a Spark result with an oracle result."""

from __future__ import annotations

import decimal
import math
import os

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "nan"
    if isinstance(v, int):
        return str(v)
    return str(v)



def duck_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def compare(cols, rows, ocols, orows) -> list[str]:
    """Problems found (empty when equal): columns, row count, values."""
    msgs = []
    if sorted(cols) != sorted(ocols):
        msgs.append(f"columns differ: spark-only {sorted(set(cols) - set(ocols))} "
                    f"oracle-only {sorted(set(ocols) - set(cols))}")
    if len(rows) != len(orows):
        msgs.append(f"rows {len(rows)} vs {len(orows)}")
    if msgs:
        return msgs
    order = sorted(cols)
    si = [cols.index(c) for c in order]
    oi = [ocols.index(c) for c in order]
    a = sorted(tuple(norm(r[i]) for i in si) for r in rows)
    b = sorted(tuple(norm(r[i]) for i in oi) for r in orows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        diffcols = set()
        for x, y in diff[:50]:
            diffcols |= {order[i] for i in range(len(order)) if x[i] != y[i]}
        msgs.append(f"values differ in {sorted(diffcols)}: {diff[:1]}")
    return msgs
