"""Compare every registered query with its SQL twin: ``python tests/compare.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def expected(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[str], list[tuple]]:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = [str(d[1]) for d in cur.description]
    return names, kinds, cur.fetchall()


def _sortable(row: tuple) -> tuple:
    return tuple((v is None, "" if v is None else repr(v) if not isinstance(v, float) else f"{v:.9e}") for v in row)


def differences(names_a: list[str], rows_a: list[tuple], names_b: list[str], rows_b: list[tuple]) -> str | None:
    """None if both tables hold the same rows, else a short description."""
    if sorted(names_a) != sorted(names_b):
        return f"columns {sorted(names_a)} != {sorted(names_b)}"
    if len(rows_a) != len(rows_b):
        return f"{len(rows_a)} rows != {len(rows_b)} rows"
    order = sorted(names_a)
    pick_a, pick_b = [names_a.index(n) for n in order], [names_b.index(n) for n in order]
    a = sorted((tuple(r[i] for i in pick_a) for r in rows_a), key=_sortable)
    b = sorted((tuple(r[i] for i in pick_b) for r in rows_b), key=_sortable)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if not bad:
        return None
    near = all(
        all(p == q or (isinstance(p, float) and isinstance(q, float) and math.isclose(p, q, rel_tol=1e-9, abs_tol=1e-9))
            for p, q in zip(x, y))
        for x, y in bad
    )
    return f"{len(bad)} rows differ{' (only by rounding)' if near else ''}: {order} {bad[0]}"


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def type_differences(df, names: list[str], kinds: list[str]) -> list[str]:
    theirs = dict(zip(names, kinds))
    return [
        f"{n}: {t} / {theirs.get(n)}" for n, t in df.dtypes if KINDS.get(t, t) != theirs.get(n)
    ]


def main() -> int:
    import __spark_entry__ as entry
    from tests.session import make_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark, con, failed = make_session(), oracle(folder), 0
    sqls = entry.oracle_sql()
    for name, run in entry.queries().items():
        if chosen and not any(c in name for c in chosen):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            rows = [tuple(r) for r in df.collect()]
            took = time.time() - start
            if name in sqls:
                names, kinds, wanted = expected(con, sqls[name])
                problem = differences(df.columns, rows, names, wanted)
                kinds_differ = type_differences(df, names, kinds)
                verdict = problem or (f"types {kinds_differ}" if kinds_differ else "ok")
            else:
                verdict = "rows only" if rows else "NO ROWS"
        except Exception as error:  # noqa: BLE001
            verdict, rows, took = f"ERROR {str(error)[:600]}", [], time.time() - start
        failed += verdict not in ("ok", "rows only")
        print(f"{name:28s} {len(rows):7d} rows {took:6.1f}s  {verdict}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
