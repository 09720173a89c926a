"""Compare a Spark result with its SQL on DuckDB. Also a script: `python tests/oracle.py DIR [query ...]`."""
from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _value(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v + 0.0)
    return str(v) if not isinstance(v, (int, bool)) else repr(float(v))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_value(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    """Empty when both sides have the same columns and the same multiset of rows."""
    result = con.execute(sql)
    want_cols, want = _rows([c[0] for c in result.description], result.fetchall())
    got_cols, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if want_cols != got_cols:
        return [f"columns {got_cols} instead of {want_cols}"]
    if want == got:
        return []
    extra, missing = got - want, want - got
    return [
        f"{sum(got.values())} rows instead of {sum(want.values())}, {sum(extra.values())} unexpected",
        *[f"unexpected {r}" for r in list(extra)[:3]],
        *[f"missing {r}" for r in list(missing)[:3]],
    ]


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from faremeter.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    session = local_session(8)
    con = connect(sf_dir)
    sqls, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in sqls:
                problems = differences(fn(session, sf_dir), con, sqls[name])
                note = "equal" if not problems else "DIFFERENT\n    " + "\n    ".join(problems)
            else:
                problems, note = [], f"rows only, {fn(session, sf_dir).count()} rows"
        except Exception as e:  # report and go on with the other queries
            problems, note = [str(e)], "ERROR " + str(e)[:1500]
        bad += bool(problems)
        print(f"{name:28s} {time.time() - start:6.1f}s  {note}", flush=True)
    print(f"{bad} bad")
    session.stop()
