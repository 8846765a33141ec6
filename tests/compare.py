"""Run queries next to their SQL in DuckDB: ``python tests/compare.py [sf_dir] [name part | -name part ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from cohortica.checks.fixtures import TABLES  # noqa: E402


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(float(value) + 0.0)
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """None if both give the same rows, else what differs."""
    ours = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    odd = [d[0] for d in cursor.description if "HUGEINT" in str(d[1]) or "DECIMAL" in str(d[1])]
    if odd:
        return f"type of {odd} in SQL"
    types = dict(df.dtypes)
    for d in cursor.description:
        if ("double" in types[d[0]]) != (str(d[1]) in ("DOUBLE", "FLOAT")):
            return f"type of {d[0]}: {types[d[0]]} / {d[1]}"
    a, b = canonical(df.columns, ours), canonical(names, theirs)
    if a != b:
        only = [x for x in a if x not in set(b)][:3], [x for x in b if x not in set(a)][:3]
        return f"rows {len(a)} / {len(b)}; {sorted(names)}; {only[0]} / {only[1]}"
    if not a:
        return "no rows"
    return None


def main(argv):
    from cohortica.checks.all import ORACLES, QUERIES
    from cohortica.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session("8")
    con = connect(sf_dir)
    bad = 0
    for name, run in QUERIES.items():
        if any(p[1:] in name for p in argv[1:] if p.startswith("-")):
            continue
        wanted = [p for p in argv[1:] if not p.startswith("-")]
        if wanted and not any(p in name for p in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in ORACLES:
                problem = compare(df, con, ORACLES[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{name} {time.time() - start:.2f}s {problem or 'ok'}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
