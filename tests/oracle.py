"""Run registered queries against their SQL on the same parquet files.

    python tests/oracle.py [--sf 0.001] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return v


def _bag(rows, names) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences between a Spark result and a SQL result, as messages."""
    expected = con.execute(sql)
    names = [c[0] for c in expected.description]
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} against {sorted(names)}"]
    want = _bag(expected.fetchall(), names)
    got = _bag(spark_df.collect(), spark_df.columns)
    if got == want:
        return []
    extra, lacking = got - want, want - got
    return [
        f"{sum(got.values())} rows against {sum(want.values())}",
        f"only Spark ({sum(extra.values())}): {list(extra)[:3]}",
        f"only SQL ({sum(lacking.values())}): {list(lacking)[:3]}",
    ]


def main() -> int:
    import __spark_entry__ as contract
    from conftest import session

    args = sys.argv[1:]
    sf = args[args.index("--sf") + 1] if "--sf" in args else "0.001"
    names = [a for a in args if not a.startswith("--") and a != sf]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = session(), connect(sf_dir)
    queries, oracles = contract.queries(), contract.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracles:
                problems = compare(df, con, oracles[name])
            else:
                problems = [] if df.count() else ["no rows"]
        except Exception as e:  # report and go on with the next query
            problems = [f"{type(e).__name__}: {str(e)[:1500]}"]
        bad += bool(problems)
        kind = "sql" if name in oracles else "rows"
        print(f"{'FAIL' if problems else 'ok  '} {name} [{kind}] {time.time() - start:.1f}s", flush=True)
        for p in problems:
            print("     ", p[:1500])
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main())
