"""Compare registered queries with their SQL: python tools/check_oracle.py [dir] [name ...]"""

import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from casewatch.plans import oracle, registry  # noqa: E402
from casewatch.session import local_session  # noqa: E402


def rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(map(repr, (r[i] for i in order))) for r in records)


def compare(spark, connection, name, sql, folder):
    """(spark columns and rows) against (SQL columns and rows); '' when equal."""
    df = registry.QUERIES[name](spark, folder)
    mine = [tuple(r) for r in df.collect()]
    if sql is None:
        return f"rows only: {len(mine)}"
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    theirs = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"COLUMNS {sorted(df.columns)} != {sorted(names)}"
    a, z = rows(df.columns, mine), rows(names, theirs)
    if a == z:
        return ""
    left, right = set(a), set(z)
    return (
        f"ROWS {len(a)} != {len(z)}; only here {len(left - right)} {sorted(left - right)[:3]}; "
        f"only there {len(right - left)} {sorted(right - left)[:3]}"
    )


def connect(folder):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        table = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    statements = oracle.statements()
    unknown = set(statements) - set(registry.QUERIES)
    if unknown:
        print("SQL without a query:", sorted(unknown))
    spark, connection = local_session(8), connect(folder)
    bad = 0
    for name in sys.argv[2:] or registry.QUERIES:
        start = time.time()
        try:
            verdict = compare(spark, connection, name, statements.get(name), folder)
        except Exception as error:  # noqa: BLE001
            verdict = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        bad += bool(verdict) and not verdict.startswith("rows only")
        print(f"{time.time() - start:6.1f}s {name}: {verdict or 'ok'}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main()
