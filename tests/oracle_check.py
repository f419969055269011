"""Run catalog queries in Spark and their SQL twins in DuckDB and compare all rows.

python -m tests.oracle_check [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows_of(columns: list[str], rows) -> list[tuple]:
    """Rows with columns by name, values in one form, in one order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def _value(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, (int, float)):
        return float(v) + 0.0
    return str(v)


def difference(spark_rows: list[tuple], sql_rows: list[tuple]) -> str | None:
    if len(spark_rows) != len(sql_rows):
        return f"{len(spark_rows)} rows against {len(sql_rows)}"
    odd = [(a, b) for a, b in zip(spark_rows, sql_rows) if a != b]
    return f"{len(odd)} rows differ, first {odd[0]}" if odd else None


KINDS = {
    "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double",
    "BOOLEAN": "boolean", "DATE": "date",
}


def type_difference(spark_types: list[tuple[str, str]], sql_types: list[tuple[str, str]]):
    """Columns whose types are not the same in both engines."""
    sql = {n: KINDS.get(str(t), str(t)) for n, t in sql_types}
    return [f"{n} {t}/{sql[n]}" for n, t in spark_types if sql[n] != t]


def check(spark, con, name: str, query, sql: str | None, sf_dir: str) -> tuple[str, str | None, float]:
    start = time.time()
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    seconds = time.time() - start
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "CartesianProduct" in plan or "NestedLoopJoin" in plan:
        return "", "pairs every row with every row", seconds
    if sql is None:
        return f"{len(got)} rows, no SQL", None if got else "no rows", seconds
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(columns) != sorted(df.columns):
        return "", f"columns {sorted(df.columns)} against {sorted(columns)}", seconds
    odd = type_difference(df.dtypes, [(d[0], d[1]) for d in cur.description])
    note = f", types {odd}" if odd else ""
    return f"{len(got)} rows{note}", difference(rows_of(df.columns, got), rows_of(columns, want)), seconds


def main() -> int:
    root = Path(__file__).resolve().parent.parent
    sys.path.insert(0, str(root))
    from __spark_entry__ import oracle_sql, queries
    from flowsift.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), oracle_sql(), 0
    for name in names:
        try:
            what, wrong, seconds = check(spark, con, name, queries()[name], sqls.get(name), sf_dir)
        except Exception as error:  # report and go on with the next query
            what, wrong, seconds = "", f"{type(error).__name__}: {str(error)[:600]}", 0.0
        bad += wrong is not None
        print(f"{'BAD' if wrong else 'ok ':4}{seconds:7.2f}s {name}: {wrong or what}", flush=True)
    print(f"{len(names) - bad} of {len(names)} good; {len(sqls)} with SQL")
    return bad


if __name__ == "__main__":
    sys.exit(main())
