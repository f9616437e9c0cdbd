"""Run a query on Spark and its SQL on DuckDB over the same tables and compare."""

from __future__ import annotations

import datetime as dt
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def duck(d: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return 0.0 if v == 0 else v
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        return v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in r))


def compare(spark, con, d: str, fn, sql: str) -> tuple[bool, str]:
    df = fn(spark, d)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    desc = [(x[0], str(x[1])) for x in cur.description]
    want = _rows([n for n, _ in desc], cur.fetchall())
    if sorted(df.columns) != sorted(n for n, _ in desc):
        return False, f"columns {sorted(df.columns)} vs {sorted(n for n, _ in desc)}"
    kinds = dict(con.execute(f"SELECT column_name, column_type FROM (DESCRIBE {sql})").fetchall())
    odd = {n: (t, kinds[n]) for n, t in df.dtypes if TYPES.get(t, t) != kinds[n]}
    if len(got) != len(want):
        return False, f"rows {len(got)} vs {len(want)} types {odd}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return False, f"{len(bad)} of {len(got)} rows differ, columns {sorted(df.columns)}: {str(bad[0][0])[:400]} VS {str(bad[0][1])[:400]} types {odd}"
    return not odd, f"{len(got)} rows, types {odd}"


def main(argv: list[str]) -> int:
    import __spark_entry__ as E
    from lectern import session

    d = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = argv[2:]
    spark = session.build("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = duck(d), 0
    for name, fn in E.queries().items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            sql = E.oracle_sql().get(name)
            ok, note = compare(spark, con, d, fn, sql) if sql else (True, f"{fn(spark, d).count()} rows, no SQL")
        except Exception as e:  # report and go on
            ok, note = False, f"{type(e).__name__}: {str(e)[:900]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - t0:.1f}s {note}", flush=True)
    print(f"failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
