"""Run queries beside their SQL and compare rows by value, as a check tool would.

``python tests/compare.py [sf_dir] [query ...]``
"""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, float):
        return f"{value:.9g}"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, con, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return f"rows only: {len(got)}"
    cur = con.execute(sql)
    want_columns, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_columns != want_columns:
        return f"COLUMNS {got_columns} != {want_columns}"
    if got != want:
        extra = list(set(got) - set(want))[:2]
        missing = list(set(want) - set(got))[:2]
        return f"ROWS {len(got)} != {len(want)}\n   spark {extra}\n   sql   {missing}"
    kinds = {d[0]: str(d[1]) for d in cur.description}
    spark_kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    same = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}
    odd = [f"{n}: {k} / {kinds[n]}" for n, k in spark_kinds.items() if same.get(k) != kinds[n]]
    return f"ok {len(got)} rows" + (f"  types differ: {odd}" if odd else "")


if __name__ == "__main__":
    from foliozone.session import build_session

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", "compare", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(sf_dir), entry.oracle_sql()
    for name, fn in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        began = time.time()
        try:
            outcome = compare(spark, con, fn, sql.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001
            outcome = "FAILED " + str(error)[:900]
        print(f"{name:30s} {time.time() - began:6.2f}s  {outcome}", flush=True)
    missing = set(sql) - set(entry.queries())
    print("sql without query:", missing)
