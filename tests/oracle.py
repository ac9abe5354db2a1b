"""Run a query in Spark and its SQL in DuckDB and compare types, rows and values."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# DuckDB type -> Spark type, for the types the queries return.
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "DATE": "date", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


def differences(spark, con, sf_dir: str, fn, sql: str) -> list[str]:
    df = fn(spark, sf_dir)
    names = sorted(df.columns)
    got = _sorted(tuple(r) for r in df.select(*names).collect())
    rel = con.sql(sql)
    want_names = sorted(rel.columns)
    if names != want_names:
        return [f"columns {names} != {want_names}"]
    problems = []
    types = dict(zip(rel.columns, rel.types, strict=True))
    for name, dtype in df.select(*names).dtypes:
        expected = TYPES.get(str(types[name]), str(types[name]))
        if expected != dtype:
            problems.append(f"type of {name}: {dtype} != {expected}")
    order = ", ".join(f'"{n}"' for n in names)
    want = _sorted(con.sql(f"SELECT {order} FROM ({sql}) q").fetchall())
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    bad = [(g, w) for g, w in zip(got, want, strict=False) if g != w]
    if bad:
        problems.append(f"{len(bad)} of {len(want)} rows differ, first: {bad[0][0]} != {bad[0][1]} ({names})")
    return problems


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as entry

    sf = sys.argv[1]
    only = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = connect(sf), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in sqls:
                problems = differences(spark, con, sf, fn, sqls[name])
            else:
                problems = [] if fn(spark, sf).collect() else ["no rows"]
        except Exception as e:  # noqa: BLE001
            problems = [f"{type(e).__name__}: {str(e)[:1500]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s {'' if name in sqls else '(rows)'}", flush=True)
        for p in problems:
            print("     ", p, flush=True)
    print("failed", failed)
