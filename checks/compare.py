"""Run registered queries next to their SQL: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from checks.fixtures import TABLES
from checks.oracle import ORACLE
from checks.queries import QUERIES
from rostrum.session import session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(None if r[i] is None else str(r[i]) for i in order) for r in rows)


_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "date": "DATE", "boolean": "BOOLEAN",
          "double": "DOUBLE"}


def difference(spark: SparkSession, con, sf_dir: str, name: str) -> str:
    """Empty when both engines agree on columns, types and rows."""
    df = QUERIES[name](spark, sf_dir)
    relation = con.sql(ORACLE[name])
    ours = {c: _TYPES.get(t, t) for c, t in df.dtypes}
    theirs = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    if ours != theirs:
        return f"schema {ours} != {theirs}"
    a, b = _rows(df.columns, df.collect()), _rows(relation.columns, relation.fetchall())
    if a == b:
        return "" if a else "no rows"
    return (f"{sum(a.values())} rows against {sum(b.values())}; only here: {list((a - b).items())[:3]}; "
            f"only there: {list((b - a).items())[:3]}")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    spark = session("compare", "local[8]", spark_ui_enabled="false", spark_sql_shuffle_partitions="8",
                    spark_driver_memory="8g", spark_ui_showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in wanted:
        start = time.time()
        try:
            problem = difference(spark, con, sf_dir, name)
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {problem}", flush=True)
    missing = set(QUERIES) ^ set(ORACLE)
    print(f"{len(wanted) - failed} of {len(wanted)} agree; without a partner: {sorted(missing)}")


if __name__ == "__main__":
    main()
