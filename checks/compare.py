"""Run the registered queries and their SQL side by side: python -m checks.compare DIRECTORY [names]."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

from checks.oracles import oracle_sql
from checks.queries import registry
from estrella.session import build_session

TABLES = "region nation customer supplier part orders lineitem events".split()


def _norm(value):
    if value is None:
        return None
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return repr(value)
    return str(value)


def rows(columns, data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(row[i]) for i in order) for row in data)


def main(directory: str, names: list[str]) -> int:
    spark = build_session("compare", "local[8]", **{"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{directory}/{table}.parquet'")
    sql = oracle_sql()
    queries = registry()
    missing = sorted(set(queries) - set(sql)), sorted(set(sql) - set(queries))
    print("without SQL:", missing[0], "without query:", missing[1])
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, directory)
            got = [tuple(r) for r in df.collect()]
            took = time.time() - start
            if name not in sql:
                print(f"----  {name}: {len(got)} rows {took:.2f}s")
                continue
            cursor = con.execute(sql[name])
            columns = [d[0] for d in cursor.description]
            want = cursor.fetchall()
            sql_types = {d[0]: str(d[1]) for d in cursor.description}
            if sorted(columns) != sorted(df.columns):
                raise AssertionError(f"columns {sorted(df.columns)} != {sorted(columns)}")
            left, right = rows(df.columns, got), rows(columns, want)
            if left != right:
                only_left, only_right = left - right, right - left
                raise AssertionError(
                    f"{len(got)} vs {len(want)} rows; {sorted(columns)}\n  spark {list(only_left.items())[:3]}\n  sql   {list(only_right.items())[:3]}"
                )
            kinds = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}
            odd = {f: (t, sql_types[f]) for f, t in df.dtypes if kinds.get(t) != sql_types[f]}
            print(f"ok    {name}: {len(got)} rows {took:.2f}s", f"types {odd}" if odd else "", flush=True)
        except Exception as error:
            bad += 1
            print(f"FAIL  {name}: {type(error).__name__} {str(error)[:900]}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
