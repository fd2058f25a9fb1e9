"""Runs a registered query in Spark and its SQL in DuckDB and compares names, types, row count and values."""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

TYPE_FAMILY = {
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "bigint", "double": "double", "float": "float",
    "string": "varchar", "date": "date", "timestamp": "timestamp", "boolean": "boolean", "integer": "int",
    "varchar": "varchar", "hugeint": "hugeint",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, Decimal):
        return float(v)
    return v


def _key(row):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def compare(spark, con, folder, make, sql):
    df = make(spark, folder)
    spark_types = {f.name: TYPE_FAMILY.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    names = sorted(df.columns)
    rows = sorted(([_norm(r[c]) for c in names] for r in df.collect()), key=_key)
    if sql is None:
        return len(rows), [], spark_types
    cur = con.execute(sql)
    duck_types = {d[0]: TYPE_FAMILY.get(str(d[1]).lower(), str(d[1]).lower()) for d in cur.description}
    problems = []
    if sorted(duck_types) != names:
        return len(rows), [f"columns {names} vs {sorted(duck_types)}"], spark_types
    index = {d[0]: i for i, d in enumerate(cur.description)}
    other = sorted(([_norm(r[index[c]]) for c in names] for r in cur.fetchall()), key=_key)
    for c in names:
        if spark_types[c] != duck_types[c]:
            problems.append(f"type of {c}: {spark_types[c]} vs {duck_types[c]}")
    if len(rows) != len(other):
        problems.append(f"rows {len(rows)} vs {len(other)}")
    bad = [(a, b) for a, b in zip(rows, other) if a != b]
    if bad:
        a, b = bad[0]
        diff = {n: (x, y) for n, x, y in zip(names, a, b) if x != y}
        problems.append(f"{len(bad)} of {len(rows)} rows differ, first {diff} in {dict(zip(names, a))}"[:600])
    return len(rows), problems, spark_types


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from ledgerloom.session import local_session

    folder = f"/root/testdata/{argv[1]}"
    queries, oracle = entry.queries(), entry.oracle_sql()
    wanted = [q for q in queries if not argv[2:] or any(q.startswith(p) for p in argv[2:])]
    spark = local_session(8)
    con = duck(folder)
    failed = 0
    for name in wanted:
        start = time.time()
        try:
            n, problems, _ = compare(spark, con, folder, queries[name], oracle.get(name))
        except Exception as e:  # noqa: BLE001
            n, problems = -1, [f"{type(e).__name__}: {str(e)[:700]}"]
        failed += bool(problems)
        state = "FAIL" if problems else ("ok" if name in oracle else "rows")
        if problems or n == 0 or len(argv) > 2 or time.time() - start > 6:
            print(f"{state:5} {name:38} rows={n:<7} {time.time() - start:5.1f}s")
        for p in problems:
            print("      ", p)
    print(f"{len(wanted)} queries, {failed} failed, {sum(1 for q in wanted if q in oracle)} with SQL")
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
