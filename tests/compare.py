"""Runs registered queries beside their SQL: `python tests/compare.py [sf] [name...]`."""

from __future__ import annotations

import hashlib
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def canonical(value) -> str:
    if isinstance(value, float):
        return repr(round(value, 9) + 0.0)
    return repr(value)


def fingerprint(columns: list[str], rows) -> tuple[int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(canonical(row[i]) for i in order) for row in rows)
    return len(lines), hashlib.sha256("\n".join(lines).encode("utf-8", "surrogatepass")).hexdigest()


# Spark and DuckDB names of the types in use.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "float": "FLOAT", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, con, folder: str, name: str, query, sql: str) -> tuple[bool, str]:
    df = query(spark, folder)
    rows = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, f"columns {df.columns} against {names}"
    kinds = {d[0]: str(d[1]) for d in result.description}
    odd = [
        (c, t, kinds[c]) for c, t in df.dtypes
        if TYPES.get(t, t.upper()) != kinds[c] and not (t == "string" and kinds[c] == "STRING")
    ]
    ours, theirs = fingerprint(df.columns, rows), fingerprint(names, expected)
    note = f"{ours[0]} rows" + (f", types {odd}" if odd else "")
    if ours == theirs:
        return True, note
    order = [names.index(c) for c in df.columns]
    left = {tuple(map(canonical, r)) for r in rows}
    right = {tuple(canonical(r[i]) for i in order) for r in expected}
    extra, missing = sorted(left - right)[:3], sorted(right - left)[:3]
    return False, f"{note} against {theirs[0]}\n   only Spark {extra}\n   only SQL {missing}"


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracle, failed = entry.oracle_sql(), []
    for name, query in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            if name in oracle:
                ok, note = compare(spark, con, folder, name, query, oracle[name])
            else:
                ok, note = True, f"{query(spark, folder).count()} rows, no SQL"
        except Exception as error:  # noqa: BLE001
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note}"[:2500], flush=True)
        failed += [] if ok else [name]
    print("failed:", failed or "none")


if __name__ == "__main__":
    main()
