"""Runs queries in Spark and their SQL in DuckDB and compares schema, rows and values.

Usage: python tests/compare.py SF_DIR [query ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "embeddings", "pages")


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def difference(spark_df, con, sql: str) -> str | None:
    """None if equal, else what differs first."""
    names = sorted(spark_df.columns)
    ours = spark_df.select(*names).collect()
    cursor = con.execute(f"SELECT {', '.join(names)} FROM ({sql})")
    theirs = cursor.fetchall()
    kinds = dict(spark_df.dtypes)
    duck_kinds = {d[0]: str(d[1]) for d in cursor.description}
    same = {
        "bigint": "BIGINT",
        "int": "INTEGER",
        "double": "DOUBLE",
        "string": "VARCHAR",
        "date": "DATE",
        "boolean": "BOOLEAN",
    }
    wrong = {n: (kinds[n], duck_kinds[n]) for n in names if same.get(kinds[n]) != duck_kinds[n]}
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}; types {wrong}"
    key = lambda row: tuple((v is None, str(v)) for v in row)
    for a, b in zip(sorted(map(tuple, ours), key=key), sorted(theirs, key=key)):
        if tuple(map(str, a)) != tuple(map(str, b)):
            at = [(n, x, y) for n, x, y in zip(names, a, b) if str(x) != str(y)]
            return f"row differs at {at[:4]}; types {wrong}"
    return f"types {wrong}" if wrong else None


def main(sf_dir: str, wanted: list[str]) -> int:
    import __spark_entry__ as entry
    from conftest import make_session

    spark, con, bad = make_session(), duck(sf_dir), 0
    oracles = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        df = fn(spark, sf_dir)
        if name not in oracles:
            print(f"rows {name}: {len(df.collect())} in {time.time() - start:.1f}s", flush=True)
            continue
        try:
            diff = difference(df, con, oracles[name])
        except Exception as e:  # report and go on with the next query
            diff = f"{type(e).__name__}: {str(e)[:600]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'DIFF'} {name}: {time.time() - start:.1f}s {diff or ''}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
