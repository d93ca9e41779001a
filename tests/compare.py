"""Side-by-side check of the registered queries against DuckDB.

Run as a script: ``python tests/compare.py [folder] [query ...]``.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(table: pa.Table) -> tuple[list[tuple[str, str]], list[str]]:
    """Column names with types, and rows as sorted text."""
    names = sorted(table.column_names)
    types = [(n, str(table.schema.field(n).type).replace("large_", "")) for n in names]
    columns = [table.column(n).to_pylist() for n in names]
    return types, sorted(repr(row) for row in zip(*columns))


def differences(spark_table: pa.Table, duck_table: pa.Table) -> list[str]:
    st, sr = canonical(spark_table)
    dt, dr = canonical(duck_table)
    out = []
    if [n for n, _ in st] != [n for n, _ in dt]:
        out.append(f"columns {sorted(set(st) ^ set(dt))}")
    elif st != dt:
        out.append(f"types {[(a, b) for a, b in zip(st, dt) if a != b]}")
    if len(sr) != len(dr):
        out.append(f"rows {len(sr)} vs {len(dr)}")
    only_s, only_d = sorted(set(sr) - set(dr)), sorted(set(dr) - set(sr))
    if only_s or only_d:
        out.append(f"values: {len(only_s)} only in spark, {len(only_d)} only in duckdb\n    {only_s[:2]}\n    {only_d[:2]}")
    elif sr != dr:
        out.append("repeats differ")
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as contract
    from bench import session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    queries, oracles = contract.queries(), contract.oracle_sql()
    spark, con, bad = session("compare"), duck(sf_dir), 0
    spark.sparkContext.setLogLevel("OFF")
    for name in argv[1:] or queries:
        start = time.time()
        try:
            result = queries[name](spark, sf_dir).toArrow()
            took = time.time() - start
            if name not in oracles:
                print(f"rows {name:28s} {result.num_rows:7d} {took:6.2f}s", flush=True)
                continue
            begun = time.time()
            found = differences(result, con.sql(oracles[name]).to_arrow_table())
            print(f"{'FAIL' if found else 'ok  '} {name:28s} {result.num_rows:7d} {took:6.2f}s duck {time.time() - begun:5.2f}s", flush=True)
            for line in found:
                print("   ", line[:1500])
            bad += bool(found)
        except Exception as error:  # report every query, then fail
            bad += 1
            print(f"ERR  {name}: {str(error)[:900]}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
