"""Run registered queries on Spark and their SQL on DuckDB and compare every value.

    python tests/oracle_check.py [folder] [name ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def canonical(table) -> tuple[dict, list]:
    names = sorted(table.column_names)
    kinds = {n: str(table.schema.field(n).type).replace("large_", "").replace("string_view", "string") for n in names}
    rows = list(zip(*[table.column(n).to_pylist() for n in names])) if names else []
    return kinds, sorted(rows, key=repr)


def differences(spark_table, duck_table) -> list[str]:
    kinds, rows = canonical(spark_table)
    other_kinds, other_rows = canonical(duck_table)
    if list(kinds) != list(other_kinds):
        return [f"columns {sorted(set(kinds) ^ set(other_kinds))}"]
    found = [f"type of {n}: {kinds[n]} / {other_kinds[n]}" for n in kinds if kinds[n] != other_kinds[n]]
    if len(rows) != len(other_rows):
        found.append(f"rows {len(rows)} / {len(other_rows)}")
    unequal = [(a, b) for a, b in zip(rows, other_rows) if a != b]
    if unequal:
        a, b = unequal[0]
        cells = [(n, x, y) for n, x, y in zip(kinds, a, b) if x != y][:6]
        found.append(f"{len(unequal)} rows differ, first in {cells}")
    return found


def check(spark, con, folder: str, names: list[str]) -> dict[str, list[str]]:
    import __spark_entry__ as entry

    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = {}
    for name in names or queries:
        start = time.time()
        try:
            result = queries[name](spark, folder).toArrow()
            took = time.time() - start
            found = differences(result, con.sql(oracles[name]).to_arrow_table()) if name in oracles else []
            note = "" if name in oracles else f" rows only: {result.num_rows}"
        except Exception as error:  # report and go on to the next query
            took, note, found = time.time() - start, "", [f"{type(error).__name__}: {str(error)[:600]}"]
        print(f"{'FAIL' if found else 'ok  '} {name} {took:.1f}s total {time.time() - start:.1f}s{note}", flush=True)
        for line in found:
            print("     ", line, flush=True)
        if found:
            failed[name] = found
    return failed


if __name__ == "__main__":
    from tests.session import test_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    failed = check(test_session(), connect(folder), folder, sys.argv[2:])
    print(f"{len(failed)} failed: {sorted(failed)}")
