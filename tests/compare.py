"""Run registered queries against their SQL in DuckDB: ``python -m tests.compare [sf] [names...]``."""

import math
import sys
import time
from pathlib import Path

import duckdb

DATA = Path("/root/testdata")


def duck(folder: Path):
    connection = duckdb.connect()
    for file in sorted(folder.glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return repr(value + 0.0)
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(frame, connection, sql: str):
    """None if both agree, else a short description of the first difference."""
    got_names, got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    relation = connection.execute(sql)
    names = [d[0] for d in relation.description]
    want_names, want = rows_of(names, relation.fetchall())
    if got_names != want_names:
        return f"columns {got_names} vs {want_names}"
    if got == want:
        return None
    left, right = set(got), set(want)
    return f"rows {len(got)} vs {len(want)}; only here {sorted(left - right)[:3]}; only there {sorted(right - left)[:3]}"


def main():
    import __spark_entry__ as contract
    from aftermath.session import open_session

    size = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    chosen = sys.argv[2:]
    spark = open_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = DATA / size
    connection = duck(folder)
    oracles = contract.oracle_sql()
    failed = []
    for name, query in contract.queries().items():
        if chosen and name not in chosen:
            continue
        began = time.time()
        try:
            if name in oracles:
                outcome = compare(query(spark, str(folder)), connection, oracles[name])
            else:
                outcome = None
                print(f"   {name}: {len(query(spark, str(folder)).collect())} rows, no SQL")
        except Exception as error:  # report and go on with the next query
            outcome = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if outcome is None else 'FAIL'} {name} {time.time() - began:.2f}s {outcome or ''}", flush=True)
        if outcome:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main()
