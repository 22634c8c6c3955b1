"""Compare registered queries with their SQL: names, row counts, and values regardless of order.

Run as ``python tests/compare.py <folder of tables> [query …]``.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _rows(table) -> tuple[list[str], list[tuple]]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, sorted(zip(*columns), key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(frame, sql: str, con) -> str | None:
    """What differs, or None."""
    ours = frame.toArrow()
    theirs = con.execute(sql).to_arrow_table()
    names, mine = _rows(ours)
    other_names, other = _rows(theirs)
    if names != other_names:
        return f"columns {names} != {other_names}"
    types = [(n, str(ours.schema.field(n).type).replace("large_", ""), str(theirs.schema.field(n).type).replace("large_", ""))
             for n in names]
    wrong = [t for t in types if t[1] != t[2]]
    if wrong:
        return f"types {wrong}"
    if len(mine) != len(other):
        return f"rows {len(mine)} != {len(other)}"
    for a, b in zip(mine, other):
        if a != b and not all(_close(x, y) for x, y in zip(a, b)):
            return f"values {a} != {b}"
    return None


def _close(x, y) -> bool:
    if isinstance(x, float) and isinstance(y, float):
        return abs(x - y) <= 1e-12 * max(1.0, abs(x))
    return x == y


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir, chosen = sys.argv[1], sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.driver.memory", "12g")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    con = connection(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert not set(oracles) - set(queries)
    bad = 0
    for name in chosen or queries:
        began = time.time()
        try:
            frame = queries[name](spark, sf_dir)
            result = differences(frame, oracles[name], con) if name in oracles else f"no SQL, {frame.count()} rows"
        except Exception as error:  # reported, and the rest still runs
            result = f"{type(error).__name__}: {str(error)[:600]}"
        bad += result is not None
        print(f"{name:22s} {time.time() - began:6.1f}s  {result or 'equal'}", flush=True)
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
