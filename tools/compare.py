"""Compare registered queries with their oracle SQL in DuckDB.

usage: python tools/compare.py [SF_DIR] [QUERY ...]
"""

from __future__ import annotations

import datetime as dt
import math
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from latebook.catalog import ORACLES, QUERIES  # noqa: E402


def session(cpus: int = 8) -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("compare")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "8g")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(pathlib.Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value: object) -> object:
    """A value as comparable text; numbers compare by value, not by type."""
    if value is None:
        return "∅"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return "nan" if isinstance(value, float) and math.isnan(value) else repr(float(value))
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    return str(value)


def rows_of(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if the rows agree, else what does not."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    want = rows_of(names, result.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if got == want:
        return None
    extra = sorted(set(got) - set(want))[:3]
    missing = sorted(set(want) - set(got))[:3]
    return f"{len(got)} rows against {len(want)}; extra {extra}; missing {missing}"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con, failed = session(), database(sf_dir), []
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            problem = (difference(df, con, ORACLES[name]) if name in ORACLES
                       else None if df.collect() else "no rows")
        except Exception as error:  # noqa: BLE001  (report and go on)
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        state = "ok" if problem is None else "FAIL"
        kind = "" if name in ORACLES else " (rows only)"
        print(f"{state:5}{name}{kind} {time.time() - start:.1f}s", flush=True)
        if problem:
            failed.append(name)
            print(f"      {problem[:1500]}", flush=True)
    print(f"{len(names) - len(failed)} of {len(names)} agree; failed: {failed}")
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
