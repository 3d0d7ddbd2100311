"""Run every registered query in Spark and in DuckDB and compare the results.

``python tests/compare.py [sf_dir] [name ...]``
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows by value, every cell as exact text."""
    df = df[sorted(df.columns)]
    text = df.astype(object).where(df.notna(), None)
    for c in text.columns:
        text[c] = [None if v is None else _text(v) for v in text[c]]
    return text.sort_values(list(text.columns), na_position="first").reset_index(drop=True)


def _text(v: object) -> str:
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or hasattr(v, "dtype") and v.dtype.kind in "iuf":
        return repr(float(v))
    return str(v)[:10] if hasattr(v, "year") else str(v)


def kinds(df: pd.DataFrame) -> dict[str, str]:
    return {c: str(t) for c, t in sorted(df.dtypes.items())}


def difference(spark_df: pd.DataFrame, duck_df: pd.DataFrame) -> str | None:
    if sorted(spark_df.columns) != sorted(duck_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(duck_df.columns)}"
    if len(spark_df) != len(duck_df):
        return f"rows {len(spark_df)} != {len(duck_df)}"
    a, b = canonical(spark_df), canonical(duck_df)
    if not a.equals(b):
        rows = (a != b) & ~(a.isna() & b.isna())
        first = rows.any(axis=1).idxmax()
        return f"{int(rows.any(axis=1).sum())} rows differ, first:\n{a.loc[first]}\n{b.loc[first]}"
    if kinds(spark_df) != kinds(duck_df):
        pairs = zip(kinds(spark_df).items(), kinds(duck_df).items(), strict=True)
        return f"TYPES ONLY {[(x, y[1]) for x, y in pairs if x != y]}"
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from aeropunct.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("compare", "local[8]", 8, {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    con, sql = duck(sf_dir), oracle_sql()
    bad = 0
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.perf_counter()
        try:
            got = run(spark, sf_dir).toPandas()
            spark_sec = time.perf_counter() - start
            problem = None
            if name in sql:
                problem = difference(got, con.sql(sql[name]).df())
        except Exception as error:  # noqa: BLE001
            spark_sec, got, problem = time.perf_counter() - start, [], str(error)[:1500]
        total = time.perf_counter() - start
        mark = "rows only" if name not in sql else "ok" if problem is None else "DIFFERS"
        bad += problem is not None
        print(f"{name:32s} {mark:10s} {len(got):7d} rows  spark {spark_sec:5.2f}  all {total:5.2f}")
        if problem:
            print(problem, flush=True)
    print(f"{bad} with differences")


if __name__ == "__main__":
    main()
