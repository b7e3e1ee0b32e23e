"""Runs registered queries next to their DuckDB SQL and compares the rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def frame(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]
    rows = [tuple(None if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)) else
                  (v.item() if hasattr(v, "item") else v) for v in r) for r in pdf.itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)) if isinstance(x, str) else "", x if x is not None else 0)
                                            for x in r))


def difference(spark_df, con, sql: str) -> str | None:
    """None when both sides agree, else a short description."""
    a = pd.DataFrame([tuple(r) for r in spark_df.collect()], columns=spark_df.columns)
    b = con.sql(sql).df()
    if sorted(a.columns) != sorted(b.columns):
        return f"columns {sorted(a.columns)} / {sorted(b.columns)}"
    if len(a) != len(b):
        return f"rows {len(a)} / {len(b)}"
    bad = [(x, y) for x, y in zip(frame(a), frame(b)) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, e.g. {bad[0]}" if bad else None


def main(names: list[str], sf_dir: str = "/root/testdata/sf0.01") -> None:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from wideloom.session import local_session

    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    ok = 0
    for n in names or list(queries):
        start = time.time()
        try:
            df = queries[n](spark, sf_dir)
            if n in oracles:
                why = difference(df, con, oracles[n])
            else:
                why = f"rows only: {df.count()}"
        except Exception as e:  # noqa: BLE001
            why = f"ERROR {type(e).__name__}: {str(e)[:600]}"
        ok += why is None or why.startswith("rows only")
        print(f"{'ok  ' if why is None else '    '}{n} {time.time() - start:.1f}s {why or ''}", flush=True)
    print(f"{ok} fine")


if __name__ == "__main__":
    args = sys.argv[1:]
    folder = next((a for a in args if a.startswith("/")), "/root/testdata/sf0.01")
    main([a for a in args if not a.startswith("/")], folder)
