"""Run registered queries against their SQL twins: ``python tests/compare.py SF [names]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def canonical(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf[sorted(pdf.columns)].copy()
    for c in pdf.columns:
        if pdf[c].dtype == object:
            pdf[c] = pdf[c].map(lambda v: None if v is None or v is pd.NaT or v != v else str(v)[:10]
                                if hasattr(v, "year") else v)
        elif str(pdf[c].dtype).startswith("datetime"):
            pdf[c] = pdf[c].dt.strftime("%Y-%m-%d %H:%M:%S.%f")
    return pdf.sort_values(list(pdf.columns), ignore_index=True)


def mismatch(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when schema, row count and all values agree, else what differs."""
    rel = con.execute(sql)
    theirs_types = {d[0]: str(d[1]) for d in rel.description}
    theirs = rel.fetch_df()
    ours_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
                  for f in df.schema}
    if ours_types != theirs_types:
        return f"schema: {sorted(ours_types.items())} != {sorted(theirs_types.items())}"
    ours = df.toPandas()
    if len(ours) != len(theirs):
        return f"rows: {len(ours)} != {len(theirs)}"
    for c, t in ours_types.items():
        if t == "DATE":
            for side in (ours, theirs):
                side[c] = pd.to_datetime(side[c])
        elif t in ("BIGINT", "INTEGER"):
            for side in (ours, theirs):
                side[c] = side[c].astype("float64")
    a, b = canonical(ours), canonical(theirs)
    for c in a.columns:
        x, y = a[c], b[c]
        bad = ~((x == y) | (x.isna() & y.isna()))
        if x.dtype == "float64":  # a hash of the value also sees the sign of zero
            bad |= (x == 0) & (y == 0) & (np.signbit(x) != np.signbit(y))
        if bad.any():
            return (f"{int(bad.sum())} of {len(a)} values of {c}; first:\n"
                    f"{a[bad].head(2).to_dict('records')}\n{b[bad].head(2).to_dict('records')}")
    return None


def main() -> None:
    from conftest import make_session
    import __spark_entry__ as e

    sf = f"/root/testdata/sf{sys.argv[1]}"
    spark, con = make_session(), connect(sf)
    queries, oracles = e.queries(), e.oracle_sql()
    names = sys.argv[2:] or list(queries)
    bad = 0
    for n in names:
        t = time.time()
        try:
            if n in oracles:
                problem = mismatch(queries[n](spark, sf), con, oracles[n])
            else:
                problem = f"rows only: {queries[n](spark, sf).count()}"
        except Exception as exc:  # keep going: this is a report
            problem = f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += problem is not None and not problem.startswith("rows only")
        print(f"{n:28s} {time.time() - t:6.1f}s  {problem or 'ok'}", flush=True)
    print(f"{len(names)} queries, {bad} bad")


if __name__ == "__main__":
    main()
