"""Run registered queries and their check SQL side by side: ``python tests/check_queries.py [sf] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
DATA = Path("/root/testdata")


def check_engine(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows sorted, every value as text with its missing values marked."""
    out = pd.DataFrame(index=frame.index)
    for name in sorted(frame.columns):
        column = frame[name]
        if pd.api.types.is_bool_dtype(column) or column.dtype == object:
            out[name] = column.map(lambda v: "~" if pd.isna(v) else str(v))
        elif pd.api.types.is_datetime64_any_dtype(column):
            out[name] = column.map(lambda v: "~" if pd.isna(v) else pd.Timestamp(v).isoformat())
        else:
            out[name] = column.map(lambda v: "~" if pd.isna(v) else repr(float(v)))
    return out.sort_values(list(out.columns)).reset_index(drop=True)


KINDS = {"tinyint": "integer", "smallint": "integer", "int": "integer", "timestamp_ntz": "timestamp", "string": "varchar"}


def differences(spark_df, con, sql: str) -> str | None:
    """What differs between the two results, or None."""
    relation = con.sql(sql)
    theirs_types = dict(zip(relation.columns, (str(t).lower() for t in relation.types)))
    ours_types = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in spark_df.schema.fields}
    if set(ours_types) != set(theirs_types):
        return f"columns {sorted(ours_types)} against {sorted(theirs_types)}"
    kinds = {c: (ours_types[c], theirs_types[c]) for c in ours_types if ours_types[c] != theirs_types[c]}
    if kinds:
        return f"types {kinds}"
    ours, theirs = canonical(spark_df.toPandas()), canonical(relation.df())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    if ours.equals(theirs):
        return None
    rows = (ours != theirs).any(axis=1)
    return f"{rows.sum()} rows differ\n{ours[rows].head(3).to_string()}\n{theirs[rows].head(3).to_string()}"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from ledgerloom.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    wanted = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = str(DATA / sf)
    con = check_engine(sf_dir)
    checks, bad = oracle_sql(), 0
    for name, query in queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.perf_counter()
        try:
            df = query(spark, sf_dir)
            if name in checks:
                found = differences(df, con, checks[name])
            else:
                found = None if df.count() >= 0 else "no rows"
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        seconds = time.perf_counter() - start
        bad += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {seconds:.1f}s{'' if found is None else ' ' + found}", flush=True)
    print(f"{bad} failed")
    return int(bad > 0)


if __name__ == "__main__":
    sys.exit(main())
