"""Run registered queries beside their SQL twins: ``python -m verification.compare <sf_dir> [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from postings.session import session
from verification.oracle import ORACLE
from verification.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(frame: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples over columns in name order, every kind of missing value alike."""
    def cell(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
            return ""
        if isinstance(v, float):
            return repr(v)
        if hasattr(v, "isoformat"):
            return pd.Timestamp(v).isoformat()
        return str(v)

    frame = frame[sorted(frame.columns)]
    columns = [frame[c].astype(object).tolist() for c in frame.columns]
    return sorted(tuple(cell(v) for v in row) for row in zip(*columns))


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> str | None:
    """What differs between the query and its twin, or None."""
    mine = QUERIES[name](spark, sf_dir)
    got = mine.toArrow()
    want = con.sql(ORACLE[name]).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {sorted(got.column_names)} != {sorted(want.column_names)}"
    for c in got.column_names:
        a, b = str(got.schema.field(c).type), str(want.schema.field(c).type)
        if a != b:
            return f"type of {c}: {a} != {b}"
    a = normal(pd.DataFrame({c: got[c].to_pylist() for c in got.column_names}, dtype=object))
    b = normal(pd.DataFrame({c: want[c].to_pylist() for c in want.column_names}, dtype=object))
    if a != b:
        extra, missing = [r for r in a if r not in set(b)], [r for r in b if r not in set(a)]
        return f"rows {len(a)} != {len(b)}; only here {extra[:2]}; only there {missing[:2]}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    spark = session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names or list(QUERIES):
        start = time.time()
        if name not in ORACLE:
            print(f"{name}: rows only, {QUERIES[name](spark, sf_dir).count()} rows, {time.time() - start:.1f} s")
            continue
        try:
            found = difference(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{name}: {'ok' if found is None else found}, {time.time() - start:.1f} s", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
