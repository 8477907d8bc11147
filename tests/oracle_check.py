"""Compare registered queries with their SQL twins: ``python tests/oracle_check.py [sf_dir] [names...]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _normal(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf[sorted(pdf.columns)].copy()
    for c in pdf.columns:
        if pdf[c].dtype.kind == "f":
            pdf[c] = pdf[c] + 0.0  # -0.0 equals 0.0
    return pdf.sort_values(list(pdf.columns), ignore_index=True)


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def type_differences(spark_df, con, sql: str) -> list[str]:
    right = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    left = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in spark_df.schema.fields}
    return [f"{c}: {left[c]} != {right.get(c)}" for c in left if left[c] != right.get(c)]


def compare(spark_df, con, sql: str) -> str:
    wrong = type_differences(spark_df, con, sql)
    if wrong:
        return f"types {wrong}"
    left = _normal(spark_df.toPandas())
    right = _normal(con.execute(sql).fetchdf())
    if list(left.columns) != list(right.columns):
        return f"columns {list(left.columns)} != {list(right.columns)}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    bad = []
    for c in left.columns:
        same = (left[c] == right[c]) | (left[c].isna() & right[c].isna())
        if not same.all():
            at = same[~same].index[0]
            bad.append(f"{c}: {int((~same).sum())} differ, first {left[c][at]!r} != {right[c][at]!r}")
    if bad:
        return "; ".join(bad)
    return "ok"


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls = entry.oracle_sql()
    wanted = sys.argv[2:] or list(entry.queries())
    failures = 0
    for name in wanted:
        start = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            result = compare(df, con, sqls[name]) if name in sqls else f"rows only: {df.count()}"
        except Exception as error:
            traceback.print_exc(limit=4)
            result = f"error {str(error)[:300]}"
        failures += not (result == "ok" or result.startswith("rows only"))
        print(f"{name:28s} {time.time() - start:6.2f}s  {result}", flush=True)
    print("failures:", failures, "without SQL:", sorted(set(entry.queries()) - set(sqls)),
          "SQL without query:", sorted(set(sqls) - set(entry.queries())))
    return failures


if __name__ == "__main__":
    sys.exit(main())
