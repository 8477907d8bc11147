"""The account table derived from customers, orders and line items.

One row per customer. Months 1-6 are calendar months folded onto a half year. Each order is
one row after the line items have been pre-aggregated per order, so a single grouping by
customer yields all monthly figures. Money is added up in whole cents: exact, order
independent, and cheaper than decimal sums. Queries that need no payments never read the line
items: a left join to unique keys disappears when its columns are not used.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from riskframe.config import INPUT_COLUMNS, KEY, PAY_COLUMNS, TARGET

# the columns the engine reads; a declared schema spares the footer scan of schema inference
TABLE_SCHEMAS = {
    "customer": "c_custkey bigint, c_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_extendedprice double, l_returnflag string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _cents(col: str) -> str:
    return f"CAST(round({col} * 100) AS BIGINT)"


def derive_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = range(1, 7)
    monthly = ", ".join(
        f"sum(CASE WHEN m = {m} THEN {source} END) AS {source}{m}"
        for m in months for source in ("standing", "bill", "paid"))
    columns = {
        "LIMIT_BAL": "CAST(10000 + (c_custkey * 7919 % 100) * 10000 AS BIGINT)",
        "SEX": "CAST(1 + c_custkey % 2 AS BIGINT)",
        "EDUCATION": "CAST(c_custkey % 7 AS BIGINT)",
        "MARRIAGE": "CAST(c_nationkey % 4 AS BIGINT)",
        "AGE": "CAST(21 + c_custkey % 59 AS BIGINT)",
        **{c: f"CAST(greatest(-2, least(8, coalesce(standing{m}, -2))) AS BIGINT)"
           for m, c in enumerate(PAY_COLUMNS, start=1)},
        **{f"BILL_AMT{m}": f"bill{m} / 100D" for m in months},
        **{f"PAY_AMT{m}": f"paid{m} / 100D" for m in months},
        TARGET: "CAST(coalesce(standing, 0) + c_custkey % 5 >= 3 AS BIGINT)",
    }
    selected = ", ".join(f"{columns[c]} AS {c}" for c in (*INPUT_COLUMNS, TARGET))
    return spark.sql(f"""
        WITH refunds AS (
          SELECT l_orderkey, sum({_cents('l_extendedprice')}) AS paid
          FROM {{lineitem}} WHERE l_returnflag = 'R' GROUP BY l_orderkey),
        dated AS (
          SELECT o_orderkey, o_custkey, (month(o_orderdate) - 1) % 6 + 1 AS m,
                 CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN -1 ELSE 0 END AS standing,
                 {_cents('o_totalprice')} AS bill
          FROM {{orders}}),
        activity AS (
          SELECT o_custkey, sum(standing) AS standing, {monthly}
          FROM dated LEFT JOIN refunds ON o_orderkey = l_orderkey GROUP BY o_custkey)
        SELECT c_custkey AS {KEY}, {selected}
        FROM {{customer}} LEFT JOIN activity ON c_custkey = o_custkey
        """, lineitem=table(spark, sf_dir, "lineitem"), orders=table(spark, sf_dir, "orders"),
        customer=table(spark, sf_dir, "customer"))
