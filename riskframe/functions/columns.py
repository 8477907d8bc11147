"""Builders of small SQL expressions shared by the operators.

They return expression text for ``selectExpr`` and ``F.expr``: a wide expression then crosses
to the JVM once instead of once per node, and everything stays inside codegen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_SPACE = 1 << 32
FLOATING = (T.DoubleType, T.FloatType)


def q(name: str) -> str:
    """Quoted column name; dots and spaces in it are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def num(value: float | int) -> str:
    """Exact numeric literal: integers as such, everything else as a double."""
    if isinstance(value, bool):
        raise TypeError("a number is expected")
    if isinstance(value, int):
        return str(value)
    value = float(value)
    if value != value or value in (float("inf"), float("-inf")):
        return f"double('{value}')"
    return f"{value!r}D"


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal(value) -> str:
    return text(value) if isinstance(value, str) else num(value)


def double(name: str) -> str:
    return f"CAST({q(name)} AS DOUBLE)"


def add_all(terms: Sequence[str]) -> str:
    return "(" + " + ".join(terms) + ")"


def finite_or_null(name: str) -> str:
    """NaN and both infinities become null."""
    return f"CASE WHEN abs({q(name)}) < double('Infinity') THEN {q(name)} END"


def row_sum(names: Sequence[str]) -> str:
    """Sum of the present values; 0 when all are missing."""
    return add_all([f"coalesce({double(n)}, 0D)" for n in names])


def row_mean(names: Sequence[str]) -> str:
    """Mean of the present values; null when all are missing."""
    present = add_all([f"CAST({q(n)} IS NOT NULL AS INT)" for n in names])
    return f"try_divide({row_sum(names)}, {present})"


def plain_sum(names: Sequence[str]) -> str:
    """Sum that is null as soon as one value is missing."""
    return add_all([double(n) for n in names])


def safe_ratio(numerator: str, denominator: str) -> str:
    """Division that gives 0 for a zero divisor or a missing operand."""
    return f"coalesce(try_divide({numerator}, {denominator}), 0D)"


def sigmoid(logit: str) -> str:
    return f"(1D / (1D + exp(-({logit}))))"


def hash32(cols: Sequence[str], seed: int) -> str:
    """A uniform integer in [0, 2^32) from the given columns and a seed.

    It depends on values only, never on partitioning, so splits and samples come out the
    same on every cluster layout.
    """
    parts = ", ".join(f"coalesce(CAST({q(c)} AS STRING), '<null>')" for c in cols)
    return f"CAST(conv(substring(md5(concat_ws('|', {parts}, '{seed}')), 1, 8), 16, 10) AS BIGINT)"


def struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {expr}" for name, expr in fields.items()) + ")"


def array(items: Sequence[str]) -> str:
    return "array(" + ", ".join(items) + ")"


def names_of(cols: Sequence[str]) -> list[str]:
    return [q(c) for c in cols]


def with_expressions(df: DataFrame, added: Mapping[str, str]) -> DataFrame:
    """Add or replace columns; replaced ones keep their place."""
    kept = [f"{added[c]} AS {q(c)}" if c in added else q(c) for c in df.columns]
    new = [f"{e} AS {q(n)}" for n, e in added.items() if n not in df.columns]
    return df.selectExpr(*kept, *new)


def as_column(expression: Column | str) -> Column:
    return F.expr(expression) if isinstance(expression, str) else expression


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def to_long_form(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One output row (kept columns, column, value) per input row and column."""
    cells = [struct(column=text(c), value=double(c)) for c in columns]
    return df.selectExpr(*names_of(keep), f"inline({array(cells)})")
