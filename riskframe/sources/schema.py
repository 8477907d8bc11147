"""Spark schemas of the account table and helpers that map a contract to them."""

from __future__ import annotations

from pyspark.sql import types as T

from riskframe.config import INPUT_COLUMNS, KEY, TARGET, TRAINING_CONTRACT

_KINDS = {"int": T.LongType(), "float": T.DoubleType()}


def account_schema(with_key: bool = True, with_target: bool = True) -> T.StructType:
    kinds = {r.column: r.kind for r in TRAINING_CONTRACT.rules}
    fields = [T.StructField(KEY, T.LongType())] if with_key else []
    fields += [T.StructField(c, _KINDS[kinds[c]]) for c in INPUT_COLUMNS]
    if with_target:
        fields.append(T.StructField(TARGET, T.LongType()))
    return T.StructType(fields)
