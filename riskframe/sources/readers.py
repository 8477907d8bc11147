"""Readers that end in the account schema, and stored matrices, models and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.config import RAW_KEY, TARGET_SOURCE_NAMES
from riskframe.functions.columns import FLOATING, finite_or_null, with_expressions
from riskframe.sources.schema import account_schema

CORRUPT = "_corrupt"
FORMATS = ("parquet", "orc", "csv", "json")


def missing_for_non_finite(df: DataFrame) -> DataFrame:
    """NaN and infinite cells become null, so aggregates skip them."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, FLOATING)]
    return with_expressions(df, {c: finite_or_null(c) for c in floating})


def csv_schema(spark: SparkSession, path: str) -> T.StructType:
    """Account types for the columns named in the header line, in file order."""
    header = spark.read.option("header", True).csv(path).columns
    known = {f.name: f.dataType for f in account_schema().fields}
    known.update({name: T.LongType() for name in (*TARGET_SOURCE_NAMES, RAW_KEY)})
    return T.StructType([T.StructField(c, known.get(c, T.StringType())) for c in header])


def read_accounts(spark: SparkSession, path: str, fmt: str = "parquet",
                  schema: T.StructType | None = None, infer: bool = False) -> DataFrame:
    """Accounts from parquet, orc, csv (with header) or json.

    Text formats use the explicit schema; a line that does not fit it keeps its raw text in
    ``_corrupt`` and its bad cells as null, for the row contract to quarantine. ``infer``
    lets Spark guess csv types, for the dataset type check.
    """
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    reader = spark.read
    if fmt in ("csv", "json") and not infer:
        wanted = schema or (csv_schema(spark, path) if fmt == "csv" else account_schema())
        reader = reader.schema(T.StructType([*wanted.fields, T.StructField(CORRUPT, T.StringType())]))
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    elif schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
        if infer:
            reader = reader.option("inferSchema", True)
    return missing_for_non_finite(reader.format(fmt).load(path))


def corrupt_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col(CORRUPT).isNotNull())


def split_malformed(df: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows of well-formed lines without the raw text, and the rows of malformed lines with it; None if none can occur."""
    if CORRUPT not in df.columns:
        return df, None
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT), corrupt_rows(df)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def record(spark: SparkSession, values: dict, with_target: bool = False) -> DataFrame:
    """One input record as a one-row table of the account schema."""
    schema = account_schema(with_key=False, with_target=with_target)
    row = []
    for f in schema.fields:
        v = values.get(f.name)
        if v is not None:
            v = float(v) if isinstance(f.dataType, T.DoubleType) else int(v)
        row.append(v)
    return spark.createDataFrame([tuple(row)], schema)


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("features", "label")


def matrix_columns(df: DataFrame, names: list[str], features_col: str = "features", key: Sequence[str] = ()) -> DataFrame:
    """Feature vectors as one named column per feature, the key first if wanted, label last."""
    arr = vector_to_array(features_col)
    return df.select(*key, *[arr[i].alias(n) for i, n in enumerate(names)], "label")


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
