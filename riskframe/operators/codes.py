"""Coded columns as positions and sparse vectors, for columns of any number of codes.

An index is a table (column, value, n, position): positions count the values of a column in rising order from 0. Rows get their
positions by a join, so no code becomes a literal of the plan; the index never passes through the driver. The smallest code
of a column, unknown codes and gaps have no indicator.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.bounded import SMALL_ROWS, join_lookup
from riskframe.functions.columns import double, names_of, num, q, to_long_form
from riskframe.sources.writers import write_table


def index_codes(df: DataFrame, columns: Sequence[str], folder: str) -> DataFrame:
    """The index of some columns, written below ``folder``.

    Values are counted in the tasks, sorted by range over the cluster and numbered inside each range; a table of one row for each
    range and column says where a range starts. Null values are left out; an empty table gives an empty index.
    """
    long = to_long_form(df, columns).where("value IS NOT NULL")
    counts = long.groupBy("column", "value").agg(F.count("*").alias("n"))
    ranged = counts.repartitionByRange("column", "value").withColumn("part", F.spark_partition_id())
    write_table(ranged, f"{folder}/ranges")
    written = df.sparkSession.read.parquet(f"{folder}/ranges")
    starts = written.groupBy("column", "part").agg(F.count("*").alias("size")).selectExpr(
        "column", "part", "coalesce(sum(size) OVER (PARTITION BY column ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start")
    placed = join_lookup(written, starts, ["column", "part"], "inner").selectExpr(
        "column", "value", "n", "start + row_number() OVER (PARTITION BY column, part ORDER BY value) - 1 AS position")
    write_table(placed, f"{folder}/index")
    return df.sparkSession.read.parquet(f"{folder}/index")


def index_sizes(index: DataFrame) -> dict[str, int]:
    """Number of codes of each column: one row a column reaches the driver."""
    return {r["column"]: r["size"] for r in index.groupBy("column").agg(F.count("*").alias("size")).collect()}


def with_positions(df: DataFrame, index: DataFrame, columns: Sequence[str], prefix: str = "position_", max_rows: int = SMALL_ROWS) -> DataFrame:
    """Rows with the position of each coded column, null for an unknown code or a gap.

    The codes of a column are broadcast when counted small and joined by shuffle otherwise. Rows and their other columns stay.
    """
    out = df
    for i, c in enumerate(columns):
        code = f"__code_{i}"
        known = index.where(F.col("column") == c).select(F.col("value").alias(code), F.col("position").alias(f"{prefix}{c}"))
        out = join_lookup(out.withColumn(code, F.expr(double(c))), known, code, "left", max_rows).drop(code)
    return out.select(*names_of(df.columns), *[q(f"{prefix}{c}") for c in columns])


def indicator_vector(df: DataFrame, sizes: Mapping[str, int], output: str, dense: tuple[str, int] | None = None) -> DataFrame:
    """Replace columns of positions by one vector, sparse where that is smaller.

    ``sizes`` gives the number of codes of each column of positions, in the order of the vector; position 0, a null or anything
    beyond the last code sets no indicator. ``dense`` names a vector column, and its width, that comes first.
    """
    wide = [c for c, k in sizes.items() if k > 1]
    kept = [c for c in df.columns if c not in sizes and (dense is None or c != dense[0])]
    indices, parts = [], []
    for i, c in enumerate(wide):
        k = sizes[c] - 1  # an index of k has no place, and so no indicator
        index = f"CAST(CASE WHEN {q(c)} BETWEEN 1 AND {num(k)} THEN {q(c)} - 1 ELSE {num(k)} END AS DOUBLE)"
        indices.append(F.expr(index).alias(f"__index_{i}", metadata={"ml_attr": {"type": "nominal", "num_vals": k}}))
    if dense is not None:
        indices.append(F.col(q(dense[0])).alias("__dense", metadata={"ml_attr": {"num_attrs": dense[1]}}))
        parts.append("__dense")
    out = df.select(*names_of(kept), *indices)
    if wide:
        hot = [f"__hot_{i}" for i in range(len(wide))]
        encoder = OneHotEncoder(inputCols=[f"__index_{i}" for i in range(len(wide))], outputCols=hot, handleInvalid="keep", dropLast=True)
        out, parts = encoder.fit(out).transform(out), [*parts, *hot]
    if not parts:
        raise ValueError("nothing to put into a vector")
    out = VectorAssembler(inputCols=parts, outputCol="__vector").transform(out)
    return out.select(*names_of(kept), F.col("__vector").alias(output))


def encode(df: DataFrame, index: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Rows with one sparse vector of the indicators of some columns, by an index of any size."""
    sizes = index_sizes(index)
    placed = with_positions(df, index, columns, "__position_")
    return indicator_vector(placed, {f"__position_{c}": sizes.get(c, 0) for c in columns}, output)
