"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import sys
import types
import uuid

from pyspark.sql import DataFrame, SparkSession

from riskframe.sources.writers import working_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: it cuts the lineage and outlives lost executors."""
    spark = df.sparkSession
    path = f"{working_dir(spark)}/llm/{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def batches_of(spark: SparkSession, rows: int = 2000) -> None:
    """Let Arrow batches have so many rows at most: whole texts and pages in them are held several times on their way."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


def per_worker(kind: str, key, make):
    """The worker's object of a kind, made when first asked for or when the key has changed, however many tasks it runs.

    Workers outlive stages, so objects of another operator (the part of a kind before a dot) are let go first: a job holds
    what one operator needs, not the caches of all stages before.
    """
    kept = sys.modules.setdefault("riskframe_llm_kept", types.ModuleType("riskframe_llm_kept")).__dict__
    if kind not in kept or kept[kind][0] != key:
        operator = kind.partition(".")[0]
        for other in [k for k in kept if not k.startswith("__") and k.partition(".")[0] != operator]:
            del kept[other]
        kept[kind] = (key, make())
    return kept[kind][1]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pieces(text: str, split) -> list[str]:
    """Cut a text where the splitting pattern surely does: before single spaces and around single newlines.

    Texts with any other white space, or with white space in a row or at an end, are cut by the pattern itself.
    """
    words = text.split()
    spaces, lines = text.count(" "), text.count("\n")
    if len(words) == spaces + lines + 1 and len("".join(words)) + spaces + lines == len(text) and "\0" not in text:
        return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")
    return split(text)
