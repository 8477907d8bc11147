"""Sinks for tables, feature matrices, reports and models."""

from __future__ import annotations

import re

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_matrix(df: DataFrame, path: str, key: list[str]) -> None:
    """Features and label side by side, with the row key."""
    df.select(*key, "features", "label").write.mode("overwrite").parquet(path)


def append_report(df: DataFrame, root: str, name: str, run_id: str, fmt: str = "parquet") -> str:
    """Append a report table under ``root/name``, every row stamped with the run."""
    if not re.fullmatch(r"[a-z_]+", name):
        raise ValueError("report names are lower-case words joined by underscores")
    path = f"{root.rstrip('/')}/{name}"
    df.withColumn("run_id", F.lit(run_id)).write.mode("append").format(fmt).save(path)
    return path


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def working_dir(spark) -> str:
    """The shared folder for written intermediates and stream state.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session without the setting
    gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    import tempfile

    return tempfile.mkdtemp(prefix="riskframe-")
