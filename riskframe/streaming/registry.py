"""Versions of fitted models in a folder, and a stream that scores with the newest complete one.

A version is complete when its row in the table of versions is written, which comes after the model; so a stream never reads
half a model. Every micro-batch notes its version before it scores, and a batch replayed after a failure uses that note.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.score import score_with_pipeline
from riskframe.sources.readers import load_model
from riskframe.sources.writers import save_model

VERSIONS = "version bigint"


def publish(model: PipelineModel, root: str, version: int) -> None:
    """Write a model as a version; complete once its note is there. A version that exists is not replaced."""
    spark = SparkSession.active()
    if version in versions(spark, root):
        raise ValueError(f"version {version} is published already")
    save_model(model, f"{root}/models/{version}")
    spark.createDataFrame([(version,)], VERSIONS).coalesce(1).write.mode("append").parquet(f"{root}/complete")


def versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions, rising; none if the folder has none."""
    try:
        return sorted(r["version"] for r in spark.read.schema(VERSIONS).parquet(f"{root}/complete").distinct().collect())
    except AnalysisException:
        return []


def version_of_batch(spark: SparkSession, root: str, out_path: str, batch_id: int) -> int:
    """The version a batch noted before, else the newest, which it notes now."""
    note = f"{out_path}/versions/batch_id={batch_id}"
    try:
        noted = spark.read.schema(VERSIONS).parquet(note).first()
    except AnalysisException:
        noted = None
    if noted is not None:
        return noted["version"]
    known = versions(spark, root)
    if not known:
        raise ValueError(f"no complete model version in {root}")
    spark.createDataFrame([(known[-1],)], VERSIONS).coalesce(1).write.mode("overwrite").parquet(note)
    return known[-1]


def versioned_writer(root: str, out_path: str) -> Callable[[DataFrame, int], None]:
    """What ``foreachBatch`` runs: score a batch with its version, stamp every record, replace the folder of the batch."""
    loaded: dict[int, PipelineModel] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        version = version_of_batch(batch.sparkSession, root, out_path, batch_id)
        if version not in loaded:
            loaded.clear()
            loaded[version] = load_model(f"{root}/models/{version}")
        scored = score_with_pipeline(batch, loaded[version]).withColumn("model_version", F.lit(version).cast("long"))
        scored.write.mode("overwrite").parquet(f"{out_path}/scored/batch_id={batch_id}")

    return write


def run_versioned_scoring(records: DataFrame, root: str, out_path: str, checkpoint: str, trigger: dict | None = None):
    """Score a stream of account records with the newest complete version at the begin of each micro-batch."""
    return (records.writeStream.foreachBatch(versioned_writer(root, out_path)).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
