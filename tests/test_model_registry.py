"""Model versions and the stream that scores with them."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from conftest import SF
from riskframe.config import KEY, TARGET
from riskframe.operators import prep, score
from riskframe.sources.accounts import derive_accounts
from riskframe.streaming import registry
from riskframe.streaming import scoring as streams


@pytest.fixture(scope="module")
def models(spark):
    accounts = derive_accounts(spark, SF).withColumn("label", F.col(TARGET).cast("double")).cache()
    made = []
    for column in ("EDUCATION", "MARRIAGE"):
        prepared = Pipeline(stages=[prep.RepaymentFeatures(), prep.AccountPrep(numericCols=[], categoricalCols=[column])]).fit(accounts)
        made.append(PipelineModel(stages=[*prepared.stages, LogisticRegression(maxIter=20).fit(prepared.transform(accounts))]))
    return accounts.drop("label"), made


def test_versions_are_complete_or_absent(spark, models, tmp_path):
    _, (first, second) = models
    root = str(tmp_path / "models")
    assert registry.versions(spark, root) == []
    with pytest.raises(ValueError, match="no complete"):
        registry.version_of_batch(spark, root, str(tmp_path / "out"), 0)
    registry.publish(first, root, 1)
    second.write().save(f"{root}/models/2")  # half published: no note
    assert registry.versions(spark, root) == [1]
    with pytest.raises(ValueError, match="already"):
        registry.publish(first, root, 1)


def test_a_replayed_batch_keeps_its_version(spark, models, tmp_path):
    accounts, (first, second) = models
    root, out = str(tmp_path / "models"), str(tmp_path / "out")
    registry.publish(first, root, 1)
    write = registry.versioned_writer(root, out)
    write(accounts, 0)
    registry.publish(second, root, 5)
    write(accounts, 1)
    write(accounts, 0)  # replayed after version 5 landed
    found = spark.read.parquet(f"{out}/scored")
    assert {(r.batch_id, r.model_version): r["count"] for r in found.groupBy("batch_id", "model_version").count().collect()} == {
        (0, 1): accounts.count(), (1, 5): accounts.count()}
    for batch_id, model in ((0, first), (1, second)):
        want = {r[KEY]: r.probability for r in score.score_with_pipeline(accounts, model).collect()}
        assert {r[KEY]: r.probability for r in found.where(F.col("batch_id") == batch_id).collect()} == pytest.approx(want)


def test_stream_without_records(spark, models, tmp_path):
    accounts, (first, _) = models
    root, landing = str(tmp_path / "models"), str(tmp_path / "landing")
    registry.publish(first, root, 1)
    accounts.limit(0).write.parquet(landing)
    streams.finish(registry.run_versioned_scoring(streams.read_stream(spark, landing, accounts.schema), root, str(tmp_path / "out"), str(tmp_path / "checkpoint")))
    assert registry.versions(spark, root) == [1]
