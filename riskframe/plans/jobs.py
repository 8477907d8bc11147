"""The three jobs: train, batch-score and explain. Run with ``spark-submit``.

    spark-submit --py-files riskframe.zip riskframe/plans/jobs.py train --input accounts/ --output run/
    spark-submit ... jobs.py score   --input new/ --model run/model --output scored/
    spark-submit ... jobs.py explain --input run/test --model run/model --output reports/
"""

from __future__ import annotations

import argparse
import logging
import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.config import KEY, SERVING_CONTRACT, TARGET, JobConfig
from riskframe.functions.bounded import reused
from riskframe.functions.columns import num, q
from riskframe.functions.labels import readable_name
from riskframe.operators import clean, contract, explain, kernel, metrics, prep, quality, score, split, train, trees
from riskframe.sources import readers, writers

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class TrainResult:
    run_id: str
    model: PipelineModel
    best: train.Candidate
    report: DataFrame
    leaderboard: DataFrame
    verdict: DataFrame


def with_row_key(df: DataFrame, key: str) -> DataFrame:
    """Accounts without a key get one from their content; equal rows collapse in cleaning anyway."""
    if key in df.columns:
        return df
    cells = ", ".join(f"coalesce(CAST({q(c)} AS STRING), '<null>')" for c in sorted(df.columns))
    return df.selectExpr("*", f"md5(concat_ws('|', {cells})) AS {q(key)}")


def intake(distinct: DataFrame, cleaned: DataFrame, malformed: int) -> DataFrame:
    """What became of the rows read: malformed lines, repeated rows, incomplete rows, and those kept. They add up."""
    counts = distinct.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("well_formed"), F.count("*").alias("n_distinct"))
    return counts.crossJoin(cleaned.agg(F.count("*").alias("kept"))).selectExpr(
        f"well_formed + {malformed}L AS read", f"{malformed}L AS malformed", "well_formed - n_distinct AS repeated",
        "n_distinct - kept AS incomplete", "kept")


def train_job(raw: DataFrame, out: str, config: JobConfig = JobConfig(), key: str = KEY,
              run_id: str | None = None) -> TrainResult:
    """Clean, check, split, prepare, tune, evaluate, explain; tables and model go to ``out``.

    Stages meet in written tables: every later stage reads a pruned parquet scan, and a lost
    executor never costs the whole chain.
    """
    spark = raw.sparkSession
    run_id = run_id or uuid.uuid4().hex
    raw, malformed = readers.split_malformed(raw)
    if malformed is not None:
        writers.write_table(malformed, f"{out}/malformed")
    raw = with_row_key(clean.canonical_target(raw), key)
    clean.require_columns(raw, [TARGET])
    # one wide shuffle serves both the quality figures and the removal of copies
    if key != clean.RAW_KEY:
        raw = clean.drop_surrogate_key(raw)
    writers.write_table(clean.group_copies(raw, key), f"{out}/distinct")
    distinct = spark.read.parquet(f"{out}/distinct")
    attributes = [c for c in raw.columns if c != key]
    writers.write_table(clean.drop_incomplete(distinct, attributes).drop("copies"), f"{out}/cleaned")
    cleaned = spark.read.parquet(f"{out}/cleaned")
    bad = spark.read.parquet(f"{out}/malformed").count() if malformed is not None else 0
    writers.append_report(intake(distinct, cleaned, bad), f"{out}/reports", "intake", run_id)

    q_table = quality.quality_of_groups(distinct, attributes)
    checks = contract.dataset_checks(cleaned, config.contract, key).unionByName(
        contract.quality_checks(q_table, config.contract))
    writers.append_report(checks, f"{out}/reports", "checks", run_id)
    # the check table just written is small: read it back instead of computing it again
    written = spark.read.parquet(f"{out}/reports/checks").where(F.col("run_id") == run_id)
    one_verdict = contract.verdict(written)
    writers.append_report(contract.status_lines(one_verdict), f"{out}/reports", "status", run_id)
    writers.append_report(quality.numeric_profile(cleaned.drop(key)), f"{out}/reports", "profile", run_id)
    if config.gate:
        contract.gate(one_verdict)

    features = prep.RepaymentFeatures(
        ratios=config.features.ratios, payments=config.features.payments, balances=config.features.balances)
    marked = (split.exact_split(cleaned, [key], config.split) if config.split.stratify
              else split.hash_split(cleaned, [key], config.split))
    train_rows, test_rows = split.train_and_test(marked)
    numeric = [*prep.NUMERIC_FEATURES, *prep.engineered_names(config.features)]
    fitted = prep.AccountPrep(numericCols=numeric).fit(features.transform(train_rows))
    label = F.col(TARGET).cast("double").alias("label")
    for name, part in (("train", train_rows), ("test", test_rows)):
        vectors = fitted.transform(features.transform(part)).withColumn("label", label)
        writers.write_matrix(vectors, f"{out}/{name}_matrix", [key])
        writers.write_table(part, f"{out}/{name}")
    train_m = split.with_fold(spark.read.parquet(f"{out}/train_matrix"), [key], config.trainer.folds,
                              config.trainer.seed, "label")
    test_m = spark.read.parquet(f"{out}/test_matrix")
    with reused(train_m) as cached:
        candidates = train.tune_all(cached, test_m, config.trainer, key)
    best = train.select_best(candidates, config.trainer)
    model = PipelineModel(stages=[features, fitted, best.model])
    writers.save_model(model, f"{out}/model")

    board = train.leaderboard(spark, candidates)
    writers.append_report(board, f"{out}/reports", "leaderboard", run_id)
    scored_test = score.score_with_pipeline(spark.read.parquet(f"{out}/test"), model)
    report = metrics.evaluation_report(scored_test, TARGET, best.name).withColumn(
        "best_params", F.lit(str(best.params)))
    writers.append_report(report, f"{out}/reports", "metrics", run_id)
    importances = train.feature_importances(best.model, fitted.feature_names())
    if importances is not None:
        writers.append_report(importances, f"{out}/reports", "importances", run_id)
    try:
        explain_job(spark.read.parquet(f"{out}/test"), model, f"{out}/reports", config, key, run_id)
    except Exception:  # an explanation must not cost a trained model
        log.warning("explanation failed", exc_info=True)
    return TrainResult(run_id, model, best, report, board, one_verdict)


def score_job(df: DataFrame, model: PipelineModel, out: str, run_id: str | None = None, key: str = KEY,
              check: bool = True) -> DataFrame:
    """Score a batch into ``out/scored``, bad rows into ``out/quarantine``; returns the summary."""
    run_id = run_id or uuid.uuid4().hex
    rows = df
    if check:
        rows, bad = contract.split_by_contract(df, SERVING_CONTRACT)
        writers.write_table(bad, f"{out}/quarantine")
    writers.write_table(score.score_with_pipeline(rows, model), f"{out}/scored")
    scored = df.sparkSession.read.parquet(f"{out}/scored")
    writers.append_report(score.batch_summary(scored), f"{out}/reports", "summary", run_id)
    writers.append_report(score.risk_distribution(scored), f"{out}/reports", "distribution", run_id)
    return score.batch_summary(scored)


def explain_job(df: DataFrame, model: PipelineModel, reports: str, config: JobConfig = JobConfig(),
                key: str = KEY, run_id: str | None = None) -> DataFrame:
    """Global and local attribution tables; returns the global statistics."""
    run_id = run_id or uuid.uuid4().hex
    features, fitted, classifier = model.stages
    names = fitted.feature_names()
    ready = score.prepare_for_scoring(df, features.config())
    method = explain.attribution_method(classifier)
    cfg = config.explain
    if method == "linear":
        card = train.as_scorecard(classifier, names)
        columns = fitted.expressions()
        with reused(ready) as table:
            how = explain.linear_attribution(table, card, [key], cfg.background_rows, cfg.seed, columns)
            stats = explain.attribution_stats(table, how)
            rows = stats.collect()
            stats = df.sparkSession.createDataFrame(rows, stats.schema)
            local = explain.top_contributions(table, how, [key], cfg.top_features)
            writers.append_report(local, reports, "local_contributions", run_id)
        base = how.base_value
    else:
        vectors = fitted.transform(ready)
        sample = split.sample_rows(vectors, [key], cfg.sample_rows, cfg.seed)
        by_cover = method == "tree" and cfg.trees == "cover"
        background = None if by_cover else explain.background_matrix(vectors, [key], cfg.background_rows, cfg.seed)
        if by_cover:
            long = trees.cover_attribution(sample, trees.ensemble(classifier), names, key)
        elif method == "tree":
            boosted = isinstance(classifier, GBTClassificationModel)
            long = explain.tree_attribution(sample, explain.tree_leaves(classifier), names, key, background, boosted)
        elif cfg.others == "kernel":
            long = kernel.kernel_attribution(sample, classifier, names, key, background, cfg.coalitions, cfg.seed)
        else:
            long = explain.sampled_attribution(sample, classifier, names, key, background, cfg.permutations, cfg.seed)
        writers.append_report(long, reports, "sampled_contributions", run_id)
        long = df.sparkSession.read.parquet(f"{reports}/sampled_contributions").where(F.col("run_id") == run_id)
        stats = explain.stats_of_long(long, len(names))
        base = long.agg(F.first("base_value")).first()[0]
    bundle = stats.selectExpr(
        "*", f"{readable_name('feature')} AS readable_name", f"'{method}' AS method",
        f"'{type(classifier).__name__}' AS model_type", f"{num(float(base))} AS base_value")
    writers.append_report(bundle, reports, "attribution", run_id)
    return stats


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="riskframe")
    parser.add_argument("job", choices=("train", "score", "explain"))
    parser.add_argument("--input", required=True)
    parser.add_argument("--format", default="parquet", choices=readers.FORMATS)
    parser.add_argument("--model")
    parser.add_argument("--output", required=True)
    parser.add_argument("--no-gate", action="store_true", help="train even when the verdict is negative")
    args = parser.parse_args(argv)
    if args.job != "train" and not args.model:
        parser.error("--model is required")
    spark = SparkSession.builder.appName(f"riskframe-{args.job}").getOrCreate()
    df = readers.read_accounts(spark, args.input, args.format)
    if args.job == "train":
        train_job(df, args.output, JobConfig(gate=not args.no_gate))
    else:
        job = score_job if args.job == "score" else explain_job
        job(df, readers.load_model(args.model), args.output)


if __name__ == "__main__":
    main()
