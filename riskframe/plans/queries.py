"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

All of them start from the account table derived from the given tables. Doubles are rounded
at the very end so that results compare across engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.config import (
    CATEGORICAL_FEATURES, DOCUMENTED_BANDS, EXPLAIN_BANDS, EXTREME_BOOSTING, GRADIENT_BOOSTING, KEY, LOGISTIC,
    NUMERIC_FEATURES, RANDOM_FOREST, RAW_KEY, SERVING_CONTRACT, TARGET, TARGET_SOURCE_NAMES, TRAINING_CONTRACT, Contract,
    ExplainConfig, FeatureConfig, JobConfig, TrainerConfig,
)
from riskframe.functions.bounded import reused
from riskframe.functions.columns import array, double, num, q, text, with_expressions
from riskframe.functions.labels import readable_name
from riskframe.operators import boosting, clean, codes, contract, explain, kernel, metrics, prep, quality, score, split, train, trees
from riskframe.operators.features import engineered_names, with_engineered_features
from riskframe.operators.score import (
    FIXED_COVER_TREES, FIXED_KERNEL_INTERCEPT, FIXED_KERNEL_WEIGHTS, FIXED_LEAVES, FIXED_SCORECARD, FIXED_TREE_COLUMNS,
)
from riskframe.plans import jobs
from riskframe.sources import readers, writers
from riskframe.sources.accounts import derive_accounts, table
from riskframe.streaming import registry
from riskframe.streaming import scoring as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
PROFILED = (*NUMERIC_FEATURES, *CATEGORICAL_FEATURES, TARGET)
COPY_OFFSET = 1_000_000_000_000
CLOSED = 10
#: Minimum split size of the collapsed forest.
SPLIT_LEAST = 40


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round every double column; ``special`` overrides the digits of single columns.

    Input values (column ``value``) are kept as they are.
    """
    return with_expressions(df, {
        f.name: f"round({q(f.name)}, {special.get(f.name, digits)})"
        for f in df.schema.fields if isinstance(f.dataType, T.DoubleType) and f.name != "value"})


def run_dir(spark: SparkSession, name: str) -> str:
    return f"{writers.working_dir(spark)}/{name}-{uuid.uuid4().hex}"


def raw_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts in which every customer with events occurs twice, the second time under another key."""
    accounts = derive_accounts(spark, sf_dir)
    active = table(spark, sf_dir, "events").select(F.col("user_id").alias(KEY)).distinct()
    copies = accounts.join(active, KEY, "left_semi").withColumn(KEY, F.col(KEY) + COPY_OFFSET)
    return accounts.unionByName(copies)


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.prepare_for_scoring(derive_accounts(spark, sf_dir))


def scored_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filled inputs, features and score columns in one projection."""
    return score.with_score_columns(featured(spark, sf_dir), FIXED_SCORECARD.probability())


def attributed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, explain.LinearAttribution]:
    """Scored accounts and their attribution. The table is written once: background, rankings and results read it pruned."""
    path = run_dir(spark, "scored")
    writers.write_table(scored_accounts(spark, sf_dir), path)
    df = spark.read.parquet(path)
    return df, explain.linear_attribution(df, FIXED_SCORECARD, [KEY])


# ---------------------------------------------------------------- sources and cleaning

@query
def account_table(spark, sf_dir):
    return derive_accounts(spark, sf_dir)


@query
def clean_accounts(spark, sf_dir):
    return clean.clean_accounts(raw_accounts(spark, sf_dir), KEY)


@query
def fill_missing(spark, sf_dir):
    return clean.fill_missing_with_zero(derive_accounts(spark, sf_dir))


@query
def text_round_trip(spark, sf_dir):
    path = run_dir(spark, "text")
    writers.write_table(derive_accounts(spark, sf_dir), path, "csv")
    return readers.read_accounts(spark, path, "csv").drop(readers.CORRUPT)


@query
def format_round_trip(spark, sf_dir):
    """The same table through every other format; lines of text are read by the explicit schema."""
    accounts, path, parts = derive_accounts(spark, sf_dir), run_dir(spark, "formats"), []
    for fmt in ("json", "orc", "parquet"):
        writers.write_table(accounts, f"{path}/{fmt}", fmt)
        parts.append(readers.read_accounts(spark, f"{path}/{fmt}", fmt).drop(readers.CORRUPT).select(F.lit(fmt).alias("format"), *accounts.columns))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def preview_rows(spark, sf_dir):
    return readers.preview(derive_accounts(spark, sf_dir).orderBy(KEY))


# ---------------------------------------------------------------- contract and quality

def _text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts read from csv lines of which one in fifty has a word in place of the age."""
    path = run_dir(spark, "lines")
    accounts = derive_accounts(spark, sf_dir)
    age = F.when(F.col(KEY) % 50 == 0, F.lit("unknown")).otherwise(F.col("AGE").cast("string"))
    writers.write_table(accounts.withColumn("AGE", age), path, "csv")
    return readers.read_accounts(spark, path, "csv")


@query
def malformed_lines(spark, sf_dir):
    """Kept and quarantined lines add up to those read."""
    path = run_dir(spark, "parsed")
    writers.write_table(_text_lines(spark, sf_dir), path)
    good, bad = readers.split_malformed(spark.read.parquet(path))
    return good.agg(F.count("*").alias("n")).select(F.lit("kept").alias("part"), "n").unionByName(
        bad.groupBy(F.lit("quarantined").alias("part")).agg(F.count("*").alias("n")))


@query
def awkward_inputs(spark, sf_dir):
    """A foreign surrogate key, another spelling of the label, NaN and infinite money, a column nobody asked for."""
    accounts = derive_accounts(spark, sf_dir)
    odd = accounts.withColumn(RAW_KEY, F.lit(1)).withColumnRenamed(TARGET, TARGET_SOURCE_NAMES[0]).withColumn("note", F.lit("x"))
    odd = odd.withColumn("BILL_AMT1", F.when(F.col(KEY) % 11 == 0, F.lit(float("nan"))).when(
        F.col(KEY) % 13 == 0, F.lit(float("inf"))).otherwise(F.col("BILL_AMT1")))
    cleaned = clean.nulls_for_non_finite(clean.canonical_target(clean.drop_surrogate_key(odd)))
    features, target = clean.project_features(cleaned)
    extra = contract.schema_checks(cleaned, TRAINING_CONTRACT, KEY).where("NOT passed").select("column_name")
    return cleaned.select(KEY, "BILL_AMT1", F.col(clean.find_target(cleaned)).alias(TARGET), F.lit(len(features)).cast("bigint").alias("n_features"),
                          F.lit(target).alias("target_name")).crossJoin(extra.agg(F.array_join(F.array_sort(F.collect_set("column_name")), ",").alias("failed_columns")))


@query
def switched_features(spark, sf_dir):
    """One group of engineered features only."""
    only = with_engineered_features(derive_accounts(spark, sf_dir), FeatureConfig(ratios=False, payments=True, balances=False))
    return rounded(only.select(KEY, *engineered_names(FeatureConfig(ratios=False, payments=True, balances=False))))


@query
def one_record(spark, sf_dir):
    """The account with the smallest key as a single record: class, probability, band and explanation in one row."""
    values = derive_accounts(spark, sf_dir).orderBy(KEY).first().asDict()
    record = readers.record(spark, values).withColumn(KEY, F.lit(values[KEY]).cast("bigint"))
    _, how = attributed(spark, sf_dir)
    scored = score.score(record, FIXED_SCORECARD)
    ready = score.prepare_for_scoring(record)
    best = explain.top_contributions(ready, how, [KEY], 3).select(
        KEY, F.array_join(F.transform("explanation", lambda r: r["feature"]), ",").alias("explanation"))
    return rounded(scored.select(KEY, "prediction", "probability", "risk_category").join(best, KEY))


@query
def train_job_tables(spark, sf_dir):
    """The train job end to end on accounts with copies and gaps: what its tables and reports count.

    All configured folds and iterations, but for time one point of the logistic grid: ``search_logistic`` searches it whole.
    """
    out = run_dir(spark, "train-job")
    config = JobConfig(trainer=TrainerConfig(algorithms=(replace(LOGISTIC, grid={"C": (1.0,)}),)), gate=False)
    jobs.train_job(raw_accounts(spark, sf_dir), out, config, run_id="q")
    read = lambda name: spark.read.parquet(f"{out}/{name}")
    taken = read("reports/intake").selectExpr("stack(4, 'read', read, 'repeated', repeated, 'incomplete', incomplete, 'kept', kept) AS (part, n)")
    judged = read("reports/metrics").selectExpr("'judged' AS part", "true_negatives + false_positives + false_negatives + true_positives AS n")
    parts = [read(name).agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n") for name in ("train", "test", "train_matrix", "test_matrix")]
    out_rows = taken.unionByName(judged)
    for part in parts:
        out_rows = out_rows.unionByName(part)
    return out_rows.select("part", F.col("n").cast("bigint").alias("n"))


#: Values planted in some rows to break the contract: column, every so many keys, value.
PLANTED = (("AGE", 41, 17), ("SEX", 43, 9))


@query
def gate_stop(spark, sf_dir):
    """The train job on a table that breaks the contract: the gate stops it, and its reports say why."""
    out = run_dir(spark, "gated")
    rows = clean.fill_missing_with_zero(derive_accounts(spark, sf_dir))
    for column, every, value in PLANTED:
        rows = rows.withColumn(column, F.when(F.col(KEY) % every == 0, value).otherwise(F.col(column)).cast("bigint"))
    try:
        jobs.train_job(rows, out, JobConfig(gate=True), run_id="q")
        status = "not stopped"
    except contract.ContractViolation as error:
        status = str(error)
    failed = spark.read.parquet(f"{out}/reports/checks").where("NOT passed AND severity = 'error'")
    return failed.select("check_name", "column_name", "violations", F.lit(status).alias("status"))


@query
def score_job_tables(spark, sf_dir):
    """The score job with a fitted, stored and loaded pipeline: what its tables and reports count."""
    out = run_dir(spark, "score-job")
    _, _, _, stages = prepared_matrices(spark, sf_dir)
    weights = [0.05 * (i % 5 - 2) for i in range(len(stages.stages[1].feature_names()))]
    writers.save_model(PipelineModel(stages=[*stages.stages, train.logistic_model(spark, weights, -0.5)]), f"{out}/model")
    jobs.score_job(derive_accounts(spark, sf_dir), readers.load_model(f"{out}/model"), out, run_id="q")
    read = lambda name: spark.read.parquet(f"{out}/{name}")
    parts = [read(name).agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n") for name in ("scored", "quarantine")]
    parts.append(read("reports/summary").selectExpr("'summary' AS part", "high_risk_count + medium_risk_count + low_risk_count AS n"))
    parts.append(read("reports/distribution").agg(F.sum("n").alias("n")).selectExpr("'distribution' AS part", "n"))
    out_rows = parts[0]
    for part in parts[1:]:
        out_rows = out_rows.unionByName(part)
    return out_rows


#: Weight of the first indicator of the explained model; the others are multiples.
EXPLAINED_WEIGHT = 0.25


@query
def explain_job_tables(spark, sf_dir):
    """The explain job for a logistic model of one coded column with known weights: the attribution bundle it reports."""
    out = run_dir(spark, "explain-job")
    writers.write_table(derive_accounts(spark, sf_dir), f"{out}/accounts")
    accounts = spark.read.parquet(f"{out}/accounts")
    stages = Pipeline(stages=[prep.RepaymentFeatures(), prep.AccountPrep(numericCols=[], categoricalCols=["EDUCATION"])]).fit(accounts)
    weights = [EXPLAINED_WEIGHT * (i + 1) for i in range(len(stages.stages[1].feature_names()))]
    jobs.explain_job(accounts, PipelineModel(stages=[*stages.stages, train.logistic_model(spark, weights, -1.0)]), f"{out}/reports", run_id="q")
    bundle = spark.read.parquet(f"{out}/reports/attribution")
    local = spark.read.parquet(f"{out}/reports/local_contributions").agg(F.count("*").alias("n_local"))
    return rounded(bundle.select("feature", "mean_contribution", "mean_abs_contribution", "n_rows", "method", "model_type", "base_value").crossJoin(local))


@query
def dataset_checks(spark, sf_dir):
    return contract.dataset_checks(derive_accounts(spark, sf_dir), TRAINING_CONTRACT, KEY)


@query
def invalid_values(spark, sf_dir):
    """All coded columns of the training contract, with codes that break it in a few rows."""
    accounts = derive_accounts(spark, sf_dir)
    broken = accounts.where(F.col(KEY) % 37 == 0).withColumns({
        KEY: F.col(KEY) + COPY_OFFSET, "EDUCATION": F.lit(9).cast("bigint"), "SEX": F.lit(None).cast("bigint"), "MARRIAGE": F.col("MARRIAGE") + 2})
    return contract.invalid_values(accounts.unionByName(broken), TRAINING_CONTRACT)


def _violations(df: DataFrame, rules: Contract) -> DataFrame:
    checked = contract.with_violations(df, rules)
    return checked.select(KEY, "first_violation", F.size("violations").cast("bigint").alias("n_violations"),
                          F.array_join("violations", ",").alias("violations"))


@query
def row_violations(spark, sf_dir):
    return _violations(derive_accounts(spark, sf_dir), TRAINING_CONTRACT)


@query
def row_violations_serving(spark, sf_dir):
    return _violations(derive_accounts(spark, sf_dir), SERVING_CONTRACT)


@query
def quarantine_split(spark, sf_dir):
    valid, quarantine = contract.split_by_contract(derive_accounts(spark, sf_dir), SERVING_CONTRACT)
    return valid.select(KEY, F.lit(True).alias("valid")).unionByName(
        quarantine.select(KEY, F.lit(False).alias("valid")))


@query
def batch_outcome(spark, sf_dir):
    return score.batch_outcome(contract.with_violations(derive_accounts(spark, sf_dir), SERVING_CONTRACT))


@query
def quality_report(spark, sf_dir):
    return rounded(quality.quality(raw_accounts(spark, sf_dir).drop(KEY)))


QUERIES["quality"] = QUERIES.pop("quality_report")


@query
def verdict(spark, sf_dir):
    return rounded(contract.verdict(contract.all_checks(raw_accounts(spark, sf_dir), key=KEY)))


@query
def status_report(spark, sf_dir):
    checks = contract.all_checks(raw_accounts(spark, sf_dir), key=KEY)
    return contract.status_lines(contract.verdict(checks))


@query
def target_distribution(spark, sf_dir):
    return quality.target_distribution(derive_accounts(spark, sf_dir))


@query
def numeric_profile(spark, sf_dir):
    profile = quality.numeric_profile(derive_accounts(spark, sf_dir), PROFILED)
    return rounded(profile.drop("median_mode").withColumnRenamed("column", "column_name"), 4)


@query
def drift(spark, sf_dir):
    parted = split.hash_split(derive_accounts(spark, sf_dir), [KEY])
    found = quality.group_drift(parted, "is_test", False, True, PROFILED, TRAINING_CONTRACT.drift_threshold)
    return rounded(found.withColumnRenamed("column", "column_name"), 4, score=6)


@query
def outliers(spark, sf_dir):
    found = quality.outlier_counts(derive_accounts(spark, sf_dir), PROFILED, TRAINING_CONTRACT.outlier_threshold)
    return found.withColumnRenamed("column", "column_name")


@query
def outlier_rows(spark, sf_dir):
    flagged = quality.with_outlier_flags(derive_accounts(spark, sf_dir), NUMERIC_FEATURES, TRAINING_CONTRACT.outlier_threshold)
    return flagged.select(KEY, F.size("outlier_columns").alias("n_outliers"))


# ---------------------------------------------------------------- features and preprocessing

@query
def engineered_features(spark, sf_dir):
    return with_engineered_features(derive_accounts(spark, sf_dir)).select(KEY, *engineered_names())


@query
def median_impute(spark, sf_dir):
    accounts = derive_accounts(spark, sf_dir)
    fitted = prep.fit_medians(accounts, NUMERIC_FEATURES)
    return rounded(accounts.selectExpr(KEY, *[
        f"coalesce({double(c)}, {num(fitted[c])}) AS {c}" for c in NUMERIC_FEATURES]), 4)


@query
def robust_scale(spark, sf_dir):
    accounts = derive_accounts(spark, sf_dir)
    model = prep.AccountPrep(numericCols=list(NUMERIC_FEATURES), categoricalCols=[]).fit(accounts)
    return rounded(accounts.selectExpr(KEY, *[f"{e} AS {n}" for n, e in model.expressions().items()]))


@query
def category_counts(spark, sf_dir):
    return prep.category_counts(derive_accounts(spark, sf_dir), CATEGORICAL_FEATURES).withColumnRenamed(
        "column", "column_name")


@query
def mode_impute(spark, sf_dir):
    return prep.fit_modes(derive_accounts(spark, sf_dir), CATEGORICAL_FEATURES).withColumnRenamed(
        "column", "column_name")


@query
def one_hot(spark, sf_dir):
    accounts = derive_accounts(spark, sf_dir)
    model = prep.AccountPrep(numericCols=[], categoricalCols=list(CATEGORICAL_FEATURES)).fit(accounts)
    on = array([f"CASE WHEN {e} = 1D THEN {text(n)} END" for n, e in model.expressions().items()])
    return accounts.selectExpr(KEY, f"explode(array_compact({on})) AS feature")


#: Columns that the code queries number; keys have as many codes as there are training rows.
INDEXED = ("AGE", "LIMIT_BAL", KEY)


def _code_index(spark: SparkSession, sf_dir: str, path: str) -> tuple[DataFrame, DataFrame]:
    marked = split.hash_split(derive_accounts(spark, sf_dir), [KEY]).select(*INDEXED, "is_test")
    return marked, codes.index_codes(marked.where("NOT is_test"), INDEXED, path)


@query
def code_index(spark, sf_dir):
    """The codes of the training part with their counts and positions."""
    _, index = _code_index(spark, sf_dir, run_dir(spark, "codes"))
    return index.withColumnRenamed("column", "column_name").select("column_name", "value", "n", "position")


@query
def sparse_codes(spark, sf_dir):
    """The indicators that are set in the stored sparse vectors of all accounts, by an index of the training part."""
    path = run_dir(spark, "codes")
    marked, index = _code_index(spark, sf_dir, path)
    # the key is a coded column too, so rows are named by a copy of it
    vectors = codes.encode(marked.withColumn("row_key", F.col(KEY)), index, INDEXED).select("row_key", "features")
    writers.write_table(vectors, f"{path}/vectors")
    stored = spark.read.schema("row_key bigint, features struct<type: tinyint, size: int, indices: array<int>, values: array<double>>").parquet(f"{path}/vectors")
    return stored.select(F.col("row_key").alias(KEY), F.col("features.size").cast("bigint").alias("width"), F.explode(F.col("features.indices").cast("array<bigint>")).alias("place"))


@query
def standard_scale(spark, sf_dir):
    filled = clean.fill_missing_with_zero(derive_accounts(spark, sf_dir))
    return rounded(prep.standard_scaled(filled, NUMERIC_FEATURES).select(KEY, *NUMERIC_FEATURES))


# ---------------------------------------------------------------- splits and samples

@query
def hash_split(spark, sf_dir):
    return split.hash_split(derive_accounts(spark, sf_dir), [KEY]).select(KEY, "is_test")


@query
def split_counts(spark, sf_dir):
    marked = split.exact_split(derive_accounts(spark, sf_dir), [KEY])
    return marked.groupBy(TARGET, "is_test").agg(F.count("*").alias("n"))


@query
def exact_split(spark, sf_dir):
    return split.exact_split(derive_accounts(spark, sf_dir), [KEY]).select(KEY, "is_test")


@query
def fold_counts(spark, sf_dir):
    folded = split.with_fold(derive_accounts(spark, sf_dir), [KEY])
    return folded.groupBy(TARGET, "fold").agg(F.count("*").alias("n"))


@query
def sample_rows(spark, sf_dir):
    return split.sample_rows(derive_accounts(spark, sf_dir), [KEY], 100).select(KEY)


# ---------------------------------------------------------------- scoring

@query
def score_accounts(spark, sf_dir):
    scored = score.score(derive_accounts(spark, sf_dir), FIXED_SCORECARD)
    return rounded(scored.select(KEY, *score.SCORE_COLUMNS), 6, risk_score=4)


QUERIES["score"] = QUERIES.pop("score_accounts")


@query
def risk_bands(spark, sf_dir):
    return scored_accounts(spark, sf_dir).selectExpr(
        KEY, "risk_category", f"{score.risk_band('probability', EXPLAIN_BANDS)} AS explain_band",
        f"{score.risk_band('probability', DOCUMENTED_BANDS)} AS documented_band")


@query
def batch_score_summary(spark, sf_dir):
    return rounded(score.batch_summary(score.score(derive_accounts(spark, sf_dir), FIXED_SCORECARD)))


@query
def risk_distribution(spark, sf_dir):
    return score.risk_distribution(score.score(derive_accounts(spark, sf_dir), FIXED_SCORECARD))


@query
def decode_labels(spark, sf_dir):
    decoded = score.with_decoded_labels(score.score(derive_accounts(spark, sf_dir), FIXED_SCORECARD))
    return decoded.select(KEY, "gender_label", "education_label", "marital_status_label", "payment_status_label", "verdict")


# ---------------------------------------------------------------- evaluation

@query
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(scored_accounts(spark, sf_dir))


@query
def weighted_metrics(spark, sf_dir):
    return rounded(metrics.weighted_metrics(metrics.confusion_matrix(scored_accounts(spark, sf_dir))))


@query
def roc_auc(spark, sf_dir):
    value = metrics.roc_auc(scored_accounts(spark, sf_dir))
    return rounded(spark.createDataFrame([(value,)], "roc_auc double"))


@query
def evaluation_report(spark, sf_dir):
    return rounded(metrics.evaluation_report(scored_accounts(spark, sf_dir), model_name="fixed scorecard"))


@query
def metric_card(spark, sf_dir):
    report = metrics.evaluation_report(scored_accounts(spark, sf_dir), model_name="fixed scorecard")
    card = metrics.metric_card(report).drop("display")
    return card.withColumn("value", F.round("value", 6))


# ---------------------------------------------------------------- explanation

@query
def linear_attribution(spark, sf_dir):
    df, how = attributed(spark, sf_dir)
    return rounded(explain.contributions(df, how, [KEY]))


@query
def base_value(spark, sf_dir):
    df, how = attributed(spark, sf_dir)
    return rounded(df.agg(F.lit(how.base_value).alias("base_value"), F.count("*").alias("n_rows")))


@query
def global_importance(spark, sf_dir):
    return rounded(explain.global_importance(*attributed(spark, sf_dir), top=5))


@query
def attribution_stats(spark, sf_dir):
    return rounded(explain.attribution_stats(*attributed(spark, sf_dir)))


@query
def top_contributions(spark, sf_dir):
    df, how = attributed(spark, sf_dir)
    top = explain.top_contributions(df, how, [KEY], 5)
    long = top.select(KEY, F.posexplode("explanation").alias("at", "r"))
    return rounded(long.select(KEY, (F.col("at") + 1).alias("position"), "r.*"))


@query
def local_explanation(spark, sf_dir):
    df, how = attributed(spark, sf_dir)
    local = explain.local_explanation(df, how, [KEY])
    p, best = F.col("prediction_probability"), F.col("feature_contributions")[0]
    total = F.aggregate("contributions", F.lit(0.0), lambda acc, r: acc + r["contribution"])
    return rounded(local.select(
        KEY, "prediction", p[0].alias("p_no_default"), p[1].alias("p_default"), "base_value",
        best["feature"].alias("top_feature"), best["contribution"].alias("top_contribution"),
        total.alias("total_contribution")))


@query
def waterfall(spark, sf_dir):
    df, how = attributed(spark, sf_dir)
    return rounded(explain.waterfall(df, how, [KEY], max_display=6))


@query
def push_totals(spark, sf_dir):
    df, how = attributed(spark, sf_dir)
    return rounded(explain.push_totals(df, how, [KEY]))


@query
def impact_table(spark, sf_dir):
    df, how = attributed(spark, sf_dir)
    return rounded(explain.impact_table(df, how, [KEY], top=5))


@query
def partial_dependence(spark, sf_dir):
    df, how = attributed(spark, sf_dir)
    with reused(df.select(*how.features)) as ready:
        top = explain.ranked_features(ready, how, 5)
        rows = explain.partial_dependence(ready, FIXED_SCORECARD, top, points=20).collect()
    curves = spark.createDataFrame(
        rows, "feature string, point int, grid_value double, mean_probability double")
    return rounded(curves, 6, grid_value=4)


@query
def decision_paths(spark, sf_dir):
    df, how = attributed(spark, sf_dir)
    return rounded(explain.decision_paths(df, how, [KEY], 20))


@query
def contribution_matrix(spark, sf_dir):
    df, how = attributed(spark, sf_dir)
    return rounded(explain.contribution_matrix(df, how, [KEY], 50, 15))


@query
def readable_names(spark, sf_dir):
    stats = explain.attribution_stats(*attributed(spark, sf_dir))
    return stats.selectExpr("feature", f"{readable_name('feature')} AS readable_name", "n_rows")


# ---------------------------------------------------------------- fitted models

def prepared_matrices(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, list[str], PipelineModel]:
    """Train matrix (with folds), test matrix, feature names and the fitted stages.

    Accounts and matrices are written once each; train and test are filters on one marked table.
    """
    out = run_dir(spark, "prepared")
    writers.write_table(clean.fill_missing_with_zero(derive_accounts(spark, sf_dir)), f"{out}/accounts")
    marked = split.exact_split(spark.read.parquet(f"{out}/accounts"), [KEY])
    stages = Pipeline(stages=[prep.RepaymentFeatures(), prep.AccountPrep()]).fit(marked.where("NOT is_test"))
    ready = stages.transform(marked).select(KEY, "features", F.col(TARGET).cast("double").alias("label"), "is_test")
    writers.write_table(ready, f"{out}/matrix")
    train_m, test_m = split.train_and_test(spark.read.parquet(f"{out}/matrix"))
    return split.with_fold(train_m, [KEY], label="label"), test_m, stages.stages[1].feature_names(), stages


def _logistic(rows: int) -> LogisticRegression:
    return LogisticRegression(maxIter=1000, tol=1e-4, standardization=False, elasticNetParam=1.0, regParam=1.0 / rows)


def searched(spark: SparkSession, sf_dir: str, config: TrainerConfig) -> DataFrame:
    """The leaderboard of a search; it says how many points of how many published ones were searched."""
    train_m, test_m, _, _ = prepared_matrices(spark, sf_dir)
    with reused(train_m) as cached:
        candidates = train.tune_all(cached, test_m, config)
    return train.leaderboard(spark, candidates)


#: Points of the extreme boosting grid that the queries search: a round of a tree is a job for each level, whatever the data.
FEW_ROUNDS = {"n_estimators": (100,), "max_depth": (3,), "subsample": (0.8,), "colsample_bytree": (0.8,)}


@query
def leaderboard(spark, sf_dir):
    """All four algorithms with their whole published grids: 16, 81, 18 and 243 points."""
    return searched(spark, sf_dir, TrainerConfig(algorithms=(LOGISTIC, RANDOM_FOREST, GRADIENT_BOOSTING, EXTREME_BOOSTING)))


@query
def search_logistic(spark, sf_dir):
    """The whole published grid."""
    return searched(spark, sf_dir, TrainerConfig(algorithms=(LOGISTIC,)))


@query
def search_forest(spark, sf_dir):
    """The whole published grid: 81 points from three fits a fold."""
    return searched(spark, sf_dir, TrainerConfig(algorithms=(RANDOM_FOREST,)))


@query
def search_boosting(spark, sf_dir):
    return searched(spark, sf_dir, TrainerConfig(algorithms=(GRADIENT_BOOSTING,), max_points=2))


@query
def search_extreme_boosting(spark, sf_dir):
    """Second-order boosting at three learning rates; folds and refits grow side by side."""
    return searched(spark, sf_dir, TrainerConfig(algorithms=(EXTREME_BOOSTING,), within=FEW_ROUNDS))


#: Columns and parameters of the boosting round that SQL follows.
ROUND_COLUMNS = ("PAY_0", "EDUCATION", "MARRIAGE", "SEX")
ROUND = boosting.Boosting(n_estimators=1, max_depth=2, learning_rate=0.1, max_bins=256)


@query
def boosting_round(spark, sf_dir):
    """The first tree of second-order boosting on coded columns: nodes with their split, weight and rows."""
    rows = _vectors(spark, sf_dir, ROUND_COLUMNS).withColumn("label", F.col(TARGET).cast("double"))
    tree = boosting.fit_side_by_side(rows, [ROUND], KEY)[0].trees[0]
    names, out, open_ = [*ROUND_COLUMNS, None], [], [(0, "root")]
    while open_:
        at, where = open_.pop()
        inner = tree.left[at] != trees.NONE
        out.append((where, names[tree.feature[at]] if inner else None, float(tree.threshold[at]) if inner else None,
                    None if inner else float(tree.value[at]), int(tree.rows[at])))
        if inner:
            open_ += [(tree.left[at], f"{where} low"), (tree.right[at], f"{where} high")]
    return rounded(spark.createDataFrame(out, "node string, feature string, threshold double, leaf_value double, n bigint"))


@query
def small_nodes(spark, sf_dir):
    """What a minimum split size leaves of a forest: no inner node below it, no row lost, and the scores that a walk with early stops gives."""
    train_m, test_m, _, _ = prepared_matrices(spark, sf_dir)
    grown = RandomForestClassifier(numTrees=5, maxDepth=10, seed=42).fit(train_m)
    cut = trees.collapse(grown, SPLIT_LEAST)
    nodes = trees.ensemble(cut).trees
    walked = trees.staged_probabilities(test_m, trees.ensemble(grown), [trees.Variant(5, None, SPLIT_LEAST)], [KEY])
    scored = cut.transform(test_m).select(KEY, vector_to_array("probability")[1].alias("p"))
    gaps = scored.join(walked, KEY).agg(F.count("*").alias("n_scored"), F.count_if(F.abs(F.col("p") - F.col("probability")) < 1e-9).alias("n_equal"))
    return gaps.select(
        F.lit(len(nodes)).alias("n_trees"), F.lit(sum(int((~t.leaf & (t.rows < SPLIT_LEAST)).sum()) for t in nodes)).alias("n_small"),
        F.lit(sum(bool(t.rows[0] == t.rows[t.leaf].sum()) for t in nodes)).alias("n_whole"), "n_scored", "n_equal")


@query
def penalised_intercept(spark, sf_dir):
    """The liblinear solver on one coded column with an l1 penalty: the optimum has a closed form."""
    rows = derive_accounts(spark, sf_dir).select(
        F.col("SEX"), F.col(TARGET).cast("double").alias("label"), array_to_vector(F.array((F.col("SEX") == 2).cast("double"))).alias("features"))
    estimator = LogisticRegression(maxIter=1000, tol=1e-12, standardization=False)
    model = train.fitted(estimator, rows, {"C": 1.0, "penalty": "l1", "solver": "liblinear"}, rows.count())
    scored = model.transform(rows).select("SEX", vector_to_array("probability")[1].alias("p"))
    return scored.groupBy("SEX").agg(F.count("*").alias("n"), F.round(F.avg("p"), 4).alias("probability"))


@query
def cv_report(spark, sf_dir):
    train_m, _, _, _ = prepared_matrices(spark, sf_dir)
    with reused(train_m) as cached:
        scores = train.fold_scores(cached, LogisticRegression(maxIter=1000, tol=1e-4, standardization=False), {"C": 1.0, "penalty": "l1"})
    return train.cv_report(scores)


@query
def coded_cv_scores(spark, sf_dir):
    """Cross-validation of a logistic model of one coded column, practically without penalty: it ranks by the default rates of the
    other folds, so SQL can work out the area of each fold. Two codes only: a solver does not tell equal rates of several codes
    apart exactly, as SQL does."""
    path = run_dir(spark, "coded-folds")
    accounts = derive_accounts(spark, sf_dir).withColumn("label", F.col(TARGET).cast("double"))
    ready = prep.AccountPrep(numericCols=[], categoricalCols=["SEX"]).fit(accounts).transform(accounts)
    writers.write_table(split.with_fold(ready, [KEY]).select("features", "label", "fold"), path)
    scores = train.fold_scores(spark.read.parquet(path), LogisticRegression(maxIter=1000, tol=1e-12, standardization=False), {"C": 1e12})
    report = train.cv_report(scores)
    return rounded(report.select("mean_cv_score", "std_cv_score", F.posexplode("cv_scores").alias("fold", "auc")), 5)


@query
def stump_importance(spark, sf_dir):
    """A tree of one split gives all importance to the column of that split."""
    rows = _vectors(spark, sf_dir, ROUND_COLUMNS).withColumn("label", F.col(TARGET).cast("double"))
    model = RandomForestClassifier(numTrees=1, maxDepth=1, featureSubsetStrategy="all", bootstrap=False, seed=42).fit(rows)
    return train.feature_importances(model, list(ROUND_COLUMNS))


@query
def coded_logistic(spark, sf_dir):
    """An unpenalised logistic model on one coded column: its probabilities are the default rates of the codes."""
    accounts = derive_accounts(spark, sf_dir).withColumn("label", F.col(TARGET).cast("double"))
    fitted = prep.AccountPrep(numericCols=[], categoricalCols=["EDUCATION"]).fit(accounts)
    model = LogisticRegression(maxIter=1000, tol=1e-10, standardization=False, regParam=0.0).fit(fitted.transform(accounts))
    card = train.as_scorecard(model, fitted.feature_names())
    logit = fitted.logit(card.intercept, [card.weights[n] for n in fitted.feature_names()])
    return accounts.selectExpr("EDUCATION", f"1 / (1 + exp(-({logit}))) AS p").groupBy("EDUCATION").agg(
        F.count("*").alias("n"), F.round(F.avg("p"), 4).alias("default_rate"))


@query
def tree_importances(spark, sf_dir):
    train_m, _, names, _ = prepared_matrices(spark, sf_dir)
    model = RandomForestClassifier(numTrees=50, maxDepth=8, seed=42).fit(train_m)
    return train.feature_importances(model, names)


@query
def fitted_scores(spark, sf_dir):
    """Fit, save, load and score: the loaded pipeline scores every account."""
    train_m, _, _, stages = prepared_matrices(spark, sf_dir)
    fitted = PipelineModel(stages=[*stages.stages, _logistic(train_m.count()).fit(train_m)])
    path = run_dir(spark, "model")
    writers.save_model(fitted, path)
    scored = score.score_with_pipeline(derive_accounts(spark, sf_dir), readers.load_model(path))
    return scored.select(KEY, *score.SCORE_COLUMNS)


@query
def prepared_matrix(spark, sf_dir):
    """Stored matrices of both parts in long form: all scaled values and the active indicators."""
    train_m, test_m, names, stages = prepared_matrices(spark, sf_dir)
    scaled = len(stages.stages[1].fitted()["numeric"])
    both = train_m.drop("fold").unionByName(test_m).select(KEY, vector_to_array("features").alias("x"))
    long = both.selectExpr(KEY, f"posexplode(x) AS (at, value)").where(f"at < {scaled} OR value = 1")
    names_sql = array([text(n) for n in names])
    return long.selectExpr(KEY, f"get({names_sql}, at) AS feature", "round(value, 6) AS value")


@query
def matrix_export(spark, sf_dir):
    """Both matrices with keys as named text columns, read back in long form: scaled values, active indicators, label."""
    train_m, test_m, names, stages = prepared_matrices(spark, sf_dir)
    path = run_dir(spark, "export")
    writers.write_table(readers.matrix_columns(train_m.drop("fold").unionByName(test_m), names, key=[KEY]), path, "csv")
    back = spark.read.option("header", True).schema(T.StructType([
        T.StructField(KEY, T.LongType()), *(T.StructField(n, T.DoubleType()) for n in [*names, "label"])])).csv(path)
    scaled = len(stages.stages[1].fitted()["numeric"])
    cells = F.array(*[F.struct(F.lit(i).alias("at"), F.lit(n).alias("feature"), F.col(q(n)).alias("value")) for i, n in enumerate([*names, "label"])])
    long = back.select(KEY, F.inline(cells)).where(f"at < {scaled} OR value = 1 OR feature = 'label'")
    return long.selectExpr(KEY, "feature", "round(value, 6) AS value")


@query
def sampled_attribution(spark, sf_dir):
    train_m, test_m, names, _ = prepared_matrices(spark, sf_dir)
    model = _logistic(train_m.count()).fit(train_m)
    background = explain.background_matrix(train_m, [KEY], 100)
    sample = split.sample_rows(test_m, [KEY], 1000)
    return explain.sampled_linear_attribution(sample, model, names, KEY, background)


@query
def sampled_tree_attribution(spark, sf_dir):
    """Boosted trees explained for the configured sample against the configured background, in log-odds."""
    train_m, test_m, names, _ = prepared_matrices(spark, sf_dir)
    config = ExplainConfig()
    model = GBTClassifier(maxIter=20, maxDepth=3, seed=config.seed).fit(train_m)
    background = explain.background_matrix(train_m, [KEY], config.background_rows)
    sample = split.sample_rows(test_m, [KEY], config.sample_rows)
    return explain.tree_attribution(sample, explain.tree_leaves(model), names, KEY, background, True)


def _vectors(spark: SparkSession, sf_dir: str, columns: tuple[str, ...]) -> DataFrame:
    """Accounts with some columns as a feature vector."""
    cells = F.array(*[F.col(c).cast("double") for c in columns])
    return derive_accounts(spark, sf_dir).select(KEY, TARGET, array_to_vector(cells).alias("features"))


@query
def cover_tree_attribution(spark, sf_dir):
    """Two fixed trees explained by the training cover of their nodes; SQL enumerates the subsets of known columns."""
    columns = list(FIXED_TREE_COLUMNS)
    model = trees.Ensemble(tuple(trees.from_nested(t, columns) for t in FIXED_COVER_TREES), True)
    sample = split.sample_rows(_vectors(spark, sf_dir, FIXED_TREE_COLUMNS), [KEY], ExplainConfig().sample_rows)
    long = trees.cover_attribution(sample, model, columns, KEY)
    return rounded(long.select(KEY, "feature", "contribution", "base_value", "probability"))


@query
def kernel_attribution(spark, sf_dir):
    """Kernel-weighted coalitions of a fixed logistic model of four columns: all of them, so SQL's enumeration gives the same."""
    columns = tuple(FIXED_KERNEL_WEIGHTS)
    rows = _vectors(spark, sf_dir, columns)
    config = ExplainConfig()
    model = train.logistic_model(spark, list(FIXED_KERNEL_WEIGHTS.values()), FIXED_KERNEL_INTERCEPT)
    background = explain.background_matrix(rows, [KEY], config.background_rows)
    sample = split.sample_rows(rows, [KEY], config.sample_rows)
    long = kernel.kernel_attribution(sample, model, columns, KEY, background, config.coalitions)
    return rounded(long.select(KEY, "feature", "contribution", "base_value", "probability"))


@query
def fixed_tree_attribution(spark, sf_dir):
    """The same with three fixed trees, which SQL can follow."""
    columns = list(FIXED_TREE_COLUMNS)
    vectors = _vectors(spark, sf_dir, FIXED_TREE_COLUMNS).drop(TARGET)
    leaves = [explain.Leaf(value, tuple((columns.index(c), lo, hi) for c, lo, hi in conditions)) for value, conditions in FIXED_LEAVES]
    config = ExplainConfig()
    background = explain.background_matrix(vectors, [KEY], config.background_rows)
    sample = split.sample_rows(vectors, [KEY], config.sample_rows)
    long = explain.tree_attribution(sample, leaves, columns, KEY, background, True)
    return rounded(long.select(KEY, "feature", "contribution"))


# What must hold for any fitted model, so that SQL can say it from the tables alone.

@query
def fitted_score_facts(spark, sf_dir):
    """Every account is scored, and class, risk score and band follow from the probability."""
    scored = fitted_scores(spark, sf_dir)
    holds = lambda test, name: F.count_if(F.expr(test)).alias(name)
    return scored.agg(
        F.count("*").alias("n"), holds("probability > 0 AND probability < 1", "in_range"), holds("prediction = CAST(probability > 0.5 AS INT)", "class_agrees"),
        holds("abs(risk_score - 100 * probability) < 1e-9", "score_agrees"),
        holds("risk_category = CASE WHEN probability < 0.3 THEN 'Low Risk' WHEN probability < 0.6 THEN 'Medium Risk' ELSE 'High Risk' END", "band_agrees"))


@query
def tree_importance_facts(spark, sf_dir):
    """One importance for each feature, adding up to one."""
    return tree_importances(spark, sf_dir).agg(F.count("*").alias("n_features"), F.round(F.sum("importance"), 6).alias("total"))


@query
def sampled_attribution_facts(spark, sf_dir):
    """All features of each sampled test row; base value and contributions add up to the probability."""
    rows = sampled_attribution(spark, sf_dir).groupBy(KEY).agg(
        F.count("*").alias("n"), (F.first("base_value") + F.sum("contribution") - F.first("probability")).alias("gap"))
    return rows.agg(F.count("*").alias("n_rows"), F.max("n").alias("n_features"), F.count_if(F.abs("gap") < 1e-9).alias("n_exact"))


@query
def cv_report_facts(spark, sf_dir):
    """Five fold scores that are areas; their mean and deviation are those reported."""
    scores = F.col("cv_scores")
    mean = F.aggregate(scores, F.lit(0.0), lambda a, x: a + x) / F.size(scores)
    spread = F.sqrt(F.aggregate(scores, F.lit(0.0), lambda a, x: a + (x - F.col("mean_cv_score")) ** 2) / F.size(scores))
    return cv_report(spark, sf_dir).select(
        F.size(scores).alias("folds"), F.forall(scores, lambda x: (x >= 0) & (x <= 1)).alias("in_range"),
        (F.abs(mean - F.col("mean_cv_score")) < 1e-9).alias("mean_agrees"), (F.abs(spread - F.col("std_cv_score")) < 1e-9).alias("deviation_agrees"))


# ---------------------------------------------------------------- streams

def _landed(spark: SparkSession, df: DataFrame, name: str) -> tuple[str, str]:
    out = run_dir(spark, name)
    writers.write_table(df, f"{out}/landing")
    return out, f"{out}/landing"


def _scored_stream_output(spark: SparkSession, sf_dir: str) -> str:
    accounts = derive_accounts(spark, sf_dir)
    out, landing = _landed(spark, accounts, "stream-score")
    records = streams.read_stream(spark, landing, accounts.schema)
    streams.finish(streams.run_scoring(
        records, FIXED_SCORECARD, f"{out}/scored", f"{out}/quarantine", f"{out}/checkpoint"))
    return out


@query
def stream_score(spark, sf_dir):
    out = _scored_stream_output(spark, sf_dir)
    scored = spark.read.parquet(f"{out}/scored")
    return rounded(scored.select(KEY, "prediction", "probability", "risk_category"))


@query
def stream_quarantine(spark, sf_dir):
    out = _scored_stream_output(spark, sf_dir)
    return spark.read.parquet(f"{out}/quarantine").select(KEY, "first_violation")


#: The coded column that each model version of the stream is fitted on.
VERSION_COLUMNS = ("EDUCATION", "MARRIAGE")


@query
def versioned_stream(spark, sf_dir):
    """Fitted models in a registry: version 2 lands between two batches, and every record carries the version that scored it."""
    accounts = derive_accounts(spark, sf_dir)
    out = run_dir(spark, "stream-versions")
    writers.write_table(accounts, f"{out}/accounts")
    accounts = spark.read.parquet(f"{out}/accounts")
    labelled = accounts.withColumn("label", F.col(TARGET).cast("double"))
    for version, column in enumerate(VERSION_COLUMNS, 1):
        prepared = Pipeline(stages=[prep.RepaymentFeatures(), prep.AccountPrep(numericCols=[], categoricalCols=[column])]).fit(labelled)
        classifier = LogisticRegression(maxIter=1000, tol=1e-10, standardization=False, regParam=0.0).fit(prepared.transform(labelled))
        registry.publish(PipelineModel(stages=[*prepared.stages, classifier]), f"{out}/models", version)
        accounts.where(F.col(KEY) % 2 == version - 1).write.mode("append").parquet(f"{out}/landing")
        records = streams.read_stream(spark, f"{out}/landing", accounts.schema)
        streams.finish(registry.run_versioned_scoring(records, f"{out}/models", f"{out}/audit", f"{out}/checkpoint"))
    audit = spark.read.parquet(f"{out}/audit/scored")
    return audit.select(KEY, F.round("probability", 4).alias("probability"), "model_version")


#: Columns watched for drift in the request stream.
DRIFT_COLUMNS = (*NUMERIC_FEATURES, *CATEGORICAL_FEATURES)


def _request_stream(spark: SparkSession, sf_dir: str, inputs: tuple[str, ...] = ()) -> tuple[str, DataFrame, DataFrame]:
    """Events as scoring requests, looked up in the written account scores, read back as a stream.

    One account in ten is closed and not in the table, so some requests have no account.
    """
    scored = scored_accounts(spark, sf_dir).select(KEY, *score.SCORE_COLUMNS, *inputs)
    out, landing = _landed(spark, scored.where(F.col(KEY) % CLOSED != 0), "stream-requests")
    static = spark.read.parquet(landing)
    schema = table(spark, sf_dir, "events").schema
    events = streams.read_stream(spark, f"{sf_dir}/[e]vents.parquet", schema)
    requests = events.select(
        F.col("event_id").alias("request_id"), F.col("user_id").alias(KEY),
        streams.as_instant("ts", schema["ts"].dataType).alias("ts"))
    streams.finish(streams.run_lookup(requests, static, KEY, f"{out}/requests", f"{out}/checkpoint-lookup"))
    looked_up = spark.read.parquet(f"{out}/requests").drop("batch_id").schema
    return out, static, streams.read_stream(spark, f"{out}/requests", looked_up)


def _monitored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    out, static, requests = _request_stream(spark, sf_dir)
    streams.finish(streams.run_monitor(requests, f"{out}/windows", f"{out}/checkpoint"))
    windows = streams.latest_windows(spark.read.parquet(f"{out}/windows"))
    day = streams.utc_day(F.col("window.start")).cast("string")
    return static, windows.select(day.alias("day"), *[c for c in windows.columns if c != "window"])


@query
def window_monitor(spark, sf_dir):
    return rounded(_monitored(spark, sf_dir)[1])


@query
def window_drift(spark, sf_dir):
    static, windows = _monitored(spark, sf_dir)
    drifted = streams.window_drift(windows, *streams.baseline_of(static))
    return rounded(drifted.select("day", "n", "score", "drifted"))


@query
def stream_column_drift(spark, sf_dir):
    """Every input column of the requests of a day against the stored profile of the accounts."""
    out, static, requests = _request_stream(spark, sf_dir, DRIFT_COLUMNS)
    writers.write_table(quality.moment_profile(static, DRIFT_COLUMNS), f"{out}/profile")
    streams.finish(streams.run_profile(requests, DRIFT_COLUMNS, f"{out}/profiles", f"{out}/checkpoint"))
    newest = streams.latest_windows(spark.read.parquet(f"{out}/profiles"), ["column"])
    found = streams.column_drift(newest, spark.read.parquet(f"{out}/profile"))
    day = streams.utc_day(F.col("window.start")).cast("string").alias("day")
    return rounded(found.select(day, F.col("column").alias("column_name"), "n", "score", "drifted"))


#: How long the closing monitor waits for late requests.
LATENESS = "3 days"


@query
def late_requests(spark, sf_dir):
    """Requests with even numbers come first, so many of the others are late: windows closed once, windows still open, late rows by day."""
    scored = scored_accounts(spark, sf_dir).select(KEY, *score.SCORE_COLUMNS)
    out = run_dir(spark, "stream-late")
    writers.write_table(scored.where(F.col(KEY) % CLOSED != 0), f"{out}/accounts")
    events = table(spark, sf_dir, "events")
    requests = events.select(F.col("event_id").alias("request_id"), F.col("user_id").alias(KEY),
                             streams.as_instant("ts", events.schema["ts"].dataType).alias("ts"))
    requests = streams.with_accounts(requests, spark.read.parquet(f"{out}/accounts"), KEY)
    for half in (0, 1):
        requests.where(F.col("request_id") % 2 == half).write.mode("append").parquet(f"{out}/landing")
        arriving = streams.read_stream(spark, f"{out}/landing", requests.schema)
        streams.finish(streams.run_late_split(arriving, out, f"{out}/checkpoint-split", lateness=LATENESS))
        marked = streams.read_stream(spark, f"{out}/marked", T.StructType([*requests.schema.fields, T.StructField("late", T.BooleanType())]))
        streams.finish(streams.run_closed_windows(marked.where("NOT late"), f"{out}/closed", f"{out}/checkpoint-closed", lateness=LATENESS))
    day = lambda instant: streams.utc_day(instant).cast("string").alias("day")
    closed = spark.read.parquet(f"{out}/closed").select(day(F.col("window.start")), F.lit("closed").alias("part"), "n", "mean_probability")
    part = F.when(F.col("late"), "late").otherwise("open").alias("part")
    rest = spark.read.parquet(f"{out}/marked").groupBy(day(F.col("ts")), part).agg(
        F.count("*").alias("n"), F.avg("probability").alias("mean_probability"))
    gone = closed.select("day", F.lit("open").alias("part"))
    return rounded(closed.unionByName(rest.join(gone, ["day", "part"], "left_anti")))


@query
def audit_trail(spark, sf_dir):
    out, _, requests = _request_stream(spark, sf_dir)
    streams.finish(streams.run_audit(requests, f"{out}/audit", f"{out}/checkpoint", "request_id", "ts", "fixed-1"))
    audit = spark.read.parquet(f"{out}/audit")
    return rounded(audit.select("request_id", KEY, F.col("day").cast("string").alias("day"), "probability",
                                "risk_category", "status", "model_version"))
