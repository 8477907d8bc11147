import datetime as dt

import pytest
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.sql import functions as F

from riskframe.config import (
    KEY, LOGISTIC_GRID, TARGET, AlgorithmConfig, ExplainConfig, JobConfig, TrainerConfig, algorithm,
)
from riskframe.operators import clean, contract, prep, score, split, train
from riskframe.operators.score import FIXED_SCORECARD
from riskframe.plans import jobs
from riskframe.sources import readers, writers
from riskframe.streaming import scoring as streams

SMALL_GRID = AlgorithmConfig("Logistic Regression", "logistic", {"C": (0.1, 1.0), "penalty": ("l1", "l2")})
SMALL = TrainerConfig(algorithms=(SMALL_GRID,), folds=2, max_iter=20)


@pytest.fixture(scope="module")
def matrices(accounts):
    df = clean.fill_missing_with_zero(accounts)
    features = prep.RepaymentFeatures()
    marked = split.exact_split(df, [KEY])
    train_rows, test_rows = split.train_and_test(marked)
    fitted = prep.AccountPrep().fit(features.transform(train_rows))
    ready = lambda part: fitted.transform(features.transform(part)).select(
        KEY, "features", F.col(TARGET).cast("double").alias("label"))
    return split.with_fold(ready(train_rows), [KEY], 2, label="label").cache(), ready(test_rows).cache(), fitted.feature_names()


# ---------------------------------------------------------------- training

def test_grid_expansion_and_penalty_scale(spark):
    assert len(train.expand_grid(LOGISTIC_GRID)) == 16
    lr = LogisticRegression()
    params = train.param_map(lr, {"C": 0.1, "penalty": "l1"}, 1000)
    assert params[lr.regParam] == pytest.approx(0.01) and params[lr.elasticNetParam] == 1.0
    untuned = train.param_map(lr, {}, 1000)
    assert untuned[lr.regParam] == pytest.approx(1 / 1000) and untuned[lr.elasticNetParam] == 0.0
    assert algorithm("Logistic Regression").grid == {"C": (0.1, 1.0, 10.0), "penalty": ("l2",)}
    assert algorithm("Random Forest", {}).grid == {}
    with pytest.raises(ValueError):
        train.param_map(RandomForestClassifier(), {"learning_rate": 0.1}, 10)
    rf = RandomForestClassifier()
    assert train.param_map(rf, {"n_estimators": 7, "max_depth": 3, "colsample_bytree": 1.0}, 10) == {
        rf.numTrees: 7, rf.maxDepth: 3, rf.featureSubsetStrategy: "all"}


def test_leaderboard_and_selection(spark, matrices):
    train_m, test_m, names = matrices
    config = TrainerConfig(algorithms=(SMALL_GRID, AlgorithmConfig("Forest", "forest", {"n_estimators": (5,), "max_depth": (3, 4)}),
                                       AlgorithmConfig("Plain", "logistic")), folds=2, max_iter=20)
    candidates = train.tune_all(train_m, test_m, config)
    board = train.leaderboard(spark, candidates).collect()
    assert [r.test_auc for r in board] == sorted((c.test_score for c in candidates), reverse=True)
    assert candidates[0].params in train.expand_grid(SMALL_GRID.grid) and 0.5 < candidates[0].test_score <= 1
    assert candidates[2].params == {} and candidates[2].cv_score is None
    assert [(c.searched, c.published) for c in candidates] == [(4, 4), (2, 2), (0, 0)]
    bounded = train.tune(train_m, test_m, SMALL_GRID, TrainerConfig(folds=2, max_iter=5, max_points=2))
    assert (bounded.searched, bounded.published) == (2, 4)
    by_test = train.select_best(candidates, TrainerConfig(select_by="test"))
    assert by_test.test_score == max(c.test_score for c in candidates)
    assert train.select_best([candidates[0], candidates[0]]) is candidates[0]
    importances = train.feature_importances(candidates[1].model, names)
    assert importances.count() == len(names)
    assert importances.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert train.feature_importances(candidates[0].model, names) is None


def test_cross_validation_report(matrices):
    train_m, _, _ = matrices
    scores = train.fold_scores(train_m, LogisticRegression(maxIter=10), {}, TrainerConfig(folds=2))
    row = train.cv_report(scores).first()
    a, b = row.cv_scores
    assert row.mean_cv_score == pytest.approx((a + b) / 2) and row.std_cv_score == pytest.approx(abs(a - b) / 2)


# ---------------------------------------------------------------- jobs

def test_train_score_and_explain_jobs(spark, accounts, tmp_path):
    out = str(tmp_path / "run")
    raw = accounts.unionByName(accounts.limit(3).withColumn(KEY, F.col(KEY) + 10**9))
    filled = clean.fill_missing_with_zero(raw)
    with pytest.raises(contract.ContractViolation):
        jobs.train_job(filled, str(tmp_path / "gated"), JobConfig(trainer=SMALL))
    result = jobs.train_job(filled, out, JobConfig(trainer=SMALL, gate=False), run_id="r1")
    n = accounts.count()
    assert spark.read.parquet(f"{out}/train").count() + spark.read.parquet(f"{out}/test").count() == n
    report = result.report.first()
    assert report.true_negatives + report.false_positives + report.false_negatives + report.true_positives == \
        spark.read.parquet(f"{out}/test").count()
    assert 0.5 < report.roc_auc <= 1 and report.recall == pytest.approx(report.accuracy)
    for name in ("checks", "status", "profile", "leaderboard", "metrics", "attribution", "local_contributions"):
        table = spark.read.parquet(f"{out}/reports/{name}")
        assert table.count() > 0 and {r.run_id for r in table.select("run_id").distinct().collect()} == {"r1"}
    matrix = readers.matrix_columns(readers.read_matrix(spark, f"{out}/test_matrix"),
                                    result.model.stages[1].feature_names())
    assert matrix.columns[-1] == "label" and len(matrix.columns) == len(result.model.stages[1].feature_names()) + 1

    model = readers.load_model(f"{out}/model")
    summary = jobs.score_job(accounts, model, str(tmp_path / "scored")).first()
    good, bad = spark.read.parquet(str(tmp_path / "scored/scored")), spark.read.parquet(str(tmp_path / "scored/quarantine"))
    assert good.count() + bad.count() == n and summary.total_records == good.count()
    everything = jobs.score_job(accounts, model, str(tmp_path / "all"), check=False).first()
    assert everything.total_records == n
    stats = jobs.explain_job(accounts, model, str(tmp_path / "why"), run_id="r2").collect()
    assert len(stats) == len(model.stages[1].feature_names()) and stats[0].n_rows == n


def test_tree_pipeline_scores_and_explains(spark, accounts, tmp_path):
    forest = AlgorithmConfig("Forest", "forest", {"n_estimators": (3,), "max_depth": (3,)})
    config = JobConfig(trainer=TrainerConfig(algorithms=(forest,), folds=2), gate=False,
                       explain=ExplainConfig(sample_rows=5, background_rows=4))
    out = str(tmp_path / "tree")
    result = jobs.train_job(clean.fill_missing_with_zero(accounts), out, config)
    why = spark.read.parquet(f"{out}/reports/attribution").first()
    assert why.method == "tree" and why.n_rows == 5
    assert spark.read.parquet(f"{out}/reports/importances").count() == why.n_features
    parts = spark.read.parquet(f"{out}/reports/sampled_contributions").groupBy(KEY, "base_value", "probability").agg(
        F.sum("contribution").alias("c"))
    assert parts.selectExpr("max(abs(base_value + c - probability))").first()[0] < 1e-9
    assert jobs.score_job(accounts, result.model, str(tmp_path / "s"), check=False).first().total_records == accounts.count()


def test_command_line(spark, accounts, tmp_path):
    result_dir = str(tmp_path / "cli")
    source = str(tmp_path / "in.csv")
    writers.write_table(clean.fill_missing_with_zero(accounts), source, "csv")
    rows = readers.read_accounts(spark, source, "csv")
    model = jobs.train_job(rows, result_dir, JobConfig(trainer=SMALL, gate=False)).model
    writers.save_model(model, str(tmp_path / "m"))
    jobs.main(["score", "--input", source, "--format", "csv", "--model", str(tmp_path / "m"), "--output", str(tmp_path / "o")])
    assert spark.read.parquet(str(tmp_path / "o/reports/summary")).count() == 1
    with pytest.raises(SystemExit):
        jobs.main(["score", "--input", source, "--output", str(tmp_path / "o")])


def test_accounts_without_a_key_get_one_from_their_content(accounts):
    keyed = jobs.with_row_key(accounts.drop(KEY), KEY)
    assert keyed.select(KEY).distinct().count() == accounts.drop(KEY).distinct().count()


# ---------------------------------------------------------------- streams

def ts(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def test_stream_scoring_equals_batch_and_replays_cleanly(spark, accounts, tmp_path):
    landing = str(tmp_path / "landing")
    accounts.repartition(4).write.parquet(landing)
    for _ in range(2):  # the second run sees nothing new
        records = streams.read_stream(spark, landing, accounts.schema, max_files=1)
        streams.finish(streams.run_scoring(records, FIXED_SCORECARD, str(tmp_path / "s"), str(tmp_path / "q"),
                                           str(tmp_path / "cp")))
    scored, quarantine = spark.read.parquet(str(tmp_path / "s")), spark.read.parquet(str(tmp_path / "q"))
    assert scored.count() + quarantine.count() == accounts.count()
    batch = score.score(accounts, FIXED_SCORECARD).select(KEY, "probability", "risk_category")
    assert scored.select(KEY, "probability", "risk_category").exceptAll(batch).count() == 0
    assert quarantine.where("size(violations) = 0").count() == 0


@pytest.fixture()
def requests_dir(spark, tmp_path):
    """Three files, one micro-batch each: in order, then late within and beyond the watermark."""
    path = str(tmp_path / "requests")
    batches = [
        [(1, ts(1, 1), 0.2), (2, ts(1, 2), 0.9), (3, ts(4), 0.5)],
        [(4, ts(3, 12), 0.7), (3, ts(4), 0.5)],
        [(5, ts(1, 3), 0.1), (6, ts(5), 0.4)],
    ]
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "request_id bigint, ts timestamp_ntz, probability double")
        scored = score.with_score_columns(df.withColumnRenamed("probability", "p"), "p")
        scored.coalesce(1).write.mode("append").parquet(path)
        import os
        import time
        for f in os.listdir(path):
            if f.endswith(".parquet") and not f.startswith("batch"):
                os.rename(f"{path}/{f}", f"{path}/batch{i}.parquet")
                stamp = time.time() - 100 + 10 * i
                os.utime(f"{path}/batch{i}.parquet", (stamp, stamp))
    return path


def request_stream(spark, path):
    schema = spark.read.parquet(path).schema
    rows = streams.read_stream(spark, path, schema, glob="batch*.parquet", max_files=1)
    return rows.withColumn("ts", streams.as_instant("ts", schema["ts"].dataType))


def test_windows_accept_late_rows_until_the_watermark(spark, requests_dir, tmp_path):
    streams.finish(streams.run_monitor(request_stream(spark, requests_dir), str(tmp_path / "w"), str(tmp_path / "cp")))
    windows = streams.latest_windows(spark.read.parquet(str(tmp_path / "w")))
    rows = windows.select(streams.utc_day(F.col("window.start")).cast("string").alias("day"), "n", "high_risk_count").collect()
    # request 4 is late but inside one day; request 5 is three days late and dropped
    assert {r.day: r.n for r in rows} == {"2024-01-01": 2, "2024-01-03": 1, "2024-01-04": 2, "2024-01-05": 1}
    assert {r.day: r.high_risk_count for r in rows}["2024-01-01"] == 1


def test_requests_without_an_account_are_kept(spark, tmp_path):
    accounts = spark.createDataFrame([(1, 0.2), (2, 0.9)], "account_id bigint, probability double")
    requests = spark.createDataFrame([(10, 1), (11, 1), (12, 7), (13, None)], "request_id bigint, account_id bigint")
    rows = streams.with_accounts(requests, accounts, "account_id").collect()
    assert sorted((r.request_id, r.probability, r.status) for r in rows) == [
        (10, 0.2, "scored"), (11, 0.2, "scored"), (12, None, "unknown account"), (13, None, "unknown account")]


def test_audit_trail_writes_each_request_once(spark, requests_dir, tmp_path):
    streams.finish(streams.run_audit(request_stream(spark, requests_dir), str(tmp_path / "a"), str(tmp_path / "cp"),
                                     "request_id", "ts", "v1"))
    audit = spark.read.parquet(str(tmp_path / "a"))
    assert sorted(r.request_id for r in audit.collect()) == [1, 2, 3, 4, 6]
    assert {r.model_version for r in audit.collect()} == {"v1"}
    assert sorted({str(r.day) for r in audit.select("day").distinct().collect()}) == [
        "2024-01-01", "2024-01-03", "2024-01-04", "2024-01-05"]


def test_window_drift(spark):
    windows = spark.createDataFrame([(1, 0.5), (2, 0.62)], "w int, mean_probability double")
    rows = streams.window_drift(windows, 0.5, 0.2).orderBy("w").collect()
    assert [r.drifted for r in rows] == [False, True] and rows[1].score == pytest.approx(0.6)


def test_working_dir_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert not named or writers.working_dir(spark) == named.rstrip("/")
