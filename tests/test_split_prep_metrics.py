import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskframe.config import CATEGORICAL_FEATURES, KEY, NUMERIC_FEATURES, TARGET, SplitConfig
from riskframe.operators import metrics, prep, split
from riskframe.operators.features import with_engineered_features


# ---------------------------------------------------------------- splits

@pytest.mark.parametrize("share", [0.2, 0.37])
def test_exact_split_sizes(accounts, share):
    marked = split.exact_split(accounts, [KEY], SplitConfig(test_share=share)).cache()
    n = accounts.count()
    train, test = split.train_and_test(marked)
    assert test.count() == math.ceil(share * n) and train.count() + test.count() == n
    assert train.select(KEY).intersect(test.select(KEY)).count() == 0
    by_class = {r[TARGET]: (r["n"], r["t"]) for r in marked.groupBy(TARGET).agg(
        F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()}
    for total, taken in by_class.values():
        assert abs(taken - math.ceil(share * n) * total / n) < 1


def test_exact_split_does_not_depend_on_layout(accounts):
    a = split.exact_split(accounts.repartition(7), [KEY]).where("is_test").select(KEY)
    b = split.exact_split(accounts.coalesce(1).orderBy(F.desc(KEY)), [KEY]).where("is_test").select(KEY)
    assert sorted(a.collect()) == sorted(b.collect())


def test_split_of_one_class_missing_labels_and_nothing(make_accounts):
    same = make_accounts(*({"AGE": 20 + i} for i in range(10)))
    assert split.exact_split(same, [KEY]).where("is_test").count() == 2
    holed = make_accounts(*({TARGET: None if i < 5 else 1} for i in range(10)))
    assert split.exact_split(holed, [KEY]).where("is_test").count() == 2
    assert split.exact_split(same.where("false"), [KEY]).count() == 0
    with pytest.raises(ValueError):
        split.exact_split(same.drop(TARGET), [KEY])


def test_plain_split_and_seed(accounts):
    plain = split.exact_split(accounts, [KEY], SplitConfig(stratify=False)).where("is_test").select(KEY).collect()
    assert len(plain) == math.ceil(0.2 * accounts.count())
    other = split.exact_split(accounts, [KEY], SplitConfig(stratify=False, seed=1)).where("is_test").select(KEY).collect()
    assert sorted(plain) != sorted(other)


def test_hash_split_needs_no_shuffle(accounts, capsys):
    split.hash_split(accounts, [KEY]).explain()
    assert "Exchange" not in capsys.readouterr().out


def test_samples(accounts):
    n = accounts.count()
    some = split.sample_rows(accounts, [KEY], 20)
    assert some.count() == 20
    assert sorted(some.select(KEY).collect()) == sorted(
        split.sample_rows(accounts.repartition(5), [KEY], 20).select(KEY).collect())
    assert split.sample_rows(accounts, [KEY], n + 100).count() == n


def test_folds_cover_everything(accounts):
    folded = split.with_fold(accounts, [KEY], 5)
    assert {r.fold for r in folded.select("fold").distinct().collect()} == {0, 1, 2, 3, 4}
    assert {r.fold for r in split.with_fold(accounts, [KEY], 1, label=None).collect()} == {0}


def test_folds_hold_their_share_of_every_class(spark):
    df = spark.range(2000).selectExpr(f"id AS {KEY}", f"CAST(id % 100 = 0 AS BIGINT) AS {TARGET}")
    counts = {(r[TARGET], r.fold): r["count"] for r in split.with_fold(df, [KEY], 5).groupBy(TARGET, "fold").count().collect()}
    assert all(abs(counts[1, k] - 4) <= 1 and abs(counts[0, k] - 396) <= 4 for k in range(5))


# ---------------------------------------------------------------- preprocessing

def test_fitted_statistics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 7.0, 2), (2.0, 7.0, 1), (3.0, None, 1), (10.0, 7.0, 2), (None, 7.0, -1)],
                               "x double, k double, code bigint")
    model = prep.AccountPrep(numericCols=["x", "k"], categoricalCols=["code"]).fit(df)
    x = model.fitted()["numeric"]["x"]
    filled = [1, 2, 3, 10, 2.5]
    assert (x["fill"], x["center"]) == (2.5, 2.5) and x["scale"] == np.quantile(filled, 0.75) - np.quantile(filled, 0.25)
    assert model.fitted()["numeric"]["k"]["scale"] == 1.0  # constant column
    assert model.fitted()["coded"]["code"] == {"fill": 1, "categories": [-1, 1, 2]}  # tie: smallest wins
    assert model.feature_names() == ["x", "k", "code_1", "code_2"]
    unseen = spark.createDataFrame([(None, 9.0, 5), (4.0, 7.0, None)], "x double, k double, code bigint")
    rows = [list(r[0]) for r in model.transform(unseen).select(vector_to_array("features")).collect()]
    assert rows[0] == [0.0, 2.0, 0.0, 0.0]  # unknown category: all zeros
    assert rows[1] == [(4.0 - 2.5) / x["scale"], 0.0, 1.0, 0.0]


def test_vector_matches_expressions_and_carries_names(accounts):
    df = with_engineered_features(accounts)
    model = prep.AccountPrep().fit(df)
    out = model.transform(df)
    names = model.feature_names()
    assert len(names) == 25 + sum(len(e["categories"]) - 1 for e in model.fitted()["coded"].values())
    assert [a["name"] for a in out.schema["features"].metadata["ml_attr"]["attrs"]["numeric"]] == names
    wide = out.selectExpr("features", *[f"{e} AS f{i}" for i, e in enumerate(model.expressions().values())])
    for r in wide.limit(20).collect():
        assert list(r.features) == pytest.approx([r[f"f{i}"] for i in range(len(names))])
    assert out.columns == [*df.columns, "features"]


def test_a_column_of_thousands_of_codes_fits(spark):
    df = spark.range(5000).selectExpr("id * 3 AS code", "CAST(id AS DOUBLE) AS x")
    model = prep.AccountPrep(numericCols=["x"], categoricalCols=["code"]).fit(df)
    assert len(model.fitted()["coded"]["code"]["categories"]) == 5000
    weights = [0.0, *(float(i) for i in range(1, 5000))]
    row = df.where("code = 2997").selectExpr(f"{model.logit(0.5, weights)} AS z").first()
    assert row.z == 999.5
    vector = model.transform(df.where("code = 2997")).first().features
    assert vector.numNonzeros() <= 2 and vector[999] == 1.0


def test_wide_codes_are_joined_not_written_into_the_plan(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import SparseVector

    df = spark.range(5000).selectExpr("id * 3 AS code", "id % 3 AS few", "CAST(id AS DOUBLE) AS x", "id AS __known", "CAST(id % 2 AS DOUBLE) AS label")
    model = prep.AccountPrep(numericCols=["x"], categoricalCols=["code", "few"]).fit(df)
    out = model.transform(df)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "8991" not in plan and len(plan) < 20_000
    rows = {r["__known"]: r["features"] for r in out.select("__known", "features").collect()}
    assert len(rows) == 5000 and all(isinstance(v, SparseVector) and len(v) == 1 + 4999 + 2 for v in rows.values())
    assert {int(i): rows[2997][int(i)] for i in rows[2997].indices if i} == {2997: 1.0}  # 2997 % 3 == 0: the smallest code
    assert [int(i) for i in rows[0].indices if i] == [] and [int(i) for i in rows[4].indices if i] == [4, 5000]
    odd = spark.createDataFrame([(1, None, 0.0), (None, 2, 1.0), (6, 1, None)], "code bigint, few bigint, x double")
    got = [[int(i) for i in r.features.indices if i] for r in model.transform(odd).collect()]
    assert got == [[], [5001], [2, 5000]]  # unknown and filled: no indicator
    weights = [0.0, *(float(i) for i in range(1, 5000)), 0.5, 0.25]
    joined, looked_up = model.with_weights(df, weights)
    expression = model.logit(0.5, weights, looked_up=looked_up)
    assert len(expression) < 1000 and list(looked_up) == ["code"]
    assert joined.where("code = 2997").selectExpr(f"{expression} AS z").first().z == 0.5 + 999
    assert joined.where("code = 12").selectExpr(f"{expression} AS z").first().z == 0.5 + 4 + 0.5
    assert LogisticRegression(maxIter=1).fit(out).numFeatures == 5002


def test_index_of_codes(spark, tmp_path):
    from riskframe.operators import codes

    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS a", "CAST(NULL AS BIGINT) AS b", "id % 2 AS c").repartition(7)
    index = codes.index_codes(df, ["a", "b", "c"], str(tmp_path / "index"))
    rows = sorted((r["column"], r["position"], r["value"], r["n"]) for r in index.collect())
    values = sorted({7 if i % 3 == 0 else i for i in range(1000)})
    assert [r[1:3] for r in rows if r[0] == "a"] == list(enumerate(map(float, values)))
    assert [r[1:] for r in rows if r[0] == "c"] == [(0, 0.0, 500), (1, 1.0, 500)] and not [r for r in rows if r[0] == "b"]
    for limit in (10_000, 10):  # broadcast and shuffled
        placed = codes.with_positions(df, index, ["a", "b", "c"], max_rows=limit)
        got = {r["id"]: (r["position_a"], r["position_b"], r["position_c"]) for r in placed.collect()}
        assert got == {i: (values.index(7 if i % 3 == 0 else i), None, i % 2) for i in range(1000)}
    vectors = {r["id"]: r["v"] for r in codes.encode(df, index, ["a", "b", "c"], "v").collect()}
    assert len(vectors[1]) == len(values) - 1 + 1
    assert list(vectors[1].indices) == [len(values) - 1] and list(vectors[8].indices) == [values.index(8) - 1]
    empty = codes.index_codes(df.limit(0), ["a"], str(tmp_path / "none"))
    assert empty.count() == 0 and codes.with_positions(df, empty, ["a"]).where("position_a IS NULL").count() == 1000


def test_stages_save_and_load(spark, accounts, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel

    fitted = Pipeline(stages=[prep.RepaymentFeatures(balances=False), prep.AccountPrep(
        numericCols=list(NUMERIC_FEATURES))]).fit(accounts)
    fitted.write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    assert loaded.stages[1].fitted() == fitted.stages[1].fitted()
    assert loaded.transform(accounts).exceptAll(fitted.transform(accounts)).count() == 0


def test_standard_scaling(spark):
    df = spark.createDataFrame([(1.0, 5), (2.0, 5), (6.0, 5)], "a double, b bigint")
    rows = prep.standard_scaled(df, ["a", "b"]).collect()
    a = np.array([1.0, 2.0, 6.0])
    assert [r.a for r in rows] == pytest.approx(list((a - a.mean()) / a.std()))
    assert [r.b for r in rows] == [0, 0, 0]


def test_modes(accounts):
    modes = {r["column"]: r["mode"] for r in prep.fit_modes(accounts, CATEGORICAL_FEATURES).collect()}
    pdf = accounts.toPandas()
    assert modes == {c: float(pdf[c].mode().min()) for c in CATEGORICAL_FEATURES}


# ---------------------------------------------------------------- metrics

def test_published_confusion_matrix(spark):
    cm = spark.createDataFrame([(0, 0, 4447), (0, 1, 220), (1, 0, 862), (1, 1, 464)], "label int, prediction int, n bigint")
    row = metrics.weighted_metrics(cm).first()
    assert row.accuracy == pytest.approx(0.8194560320373769, abs=1e-14)
    assert row.precision == pytest.approx(0.8023940616779549, abs=1e-14)
    assert row.recall == pytest.approx(0.8194560320373769, abs=1e-14)
    assert row.f1_score == pytest.approx(0.7964322948261959, abs=1e-14)
    assert tuple(metrics.confusion_counts(cm).first()) == (4447, 220, 862, 464)


def test_class_never_predicted(spark):
    cm = spark.createDataFrame([(0, 0, 3), (1, 0, 1)], "label int, prediction int, n bigint")
    row = metrics.weighted_metrics(cm).first()
    assert row.accuracy == 0.75 and row.precision == pytest.approx(0.75 * 0.75)


def test_auc_counts_pairs(spark):
    rng = np.random.default_rng(3)
    y, s = rng.integers(0, 2, 200), rng.integers(0, 12, 200) / 12
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], f"{TARGET} int, probability double")
    pos, neg = s[y == 1], s[y == 0]
    pairs = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    assert metrics.roc_auc(df) == pytest.approx(pairs / (len(pos) * len(neg)), abs=1e-12)
    assert metrics.roc_auc(df.where(f"{TARGET} = 1")) is None


def test_metric_card(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (1, 1, 0.9), (1, 0, 0.4)], f"{TARGET} int, prediction int, probability double")
    card = {r.metric: r.display for r in metrics.metric_card(metrics.evaluation_report(df)).collect()}
    assert card == {"accuracy": "0.667", "precision": "0.833", "recall": "0.667", "f1_score": "0.667", "roc_auc": "1.000"}
