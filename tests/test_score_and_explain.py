import itertools
import math
import re

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SAMPLE
from riskframe.config import DEFAULT_BANDS, EXPLAIN_BANDS, KEY, TARGET, RiskBands
from riskframe.functions.columns import literal
from riskframe.functions.labels import PAY_LABELS, decode, readable_name
from riskframe.operators import clean, contract, explain, prep, score, train
from riskframe.operators.score import FIXED_SCORECARD
from riskframe.sources import readers


@pytest.fixture(scope="module")
def fitted(accounts):
    """Prepared rows, feature names, and a fitted logistic pipeline."""
    df = clean.fill_missing_with_zero(accounts)
    features = prep.RepaymentFeatures()
    prepared = prep.AccountPrep().fit(features.transform(df))
    rows = prepared.transform(features.transform(df)).withColumn("label", F.col(TARGET).cast("double")).cache()
    lr = LogisticRegression(maxIter=200, elasticNetParam=1.0, regParam=0.02, standardization=False).fit(rows)
    return rows, prepared.feature_names(), PipelineModel(stages=[features, prepared, lr])


def test_band_boundaries(spark):
    def bands(which):
        df = spark.createDataFrame([(p,) for p in (0.1, 0.45, 0.8, 0.3, 0.6, 0.4, 0.7, math.nan, None)], "p double")
        return [r[0] for r in df.selectExpr(score.risk_band("p", which)).collect()]

    low, mid, high = DEFAULT_BANDS.labels
    assert bands(DEFAULT_BANDS) == [low, mid, high, mid, high, mid, high, high, high]
    assert bands(EXPLAIN_BANDS) == ["Low", "Medium", "High", "Low", "Medium", "Low", "Medium", "High", "High"]
    with pytest.raises(ValueError):
        RiskBands((0.5,), ("only one",))


def test_score_keeps_inputs_and_adds_four_columns(make_accounts):
    df = make_accounts({}, {"BILL_AMT1": None})
    out = score.score(df, FIXED_SCORECARD)
    assert out.columns == [*df.columns, *score.SCORE_COLUMNS]
    assert out.where(f"{KEY} = 2").first()["BILL_AMT1"] == 0
    row = out.first()
    assert row.risk_score == row.probability * 100 and row.prediction == int(row.probability > 0.5)


def test_summary_partitions_the_rows(accounts):
    scored = score.score(accounts, FIXED_SCORECARD)
    row = score.batch_summary(scored).first()
    assert row.total_records == accounts.count() == row.default_predictions + row.no_default_predictions
    assert row.total_records == row.high_risk_count + row.medium_risk_count + row.low_risk_count
    counts = [r.n for r in score.risk_distribution(scored).collect()]
    assert counts == sorted(counts, reverse=True) and sum(counts) == row.total_records
    empty = score.batch_summary(scored.where("false")).first()
    assert empty.total_records == 0 and empty.avg_risk_score is None


def test_single_record_equals_batch(spark, make_accounts):
    one = score.score(readers.record(spark, SAMPLE), FIXED_SCORECARD).first()
    assert one.probability == score.score(make_accounts({}), FIXED_SCORECARD).first().probability


def test_pipeline_scoring_without_vectors_equals_transform(accounts, fitted):
    _, _, model = fitted
    holed = accounts
    fast = score.score_with_pipeline(holed, model).select(KEY, "probability", "prediction")
    slow = model.transform(clean.fill_missing_with_zero(holed)).select(
        KEY, vector_to_array("probability")[1].alias("p"), F.col("prediction").alias("c"))
    worst = fast.join(slow, KEY).agg(F.max(F.abs(F.col("probability") - F.col("p"))), F.max(F.abs(F.col("prediction") - F.col("c")))).first()
    assert worst[0] < 1e-12 and worst[1] == 0


def test_missing_inputs_can_be_imputed(accounts, fitted):
    _, _, model = fitted
    row = score.score_with_pipeline(accounts.where("BILL_AMT1 IS NULL").limit(1), model, missing="impute").first()
    assert row.BILL_AMT1 is None and 0 < row.probability < 1


def plan_of(df, capsys):
    capsys.readouterr()
    df.explain("codegen")
    return capsys.readouterr().out


def test_scoring_is_one_compilable_stage(accounts, fitted, capsys):
    _, _, model = fitted
    for df in (score.score(accounts, FIXED_SCORECARD), score.score_with_pipeline(accounts, model),
               explain.contributions(score.prepare_for_scoring(accounts), explain.LinearAttribution(
                   FIXED_SCORECARD, dict.fromkeys(FIXED_SCORECARD.features, 0.0)), [KEY])):
        text = plan_of(df, capsys)
        assert "Exchange" not in text and "Python" not in text
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
        assert sizes and max(sizes) < 8000, text[:2000]


def test_contract_filter_and_columns_reach_the_scan(accounts, capsys):
    from riskframe.config import SERVING_CONTRACT

    contract.split_by_contract(accounts, SERVING_CONTRACT)[0].select(KEY).explain()
    text = capsys.readouterr().out
    assert "GreaterThanOrEqual(LIMIT_BAL,10000)" in text and "Exchange" not in text
    accounts.groupBy(TARGET).count().explain()
    assert f"ReadSchema: struct<{TARGET}:bigint>" in capsys.readouterr().out


def test_decoding_and_readable_names(spark):
    df = spark.createDataFrame([(-2,), (-1,), (0,), (8,), (9,)], "c bigint")
    assert [r[0] for r in df.selectExpr(decode("c", PAY_LABELS)).collect()] == [
        "Paid in full", "No consumption", "Pay 0", "Pay 8", None]
    names = ["PAY_0", "BILL_AMT3", "AVG_PAY_STATUS", "num__PAY_2x_3ab", "SEX_2", "a-b c", "x# y"]
    out = [r[0] for r in spark.createDataFrame([(n,) for n in names], "f string").selectExpr(readable_name("f")).collect()]
    assert out[:2] == ["Payment Status (Current)", "Bill Amount (3 months ago)"]
    assert out[2:-1] == [n.replace("_", " ").title() for n in names[2:-1]]


def test_literals_survive_quoting(spark):
    for value in ("it's", "back\\slash", 'q"', 1.5, -2, 1e-300, 0.1):
        assert spark.range(1).selectExpr(f"{literal(value)} AS v").first().v == value


# ---------------------------------------------------------------- linear attribution

@pytest.fixture(scope="module")
def attributed(accounts):
    df = score.with_score_columns(score.prepare_for_scoring(accounts), FIXED_SCORECARD.probability()).cache()
    return df, explain.linear_attribution(df, FIXED_SCORECARD, [KEY])


def test_contributions_add_up_to_the_logit(attributed):
    df, how = attributed
    out = explain.push_totals(df, how, [KEY]).join(df, KEY)
    worst = out.selectExpr("max(abs(output_value - ln(probability / (1 - probability))))",
                           "max(abs(base_value + push_up + push_down - output_value))").first()
    assert worst[0] < 1e-6 and worst[1] < 1e-9


def test_background_contributes_zero_on_average(attributed):
    df, _ = attributed
    how = explain.linear_attribution(df, FIXED_SCORECARD, [KEY], background_rows=df.count())
    rows = explain.attribution_stats(df, how).collect()
    assert all(abs(r.mean_contribution) < 1e-9 for r in rows)
    assert [r.mean_abs_contribution for r in rows] == sorted((r.mean_abs_contribution for r in rows), reverse=True)


def test_waterfall_ends_at_the_output(attributed):
    df, how = attributed
    totals = explain.push_totals(df, how, [KEY]).select(KEY, "output_value")
    for display in (3, 15):
        steps = explain.waterfall(df, how, [KEY], display)
        last = steps.groupBy(KEY).agg(F.max_by("running_total", "step").alias("end"), F.count("*").alias("n"))
        row = last.join(totals, KEY).selectExpr("max(abs(end - output_value))", "max(n)").first()
        assert row[0] < 1e-9 and row[1] == min(display, len(how.features))


def test_global_tables_agree(attributed):
    df, how = attributed
    wide = [(r.feature, pytest.approx(r.importance)) for r in explain.global_importance(df, how).collect()]
    long = [(r.feature, r.importance) for r in explain.importance_of_long(explain.contributions(df, how, [KEY])).collect()]
    assert long == wide
    stats = explain.stats_of_long(explain.contributions(df, how, [KEY]), len(how.features)).collect()
    assert [(s.feature, s.n_rows) for s in stats] == [(f, df.count()) for f, _ in long]


def test_global_aggregates_shuffle_no_rows(attributed, capsys):
    df, how = attributed
    explain.attribution_stats(df, how).explain()
    assert "hashpartitioning" not in capsys.readouterr().out


def test_partial_dependence_by_brute_force(attributed):
    df, how = attributed
    out = explain.partial_dependence(df, FIXED_SCORECARD, ["AGE", "MAX_PAY_DELAY"], 5).collect()
    assert len(out) == 10
    for r in out:
        p = df.withColumn(r.feature, F.lit(r.grid_value)).selectExpr(f"avg({FIXED_SCORECARD.probability()})").first()[0]
        assert r.mean_probability == pytest.approx(p, abs=1e-12)


def test_fitted_model_attribution_adds_up(accounts, fitted):
    _, names, model = fitted
    ready = score.prepare_for_scoring(accounts)
    card = train.as_scorecard(model.stages[2], names)
    how = explain.linear_attribution(ready, card, [KEY], columns=model.stages[1].expressions())
    total = explain.contributions(ready, how, [KEY]).groupBy(KEY).agg((F.sum("contribution") + how.base_value).alias("z"))
    scored = score.score_with_pipeline(accounts, model).select(KEY, "probability")
    worst = total.join(scored, KEY).selectExpr("max(abs(1 / (1 + exp(-z)) - probability))").first()[0]
    assert worst < 1e-9


# ---------------------------------------------------------------- sampled attribution

def exact_shapley(f, x, background):
    """All coalitions, averaged over the background: brute force for a few features."""
    n = len(x)
    value = {}
    for r in range(n + 1):
        for s in itertools.combinations(range(n), r):
            z = background.copy()
            z[:, list(s)] = x[list(s)]
            value[s] = f(z).mean()
    phi = np.zeros(n)
    for j in range(n):
        others = [k for k in range(n) if k != j]
        for r in range(n):
            for s in itertools.combinations(others, r):
                w = math.factorial(r) * math.factorial(n - r - 1) / math.factorial(n)
                phi[j] += w * (value[tuple(sorted((*s, j)))] - value[s])
    return phi, value[()]


@pytest.fixture(scope="module")
def small_problem(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(150, 3))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=150) > 0).astype(float)
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame(
        [(i, Vectors.dense(r), float(t)) for i, (r, t) in enumerate(zip(x, y))], [KEY, "features", "label"]).cache()
    return df, x


def test_sampled_linear_attribution(small_problem):
    df, x = small_problem
    model = LogisticRegression().fit(df)
    w, b = model.coefficients.toArray(), model.intercept
    f = lambda z: 1 / (1 + np.exp(-(z @ w + b)))
    background = x[:10]
    out = explain.sampled_linear_attribution(df.limit(4), model, ["a", "b", "c"], KEY, background, 400).toPandas()
    for k, part in out.groupby(KEY):
        phi, base = exact_shapley(f, x[k], background)
        assert part.base_value.iloc[0] == pytest.approx(base)
        assert part.contribution.sum() + base == pytest.approx(f(x[k][None])[0])
        assert part.contribution.to_numpy() == pytest.approx(phi, abs=0.02)
    again = explain.sampled_linear_attribution(df.limit(4).repartition(3), model, ["a", "b", "c"], KEY, background, 400).toPandas()
    same = lambda t: t.sort_values([KEY, "feature"], ignore_index=True)
    assert same(out).equals(same(again))


def test_sampled_tree_attribution(small_problem):
    df, x = small_problem
    model = GBTClassifier(maxIter=5, maxDepth=3, seed=1).fit(df)
    background = x[:6]

    def f(z):
        from pyspark.ml.linalg import Vectors
        return np.array([model.predictProbability(Vectors.dense(r))[1] for r in z])

    out = explain.sampled_attribution(df.limit(2), model, ["a", "b", "c"], KEY, background, 60).toPandas()
    assert len(out) == 6
    for k, part in out.groupby(KEY):
        phi, base = exact_shapley(f, x[k], background)
        part = part.sort_values("feature")
        assert part.base_value.iloc[0] == pytest.approx(base)
        assert part.probability.iloc[0] == pytest.approx(f(x[k][None])[0])
        assert part.contribution.sum() + base == pytest.approx(part.probability.iloc[0])
        assert part.value.to_numpy() == pytest.approx(x[k])
        assert part.contribution.to_numpy() == pytest.approx(phi, abs=0.05)


def test_method_follows_the_model(fitted):
    assert explain.attribution_method(fitted[2].stages[2]) == "linear"


@pytest.mark.parametrize("family", ["forest", "boosting"])
def test_tree_attribution_equals_all_permutations(spark, family):
    import itertools

    import numpy as np
    from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    rng = np.random.default_rng(3)
    x = rng.integers(0, 6, (120, 3)).astype(float)
    y = ((x[:, 0] > 2) & (x[:, 1] < 4) | (x[:, 2] > 4)).astype(float)
    df = spark.createDataFrame([(i, x[i].tolist(), float(y[i])) for i in range(120)], f"{KEY} bigint, x array<double>, label double").select(
        KEY, array_to_vector("x").alias("features"), "label")
    estimator = RandomForestClassifier(numTrees=4, maxDepth=4, seed=1) if family == "forest" else GBTClassifier(maxIter=4, maxDepth=3, seed=1)
    model = estimator.fit(df)
    leaves, background = explain.tree_leaves(model), x[:7]

    def raw(z):
        return sum(leaf.value for leaf in leaves if all(lo < z[f] <= hi for f, lo, hi in leaf.conditions))

    out = explain.tree_attribution(df.where(f"{KEY} < 5"), leaves, ["a", "b", "c"], KEY, background, family == "boosting").toPandas()
    chances = {r[KEY]: r.probability[1] for r in model.transform(df).collect()}
    for i in range(5):
        phi = np.zeros(3)
        for order in itertools.permutations(range(3)):
            for z in background:
                at = z.copy()
                for f in order:
                    before, at[f] = raw(at), x[i][f]
                    phi[f] += raw(at) - before
        rows = out[out[KEY] == i].set_index("feature")
        assert rows["contribution"][["a", "b", "c"]].tolist() == pytest.approx(list(phi / 6 / len(background)))
        assert rows["probability"].iloc[0] == pytest.approx(chances[i])
