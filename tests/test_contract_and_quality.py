import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskframe.config import KEY, SERVING_CONTRACT, TARGET, TRAINING_CONTRACT
from riskframe.functions import quantiles
from riskframe.functions.quantiles import exact_quantiles
from riskframe.operators import contract, quality


def failed(df, rules=TRAINING_CONTRACT):
    rows = contract.dataset_checks(df, rules, KEY).where("NOT passed").collect()
    return {(r.check_name, r.column_name): r for r in rows}


def test_clean_table_passes(make_accounts):
    assert failed(make_accounts({}, {"AGE": 40})) == {}


def test_missing_extra_and_mistyped_columns(make_accounts):
    df = make_accounts({}).drop("AGE").withColumn("EXTRA", F.lit(1)).withColumn("SEX", F.col("SEX").cast("string"))
    out = failed(df)
    assert set(out) == {("present", "AGE"), ("unexpected", "EXTRA"), ("type", "SEX")}
    assert out["unexpected", "EXTRA"].severity == "warn"
    # money may be whole numbers, codes may not be fractions
    df = make_accounts({}).withColumn("BILL_AMT1", F.lit(1)).withColumn("PAY_0", F.lit(1.0))
    assert set(failed(df)) == {("type", "PAY_0")}


def test_ranges_count_violations_and_show_extremes(make_accounts):
    out = failed(make_accounts({"AGE": 15}, {"AGE": 16}, {"PAY_0": 9}, {"EDUCATION": 9}, {"EDUCATION": None}, {TARGET: 2}))
    assert (out["min", "AGE"].violations, out["min", "AGE"].observed) == (2, 15)
    assert (out["max", "PAY_0"].violations, out["max", "PAY_0"].observed) == (1, 9)
    assert out["allowed", "EDUCATION"].violations == 2  # a missing code is not an allowed one
    assert ("allowed", TARGET) in out


def test_invalid_values_are_all_listed(make_accounts):
    df = make_accounts({"EDUCATION": 9}, {"EDUCATION": 9}, {"SEX": None})
    rows = {(r.column_name, r.value): r.n for r in contract.invalid_values(df).collect()}
    assert rows == {("EDUCATION", 9.0): 2, ("SEX", None): 1}


def test_row_violations_follow_contract_order(make_accounts):
    df = make_accounts({"AGE": 15}, {"LIMIT_BAL": 5, "AGE": 101}, {"BILL_AMT1": None, "SEX": 7}, {})
    rows = contract.with_violations(df, TRAINING_CONTRACT).orderBy(KEY).collect()
    assert [r.first_violation for r in rows] == ["AGE:min", "LIMIT_BAL:min", "SEX:allowed", None]
    assert rows[2].violations == ["SEX:allowed", "BILL_AMT1:type"]


def test_serving_contract_is_stricter_on_codes_and_looser_on_bills(make_accounts):
    df = make_accounts({"EDUCATION": 0}, {"MARRIAGE": 0}, {"BILL_AMT1": 9e9}, {"PAY_AMT1": -1.0})
    valid, bad = contract.split_by_contract(df, SERVING_CONTRACT)
    assert [r[KEY] for r in valid.collect()] == [3]
    assert {r[KEY]: r.first_violation for r in bad.collect()} == {
        1: "EDUCATION:min", 2: "MARRIAGE:min", 4: "PAY_AMT1:min"}


def test_split_keeps_every_row(accounts):
    valid, bad = contract.split_by_contract(accounts, SERVING_CONTRACT)
    assert valid.count() + bad.count() == accounts.count()
    assert valid.count() == contract.with_violations(accounts, SERVING_CONTRACT).where("size(violations) = 0").count()


def test_absent_column_quarantines_everything(make_accounts):
    valid, bad = contract.split_by_contract(make_accounts({}).drop("AGE"), SERVING_CONTRACT)
    assert valid.count() == 0 and bad.first().violations == ["AGE:present"]


def test_verdict_and_gate(make_accounts):
    good = make_accounts(*({"AGE": 20 + i} for i in range(5)))
    one = contract.verdict(contract.all_checks(good, key=KEY))
    assert one.first().validation_status == "Validation Passed"
    contract.gate(one)
    lines = [r.line for r in contract.status_lines(one).orderBy("line_no").collect()]
    assert lines == ["Validation Status: Validation Passed", "Column Validation: Passed", "Type Validation: Passed",
                     "Range Validation: Passed", "Missing Percentage: 0.00%", "Duplicate Percentage: 0.00%"]
    copies = contract.verdict(contract.all_checks(make_accounts({}, {}), key=KEY))
    assert copies.first().duplicate_percentage == 50
    with pytest.raises(contract.ContractViolation):
        contract.gate(copies)


@pytest.mark.parametrize("method", ["exact", "hashed"])
def test_quality_counts(make_accounts, method):
    df = make_accounts({}, {}, {"AGE": None}, {"AGE": None}, {"SEX": 1, "BILL_AMT1": None}).drop(KEY)
    row = quality.quality(df, method=method).first()
    assert (row.rows, row.columns, row.missing_count, row.duplicate_count) == (5, 24, 3, 2)
    assert row.missing_percentage == pytest.approx(3 / 120 * 100) and row.duplicate_percentage == 40


def test_quality_of_an_empty_table(make_accounts):
    row = quality.quality(make_accounts({}).where("false")).first()
    assert (row.rows, row.missing_percentage, row.duplicate_percentage) == (0, 0, 0)


def test_profile_matches_numpy_and_says_how(accounts):
    x = np.array([r[0] for r in accounts.select("BILL_AMT1").collect() if r[0] is not None])
    exact = {r["column"]: r for r in quality.numeric_profile(accounts, ["BILL_AMT1"]).collect()}["BILL_AMT1"]
    assert exact["median"] == pytest.approx(np.median(x)) and exact["std"] == pytest.approx(np.std(x, ddof=1))
    assert exact["median_mode"] == "exact"
    assert quality.numeric_profile(accounts, ["BILL_AMT1"], accuracy=1000).first()["median_mode"] == "approximate"


def test_drift_of_profiles(spark):
    base = spark.createDataFrame([(float(i), 5.0) for i in range(10)], "a double, b double")
    moved = base.selectExpr("a + 10 AS a", "b")
    shifted = {r["column"]: r for r in quality.drift(quality.moment_profile(base), quality.moment_profile(moved)).collect()}
    assert shifted["a"].drifted and shifted["a"].score == pytest.approx(10 / np.std(range(10), ddof=1))
    assert not shifted["b"].drifted and shifted["b"].score == 0
    constant = {r["column"]: r for r in quality.drift(
        quality.moment_profile(base), quality.moment_profile(base.selectExpr("a", "b + 1 AS b"))).collect()}
    assert constant["b"].drifted and math.isinf(constant["b"].score)


def test_outliers(spark):
    df = spark.createDataFrame([(float(i % 3), 1.0) for i in range(50)] + [(1000.0, 1.0), (None, 1.0)], "a double, b double")
    rows = {r["column"]: (r.n, r.outliers) for r in quality.outlier_counts(df).collect()}
    assert rows == {"a": (51, 1), "b": (52, 0)}
    flagged = quality.with_outlier_flags(df, ["a", "b"]).where("size(outlier_columns) > 0").collect()
    assert len(flagged) == 1 and flagged[0].outlier_columns == ["a"]


QS = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]


def test_quantiles_equal_numpy_however_they_are_found(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(rng.gauss(0, 1e6) if rng.random() < 0.6 else 0.0, float(rng.randrange(4)),
             None if i % 10 == 0 else math.exp(rng.gauss(0, 4)), 3.0) for i in range(20000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(8).cache()
    got = exact_quantiles(df, ["a", "b", "c", "d"], QS)
    for ordered, parts in ((200, 8), (200, 3), (17, 1)):
        monkeypatch.setattr(quantiles, "ORDERED_ROWS", ordered)
        assert exact_quantiles(df.repartition(parts), ["a", "b", "c", "d"], QS) == got  # to the last bit
    for i, c in enumerate("abcd"):
        x = np.array([r[i] for r in rows if r[i] is not None])
        assert got[c] == pytest.approx(list(np.quantile(x, QS)), rel=1e-12, abs=1e-12)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.floats(-1e9, 1e9), st.integers(0, 3).map(float)), min_size=1, max_size=60))
def test_quantiles_of_any_column(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    present = [v for v in values if v is not None]
    for ordered in (20_000, 3):
        quantiles.ORDERED_ROWS, kept = ordered, quantiles.ORDERED_ROWS
        try:
            got = exact_quantiles(df, ["v"], [0.25, 0.5, 0.75])["v"]
        finally:
            quantiles.ORDERED_ROWS = kept
        if not present:
            assert got == [None] * 3
        else:
            assert got == pytest.approx(list(np.quantile(present, [0.25, 0.5, 0.75])), rel=1e-9, abs=1e-9)
