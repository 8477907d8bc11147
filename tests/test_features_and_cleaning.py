import math

import pytest

from conftest import SAMPLE
from riskframe.config import KEY, TARGET, FeatureConfig
from riskframe.operators import clean
from riskframe.operators.features import BALANCE_FEATURES, engineered_names, with_engineered_features
from riskframe.operators.score import prepare_for_scoring
from riskframe.sources import readers


def first(df):
    return df.first().asDict()


def test_sample_record_by_hand(make_accounts):
    row = first(with_engineered_features(make_accounts({})))
    expected = {
        "PAY_AMT_TO_LIMIT_RATIO": 0.15, "BILL_AMT_TO_LIMIT_RATIO": 0.3, "PAY_TO_BILL_RATIO": 1500 / 15001,
        "AVG_PAY_STATUS": 0.5, "MAX_PAY_DELAY": 2, "MONTHS_WITH_DELAY": 2, "TOTAL_BILL_AMT": 75000,
        "AVG_BILL_AMT": 12500, "BILL_AMT_TREND": 5000, "TOTAL_PAY_AMT": 7500, "AVG_PAY_AMT": 1250,
    }
    assert {k: row[k] for k in expected} == pytest.approx(expected)


def test_zero_divisors_give_zero(make_accounts):
    row = first(with_engineered_features(make_accounts({"LIMIT_BAL": 0, "BILL_AMT1": -1.0})))
    assert row["PAY_AMT_TO_LIMIT_RATIO"] == row["BILL_AMT_TO_LIMIT_RATIO"] == row["PAY_TO_BILL_RATIO"] == 0


def test_row_statistics_skip_missing_months(make_accounts):
    row = first(with_engineered_features(make_accounts({"BILL_AMT2": None, "PAY_AMT1": None, "PAY_2": None})))
    assert row["TOTAL_BILL_AMT"] == 61000 and row["AVG_BILL_AMT"] == pytest.approx(61000 / 5)
    assert row["PAY_AMT_TO_LIMIT_RATIO"] == row["PAY_TO_BILL_RATIO"] == 0
    assert row["AVG_PAY_STATUS"] == pytest.approx(0.2) and row["MAX_PAY_DELAY"] == 1


def test_all_months_missing(make_accounts):
    gone = {f"BILL_AMT{m}": None for m in range(1, 7)}
    row = first(with_engineered_features(make_accounts(gone)))
    assert row["TOTAL_BILL_AMT"] == row["AVG_BILL_AMT"] == row["BILL_AMT_TREND"] == 0


def test_feature_groups_switch_off(make_accounts):
    df = with_engineered_features(make_accounts({}), FeatureConfig(balances=False))
    assert not set(BALANCE_FEATURES) & set(df.columns)
    assert engineered_names() == engineered_names()  # asking twice must not grow the list
    assert len(engineered_names()) == 11


def test_serving_fills_before_features(make_accounts):
    row = first(prepare_for_scoring(make_accounts({"BILL_AMT1": math.inf, "PAY_AMT1": math.nan, "BILL_AMT2": None})))
    assert row["BILL_AMT1"] == row["PAY_AMT1"] == row["BILL_AMT2"] == 0
    assert row["AVG_BILL_AMT"] == pytest.approx(46000 / 6)


def test_clean_collapses_copies_and_drops_gaps(make_accounts):
    df = make_accounts({}, {}, {"AGE": None}, {"BILL_AMT1": math.nan}, {"AGE": 36})
    kept = clean.clean_accounts(df, KEY).orderBy(KEY).collect()
    assert [(r[KEY], r["AGE"]) for r in kept] == [(1, 35), (5, 36)]


def test_clean_without_key_drops_surrogate_and_renames_target(make_accounts):
    df = make_accounts({}, {}).withColumnRenamed(KEY, "ID").withColumnRenamed(TARGET, "default.payment.next.month")
    out = clean.clean_accounts(df)
    assert out.count() == 1 and TARGET in out.columns and "ID" not in out.columns


def test_target_names(make_accounts):
    df = make_accounts({}).drop(TARGET)
    with pytest.raises(ValueError):
        clean.find_target(df)
    assert clean.find_target(df, last_column_fallback=True) == "PAY_AMT6"
    with pytest.raises(ValueError):
        clean.project_features(df)


def test_non_finite_to_null(make_accounts):
    row = first(clean.nulls_for_non_finite(make_accounts({"BILL_AMT1": -math.inf, "BILL_AMT2": math.nan})))
    assert row["BILL_AMT1"] is None and row["BILL_AMT2"] is None and row["BILL_AMT3"] == 13000


def test_csv_header_order_does_not_matter_and_bad_cells_are_kept_aside(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("AGE,ID,LIMIT_BAL,BILL_AMT1,note\n35,1,50000,NaN,x\nold,2,60000,7.5,y\n")
    df = readers.read_accounts(spark, str(path), "csv").orderBy("ID").cache()
    good, bad = df.collect()
    assert (good["AGE"], good["LIMIT_BAL"], good["BILL_AMT1"], good["note"]) == (35, 50000, None, "x")
    assert bad["AGE"] is None and bad["BILL_AMT1"] == 7.5 and bad[readers.CORRUPT].startswith("old,2")
    assert readers.corrupt_rows(df).count() == 1


def test_record_and_preview(spark, accounts):
    one = readers.record(spark, SAMPLE)
    assert one.count() == 1 and one.first()["LIMIT_BAL"] == 50000
    assert readers.preview(accounts).count() == 5


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv", "json"])
def test_formats_round_trip(spark, accounts, tmp_path, fmt):
    from riskframe.sources import writers

    writers.write_table(accounts, str(tmp_path / fmt), fmt)
    back = readers.read_accounts(spark, str(tmp_path / fmt), fmt).drop(readers.CORRUPT).select(*accounts.columns)
    assert back.exceptAll(accounts).count() == 0 and back.count() == accounts.count()
