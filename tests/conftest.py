from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

from pyspark.sql import SparkSession  # noqa: E402

from riskframe.config import INPUT_COLUMNS, KEY, TARGET  # noqa: E402
from riskframe.sources.schema import account_schema  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("riskframe-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# The sample record whose features are worked out by hand.
SAMPLE = {
    "LIMIT_BAL": 50000, "SEX": 2, "EDUCATION": 2, "MARRIAGE": 1, "AGE": 35,
    "PAY_0": 1, "PAY_2": 2, "PAY_3": 0, "PAY_4": 0, "PAY_5": 0, "PAY_6": 0,
    "BILL_AMT1": 15000.0, "BILL_AMT2": 14000.0, "BILL_AMT3": 13000.0, "BILL_AMT4": 12000.0,
    "BILL_AMT5": 11000.0, "BILL_AMT6": 10000.0,
    "PAY_AMT1": 1500.0, "PAY_AMT2": 1400.0, "PAY_AMT3": 1300.0, "PAY_AMT4": 1200.0,
    "PAY_AMT5": 1100.0, "PAY_AMT6": 1000.0,
}


@pytest.fixture(scope="session")
def make_accounts(spark):
    """Accounts from partial records on top of the sample record; keys count up from 1."""
    def build(*records: dict):
        rows = []
        for i, r in enumerate(records, start=1):
            full = {KEY: i, **SAMPLE, TARGET: 0, **r}
            rows.append(tuple(full[c] for c in (KEY, *INPUT_COLUMNS, TARGET)))
        return spark.createDataFrame(rows, account_schema())

    return build


@pytest.fixture(scope="session")
def accounts(spark, tmp_path_factory):
    """The derived account table of the smallest scale factor, written once."""
    from riskframe.sources.accounts import derive_accounts

    path = str(tmp_path_factory.mktemp("data") / "accounts")
    derive_accounts(spark, SF).write.parquet(path)
    return spark.read.parquet(path)
