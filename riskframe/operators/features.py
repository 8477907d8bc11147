"""The eleven repayment features: one narrow projection, no shuffle, no Python.

A missing divisor, a zero divisor or a missing operand yields 0; row means, sums and maxima
skip missing months.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskframe.config import BILL_COLUMNS, PAY_COLUMNS, PAYMENT_COLUMNS, FeatureConfig
from riskframe.functions.columns import (
    add_all, double, names_of, plain_sum, q, row_mean, row_sum, safe_ratio, with_expressions,
)

# The names of the engineered features, by group.
RATIO_FEATURES = ("PAY_AMT_TO_LIMIT_RATIO", "BILL_AMT_TO_LIMIT_RATIO", "PAY_TO_BILL_RATIO")
PAYMENT_FEATURES = ("AVG_PAY_STATUS", "MAX_PAY_DELAY", "MONTHS_WITH_DELAY")
BALANCE_FEATURES = ("TOTAL_BILL_AMT", "AVG_BILL_AMT", "BILL_AMT_TREND", "TOTAL_PAY_AMT", "AVG_PAY_AMT")


def engineered_names(config: FeatureConfig = FeatureConfig()) -> tuple[str, ...]:
    return (
        (RATIO_FEATURES if config.ratios else ())
        + (PAYMENT_FEATURES if config.payments else ())
        + (BALANCE_FEATURES if config.balances else ())
    )


def _or_zero(expression: str) -> str:
    return f"coalesce({expression}, 0D)"


def engineered_expressions() -> dict[str, str]:
    limit = double("LIMIT_BAL")
    delayed = add_all([f"coalesce(CAST({q(c)} > 0 AS BIGINT), 0)" for c in PAY_COLUMNS])
    worst = f"greatest({', '.join(names_of(PAY_COLUMNS))})"
    return {
        "PAY_AMT_TO_LIMIT_RATIO": safe_ratio(plain_sum(PAYMENT_COLUMNS), limit),
        "BILL_AMT_TO_LIMIT_RATIO": safe_ratio("BILL_AMT1", limit),
        "PAY_TO_BILL_RATIO": safe_ratio("PAY_AMT1", "BILL_AMT1 + 1D"),
        "AVG_PAY_STATUS": _or_zero(row_mean(PAY_COLUMNS)),
        "MAX_PAY_DELAY": f"coalesce(CAST({worst} AS BIGINT), 0)",
        "MONTHS_WITH_DELAY": delayed,
        "TOTAL_BILL_AMT": row_sum(BILL_COLUMNS),
        "AVG_BILL_AMT": _or_zero(row_mean(BILL_COLUMNS)),
        "BILL_AMT_TREND": _or_zero("BILL_AMT1 - BILL_AMT6"),
        "TOTAL_PAY_AMT": row_sum(PAYMENT_COLUMNS),
        "AVG_PAY_AMT": _or_zero(row_mean(PAYMENT_COLUMNS)),
    }


def with_engineered_features(df: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    expressions = engineered_expressions()
    return with_expressions(df, {name: expressions[name] for name in engineered_names(config)})
