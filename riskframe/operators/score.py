"""Scoring: probability, class, risk score, band, summaries and decoded labels.

``Scorecard`` is a logistic model written as a plain SQL expression, so scoring with it is
a projection inside whole-stage codegen. A fitted Spark ML logistic model converts into one;
tree models go through ``model.transform``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.config import DEFAULT_BANDS, FeatureConfig, RiskBands
from riskframe.functions.columns import add_all, double, names_of, num, sigmoid, text, with_expressions
from riskframe.functions.labels import (
    EDUCATION_LABELS, GENDER_LABELS, MARRIAGE_LABELS, PAY_LABELS, VERDICT_LABELS, decode,
)
from riskframe.operators.clean import fill_missing_with_zero
from riskframe.operators.features import with_engineered_features

SCORE_COLUMNS = ("prediction", "probability", "risk_score", "risk_category")


@dataclass(frozen=True)
class Scorecard:
    """Intercept and one weight per feature column."""

    intercept: float
    weights: Mapping[str, float]

    @property
    def features(self) -> tuple[str, ...]:
        return tuple(self.weights)

    def logit(self, columns: Mapping[str, str] | None = None) -> str:
        """Linear predictor; ``columns`` replaces some feature columns by other expressions."""
        columns = columns or {}
        terms = [f"{columns.get(f) or double(f)} * {num(float(w))}" for f, w in self.weights.items()]
        return add_all([num(float(self.intercept)), *terms])

    def probability(self, columns: Mapping[str, str] | None = None) -> str:
        return sigmoid(self.logit(columns))


# A fixed model on raw and engineered columns, for runs without training.
FIXED_SCORECARD = Scorecard(
    -0.55,
    {
        "LIMIT_BAL": -0.0000012,
        "AGE": -0.01,
        "AVG_PAY_STATUS": 0.85,
        "MAX_PAY_DELAY": 0.45,
        "MONTHS_WITH_DELAY": 0.22,
        "PAY_AMT_TO_LIMIT_RATIO": -0.035,
        "BILL_AMT_TO_LIMIT_RATIO": 0.09,
        "BILL_AMT_TREND": 0.0000004,
        "AVG_PAY_AMT": -0.0000015,
        "TOTAL_BILL_AMT": 0.00000025,
    },
)


#: Three small trees for checking tree attribution: a leaf's log-odds and the interval (lo, hi] of each column leading to it.
FIXED_TREE_COLUMNS = ("PAY_0", "AGE", "LIMIT_BAL")
FIXED_LEAVES = (
    (-0.8, (("PAY_0", -10.0, 0.0), ("AGE", 0.0, 40.0))),
    (-0.3, (("PAY_0", -10.0, 0.0), ("AGE", 40.0, 200.0))),
    (0.9, (("PAY_0", 0.0, 10.0), ("LIMIT_BAL", 0.0, 300000.0))),
    (0.4, (("PAY_0", 0.0, 10.0), ("LIMIT_BAL", 300000.0, 1e9))),
    (0.2, (("AGE", 0.0, 30.0),)),
    (-0.1, (("AGE", 30.0, 60.0), ("LIMIT_BAL", 0.0, 500000.0), ("PAY_0", -10.0, 1.0))),
    (0.7, (("AGE", 30.0, 60.0), ("LIMIT_BAL", 0.0, 500000.0), ("PAY_0", 1.0, 10.0))),
    (0.05, (("AGE", 30.0, 60.0), ("LIMIT_BAL", 500000.0, 1e9))),
    (-0.25, (("AGE", 60.0, 200.0),)),
)


#: Two trees with the training cover of their leaves, (column, threshold, left, right) or (log-odds, cover); one column comes twice on a way.
FIXED_COVER_TREES = (
    ("PAY_0", 0.0, ("AGE", 40.0, (-0.8, 300.0), (-0.3, 200.0)), ("LIMIT_BAL", 300000.0, (0.9, 350.0), (0.4, 150.0))),
    ("AGE", 30.0, (0.2, 180.0), ("LIMIT_BAL", 500000.0, ("PAY_0", 1.0, ("AGE", 50.0, (-0.15, 260.0), (-0.05, 140.0)), (0.7, 120.0)), (0.05, 300.0))),
)
#: A logistic model of four columns for checking kernel attribution: weights, then the intercept.
FIXED_KERNEL_WEIGHTS = {"PAY_0": 0.6, "AGE": -0.02, "EDUCATION": 0.3, "MARRIAGE": -0.4}
FIXED_KERNEL_INTERCEPT = -0.5


def risk_band(probability: str, bands: RiskBands = DEFAULT_BANDS) -> str:
    """Band label; a missing or NaN probability lands in the last band."""
    op = "<" if bands.closed == "left" else "<="
    cases = " ".join(f"WHEN {probability} {op} {num(float(cut))} THEN {text(label)}"
                     for cut, label in zip(bands.cuts, bands.labels))
    return f"CASE {cases} ELSE {text(bands.labels[-1])} END"


def with_score_columns(df: DataFrame, probability: str, threshold: float = 0.5,
                       bands: RiskBands = DEFAULT_BANDS) -> DataFrame:
    """Add the four score columns given the probability of default as an expression."""
    scored = with_expressions(df, {"probability": probability})
    return with_expressions(scored, {
        "prediction": f"CAST(probability > {num(float(threshold))} AS INT)",
        "risk_score": "probability * 100D",
        "risk_category": risk_band("probability", bands),
    })


def prepare_for_scoring(df: DataFrame, config: FeatureConfig = FeatureConfig(),
                        missing: str = "zero") -> DataFrame:
    """Fill missing inputs with 0 and add the features.

    ``missing="impute"`` leaves the gaps to the fitted preprocessing instead.
    """
    if missing not in ("zero", "impute"):
        raise ValueError("missing must be 'zero' or 'impute'")
    base = fill_missing_with_zero(df) if missing == "zero" else df
    return with_engineered_features(base, config)


def score(df: DataFrame, model: Scorecard, threshold: float = 0.5, bands: RiskBands = DEFAULT_BANDS,
          config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Input columns plus the four score columns: one projection, no shuffle."""
    prepared = prepare_for_scoring(df, config)
    scored = with_score_columns(prepared, model.probability(), threshold, bands)
    return scored.select(*names_of(df.columns), *SCORE_COLUMNS)


def score_with_pipeline(df: DataFrame, model: PipelineModel, threshold: float = 0.5,
                        bands: RiskBands = DEFAULT_BANDS, missing: str = "zero") -> DataFrame:
    """The same for a fitted pipeline of features, preprocessing and classifier.

    A logistic regression is scored as one SQL expression without building vectors; other
    classifiers go through ``transform``.
    """
    features, fitted, classifier = model.stages
    ready = prepare_for_scoring(df, features.config(), missing)
    if isinstance(classifier, LogisticRegressionModel):
        integral = [f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)]
        weights = classifier.coefficients.toArray()
        ready, looked_up = fitted.with_weights(ready, weights)
        p = sigmoid(fitted.logit(classifier.intercept, weights, missing == "zero", integral, looked_up))
        scored = with_score_columns(ready, p, threshold, bands)
    else:
        out = classifier.transform(fitted.transform(ready))
        out = out.withColumn("p1", vector_to_array("probability")[1]).drop("probability", "prediction")
        scored = with_score_columns(out, "p1", threshold, bands)
    return scored.select(*names_of(df.columns), *SCORE_COLUMNS)


def batch_summary(scored: DataFrame, bands: RiskBands = DEFAULT_BANDS) -> DataFrame:
    """Totals of one scored batch; zero counts, and a null mean, for an empty batch."""
    counts = [F.expr(f"count_if(risk_category = {text(label)})").alias(f"{label.split()[0].lower()}_risk_count")
              for label in reversed(bands.labels)]
    # The names of the summary.
    return scored.agg(
        F.expr("count(*) AS total_records"),
        F.expr("count_if(prediction = 1) AS default_predictions"),
        F.expr("count_if(prediction = 0) AS no_default_predictions"),
        F.expr("avg(risk_score) AS avg_risk_score"),
        *counts,
    )


def risk_distribution(scored: DataFrame) -> DataFrame:
    return (scored.groupBy("risk_category").agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), "risk_category"))


def with_decoded_labels(df: DataFrame) -> DataFrame:
    """Readable gender, education, marital status, latest payment status and verdict."""
    added = {
        "gender_label": decode("SEX", GENDER_LABELS),
        "education_label": decode("EDUCATION", EDUCATION_LABELS),
        "marital_status_label": decode("MARRIAGE", MARRIAGE_LABELS),
        "payment_status_label": decode("PAY_0", PAY_LABELS),
    }
    if "prediction" in df.columns:
        added["verdict"] = decode("prediction", VERDICT_LABELS)
    return with_expressions(df, added)


def batch_outcome(checked: DataFrame) -> DataFrame:
    """Success and error counts of a batch whose rows carry a ``violations`` array."""
    return checked.agg(
        F.expr("count(*) AS total"),
        F.expr("count_if(size(violations) = 0) AS success_count"),
        F.expr("count_if(size(violations) > 0) AS error_count"),
    )
