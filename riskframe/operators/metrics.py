"""Classification metrics from a confusion matrix, and exact area under the ROC curve."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.config import TARGET
from riskframe.functions.bounded import join_lookup, reused
from riskframe.functions.columns import array, double, q, safe_ratio, struct, text
from riskframe.functions.quantiles import split_points


def confusion_matrix(df: DataFrame, label: str = TARGET, prediction: str = "prediction") -> DataFrame:
    """Long table (label, prediction, n); absent combinations have no row."""
    return df.selectExpr(f"CAST({q(label)} AS INT) AS label", f"CAST({q(prediction)} AS INT) AS prediction").groupBy(
        "label", "prediction").agg(F.count("*").alias("n"))


# The names of the four cells of a binary matrix.
CELLS = {"true_negatives": (0, 0), "false_positives": (0, 1), "false_negatives": (1, 0), "true_positives": (1, 1)}


def confusion_counts(matrix: DataFrame) -> DataFrame:
    """The four cells of a binary matrix in one row."""
    return matrix.agg(*[
        F.expr(f"coalesce(sum(CASE WHEN label = {y} AND prediction = {p} THEN n END), 0)").alias(name)
        for name, (y, p) in CELLS.items()])


def weighted_metrics(matrix: DataFrame) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 from a confusion matrix.

    A class that is never predicted has precision 0.
    """
    sides = array([
        struct(cls="label", support="n", predicted="0L", tp="CASE WHEN label = prediction THEN n ELSE 0L END"),
        struct(cls="prediction", support="0L", predicted="n", tp="0L"),
    ])
    per_class = matrix.selectExpr(f"inline({sides})").groupBy("cls").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
    rates = per_class.selectExpr("*", f"{safe_ratio('tp', 'predicted')} AS p", f"{safe_ratio('tp', 'support')} AS r")
    scored = rates.selectExpr("*", f"{safe_ratio('2D * p * r', 'p + r')} AS f")
    weigh = lambda c: F.expr(f"try_divide(sum({c} * support), sum(support))")
    return scored.agg(
        F.expr("try_divide(sum(tp), sum(support)) AS accuracy"),
        weigh("p").alias("precision"), weigh("r").alias("recall"), weigh("f").alias("f1_score"))


def roc_auc_by(df: DataFrame, groups: list[str], label: str = "label", score: str = "probability", ranges: int = 4096, share: str = "s") -> DataFrame:
    """(groups, auc): exact area under the ROC curve of each group, all in one plan; scores ``s`` lie in [0, 1], or ``share`` is an
    expression that lies there and never falls where they rise.

    Equal scores collapse first. Scores are ordered inside equal parts of the unit interval; what lies below a part comes
    from a table of one row for each group and part. A group without one of the classes has no area.
    """
    keys = [q(g) for g in groups]
    cells = df.selectExpr(*keys, f"{double(label)} AS y", f"{double(score)} AS s").where("y IS NOT NULL AND s IS NOT NULL").groupBy(
        *groups, "s").agg(F.expr("count_if(y = 1) AS pos"), F.expr("count_if(y <> 1) AS neg")).selectExpr("*", f"floor(({share}) * {ranges}) AS part")
    within = f"OVER (PARTITION BY {', '.join(keys)}, part ORDER BY s)"
    parts = cells.selectExpr(*keys, "part", "pos", "neg", f"sum(neg) {within} - neg AS below").groupBy(*groups, "part").agg(
        F.expr("sum(pos) AS pos"), F.expr("sum(neg) AS neg"), F.expr("sum(pos * (below + neg / 2D)) AS area"))
    before = f"OVER (PARTITION BY {', '.join(keys)} ORDER BY part)"
    placed = parts.selectExpr(*keys, "pos", "neg", f"area + pos * (sum(neg) {before} - neg) AS area")
    return placed.groupBy(*groups).agg(F.expr("try_divide(sum(area), CAST(sum(pos) AS DOUBLE) * sum(neg)) AS auc"))


def roc_auc(df: DataFrame, label: str = TARGET, score: str = "probability", ranges: int = 1024) -> float | None:
    """Exact area under the ROC curve; equal scores of both classes count one half.

    Equal scores collapse first. The distinct scores are cut into ranges of equal size; what
    lies below a range comes from a table of range totals, and only inside a range are scores
    ordered, so no task sees more than a small part of them. None when a class is absent.
    """
    data = df.selectExpr(f"{double(label)} AS label", f"{double(score)} AS score").dropna()
    by_score = data.groupBy("score").agg(
        F.expr("count_if(label = 1) AS pos"), F.expr("count_if(label <> 1) AS neg"))
    with reused(by_score) as scores:
        total = scores.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.count("*").alias("n")).first()
        if not total.pos or not total.neg:
            return None
        edges = split_points(scores, "score", min(ranges, total.n)) if total.n > 1 else []
        placed = Bucketizer(splits=[-float("inf"), *edges, float("inf")], inputCol="score",
                            outputCol="range").transform(scores)
        totals = placed.groupBy("range").agg(F.sum("neg").alias("neg"))
        offsets = totals.selectExpr("range", "sum(neg) OVER (ORDER BY range) - neg AS offset")
        ordered = placed.selectExpr(
            "range", "pos", "neg", "sum(neg) OVER (PARTITION BY range ORDER BY score) - neg AS below")
        area = join_lookup(ordered, offsets, "range").agg(
            F.expr("sum(pos * (offset + below + neg / 2D))")).first()[0]
    return area / (float(total.pos) * float(total.neg))


def evaluation_report(scored: DataFrame, label: str = TARGET, model_name: str = "model") -> DataFrame:
    """One row with the five headline metrics and the four matrix cells."""
    with reused(scored.select(q(label), "prediction", "probability")) as table:
        matrix = confusion_matrix(table, label)
        cells = confusion_counts(matrix).first()
        headline = weighted_metrics(matrix).first()
        auc = roc_auc(table, label)
    return scored.sparkSession.createDataFrame(
        [(model_name, *headline, auc, *cells)],
        "model_name string, accuracy double, precision double, recall double, f1_score double, roc_auc double, "
        "true_negatives bigint, false_positives bigint, false_negatives bigint, true_positives bigint")


HEADLINE = ("accuracy", "precision", "recall", "f1_score", "roc_auc")


def metric_card(report: DataFrame) -> DataFrame:
    """The five headline metrics as (metric, value) rows with their rounded display text."""
    cells = array([struct(metric=text(m), value=f"coalesce({m}, 0D)") for m in HEADLINE])
    return report.selectExpr("model_name", f"inline({cells})").selectExpr(
        "*", "format_string('%.3f', value) AS display")
