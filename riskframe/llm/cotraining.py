"""Document quality by co-training.

Two classifiers see different sides of a document: one its text (shares of character classes, repetition, line and word
shapes), the other its metadata (source, language, stated length). Both start from the same labelled rows; in each round
each labels the unlabelled documents it is most sure of and hands them to the other. At the end each view is calibrated
on labelled rows that neither was trained on, and the calibrated views are combined into one score for every document.

Classifiers are fitted on bounded samples chosen by hashes of the keys; scoring covers whole texts of all documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from riskframe.llm.common import batches_of

#: Bounds of the samples: labelled rows of each class, and unlabelled documents.
SAMPLE_LABELLED, SAMPLE_UNLABELLED = 3000, 6000
ROUNDS = 5
#: Share of the unlabelled sample that each view labels in a round, at most, and how sure it has to be.
HANDED, SURE = 0.04, 0.95
#: Share of the labelled sample kept for calibration.
CALIBRATION = 0.3
SOURCE_SLOTS, LANG_SLOTS = 64, 16

_MARKS = b"|!#$%&*<>=_{}[]\\/@^~+;:\"'()"


def text_features(text: str | None) -> list[float]:
    """The text view: shares of character classes, repetition, and shapes of words and lines."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words, lines = text.split(), text.split("\n")
    n, w = max(1, len(data)), max(1, len(words))
    histogram = np.bincount(np.frombuffer(data, np.uint8), minlength=256) / n
    distinct = len(set(words))
    pairs = set(zip(words, words[1:]))
    same = sum(map(str.__eq__, words, words[1:]))
    upper = sum(map(str.isupper, words))
    longest = max(map(len, words), default=0)
    return [
        *(histogram[m] for m in _MARKS),
        histogram[48:58].sum(), histogram[65:91].sum(), histogram[97:123].sum(), histogram[128:].sum(), histogram[32], histogram[10],
        histogram[46], histogram[44], float(-(histogram * np.log(histogram + 1e-12)).sum()),
        distinct / w, len(pairs) / w, same / w, upper / w, np.log1p(w), np.log1p(len(lines)), np.log1p(longest),
        np.log1p(n / w), len(set(lines)) / len(lines), float(same > 3),
    ]


def meta_features(source: str | None, lang: str | None, n_chars: int | None) -> list[float]:
    """The metadata view: hashed source and language, stated length in a few forms."""
    out = [0.0] * (SOURCE_SLOTS + LANG_SLOTS)
    if source is not None:
        out[zlib.crc32(str(source).encode("utf-8", "surrogatepass")) % SOURCE_SLOTS] = 1.0
    if lang is not None:
        out[SOURCE_SLOTS + zlib.crc32(str(lang).encode("utf-8", "surrogatepass")) % LANG_SLOTS] = 1.0
    size = np.log1p(max(0, n_chars or 0))
    return out + [size, size * size / 10, float(n_chars is None), *(float(n_chars is not None and n_chars < k) for k in (50, 200, 800, 3000, 12000))]


class Logistic:
    """Penalised logistic regression on standardised features and their squares."""

    def __init__(self, penalty: float = 1.0):
        self.penalty = penalty

    def _wide(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        return np.concatenate([z, z * z, np.ones((len(x), 1))], 1)

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Logistic:
        self.mean, self.spread = x.mean(0), x.std(0) + 1e-6
        z = self._wide(x)
        self.beta = np.zeros(z.shape[1])
        ridge = self.penalty * np.eye(z.shape[1])
        ridge[-1, -1] = 1e-6
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(z @ self.beta, -30, 30)))
            step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + ridge, z.T @ (weight * (y - p)) - ridge @ self.beta)
            self.beta += step * min(1.0, 5 / (np.abs(step).max() + 1e-9))
            if np.abs(step).max() < 1e-4:
                break
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._wide(x) @ self.beta, -30, 30)


def curve(logits: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a logistic curve over calibrating logits, (columns + 1)."""
    x = np.concatenate([logits, np.ones((len(logits), 1))], 1)
    beta, ridge = np.r_[np.full(logits.shape[1], 1 / logits.shape[1]), 0.0], 0.1
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - ridge * beta)
        beta += step * min(1.0, 2 / (np.abs(step).max() + 1e-9))
    return beta


class CoTrained:
    """Both views, their calibration curves and their combination; scores are the probability of label 1."""

    def __init__(self, x: tuple[np.ndarray, np.ndarray], y: np.ndarray, weight: np.ndarray, pool: tuple[np.ndarray, np.ndarray], held: np.ndarray):
        train = ~held
        own = [(v[train], y[train], weight[train]) for v in x]
        left, share = np.ones(len(pool[0]), bool), float(np.average(y, weights=weight))
        self.views = [Logistic().fit(*o) for o in own]
        self.handed = 0
        for _ in range(ROUNDS):
            for giver, taker in ((0, 1), (1, 0)):
                p = 1 / (1 + np.exp(-self.views[giver].logit(pool[giver])))
                for label, sure, part in ((1, p, share), (0, 1 - p, 1 - share)):
                    most = max(1, int(HANDED * part * len(p))) if len(p) else 0
                    at = np.flatnonzero(left & (sure >= SURE))
                    at = at[np.argsort(-sure[at], kind="stable")[:most]]
                    left[at] = False
                    self.handed += len(at)
                    own[taker] = (np.concatenate([own[taker][0], pool[taker][at]]), np.concatenate([own[taker][1], np.full(len(at), float(label))]),
                                  np.concatenate([own[taker][2], np.full(len(at), float(weight.mean()))]))
            self.views = [Logistic().fit(*o) for o in own]
        rest = held if held.any() and 0 < y[held].mean() < 1 else train
        logits = np.stack([view.logit(v[rest]) for view, v in zip(self.views, x)], 1)
        self.curves = [curve(logits[:, [k]], y[rest], weight[rest]) for k in (0, 1)]
        calibrated = np.stack([logits[:, k] * c[0] + c[1] for k, c in enumerate(self.curves)], 1)
        self.both = curve(calibrated, y[rest], weight[rest])

    def __call__(self, x: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Combined score, text view, metadata view."""
        calibrated = [view.logit(v) * c[0] + c[1] for view, v, c in zip(self.views, x, self.curves)]
        both = calibrated[0] * self.both[0] + calibrated[1] * self.both[1] + self.both[2]
        return tuple(1 / (1 + np.exp(-np.clip(v, -30, 30))) for v in (both, *calibrated))


def held_out(key: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _features(batch: pa.RecordBatch, first: int) -> tuple[np.ndarray, np.ndarray]:
    columns = [batch.column(first + k).to_pylist() for k in range(4)]
    return (np.array([text_features(t) for t in columns[0]]).reshape(batch.num_rows, -1),
            np.array([meta_features(*m) for m in zip(*columns[1:])]).reshape(batch.num_rows, -1))


def _view_columns(docs: DataFrame, text_col: str) -> list[F.Column]:
    """Text, source, lang, n_chars; what a table lacks is null."""
    return [F.col(f"`{text_col}`"), *((F.col(c) if c in docs.columns else F.lit(None)).cast(kind).alias(c)
                                      for c, kind in (("source", "string"), ("lang", "string"), ("n_chars", "bigint")))]


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> CoTrained | None:
    """The two views from bounded samples of rows that may be learned from; None unless both labels occur."""
    able = labels.where(~held_out(key)).groupBy(F.col(f"`{key}`").alias("id")).agg(F.min(f"`{label_col}`").cast("int").alias("y")).where(
        "id is not null and y in (0, 1)")
    totals = {r["y"]: r["n"] for r in able.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return None
    order = Window.partitionBy("y").orderBy(F.xxhash64("id"), "id")
    chosen = able.withColumn("r", F.row_number().over(order)).where(F.col("r") <= SAMPLE_LABELLED).drop("r")
    pool = docs.select(F.col(f"`{key}`").alias("id")).where("id is not null").join(able, "id", "left_anti").where(~held_out("id")).orderBy(
        F.xxhash64("id"), "id").limit(SAMPLE_UNLABELLED).withColumn("y", F.lit(-1))
    wanted = chosen.unionByName(pool).distinct()
    schema = "id bigint, y int, t array<double>, m array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, meta = _features(batch, 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(text), pa.list_(pa.float64())),
                                              pa.array(list(meta), pa.list_(pa.float64()))], ["id", "y", "t", "m"])

    slim = docs.select(F.col(f"`{key}`").cast("bigint").alias("id"), *_view_columns(docs, text_col)).join(F.broadcast(wanted), "id")
    rows = slim.select("id", "y", text_col, "source", "lang", "n_chars").mapInArrow(run, schema).toPandas().sort_values("id", kind="stable")
    if rows.empty:
        return None
    text, meta, y = np.stack(rows["t"]), np.stack(rows["m"]), rows["y"].to_numpy()
    marked = y >= 0
    got = {k: int((y == k).sum()) for k in (0, 1)}
    if not all(got.values()):
        return None
    weight = np.where(y[marked] == 1, totals[1] / got[1], totals[0] / got[0])
    held = np.array([zlib.crc32(f"calibration {i}".encode()) % 1000 < CALIBRATION * 1000 for i in rows["id"][marked]])
    return CoTrained((text[marked], meta[marked]), y[marked].astype(float), weight / weight.mean(), (text[~marked], meta[~marked]), held)


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          keep: bool = False) -> DataFrame:
    """(key, held_out, score, predicted, text_score, meta_score) of each document, with all columns of ``docs`` if ``keep``.

    Scores are probabilities of label 1. Rows of ``labels`` whose crc32(key) mod 5 is 0 are never learned from. Null texts
    count as empty, null metadata is a value of its own. Unless both labels can be learned every score is 1: nothing is
    known against a document. Repeated rows stay; an empty table gives an empty table; columns named like the results
    are replaced.
    """
    batches_of(docs.sparkSession)
    fitted = fit(docs, labels, key, text_col, label_col)  # a few hundred numbers, sent with the task
    results = [StructField("held_out", BooleanType()), StructField("score", DoubleType()), StructField("predicted", IntegerType()),
               StructField("text_score", DoubleType()), StructField("meta_score", DoubleType())]
    names = {f.name for f in results}
    carried = [f for f in docs.schema if f.name not in names and (keep or f.name == key)]
    schema = StructType([*carried, *results])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if fitted is None:
                scores = [np.ones(batch.num_rows)] * 3
            else:
                scores = fitted(_features(batch, 0))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[5:], batch.column(4), pa.array(scores[0]), pa.array((scores[0] >= 0.5).astype(np.int32)), pa.array(scores[1]),
                 pa.array(scores[2])], schema.names)

    views = [c.alias(f"__{k}") for k, c in enumerate(_view_columns(docs, text_col))]
    return docs.select(*views, held_out(key).alias("__out"), *[F.col(f"`{f.name}`") for f in carried]).mapInArrow(run, schema)
