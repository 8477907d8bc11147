"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are words and the beginnings of words. A bounded sample of labelled rows gives the examples and, by association
with the label, the vocabulary; inverse document frequencies of its terms come from all documents. The examples lie in an
inverted index whose postings are cut into blocks with the largest weight of each term in each block. A query visits
blocks by falling bound and stops when no block left can beat its nearest examples so far, so the neighbours are exact.
Their labels vote with the cosine as weight, and a logistic curve fitted to leave-one-out votes calibrates the score.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, StringType, StructField, StructType

from riskframe.llm.common import partitions, per_worker, staged

#: Bound of the sample: labelled rows of each class.
SAMPLE = {1: 3000, 0: 6000}
#: Terms are kept if this many sampled rows have them and their association with label 1 reaches so many standard errors.
LEAST_ROWS, LEAST_Z, MAX_TERMS = 5, 4.5, 8192
PREFIXES = range(4, 10)
NEIGHBOURS = 25
BLOCK = 64
#: Blocks a query visits first; then four times as many at a time.
FIRST_BLOCKS = 16
MAX_WORDS = 300_000
STRIP = ".,;:!?\"'()[]{}<>|*#$%&_-/\\"


def terms_of(word: str) -> list[str]:
    """A word without the marks around it, and its beginnings of a few lengths."""
    bare = word.strip(STRIP)
    return [bare, *(bare[:k] + "*" for k in PREFIXES if k < len(bare))] if bare else []


class Vocabulary:
    """Counts of the vocabulary's terms in a text; what a word contributes is kept."""

    def __init__(self, terms: list[str]):
        self.number = {term: i for i, term in enumerate(terms)}
        self.known: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str | None) -> dict[int, int]:
        words = (text or "").lower().split()
        if len(self.known) > MAX_WORDS:
            self.known.clear()
        for word in set(words).difference(self.known):
            self.known[word] = tuple(self.number[t] for t in terms_of(word) if t in self.number)
        out: dict[int, int] = {}
        for found in filter(None, map(self.known.__getitem__, words)):
            for term in found:
                out[term] = out.get(term, 0) + 1
        return out


def weighted(terms: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    w = (1 + np.log(counts)) * idf[terms]
    return w / max(np.sqrt(w @ w), 1e-12)


class BlockMaxIndex:
    """Examples as unit vectors (terms, weights) in block-max postings."""

    def __init__(self, examples: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        self.n = len(examples)
        self.blocks = max(1, -(-self.n // BLOCK))
        owner = np.repeat(np.arange(self.n), [len(t) for t, _ in examples])
        terms = np.concatenate([t for t, _ in examples]) if examples else np.zeros(0, np.int64)
        weights = np.concatenate([w for _, w in examples]) if examples else np.zeros(0)
        order = np.lexsort((owner, terms))
        self.owner, self.weight = owner[order], weights[order]
        cell = terms[order] * self.blocks + self.owner // BLOCK
        self.begin = np.searchsorted(cell, np.arange(n_terms * self.blocks + 1)).reshape(-1)
        self.top = np.zeros(n_terms * self.blocks, np.float32)
        np.maximum.at(self.top, cell, self.weight.astype(np.float32))
        self.top = np.nextafter(self.top, np.float32(2)).reshape(n_terms, self.blocks)  # a bound, also when rounded

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of the largest cosine above 0 and the cosines; equal cosines go to the earlier example."""
        bound = weights @ self.top[terms]
        ids, scores, least = np.zeros(0, np.int64), np.zeros(0), 0.0
        order, at, size = np.argsort(-bound, kind="stable"), 0, FIRST_BLOCKS
        while at < self.blocks:
            some = order[at:at + size]
            at, size = at + size, size * 4
            some = some[bound[some] >= least] if len(ids) == k else some[bound[some] > 0]
            if not len(some):
                break
            cells = terms[:, None] * self.blocks + some
            begin = self.begin[cells].ravel()
            sizes = self.begin[cells + 1].ravel() - begin
            total = int(sizes.sum())
            if not total:
                continue
            post = np.repeat(begin - np.cumsum(sizes) + sizes, sizes) + np.arange(total)
            q = np.repeat(np.repeat(weights, len(some)), sizes)
            score = np.bincount(self.owner[post], q * self.weight[post], self.n)
            if without >= 0:
                score[without] = 0.0
            found = np.flatnonzero(score)
            if len(found) > 4 * k:  # far from the best; equal scores all stay
                found = found[score[found] >= np.partition(score[found], -k)[-k]]
            ids, scores = np.concatenate([ids, found]), np.concatenate([scores, score[found]])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            least = scores[-1] - 1e-9 if len(scores) else 0.0
        return ids, scores


class Model:
    """Examples, their labels and ids, and the calibration."""

    def __init__(self, terms: list[str], idf: np.ndarray, examples: list, labels: np.ndarray, keys: list, prior: float, curve=None):
        self.idf, self.labels, self.keys, self.terms, self.prior = idf, labels, keys, terms, prior
        self.vectors = [(t, weighted(t, c, idf)) for t, c in examples]
        self.index = BlockMaxIndex(self.vectors, len(terms))
        self.examples, self.curve = examples, curve

    def vote(self, terms: np.ndarray, counts: np.ndarray, without: int = -1) -> tuple[float, float, list[tuple[int, float]]]:
        """Distance-weighted share of label 1 among the nearest, the weight of the text's terms, and the nearest."""
        ids, cosine = self.index.nearest(terms, weighted(terms, counts, self.idf), NEIGHBOURS, without) if len(terms) else ((), ())
        if not len(ids):
            return self.prior, 0.0, []
        mass = float(np.log1p(((1 + np.log(counts)) * self.idf[terms]).sum()))
        return float(cosine @ self.labels[ids] / cosine.sum()), mass, list(zip(ids.tolist(), cosine.tolist()))

    def calibrate(self, weights: np.ndarray) -> None:
        """Fit the curve to each example's vote without itself; texts without any term have a rate of their own."""
        votes = [self.vote(t, c, i) for i, (t, c) in enumerate(self.examples)]
        x = np.array([features(v, m) for v, m, _ in votes]).reshape(len(votes), 3)
        beta = np.zeros(3)
        for _ in range(50):
            p = 1 / (1 + np.exp(-x @ beta))
            h = (x * (weights * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
            beta = beta + np.linalg.solve(h, x.T @ (weights * (self.labels - p)) - 0.1 * beta)
        self.curve = beta

    def score(self, terms: np.ndarray, counts: np.ndarray) -> tuple[float, list[tuple[int, float]]]:
        vote, mass, near = self.vote(terms, counts)
        return float(1 / (1 + np.exp(-np.dot(features(vote, mass), self.curve)))), near


def features(vote: float, mass: float) -> tuple[float, float, float]:
    return 1.0, float(np.log((vote + 0.02) / (1.02 - vote))), mass


def held_out(key: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, key: str, text_col: str, label_col: str) -> tuple[DataFrame, dict[int, int]]:
    """(id, text, y) of the bounded sample, chosen by hashes of the keys, and how many rows each class has."""
    able = labels.where(~held_out(key)).groupBy(F.col(f"`{key}`").alias("id")).agg(F.max(f"`{label_col}`").cast("int").alias("y")).where(
        "id is not null and y in (0, 1)")
    totals = {r["y"]: r["n"] for r in able.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = Window.partitionBy("y").orderBy(F.xxhash64("id"), "id")
    bound = F.when(F.col("y") == 1, SAMPLE[1]).otherwise(SAMPLE[0])
    chosen = able.withColumn("r", F.row_number().over(order)).where(F.col("r") <= max(SAMPLE.values())).where(F.col("r") <= bound).drop("r")
    return docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text_col}`").alias("text")).join(F.broadcast(chosen), "id"), totals


def vocabulary(rows: DataFrame, n: dict[int, int]) -> list[str]:
    """Terms associated with label 1, by the difference of their shares of rows; at most ``MAX_TERMS`` reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[str, list[int]] = {}
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for term in {t for w in set((text or "").lower().split()) for t in terms_of(w)}:
                    count.setdefault(term, [0, 0])[y] += 1
        yield pa.RecordBatch.from_arrays([pa.array(count, pa.string()), pa.array([c[0] for c in count.values()], pa.int64()),
                                          pa.array([c[1] for c in count.values()], pa.int64())], ["term", "n0", "n1"])

    counts = rows.select("text", "y").mapInArrow(run, "term string, n0 bigint, n1 bigint").groupBy("term").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where(F.col("n0") + F.col("n1") >= LEAST_ROWS)
    share = (F.col("n0") + F.col("n1")) / (n[0] + n[1])
    z = (F.col("n1") / n[1] - F.col("n0") / n[0]) / F.sqrt(share * (1 - share) * (1 / n[0] + 1 / n[1]) + 1e-12)
    return [r["term"] for r in counts.withColumn("z", z).where(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "term").limit(MAX_TERMS).collect()]


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(key, held_out, score, predicted, evidence) of each document; only text enters a score.

    ``evidence`` is a JSON list of the three nearest examples with cosine and label. Null and empty texts and texts without
    any term of the vocabulary get the rate of such texts. Without rows of both labels every score is the share of label 1
    (0 without rows). Rows with a null key are scored and not held out; repeated rows stay; an empty table gives an empty
    table; further columns are not read.
    """
    spark, mark = docs.sparkSession, uuid.uuid4().hex
    rows, totals = sample(docs, labels, key, text_col, label_col)
    prior = totals.get(1, 0) / max(1, sum(totals.values()))
    rows = staged(rows, "sample")
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    terms = vocabulary(rows, sizes) if len(sizes) == 2 else []
    schema = StructType([StructField("id", docs.schema[key].dataType), StructField("out", BooleanType()),
                         StructField("terms", ArrayType(IntegerType())), StructField("counts", ArrayType(IntegerType()))])
    shared_terms = spark.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = per_worker("toxicity.terms", mark, lambda: Vocabulary(shared_terms.value))
        for batch in batches:
            found = [counted(text) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([list(f) for f in found], pa.list_(pa.int32())),
                                              pa.array([list(f.values()) for f in found], pa.list_(pa.int32()))], schema.names)

    coded = staged(docs.select(F.col(f"`{key}`"), held_out(key), F.col(f"`{text_col}`")).mapInArrow(count, schema), "terms")
    n = coded.count()
    df = np.zeros(len(terms))
    for r in coded.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("n")).collect():  # one row for each term
        df[r["t"]] = r["n"]
    idf = np.log((n + 1) / (df + 1)) + 1
    local = Vocabulary(terms)
    kept = sorted(((r["id"], r["y"], local(r["text"])) for r in rows.toLocalIterator()), key=lambda x: x[0])
    examples = [(np.fromiter(f, np.int64, len(f)), np.fromiter(f.values(), np.float64, len(f))) for _, _, f in kept]
    model = Model(terms, idf, examples, np.array([y for _, y, _ in kept], float), [k for k, _, _ in kept], prior)
    if len(sizes) == 2:
        model.calibrate(np.array([totals[y] / sizes[y] for _, y, _ in kept]))
    shared = spark.sparkContext.broadcast((terms, idf, examples, model.labels, model.keys, prior, model.curve))
    out = StructType([StructField(key, docs.schema[key].dataType), StructField("held_out", BooleanType()), StructField("score", DoubleType()),
                      StructField("predicted", IntegerType()), StructField("evidence", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = per_worker("toxicity.neighbours", mark, lambda: Model(*shared.value))
        known: dict[bytes, tuple[float, str]] = {}
        for batch in batches:
            scores, evidence = [], []
            for t, c in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                t, c = np.array(t, np.int64), np.array(c, np.float64)
                order = np.argsort(t)
                t, c = t[order], c[order]
                vector = t.tobytes() + c.tobytes()
                if vector not in known:
                    if len(known) > MAX_WORDS // 10:
                        known.clear()
                    if fitted.curve is None:
                        known[vector] = (fitted.prior, "[]")
                    else:
                        p, near = fitted.score(t, c)
                        known[vector] = (p, json.dumps([[fitted.keys[i], round(s, 6), int(fitted.labels[i])] for i, s in near[:3]]))
                scores.append(known[vector][0])
                evidence.append(known[vector][1])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64()),
                                              pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(evidence, pa.string())], out.names)

    # the rows are small but their neighbours take time, so they are spread over all tasks
    return coded.repartition(partitions(spark)).mapInArrow(run, out)
