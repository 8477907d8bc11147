"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the bytes of a word in both directions, labels every byte, and a document's languages are the mean of
its positions' probabilities. Reading starts anew at white space (and after ``LONGEST`` bytes), so equal words get equal
labels and each distinct word is run once for a stretch of documents. Training is plain numpy: backpropagation through
time on a bounded sample of labelled rows. Everything else covers whole texts of all documents.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from riskframe.llm.common import batches_of, per_worker

#: Bound of the training sample: documents of each language, and distinct (language, word) pairs from them.
SAMPLE_DOCS, SAMPLE_WORDS = 400, 40_000
HIDDEN, LONGEST = 16, 32
BATCH, STEPS, RATE, SEED = 256, 900, 0.01, 7
#: Documents, and words of one length, that are run together.
STRETCH, RUN = 256, 8192
MAX_WORDS = 300_000
NONE = "und"

_LETTER = re.compile(r"[^\W\d_]")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Network:
    """Weights of both directions side by side: byte inputs, recurrence, and one output layer over both states."""

    def __init__(self, languages: list[str], weights: dict[str, np.ndarray] | None = None):
        self.languages = languages
        draw, h, n = np.random.default_rng(SEED), HIDDEN, len(languages)
        self.w = weights or {
            "x": draw.normal(0, 0.3, (2, 256, 3 * h)).astype(np.float32), "u": draw.normal(0, h ** -0.5, (2, h, 3 * h)).astype(np.float32),
            "o": draw.normal(0, 0.3, (2, h, n)).astype(np.float32), "b": np.zeros(n, np.float32)}

    def _read(self, x: np.ndarray) -> list[tuple]:
        """State and gates of each step for words of one length, (words, length) bytes."""
        h = HIDDEN
        both, state, steps = np.stack([x, x[:, ::-1]]), np.zeros((2, len(x), h), np.float32), []
        for t in range(x.shape[1]):
            into = np.stack([self.w["x"][d][both[d, :, t]] for d in (0, 1)])
            back = state @ self.w["u"]
            gates = _sigmoid(into[..., :2 * h] + back[..., :2 * h])
            keep, reset = gates[..., :h], gates[..., h:]
            new = np.tanh(into[..., 2 * h:] + reset * back[..., 2 * h:])
            steps.append((both[:, :, t], state, keep, reset, new, back[..., 2 * h:]))
            state = new + keep * (state - new)
        steps.append((None, state))
        return steps

    def _label(self, steps: list[tuple]) -> np.ndarray:
        """Probabilities (length, words, languages) of every position."""
        length = len(steps) - 1
        ahead = np.stack([steps[t + 1][1][0] for t in range(length)])
        behind = np.stack([steps[length - t][1][1] for t in range(length)])
        logits = ahead @ self.w["o"][0] + behind @ self.w["o"][1] + self.w["b"]
        p = np.exp(logits - logits.max(-1, keepdims=True))
        return p / p.sum(-1, keepdims=True)

    def positions(self, x: np.ndarray) -> np.ndarray:
        return self._label(self._read(x))

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over all positions and its gradients, by backpropagation through time."""
        h, length, steps = HIDDEN, x.shape[1], self._read(x)
        p = self._label(steps)
        loss = -np.log(p[:, np.arange(len(x)), y] + 1e-9).mean()
        p[:, np.arange(len(x)), y] -= 1
        p /= length * len(x)
        grad = {k: np.zeros_like(v) for k, v in self.w.items()}
        grad["b"] = p.sum((0, 1))
        down = np.stack([p @ self.w["o"][0].T, p[::-1] @ self.w["o"][1].T], 1)  # by reading step of each direction
        for t in range(length):
            grad["o"][0] += steps[t + 1][1][0].T @ p[t]
            grad["o"][1] += steps[t + 1][1][1].T @ p[length - 1 - t]
        later = np.zeros_like(steps[0][1])
        for t in range(length - 1, -1, -1):
            symbols, state, keep, reset, new, back = steps[t]
            d = later + down[t]
            d_new = d * (1 - keep) * (1 - new * new)
            d_keep = d * (state - new) * keep * (1 - keep)
            d_reset = d_new * back * reset * (1 - reset)
            into = np.concatenate([d_keep, d_reset, d_new], -1)
            rec = np.concatenate([d_keep, d_reset, d_new * reset], -1)
            for k in (0, 1):
                np.add.at(grad["x"][k], symbols[k], into[k])
            grad["u"] += state.transpose(0, 2, 1) @ rec
            later = d * keep + rec @ self.w["u"].transpose(0, 2, 1)
        return float(loss), grad


def parts(words: list[bytes]) -> list[bytes]:
    return [w[i:i + LONGEST] for w in words for i in range(0, len(w), LONGEST)]


def fit(rows: list[tuple[str, str, int]], steps: int = STEPS) -> Network | None:
    """A network from (language, word, count) rows; None without rows."""
    languages = sorted({lang for lang, _, _ in rows})
    if not languages:
        return None
    net, draw = Network(languages), np.random.default_rng(SEED)
    by_length: dict[int, tuple[list, list, list]] = {}
    share = {lang: 0.0 for lang in languages}
    for lang, word, count in rows:
        share[lang] += count ** 0.5
    for lang, word, count in rows:
        for part in parts([word.encode("utf-8", "surrogatepass")]):
            x, y, w = by_length.setdefault(len(part), ([], [], []))
            x.append(part), y.append(languages.index(lang)), w.append(count ** 0.5 / share[lang])  # languages weigh the same
    groups = [(np.frombuffer(b"".join(x), np.uint8).reshape(len(x), n), np.array(y), np.array(w) / sum(w), sum(w) * n)
              for n, (x, y, w) in sorted(by_length.items())]
    mass = np.array([g[3] for g in groups]) / sum(g[3] for g in groups)
    mean, square = ({k: np.zeros_like(v) for k, v in net.w.items()} for _ in range(2))
    for step in range(1, steps + 1):
        x, y, w, _ = groups[draw.choice(len(groups), p=mass)]
        at = draw.choice(len(x), BATCH, p=w)
        _, grad = net.gradients(x[at], y[at])
        rate = RATE * min(1.0, 2 - 2 * step / steps)
        for k, g in grad.items():
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.999 * square[k] + 0.001 * g * g
            net.w[k] -= (rate * mean[k] / (1 - 0.9 ** step) / (np.sqrt(square[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net


class Labeller:
    """Language probabilities of texts, with each distinct word's sums over its positions kept."""

    def __init__(self, net: Network):
        self.net, self.known = net, {}
        self.sums = np.zeros((0, len(net.languages) + 1), np.float32)

    def _learn(self, new: list[bytes]) -> None:
        by_length: dict[int, list[bytes]] = {}
        for word in new:
            by_length.setdefault(len(word), []).append(word)
        found = [self.sums]
        for length, words in by_length.items():
            for i in range(0, len(words), RUN):
                some = words[i:i + RUN]
                p = self.net.positions(np.frombuffer(b"".join(some), np.uint8).reshape(len(some), length)).sum(0)
                found.append(np.concatenate([p, np.full((len(some), 1), length, np.float32)], 1))
                self.known.update(zip(some, range(len(self.known), len(self.known) + len(some))))
        self.sums = np.concatenate(found)

    def pooled(self, texts: list[str]) -> np.ndarray:
        """Mean probabilities over all positions of each text, (texts, languages); zero without words."""
        if len(self.known) > MAX_WORDS:
            self.known, self.sums = {}, self.sums[:0]
        split = [text.encode("utf-8", "surrogatepass").split() for text in texts]
        split = [parts(words) if max(map(len, words), default=0) > LONGEST else words for words in split]
        self._learn([w for w in dict.fromkeys(w for words in split for w in words) if w not in self.known])
        out = np.zeros((len(texts), self.sums.shape[1]))
        for k, words in enumerate(split):
            at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            out[k] = self.sums[at].sum(0, dtype=np.float64)
        return out[:, :-1] / np.maximum(out[:, -1:], 1)


def held_out(key: str) -> F.Column:
    return F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % 4 == 2


def sample_words(docs: DataFrame, key: str, text_col: str, lang_col: str) -> list[tuple[str, str, int]]:
    """(language, word, count) rows of a bounded sample of rows that may be learned from, chosen by hashes of keys and words."""
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    able = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{lang_col}`").alias("lang"), F.coalesce(held_out(key), F.lit(False)).alias("out"))
    chosen = able.where("lang is not null and id is not null and not out").withColumn("r", F.row_number().over(order)).where(
        F.col("r") <= SAMPLE_DOCS).select("id", "lang")
    texts = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text_col}`").alias("text")).join(F.broadcast(chosen), "id")
    words = texts.select("lang", F.explode(F.split("text", r"\s+")).alias("word")).where(F.col("word").rlike(r"\p{L}"))
    counts = words.groupBy("lang", "word").agg(F.count("*").alias("n"))
    rows = counts.orderBy(F.xxhash64("word", "lang"), "word", "lang").limit(SAMPLE_WORDS).collect()
    return [(r["lang"], r["word"], r["n"]) for r in rows]


def identify(docs: DataFrame, key: str = "doc_id", text_col: str = "text", lang_col: str = "lang", keep: bool = False) -> DataFrame:
    """(key, held_out, lang_pred, score) of each document, with all columns of ``docs`` if ``keep``; only text enters a prediction.

    ``lang_pred`` is a learned language, or ``und`` with score 0 where the text is null or has no letter (for every text,
    if no row can be learned from). Rows whose language or key is null are not learned from; a null key is not held out.
    Ties go to the language first in the alphabet. Repeated rows stay; an empty table gives an empty table; further
    columns are not read unless kept, and columns named like the results are replaced.
    """
    batches_of(docs.sparkSession)
    net = fit(sample_words(docs, key, text_col, lang_col))
    mark = uuid.uuid4().hex
    shared = docs.sparkSession.sparkContext.broadcast((net.languages, net.w) if net else None)
    results = [StructField("held_out", BooleanType()), StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    names = {f.name for f in results}
    carried = [f for f in docs.schema if f.name not in names and (keep or f.name == key)]
    schema = StructType([*carried, *results])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = None
        if shared.value:
            languages, weights = shared.value
            labeller = per_worker("rnn", mark, lambda: Labeller(Network(languages, weights)))
        for batch in batches:
            texts, named, scores = batch.column(0).to_pylist(), [], []
            for i in range(0, len(texts), STRETCH):
                some = [text or "" for text in texts[i:i + STRETCH]]
                pooled = labeller.pooled(some) if labeller else None
                for k, text in enumerate(some):
                    known = labeller is not None and _LETTER.search(text) is not None
                    best = int(pooled[k].argmax()) if known else 0
                    named.append(languages[best] if known else NONE)
                    scores.append(min(1.0, float(pooled[k, best])) if known else 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], batch.column(1), pa.array(named, pa.string()), pa.array(scores, pa.float64())], schema.names)

    slim = docs.select(F.col(f"`{text_col}`").alias("__text"), F.coalesce(held_out(key), F.lit(False)).alias("__out"),
                       *[F.col(f"`{f.name}`") for f in carried])
    return slim.mapInArrow(run, schema)
