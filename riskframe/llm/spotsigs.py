"""Document fingerprints by spot signatures.

A common word anchors a chain of the content words that follow it; anchor and chain make one signature, and the set of a
document's signatures is its fingerprint. Frames of pages and edits far from the anchors leave most signatures alone.
Likeness is the Jaccard index of two sets. ``similar`` finds all pairs above a threshold: sets are partitioned by length,
so that only sets whose lengths allow the threshold meet, an inverted index over the rarest signatures of each set gives
the candidates, and the comparison stops when the rest of a set can't reach the threshold any more.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from riskframe.llm.common import partitions, per_worker, staged

#: Content words in a chain, and the step from one to the next.
CHAIN, DISTANCE = 3, 2
#: Rows of one run of consecutive documents, on average; beyond ``MAX_CUTS`` runs they grow longer.
RUN_ROWS, MAX_CUTS = 512, 1 << 16
MAX_WORDS = 300_000

# Common words of English, German, French and Spanish.
COMMON = frozenset(
    "the a an and or of to in is it that this was for on are as with be by at from he she they we you not have has had but "
    "der die das und ist ein eine nicht mit von zu den dem des im in auf sich für als auch es an werden aus er hat dass sie "
    "le la les de des du et un une est en que qui dans pour pas sur au par il elle ne se ce plus avec sont "
    "el los las del y que en un una por con para es no se al lo como más su sus".split())

_MIX = np.uint64(0x9E3779B97F4A7C15)
_CONTENT, _ANCHOR, _NOTHING = 0, 1, 2


class Words:
    """Word hashes whose two low bits tell content words, anchors and bare punctuation apart; kept between texts."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        words, known = text.lower().split(), self.known
        if len(known) > MAX_WORDS:
            known.clear()
        for word in set(words).difference(known):
            bare = "".join(filter(str.isalnum, word))
            kind = _NOTHING if not bare else _ANCHOR if bare in COMMON else _CONTENT
            known[word] = xxhash.xxh3_64_intdigest(bare.encode("utf-8", "surrogatepass")) & ~3 | kind
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * _MIX
    return x ^ (x >> np.uint64(32))


def signatures(text: str, words) -> np.ndarray:
    """Sorted distinct 32-bit signatures. A text without a whole chain has one signature of all its words; one without words none."""
    found = words(text)
    kind = found & np.uint64(3)
    content = np.flatnonzero(kind == _CONTENT)
    anchors = np.flatnonzero(kind == _ANCHOR)
    first = np.searchsorted(content, anchors)
    whole = first + (CHAIN - 1) * DISTANCE < len(content)
    if whole.any():
        out = _mixed(found[anchors[whole]])
        for k in range(CHAIN):
            out = _mixed(out ^ found[content[first[whole] + k * DISTANCE]])
    else:
        found = found[kind != _NOTHING]
        if not len(found):
            return np.zeros(0, np.uint32)
        out = np.array([xxhash.xxh3_64_intdigest(found.tobytes())], np.uint64)
    return np.unique((out >> np.uint64(32)).astype(np.uint32))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard index of two fingerprints; two empty ones are alike."""
    if not len(a) and not len(b):
        return 1.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def pruned_likeness(a: np.ndarray, b: np.ndarray, threshold: float) -> float:
    """The Jaccard index if it reaches the threshold, else 0; large sets are compared in parts and given up early."""
    if min(len(a), len(b)) < threshold * max(len(a), len(b)):
        return 0.0
    need, common = threshold / (1 + threshold) * (len(a) + len(b)), 0
    for i in range(0, len(a), 256):
        part = a[i:i + 256]
        common += int(np.isin(part, b, assume_unique=True).sum())
        if common + len(a) - i - len(part) < need - 1e-9:
            return 0.0
    return common / (len(a) + len(b) - common)


def fingerprint(found: np.ndarray) -> str:
    return found.astype(">u4").tobytes().hex()


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as many first characters of the following one (or all it has)."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _in_runs(docs: DataFrame, key: str, text_col: str) -> DataFrame:
    """Documents in runs of consecutive keys, each run closed by a copy of the document that follows it.

    A run begins at each key that a hash chooses, so runs need no sorting of the whole table; only the chosen keys, at
    most about ``MAX_CUTS``, come to the driver. The last run is closed by the first document.
    """
    spark = docs.sparkSession
    ids = docs.select(F.col(f"`{key}`").cast("long").alias("id"))
    whole = ids.agg(F.count("id").alias("n"), F.min("id").alias("first")).first()
    every = max(RUN_ROWS, -(-whole["n"] // MAX_CUTS))
    chosen = F.pmod(F.xxhash64("id"), F.lit(every)) == 0
    cuts = np.sort(np.array([r["id"] for r in ids.where(chosen & F.col("id").isNotNull()).distinct().collect()], np.int64))
    shared = spark.sparkContext.broadcast(cuts)

    @F.pandas_udf("long")
    def run_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(shared.value, ids.fillna(0).to_numpy(np.int64), "right"))

    last = len(cuts)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = rows.withColumn("run", F.when(F.col("id").isNotNull(), run_of("id")))
    # turn 0: the run's own rows; 1: the row that follows the run; 2: the first row of all, after the last run; 3: null keys
    own = F.struct(F.coalesce("run", F.lit(-1)).alias("run"), F.when(F.col("id").isNull(), 3).otherwise(0).alias("turn"))
    before = F.when(chosen & (F.col("run") > 0), F.struct((F.col("run") - 1).alias("run"), F.lit(1).alias("turn")))
    wrap = F.when(F.col("id") == whole["first"], F.struct(F.lit(last).cast("long").alias("run"), F.lit(2).alias("turn")))
    places = F.filter(F.array(own, before, wrap), lambda p: p.isNotNull())
    return rows.withColumn("place", F.explode(places)).select("place.run", "place.turn", "id", "text")


def compare_with_edits(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of each document.

    The next document is the one with the next larger key; the last is followed by the first, a single one by itself.
    Null texts are empty. Rows that share a key follow each other by text. Rows with a null key come after nothing and
    before an empty text. An empty table gives an empty table; further columns are not read. Texts are shuffled once.
    """
    schema = StructType([
        StructField(key, LongType()), StructField("n_chars", LongType()), StructField("edited_sha256", StringType()),
        StructField("fingerprint", StringType()), StructField("edited_fingerprint", StringType()),
        StructField("near_edited", DoubleType()), StructField("near_next", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = per_worker("spots", None, Words)

        def row(id_, text, found, following, after):
            changed = edited(text, following)
            other = signatures(changed, words)
            return (id_, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), fingerprint(found),
                    fingerprint(other), likeness(found, other), likeness(found, after))

        waiting, empty = None, np.zeros(0, np.uint32)
        for batch in batches:
            rows = []
            for place, turn, id_, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = signatures(text, words)
                if waiting is not None and waiting[0] == place:
                    rows.append(row(*waiting[1:], text, found))
                waiting = None
                if turn == 3:
                    rows.append(row(id_, text, found, "", empty))
                elif turn == 0:
                    waiting = (place, id_, text, found)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), ARROW)], schema.names)

    dealt = _in_runs(docs, key, text_col).repartition(partitions(docs.sparkSession), "run").sortWithinPartitions("run", "turn", "id", "text")
    return dealt.mapInArrow(run, schema)


ARROW = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def signature_sets(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, signatures) of each document."""
    schema = StructType([StructField("id", LongType()), StructField("signatures", ArrayType(LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = per_worker("spots", None, Words)
        for batch in batches:
            found = [signatures(text or "", words).astype(np.int64) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], schema.names)

    return docs.select(F.col(f"`{key}`").cast("long"), F.col(f"`{text_col}`")).mapInArrow(run, schema)


def similar(docs: DataFrame, threshold: float = 0.75, key: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b, likeness) of different signature sets that reach the threshold, each named by its smallest key, and
    membership (key, class) of every document in its set.

    Empty sets (null, empty or wordless texts) are in no pair and have their own key as class; null keys take no part.
    """
    made = staged(signature_sets(docs, key, text_col).where("id is not null"), "signatures")
    classes = staged(made.where("size(signatures) > 0").groupBy("signatures").agg(F.min("id").alias("class")), "classes")
    step = math.log(1 / threshold)
    length = F.floor(F.log(F.size("signatures")) / step + 1e-9)
    frequency = classes.select(F.explode("signatures").alias("s")).groupBy("s").agg(F.count("*").alias("df"))
    # sets that reach the threshold share one of the rarest signatures of both
    rare = classes.select("class", F.size("signatures").alias("n"), length.alias("part"), F.explode("signatures").alias("s")).join(
        frequency, "s").groupBy("class", "n", "part").agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("r"))
    prefix = F.slice("r", 1, (F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9) + 1).cast("int"))
    index = staged(rare.select("class", "n", "part", F.explode(prefix).alias("x")).select("class", "n", "part", "x.s"), "index")
    # a set meets those of its own length partition and of the one above
    upper = index.select(F.col("class").alias("b"), F.col("n").alias("nb"), F.explode(F.array("part", F.col("part") - 1)).alias("part"), "s")
    lower = index.select(F.col("class").alias("a"), F.col("n").alias("na"), "part", "s")
    near = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    pairs = lower.join(upper, ["part", "s"]).where(near & (F.col("na") >= threshold * F.col("nb") - 1e-9)).select("a", "b").distinct()

    @F.pandas_udf("double")
    def compared(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([pruned_likeness(np.asarray(a), np.asarray(b), threshold) for a, b in zip(x, y)])

    sets = classes.select("class", "signatures")
    found = pairs.join(sets.select(F.col("class").alias("a"), F.col("signatures").alias("x")), "a").join(
        sets.select(F.col("class").alias("b"), F.col("signatures").alias("y")), "b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), compared("x", "y").alias("likeness"))
    members = made.join(classes, "signatures", "left").select(F.col("id").alias(key), F.coalesce("class", "id").alias("class"))
    return found.where(F.col("likeness") >= threshold - 1e-12), members
