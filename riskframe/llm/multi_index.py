"""Approximate nearest neighbours by an inverted multi-index.

The two halves of the vectors are quantised apart, so that k centroids a half make k * k cells. A query walks pairs of
centroids in the order of their summed inner products, with a heap, until the cells it has met hold a set share of all
vectors; the entries of these cells are ranked by their exact inner products. How large that share has to be is measured
on a bounded sample of queries against a full scan.

Equal vectors are one entry with the smallest keys that can be among the nearest, so copies cost nothing. Centroids come
from a bounded sample; every vector is indexed.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import partitions, staged

#: Centroids of each half, and bound of the sample of vectors they are fitted to.
CENTROIDS, SAMPLE, ROUNDS = 64, 20_000, 12
#: Bound of the sample of queries that sets the share walked, and the recall it has to reach there.
TRIALS, RECALL = 200, 0.96
#: Entries of an index block, queries of a chunk that meets it, and queries ranked at a time.
BLOCK_ROWS, CHUNK_ROWS, AT_ONCE = 16_384, 4096, 128


def usable(vectors: DataFrame, key: str, vector_col: str) -> DataFrame:
    """(id, v) of rows whose vector is finite, not zero and of the most frequent length; -0.0 becomes 0.0."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.transform(v, lambda x: x + F.lit(0.0)).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    widths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("v") == (widths[0]["n"] if widths else 0))


def entries(rows: DataFrame, k: int) -> DataFrame:
    """(entry, v, ids): one entry for each distinct vector, with its k + 1 smallest keys. The rank filter runs before the shuffle."""
    ranked = rows.dropDuplicates(["id", "v"]).withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id")))
    return ranked.where(F.col("r") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(
        F.element_at("ids", 1).alias("entry"), "v", "ids")


def centroids(sample: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    draw = np.random.default_rng(seed)
    out = sample[draw.choice(len(sample), min(k, len(sample)), replace=False)].copy()
    for _ in range(ROUNDS):
        own = nearest_centroid(sample, out)
        for j in np.unique(own):
            out[j] = sample[own == j].mean(0)
    return out


def nearest_centroid(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c * c).sum(1) - 2 * x @ c.T).argmin(1)


def walk(first: np.ndarray, second: np.ndarray, counts: np.ndarray, wanted: int) -> list[int]:
    """Cells in the order of falling summed score of their halves, until they hold ``wanted`` entries.

    ``counts`` has the entries of cell (i, j) at i * len(second) + j. A pair enters the heap when both its neighbours with
    a better half have left it, so the heap stays as small as the border of what was walked.
    """
    by_first, by_second, width = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable"), len(second)
    a, b = first[by_first].tolist(), second[by_second].tolist()
    rows, columns = by_first.tolist(), by_second.tolist()
    sizes = counts.tolist()
    done = [0] * (len(a) + 1)  # pairs of each row that have left the heap
    heap, out, held = [(-(a[0] + b[0]), 0, 0)], [], 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        done[i] = j + 1
        cell = rows[i] * width + columns[j]
        if sizes[cell]:
            out.append(cell)
            held += sizes[cell]
        if i + 1 < len(a) and done[i + 1] == j:
            heapq.heappush(heap, (-(a[i + 1] + b[j]), i + 1, j))
        if j + 1 < len(b) and (i == 0 or done[i - 1] > j + 1):
            heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
    return out


def exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products summed in one order, whatever block a vector lies in."""
    return (x * q).sum(-1)


def matrix(column) -> np.ndarray:
    return np.array(column.to_pylist() if hasattr(column, "to_pylist") else list(column), np.float64)


def share_to_walk(found: DataFrame, cells: tuple[np.ndarray, np.ndarray], counts: np.ndarray, k: int) -> float:
    """The share of entries after which ``RECALL`` of the true neighbours of a bounded sample of queries have been met."""
    trial = found.orderBy(F.xxhash64("entry", F.lit(1)), "entry").limit(TRIALS).select("entry", "v").collect()
    q = np.array([r["v"] for r in trial])
    own = {r["entry"]: i for i, r in enumerate(trial)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = pd.DataFrame({"q": np.zeros(0, np.int64), "cell": np.zeros(0, np.int64), "score": np.zeros(0)})
        for batch in batches:
            ids, cell, x = batch.column(0).to_numpy(), batch.column(1).to_numpy(), matrix(batch.column(2))
            scores = q @ x.T
            for at, entry in enumerate(ids):
                if entry in own:
                    scores[own[entry], at] = -np.inf
            top = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            here = pd.DataFrame({"q": np.repeat(np.arange(len(q)), top.shape[1]), "cell": cell[top].ravel(),
                                 "score": np.take_along_axis(scores, top, 1).ravel()})
            best = pd.concat([best, here]).sort_values(["q", "score"], ascending=[True, False], kind="stable").groupby("q").head(k)
        yield pa.RecordBatch.from_pandas(best[["q", "cell", "score"]], preserve_index=False)

    rows = found.select("entry", "cell", "v").mapInArrow(run, "q bigint, cell bigint, score double")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "cell"))
    best = rows.where(F.col("score") > F.lit(float("-inf"))).withColumn("r", rank).where(F.col("r") <= k).collect()
    half, total = cells[0].shape[1], max(1, int(counts.sum()))
    shares, walked = [], {}
    for r in best:
        if r["q"] not in walked:
            order = walk(q[r["q"]][:half] @ cells[0].T, q[r["q"]][half:] @ cells[1].T, counts, total)
            walked[r["q"]] = dict(zip(order, np.cumsum(counts[order]).tolist()))
        shares.append(walked[r["q"]][r["cell"]] / total)
    return float(np.quantile(shares, RECALL, method="higher")) if shares else 1.0


def search(vectors: DataFrame, queries: F.Column, k: int = 20, key: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row that meets ``queries``, its own row left out.

    The score is the inner product in double precision; ties go to the smaller key. Rows whose key or vector is null, whose
    vector is zero or holds null, NaN or infinite components, or has another length than most, take no part. Rows repeated
    with the same key count once. Fewer than k candidates give all of them; an empty table an empty table.
    """
    rows = usable(vectors.select(F.col(f"`{key}`").alias(key), F.col(f"`{vector_col}`").alias(vector_col)), key, vector_col)
    spark, schema = vectors.sparkSession, "query_id bigint, rank int, vec_id bigint, score double"
    found = staged(entries(rows, k), "entries")
    sample = np.array([r["v"] for r in found.orderBy(F.xxhash64("entry"), "entry").limit(SAMPLE).select("v").collect()])
    if not len(sample):
        return spark.createDataFrame([], schema)
    half = sample.shape[1] // 2
    cells = centroids(sample[:, :half], CENTROIDS), centroids(sample[:, half:], CENTROIDS, 1)
    width = len(cells[1])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1))
            cell = nearest_centroid(x[:, :half], cells[0]) * width + nearest_centroid(x[:, half:], cells[1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int64())], ["entry", "v", "ids", "cell"])

    placed = staged(found.mapInArrow(place, "entry bigint, v array<double>, ids array<bigint>, cell bigint"), "placed")
    counts = np.zeros(len(cells[0]) * width, np.int64)
    for r in placed.groupBy("cell").agg(F.count("*").alias("n")).collect():  # one row for each cell at most
        counts[r["cell"]] = r["n"]
    total = int(counts.sum())
    wanted = max(k + 1, int(np.ceil(share_to_walk(placed, cells, counts, k) * total)))
    # whole cells in a row make blocks; a cell larger than a block is cut into several
    block_of = np.cumsum(np.minimum(counts, BLOCK_ROWS)) // BLOCK_ROWS
    cuts = -(-counts // BLOCK_ROWS)
    asked = staged(vectors.where(queries).select(F.col(f"`{key}`").alias("id")).join(rows, "id").distinct(), "asked")
    distinct = asked.groupBy("v").agg(F.min("id").alias("q"))
    chunks = max(1, -(-distinct.count() // CHUNK_ROWS))
    shared = spark.sparkContext.broadcast((cells, counts, block_of, cuts))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, counts, block_of, cuts = shared.value
        for batch in batches:
            for q, v in zip(batch.column(0).to_pylist(), matrix(batch.column(1))):
                met = np.array(walk(v[:half] @ cells[0].T, v[half:] @ cells[1].T, counts, wanted), np.int64)
                blocks = [(int(b), int(c), met[(block_of[met] == b) & (cuts[met] > c)]) for b in np.unique(block_of[met])
                          for c in range(int(cuts[met[block_of[met] == b]].max()))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([q] * len(blocks), pa.int64()), pa.array([v] * len(blocks), pa.list_(pa.float64())),
                     pa.array([b for b, _, _ in blocks], pa.int64()), pa.array([c for _, c, _ in blocks], pa.int64()),
                     pa.array([m for _, _, m in blocks], pa.list_(pa.int64()))], ["q", "v", "block", "cut", "met"])

    # walking costs far more than its input's size suggests, so the queries are spread over all tasks
    spread = distinct.select("q", "v").repartition(partitions(spark), "q")
    probes = spread.mapInArrow(probe, "q bigint, v array<double>, block bigint, cut bigint, met array<bigint>").withColumn(
        "chunk", F.pmod(F.xxhash64("q"), F.lit(chunks)))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, block_of, cuts = shared.value
        for batch in batches:
            cell, entry = batch.column(3).to_numpy(), batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(block_of[cell], pa.int64()), pa.array(entry % cuts[cell], pa.int64())],
                                             ["entry", "v", "ids", "cell", "block", "cut"])

    index = placed.mapInArrow(mark, "entry bigint, v array<double>, ids array<bigint>, cell bigint, block bigint, cut bigint").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)).cast("array<bigint>")))

    def rank(own: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = {"q": [], "score": [], "ids": []}
        if len(own) and len(block):
            block = block.sort_values(["cell", "entry"])
            x, cell, ids = np.array(block["v"].tolist()), block["cell"].to_numpy(), block["ids"].to_numpy()
            cells_here, begin = np.unique(cell, return_index=True)
            end = np.append(begin[1:], len(cell))
            for at in range(0, len(own), AT_ONCE):
                some = own.iloc[at:at + AT_ONCE]
                q = np.array(some["v"].tolist())
                who = np.repeat(np.arange(len(some)), some["met"].map(len))
                met = np.concatenate(some["met"].to_list())
                order = np.argsort(met, kind="stable")
                who, met = who[order], met[order]
                scores = np.full((len(some), len(x)), -np.inf)
                for c, i, j in zip(cells_here, begin, end):
                    visitors = who[np.searchsorted(met, c):np.searchsorted(met, c, "right")]
                    if len(visitors):
                        scores[visitors, i:j] = q[visitors] @ x[i:j].T
                most = min(k + 4, len(x))
                top = np.argpartition(-scores, most - 1, axis=1)[:, :most]
                for r, (name, near) in enumerate(zip(some["q"], top)):
                    near = near[scores[r, near] > -np.inf]
                    value = exact(x[near], q[r])
                    best = np.lexsort(([ids[i][0] for i in near], -value))[:k + 1]
                    out["q"] += [name] * len(best)
                    out["score"] += value[best].tolist()
                    out["ids"] += [ids[i] for i in near[best]]
        return pd.DataFrame({"q": pd.Series(out["q"], dtype="int64"), "score": pd.Series(out["score"], dtype="float64"),
                             "ids": pd.Series(out["ids"], dtype="object")})

    group = ["block", "cut", "chunk"]
    near = probes.groupBy(*group).cogroup(index.groupBy(*group)).applyInPandas(rank, "q bigint, score double, ids array<bigint>")
    # each step keeps what can still be among the k nearest: k + 1 entries, then k + 1 keys with the query's own among them
    near = near.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), F.element_at("ids", 1)))).where(
        F.col("r") <= k + 1).select("q", "score", F.explode("ids").alias("id"))
    near = near.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))).where(F.col("r") <= k + 1)
    lists = near.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("r", "id", "score"))).alias("near"))
    own = asked.join(distinct, "v").select("id", "q")
    kept = F.slice(F.filter("near", lambda x: x["id"] != F.col("id")), 1, k)
    return own.join(lists, "q").select("id", F.posexplode(kept).alias("at", "x")).select(
        F.col("id").alias("query_id"), (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score"))
