"""Vector compression by product codes, with assignment through memoised grid cells.

Vectors become integers and are cut into equal parts; each part position has a codebook, and a part is stored as the
number of its nearest entry. To find it, the part is placed in a coarse grid cell. For a cell met for the first time the
smallest and largest distance from its box to every entry are worked out: an entry whose smallest distance is above some
other entry's largest one can be nearest nowhere in the box and is left out. What remains is kept by cell, and the exact
distances are taken to those entries alone. So the result is that of a full search.

Codebooks are fitted to all vectors: each round, tasks send one sum and count for each component of each entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from riskframe.functions.bounded import collect_small
from riskframe.llm.common import per_worker, staged

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Cells kept for each part position; beyond that they are worked out anew.
MAX_CELLS = 16_384
#: Vectors assigned at a time, and cells whose bounds are worked out at a time.
AT_ONCE = 4096
#: Scaled components beyond this could overflow the sums of squares.
LARGEST = 1 << 26


class Grid:
    """Nearest entries of one codebook, by cells of ``side`` units."""

    def __init__(self, book: np.ndarray, side: int | None = None):
        self.book = book
        # half the spread of the entries: cells small against their distances, yet shared by many parts
        self.side = side or max(1, round(float(book.std(0).mean()) / 2)) if book.size else 1
        self.clear()

    def clear(self) -> None:
        self.rows: dict[bytes, int] = {}
        self.open = np.zeros((0, len(self.book)), bool)

    def candidates(self, cells: np.ndarray) -> np.ndarray:
        """For each cell, which entries no other entry dominates across its box."""
        out = np.empty((len(cells), len(self.book)), bool)
        for i in range(0, len(cells), AT_ONCE):
            low = cells[i:i + AT_ONCE, None, :] * self.side
            under, over = low - self.book, self.book - (low + self.side - 1)
            nearest = (np.maximum(np.maximum(under, over), 0) ** 2).sum(2)
            farthest = (np.maximum(np.abs(under), np.abs(over)) ** 2).sum(2)
            out[i:i + AT_ONCE] = nearest <= farthest.min(1, keepdims=True)
        return out

    def _masks(self, cells: np.ndarray) -> np.ndarray:
        """The memoised candidates of each row's cell."""
        names = np.ascontiguousarray(cells).view(np.dtype((np.void, cells.dtype.itemsize * cells.shape[1]))).ravel()
        distinct, first, which = np.unique(names, return_index=True, return_inverse=True)
        if len(self.rows) + len(distinct) > MAX_CELLS:
            self.clear()
        keys = [name.tobytes() for name in distinct]
        fresh = [i for i, key in enumerate(keys) if key not in self.rows]
        if fresh:
            for i in fresh:
                self.rows[keys[i]] = len(self.rows)
            self.open = np.concatenate([self.open, self.candidates(cells[first[fresh]])])
        return self.open[np.array([self.rows[key] for key in keys])[which]]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry of each part, the lower of equal ones, and the squared distance to it."""
        if not parts.size:  # no vectors, or vectors without components
            return np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        at, distance = [], []
        for i in range(0, len(parts), AT_ONCE):
            some = parts[i:i + AT_ONCE]
            row, entry = np.nonzero(self._masks(some // self.side))
            exact = ((some[row] - self.book[entry]) ** 2).sum(1)
            begin = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            least = np.minimum.reduceat(exact, begin)
            hits = np.flatnonzero(exact == least[row])
            hits = hits[np.r_[True, row[hits][1:] != row[hits][:-1]]]
            at.append(entry[hits])
            distance.append(least)
        return np.concatenate(at), np.concatenate(distance)


def _matrix(column: pa.Array, width: int, parts: int) -> np.ndarray:
    """(rows, parts, width): vectors as integers; vectors that do not fill the last part have zeros there."""
    values = np.asarray(column.flatten(), np.float64)
    flat = np.floor(values.reshape(len(column), len(values) // max(len(column), 1)) * SCALE)
    if flat.size and np.abs(flat).max() > LARGEST:
        raise ValueError(f"components beyond {LARGEST // SCALE} are too large for exact distances")
    out = np.zeros((len(column), parts * width), np.int64)
    out[:, :flat.shape[1]] = flat
    return out.reshape(len(column), parts, width)


def usable(vectors: DataFrame, key: str, vector_col: str, label_col: str) -> tuple[DataFrame, int]:
    """(key, label, v) of the vectors that can be coded, and their number of components.

    Null vectors and those with null or non-finite components are left out; of different lengths the most frequent one
    (of equally frequent ones the smallest) is kept.
    """
    v = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label_col}`").alias("label"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("v").isNotNull() & finite)
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    length = lengths[0]["n"] if lengths else 0
    return rows.where(F.size("v") == length), length


def first_books(rows: DataFrame, length: int, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """(parts, entries, width): the parts of the vectors with the smallest keys. At most ``entries`` rows reach the driver."""
    width = -(-length // parts)
    first = rows.orderBy(F.col("key").asc_nulls_last(), "v").limit(entries).select("v").collect()
    column = pa.array([r["v"] for r in first], pa.list_(pa.float64()))
    return _matrix(column, width, parts).transpose(1, 0, 2).copy()


def _grids(books: np.ndarray) -> list[Grid]:
    return per_worker("grids", books.tobytes(), lambda: [Grid(book) for book in books])


def improve(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every entry becomes the floor of the mean of its parts; entries without parts stay.

    The driver receives one sum and one count for each component of each entry, whatever the number of vectors.
    """
    parts, entries, width = books.shape
    if not entries or not width:
        return books

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids, sums, counts = _grids(books), np.zeros_like(books), np.zeros((parts, entries), np.int64)
        for batch in batches:
            data = _matrix(batch.column(0), width, parts)
            for p, grid in enumerate(grids):
                at, _ = grid.nearest(data[:, p])
                np.add.at(sums[p], at, data[:, p])
                counts[p] += np.bincount(at, minlength=entries)
        used = np.repeat(counts.ravel() > 0, width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.flatnonzero(used)), pa.array(sums.ravel()[used]), pa.array(np.repeat(counts.ravel(), width)[used])], ["at", "total", "n"])

    sums = rows.select("v").mapInArrow(run, "at bigint, total bigint, n bigint").groupBy("at").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    out = books.copy().ravel()
    for row in sums.collect():
        out[row["at"]] = row["total"] // row["n"]
    return out.reshape(books.shape)


def fit(rows: DataFrame, length: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts, entries, width) after some rounds over all vectors."""
    books = first_books(rows, length, parts, entries)
    for _ in range(rounds):
        books = improve(rows, books)
    return books


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """(key, label, code, error) of vectors (key, label, v): two hex digits for each part, and the summed squared distances."""
    parts, _, width = books.shape
    kinds = {f.name: f.dataType for f in rows.schema}
    schema = StructType([StructField("key", kinds["key"]), StructField("label", kinds["label"]), StructField("code", StringType()), StructField("error", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = _matrix(batch.column(2), width, parts)
            codes, error = np.empty((len(data), parts), np.uint8), np.zeros(len(data), np.int64)
            for p, grid in enumerate(_grids(books)):
                codes[:, p], distance = grid.nearest(data[:, p])
                error += distance
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error)], schema.names)

    return rows.select("key", "label", "v").mapInArrow(run, schema)


def decode(code: str, books: np.ndarray) -> np.ndarray:
    """The vector that a code stands for, in the scale of the input: the middle of each integer's range."""
    parts = np.frombuffer(bytes.fromhex(code), np.uint8)
    return (np.concatenate([books[p, j] for p, j in enumerate(parts)]) + 0.5) / SCALE


def book_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, key: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """key, code, error, label_error, codebooks_sha256 of each vector that can be coded.

    Null vectors, null or non-finite components and vectors of a rarer length have no row. Null keys come last when the
    first codebook is taken and are coded like others; repeated rows are coded and counted each; equal keys are taken in
    the order of their vectors; null labels are one label; fewer vectors than entries make a smaller codebook; vectors
    whose length the parts do not divide are filled with zeros; an empty table gives an empty table; further columns are
    not read. At most 256 entries.
    """
    if not 0 < entries <= 256:
        raise ValueError("two hex digits number at most 256 entries")
    rows, length = usable(vectors, key, vector_col, label_col)
    books = fit(rows, length, parts, entries, rounds)
    coded = staged(encode(rows, books), "codes")
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    few = collect_small(sums)  # a broadcast of checked size, else a shuffled join
    lookup = sums if few is None else F.broadcast(vectors.sparkSession.createDataFrame(few, sums.schema))
    return coded.join(lookup, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("key").alias(key), "code", "error", "label_error", F.lit(book_digest(books)).alias("codebooks_sha256"))
