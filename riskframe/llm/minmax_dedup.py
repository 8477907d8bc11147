"""Near-duplicate documents by min-max hashing.

Each permutation of the shingle hashes gives two signature values, its smallest and its largest image, so half the hash
evaluations of plain min-hashing are needed and the estimate stays unbiased with a lower variance. Signatures are banded;
documents that share a band are candidates, and every link is confirmed on the full shingle sets.

Copies first collapse to one node for each distinct set. In each band bucket all nodes are compared with the smallest one
(a star, never all pairs). Buckets whose nodes are then still in different components are compared further: first each
node outside a bucket's largest component with its likeliest partners, then every pair across components that is left and
whose set sizes and signatures allow the threshold.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from riskframe.llm.common import batches_of, partitions, per_worker, staged
from riskframe.llm.components import components, joined

SHINGLE = 5
#: Share of the union, in hundredths, from which documents are linked.
THRESHOLD = 75
BANDS, ROWS = 40, 4
#: A pair at the threshold shares no band with probability (1 - 0.75**4)**40 = 2.5e-7.
PERMUTATIONS = BANDS * ROWS // 2
#: Pairs whose signatures agree in a smaller share are not confirmed: 4.7 standard deviations below the threshold.
ALIKE = 0.59
#: The last pairs are judged by this many permutations more, six standard deviations below the threshold.
FINE, FINE_ALIKE = 512, 0.66
#: Likeliest partners in other components that each node is confirmed with before all that are left.
FIRST = 3
#: Nodes of one bucket compared with each other in one task; larger buckets become pairs of blocks.
BLOCK = 2048
BROADCAST_IDS = 500_000
MAX_WORDS = 300_000

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """64-bit hashes of words, kept between texts."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > MAX_WORDS:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingles(text: str | None, hashed) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; with fewer words than a shingle, of all its words as one."""
    words = hashed((text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split())
    if not len(words):
        return words
    size = min(SHINGLE, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        out = (out ^ words[k:k + len(out)]) * _MIX
        out ^= out >> np.uint64(31)
    return np.unique(out)


def permutations(count: int = PERMUTATIONS, seed: int = 20260101) -> tuple[np.ndarray, np.ndarray]:
    factors, offsets = np.random.default_rng(seed).integers(0, 1 << 31, (2, count, 1), np.uint32)
    return factors * np.uint32(2) + np.uint32(1), offsets


def signature(found: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Minima of all permutations of 32-bit hashes, then their maxima, 16 bits of each."""
    low, high = np.full(len(factors), 2 ** 32 - 1, np.uint32), np.zeros(len(factors), np.uint32)
    short = (found >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(short), 1024):
        image = short[start:start + 1024] * factors
        image += offsets
        image ^= image >> np.uint32(15)
        image *= np.uint32(0x846CA68B)
        low, high = np.minimum(low, image.min(1)), np.maximum(high, image.max(1))
    return np.concatenate([low, high]).astype("<u2")  # the low bits tell values apart


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band: its four 16-bit values as they are, so equal keys are equal values."""
    return np.ascontiguousarray(values).view("<i8")


def sketches(docs: DataFrame) -> DataFrame:
    """(id, n, set_key, values, bands) of each (id, text); without shingles n is 0 and the rest null."""
    schema = StructType([StructField("id", LongType()), StructField("n", LongType()), StructField("set_key", BinaryType()),
                         StructField("values", BinaryType()), StructField("bands", ArrayType(LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, (factors, offsets) = per_worker("words", None, Words), permutations()
        for batch in batches:
            counts, keys, values, bands = [], [], [], []
            for text in batch.column(1).to_pylist():
                found = shingles(text, hashed)
                counts.append(len(found))
                if len(found):
                    sketch = signature(found, factors, offsets)
                    keys.append(xxhash.xxh3_128_digest(found.tobytes()))
                    values.append(sketch.tobytes())
                    bands.append(band_keys(sketch))
                else:
                    keys.append(None), values.append(None), bands.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()),
                                              pa.array(values, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], schema.names)

    return docs.mapInArrow(run, schema)


def chosen_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The (id, text) rows of some ids. A short list is broadcast, which spares shuffling the texts; a longer one is joined by shuffle."""
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", "left_semi")


def fine_values(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, fine): longer signatures of some documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, (factors, offsets) = per_worker("words", None, Words), permutations(FINE, 20260102)
        for batch in batches:
            fine = [signature(shingles(text, hashed), factors, offsets).astype(np.uint8).tobytes() for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fine, pa.binary())], ["id", "fine"])

    return chosen_texts(docs, ids).mapInArrow(run, "id bigint, fine binary").dropDuplicates(["id"])


def confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Those pairs (a, b) of nodes whose full shingle sets reach the threshold. Sets are made from the texts of candidates only."""
    wanted = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    texts = chosen_texts(docs, wanted)
    schema = StructType([StructField("id", LongType()), StructField("s", ArrayType(LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = per_worker("words", None, Words)
        for batch in batches:
            sets = [shingles(text, hashed).view(np.int64) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], schema.names)

    sets = texts.mapInArrow(run, schema)
    left, right = sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), sets.select(F.col("id").alias("b"), F.col("s").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(right, "b").join(left, "a").where(
        common * 100 >= (F.size("sa") + F.size("sb") - common) * THRESHOLD).select("a", "b")


def _blocks(open_: DataFrame) -> DataFrame:
    """Pairs of blocks of each bucket, every block small; rows (band, key, block pair) with the nodes of both blocks."""
    count = open_.groupBy("band", "key").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    block = F.pmod(F.xxhash64("id"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    return open_.join(count, ["band", "key"]).withColumn("block", block).withColumn("other", other).withColumn(
        "low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))


def partners(band: int, ids: np.ndarray, components_: np.ndarray, n: np.ndarray, block: np.ndarray, values: np.ndarray,
             fine: np.ndarray, split: bool, most: int | None) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Pairs to confirm in one bucket (or pair of blocks), whose nodes come by growing set size.

    When all partners are wanted, a pair is named by the first band it shares only.
    """
    keys = band_keys(values)
    _, code, size = np.unique(components_, return_inverse=True, return_counts=True)
    main, a, b = code == size.argmax(), [], []
    for i in np.flatnonzero(~main):
        # sets too small or too large can't reach the threshold
        near = np.arange(np.searchsorted(n, -(-n[i] * THRESHOLD // 100)), np.searchsorted(n, n[i] * 100 // THRESHOLD, "right"))
        near = near[(code[near] != code[i]) & (main[near] | (near > i) | (most is not None))]
        if split:
            near = near[block[near] != block[i]]
        if most is None:
            near = near[~(keys[near, :band] == keys[i, :band]).any(1)]
        if not len(near):
            continue
        alike = (values[near] == values[i]).mean(1)
        near, alike = near[alike >= ALIKE], alike[alike >= ALIKE]
        if fine.size and len(near):
            near = near[(fine[near] == fine[i]).mean(1) >= FINE_ALIKE]
        if most is not None and len(near) > most:
            near = near[np.argsort(-alike, kind="stable")[:most]]
        a.append(np.minimum(ids[near], ids[i]))
        b.append(np.maximum(ids[near], ids[i]))
    return a, b


def across(open_: DataFrame, most: int | None) -> DataFrame:
    """Distinct pairs (a, b) that share an open bucket, lie in different components and may reach the threshold.

    ``open_`` has (band, key, id, component, n, values, fine); fine signatures may all be empty. Every such pair has a node outside the bucket's largest component,
    so only those nodes are compared with the others; each names its ``most`` likeliest partners, or all of them. Buckets
    follow each other in sorted partitions, and a task holds one batch and one bucket at a time.
    """
    group = ["band", "key", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held = pa.concat_batches([held, batch]) if held is not None else batch
            if held is None or not held.num_rows:
                continue
            columns = [held.column(i).to_numpy() for i in range(8)]
            new = np.any([c[1:] != c[:-1] for c in columns[:4]], axis=0)
            begins = np.r_[0, np.flatnonzero(new) + 1, held.num_rows]
            # the last bucket may go on in the next batch
            whole = len(begins) - 1 if batch is None else len(begins) - 2
            values, fine = (np.frombuffer(b"".join(held.column(c).to_pylist()), kind).reshape(held.num_rows, -1)
                            for c, kind in ((8, "<u2"), (9, np.uint8)))
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i, j in zip(begins[:whole], begins[1:whole + 1]):
                ids, found, n, block = (c[i:j] for c in columns[4:])
                some = partners(int(columns[0][i]), ids, found, n, block, values[i:j], fine[i:j], columns[2][i] != columns[3][i], most)
                a += some[0]
                b += some[1]
            held = None if batch is None else held.slice(begins[whole])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    rows = _blocks(open_).select(*group, "id", "component", "n", "block", "values", "fine")
    dealt = rows.repartition(partitions(rows.sparkSession), *group).sortWithinPartitions(*group, "n", "id")
    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def still_open(members: DataFrame, found: DataFrame, nodes: DataFrame, docs: DataFrame, fine: bool) -> DataFrame:
    """The members of buckets whose nodes are in several components; with two nodes, the star has compared them already."""
    placed = staged(members.select("band", "key", "id").join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "band", "key", "id", F.coalesce("component", "id").alias("component")), "placed")
    ends = F.count("*").alias("m"), F.min("component").alias("x"), F.max("component").alias("y")
    unsettled = placed.groupBy("band", "key").agg(*ends).where("x <> y AND m > 2").select("band", "key")
    open_ = staged(placed.join(unsettled, ["band", "key"], "left_semi"), "open")
    sketched = nodes.select("id", "n", "values")
    if not fine:
        return open_.join(sketched, "id").withColumn("fine", F.lit(b""))
    return open_.join(sketched.join(fine_values(docs, open_.select("id").distinct()), "id"), "id")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept) of each document.

    Null or empty texts and texts without words have no shingles and stay alone. A row with a null key is linked with
    nothing: its component is null and it is kept. Repeated rows get the same component each; rows that share a key share
    the links of all their texts. An empty table gives an empty table; further columns are not read.
    """
    batches_of(docs.sparkSession)
    docs = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    made = staged(sketches(docs), "sketches")
    linked = made.where("n > 0 and id is not null")
    nodes = staged(linked.groupBy("set_key").agg(F.min(F.struct("id", "n", "values", "bands")).alias("x")).select("set_key", "x.*"), "nodes")
    entries = nodes.select("id", F.posexplode("bands").alias("band", "key"))
    buckets = entries.groupBy("band", "key").agg(F.min("id").alias("a"), F.count("*").alias("m")).where("m > 1").drop("m")
    members = staged(entries.join(buckets, ["band", "key"]), "members")
    texts = docs.where("id is not null")
    stars = staged(members.where("id <> a").select("a", F.col("id").alias("b")).distinct(), "stars")
    links = staged(confirmed(stars, texts), "links")
    found, tried = components(links), stars
    for most in (FIRST, None):  # the likeliest partners settle most buckets; then everything that is left
        pairs = staged(across(still_open(members, found, nodes, texts, most is None), most).join(tried, ["a", "b"], "left_anti"), "pairs")
        new = staged(confirmed(pairs, texts), "links")
        tried = tried.unionByName(pairs)
        if not new.isEmpty():
            found = staged(joined(found, new), "components")
    # ids of nodes stand for their sets; a component is named by its smallest node, which is its smallest document
    named = nodes.select("set_key", "id").join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "set_key", F.coalesce("component", "id").alias("component"))
    alone = made.where("n = 0 or id is null").select("id", "n", F.when(F.col("n") == 0, F.col("id")).alias("component"))
    return linked.select("id", "n", "set_key").join(named, "set_key").select("id", "n", "component").unionByName(alone).select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))


def unique(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without those that are not kept: one document of each group stays, with all its columns.

    Rows with a null key all stay; of rows that share a key one stays.
    """
    removed = staged(near_duplicates(docs, key, text_col).where(f"not kept and `{key}` is not null").select(key).distinct(), "removed")
    out = docs.join(F.broadcast(removed) if removed.count() <= BROADCAST_IDS else removed, key, "left_anti").select(docs.columns)
    if docs.where(F.col(f"`{key}`").isNotNull()).groupBy(key).count().where("count > 1").isEmpty():
        return out
    return out.where(F.col(f"`{key}`").isNull()).unionByName(out.where(F.col(f"`{key}`").isNotNull()).dropDuplicates([key]))
