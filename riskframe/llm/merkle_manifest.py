"""Merkle manifest of a dataset with incremental witnesses.

Every record is a leaf, the leaves of a group are ordered by key, and every ``FANOUT`` nodes in a row become the hash of
their digests until one is left, the subroot; the subroots, ordered by group, become the root in the same way. The witness
of a leaf has, level by level, the digests left and right of its node.

Leaves are appended in a stream. A subtree that is still open holds the witness of all leaves below it as one shared part;
when the run it belongs to is complete, its siblings are known and the part is written once for the whole subtree. Runs are
aligned, so a block of ``FANOUT ** BLOCK_LEVELS`` leaves in a row is a subtree that a task can build on its own. The roots
of the blocks are then appended to the next level like leaves, in blocks again, until a group has one node.

No group is ever in one task: positions come from a range sort over group and key, whose partitions are counted and added
up as a table, and a task holds one block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from riskframe.llm.common import partitions, staged

FANOUT = 16
#: Levels of a block: a task builds subtrees of FANOUT ** BLOCK_LEVELS leaves.
BLOCK_LEVELS = 3
BLOCK = FANOUT ** BLOCK_LEVELS
#: Seed of the last sort key, which parts equal records; they have equal leaves, so any order gives the same tree.
SPREAD = 13
STEPS = "array<struct<before string, after string>>"


def digest(data: str) -> str:
    return hashlib.sha256(data.encode()).hexdigest()


def fold(leaf: str, witness: list[tuple[str, str]]) -> str:
    """The root that a leaf and its witness give."""
    for before, after in witness:
        leaf = digest(before + leaf + after)
    return leaf


class Subtree:
    """A node with the runs below it; ``step`` is the part of the witness that all leaves below it share."""

    __slots__ = ("digest", "below", "step")

    def __init__(self, digest_: str, below: list[Subtree] | None = None):
        self.digest, self.below, self.step = digest_, below, None

    def witnesses(self, above: tuple = ()) -> Iterator[tuple]:
        """The witness of each leaf, in order, from the leaf up to this node and on along ``above``."""
        if self.below is None:
            yield above
        else:
            for node in self.below:
                yield from node.witnesses((node.step, *above))


class Appender:
    """Tree that grows leaf by leaf; of each level only the open run is held besides the finished subtrees."""

    def __init__(self):
        self.open: list[list[Subtree]] = [[]]
        self.count = [0]

    def append(self, node: Subtree, level: int = 0) -> None:
        if level == len(self.open):
            self.open.append([])
            self.count.append(0)
        self.open[level].append(node)
        self.count[level] += 1
        if len(self.open[level]) == FANOUT:
            self._complete(level)

    def _complete(self, level: int) -> None:
        """Close the open run: every sibling in it gets its step of the witness, and their parent is appended above."""
        run, self.open[level] = self.open[level], []
        row = "".join([node.digest for node in run])
        for i, node in enumerate(run):
            node.step = (row[:64 * i], row[64 * (i + 1):])
        self.append(Subtree(digest(row), run), level + 1)

    def close(self, levels: int | None = None) -> Subtree:
        """The root: where one node is left, or after so many levels for a block among others."""
        level = 0
        while level < levels if levels is not None else self.count[level] > 1:
            if self.open[level]:
                self._complete(level)
            level += 1
        return self.open[level][0]


def tree(digests: list[str], whole: bool) -> Subtree:
    """The subtree of a block; ``whole``: the group has no other block, so it ends where one node is left."""
    grown = Appender()
    for one in digests:
        grown.append(Subtree(one))
    return grown.close(None if whole else BLOCK_LEVELS)


def field(column: F.Column) -> F.Column:
    """``-`` for null, else the bytes of the value as text, ``:`` and the value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: list[F.Column]) -> F.Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``at`` (from 0) and ``n``, place and number in their group ``g``, in the given order.

    Rows are range-sorted over group, order and a seeded number; a table with one row for each range and group adds up the
    counts, so a group may span any number of tasks.
    """
    spark, names = rows.sparkSession, rows.columns
    ranged = rows.withColumn("__spread", F.rand(SPREAD)).repartitionByRange(partitions(spark), "g", *order, "__spread")
    held = staged(ranged.select(*names, F.spark_partition_id().alias("__range")), "ranged")
    counts = held.groupBy("__range", "g").agg(F.count("*").alias("__here"))
    group = Window.partitionBy("g")
    sums = counts.select(
        "__range", "g", F.sum("__here").over(group).alias("n"),
        (F.sum("__here").over(group.orderBy("__range")) - F.col("__here")).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__range", "g").orderBy(*order)) - 1
    return held.withColumn("__place", place).join(sums, ["__range", "g"]).select(
        *names, (F.col("__before") + F.col("__place")).alias("at"), "n")


def blocks(nodes: DataFrame, item: list[str]) -> DataFrame:
    """(g, block, n, items): the nodes (g, at, n, ...) of each aligned block, at most ``BLOCK``, in order."""
    return nodes.groupBy("g", F.floor(F.col("at") / BLOCK).alias("block")).agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("at", *item))).alias("items"))


def block_roots(held: DataFrame) -> DataFrame:
    """(g, at, n, digest): the root of each block as a node of the level above."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots = [tree(digests, n <= BLOCK).digest for n, digests in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(roots, pa.string())], ["g", "at", "n", "digest"])

    slim = held.select("g", "block", "n", F.transform("items", lambda x: x["digest"]).alias("digests"))
    return slim.mapInArrow(run, "g string, at bigint, n bigint, digest string").withColumn("n", F.ceil(F.col("n") / BLOCK))


def climb(nodes: DataFrame) -> DataFrame:
    """(g, at, steps, top): the witness of each node (g, at, n, digest) up to the top of its group.

    Each round appends the roots of blocks to the level above and takes a factor of ``BLOCK``, so few rounds are needed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, block, n, items in zip(*[c.to_pylist() for c in batch.columns]):
                top = tree([x["digest"] for x in items], n <= BLOCK)
                rows = [(g, block, item["at"], [{"before": b, "after": a} for b, a in steps], top.digest)
                        for item, steps in zip(items, top.witnesses())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    step = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
    types, names = [pa.string(), pa.int64(), pa.int64(), step, pa.string()], ["g", "block", "at", "steps", "top"]
    held = blocks(nodes, ["digest"])
    here = held.mapInArrow(run, f"g string, block bigint, at bigint, steps {STEPS}, top string")
    most = nodes.agg(F.max("n")).first()[0] or 0
    if most <= BLOCK:
        return here.drop("block")
    above = climb(staged(block_roots(held), "nodes")).select("g", F.col("at").alias("block"), F.col("steps").alias("more"), F.col("top").alias("last"))
    return here.join(above, ["g", "block"]).select("g", "at", F.concat("steps", "more").alias("steps"), F.col("last").alias("top"))


def grown(records: DataFrame, key: str, group: str, fields: list[str], also: dict[str, F.Column] | None = None) -> DataFrame:
    """One row for each block of leaves: items (at, key, digest, further columns), steps from its root on, subroot, root.

    Group order is null first, then bytewise. ``also`` names further columns of the items.
    """
    also = also or {}
    name = F.col(f"`{group}`").cast("string")
    rows = records.select(
        F.coalesce(F.concat(F.lit("="), name), F.lit("-")).alias("g"),  # the same order, without null
        F.col(f"`{key}`").alias("key"), leaf([F.col(f"`{c}`") for c in fields]).alias("digest"), *[c.alias(a) for a, c in also.items()])
    held = staged(blocks(numbered(rows, ["key", "digest"]), ["key", "digest", *also]), "blocks")
    lower = staged(climb(staged(block_roots(held), "roots")), "groups")
    subroots = lower.where("at = 0").select(F.lit("").alias("g"), F.col("g").alias("name"), F.col("top").alias("digest"))
    placed = staged(numbered(subroots, ["name"]), "subroots")
    upper = climb(placed.select("g", "at", "n", "digest")).select("at", F.col("steps").alias("over"), F.col("top").alias("root"))
    named = placed.select("at", F.col("name").alias("g")).join(upper, "at").drop("at")
    above = lower.join(named, "g").select(
        "g", F.col("at").alias("block"), F.concat("steps", "over").alias("steps"), F.col("top").alias("subroot"), "root")
    return held.join(above, ["g", "block"])


def _leaves(batch: pa.RecordBatch) -> Iterator[tuple[list[dict], list[list[tuple[str, str]]], str, str]]:
    """Items and witnesses of each block in a batch of (items, n, steps, subroot, root)."""
    for items, n, steps, subroot, root in zip(*[c.to_pylist() for c in batch.columns]):
        above = tuple((s["before"], s["after"]) for s in steps)
        yield items, tree([x["digest"] for x in items], n <= BLOCK).witnesses(above), subroot, root


def manifest(records: DataFrame, key: str, group: str, fields: list[str]) -> DataFrame:
    """key, leaf, witness, subroot, root of each record: what a reader needs to check that a record belongs to the root.

    ``fields`` are hashed as text. A null field is ``-``; a null key comes first in its group; a null group is the first
    group; records with equal keys are ordered by their leaves, and repeated records are leaves of their own; an empty
    table gives an empty table; further columns are not read.
    """
    kind = records.schema[key].dataType
    schema = StructType([StructField(key, kind), StructField("leaf", StringType()), *StructType.fromDDL(
        f"witness {STEPS}, subroot string, root string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for items, witnesses, subroot, root in _leaves(batch):
                rows = [(x["key"], x["digest"], [{"before": b, "after": a} for b, a in w], subroot, root) for x, w in zip(items, witnesses)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema.names)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return grown(records, key, group, fields).select("items", "n", "steps", "subroot", "root").mapInArrow(run, schema)


def audit(docs: DataFrame, key: str = "doc_id", group: str = "source", text_col: str = "text",
          fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text")) -> DataFrame:
    """Fold every record of a tampered copy with the witnesses of the manifest: key, leaf, subroot, root, proof_sha256,
    folded_root, verified.

    Tampering lower-cases A-Z in the text of records whose crc32 of the key as text is divisible by 5; a null key or text
    is left alone. Nulls, repeated rows, ties and empty tables as in ``manifest``.
    """
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    tampered = F.translate(F.col(f"`{text_col}`"), upper, lower)
    hit = F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % 5 == 0
    changed = F.when(hit, leaf([tampered if c == text_col else F.col(f"`{c}`") for c in fields]))
    schema = StructType([StructField(key, docs.schema[key].dataType), *StructType.fromDDL(
        "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for items, witnesses, subroot, root in _leaves(batch):
                rows = []
                for item, witness in zip(items, witnesses):
                    folded = fold(item["changed"] or item["digest"], witness)
                    proof = digest("".join([half for step in witness for half in step]))
                    rows.append((item["key"], item["digest"], subroot, root, proof, folded, folded == root))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema.names)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    held = grown(docs, key, group, list(fields), {"changed": changed})
    return held.select("items", "n", "steps", "subroot", "root").mapInArrow(run, schema)
