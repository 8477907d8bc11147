"""Packing of documents into training sequences by lexical retrieval.

Documents become token ids once and are laid out by a min-hash over runs of ids, so that likely neighbours meet in one
shard of bounded size; the doc_id breaks ties, so no group of copies is too large for the layout. Each shard is an
inverted index over its documents with BM25 weights; document frequencies and the mean length come from all documents.
A window begins with a seed (what was left of the last document cut, else the next unused one), asks the index for the
unused documents nearest to the seed, and takes them in falling order until it is full. The document that meets the end
of the window is cut there, so only the last window of a shard can have padding.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType
from tokenizers import Tokenizer

from riskframe.llm.common import batches_of, partitions, per_worker, staged

WINDOW = 2048
#: Ends each document.
END_ID = 1
#: A shard is closed at so many documents or ids, whichever comes first.
SHARD_DOCS, SHARD_IDS = 1024, 1 << 21
#: Terms of a seed that are looked up: all of them.
QUERY_TERMS = float("inf")
#: Ids in a row that one hash of the layout covers.
RUN = 8
MIX = np.array([0x9E3779B1, 0x85EBCA77], np.uint32)
K1, B = 1.2, 0.75
#: A term in one of so many documents of a shard has a row of weights.
DENSE = 4


def byte_ranks(path: str) -> dict[bytes, int] | None:
    """Ranks of a plain byte-level BPE file whose ids follow its merges, else None. Special tokens are left out."""
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    model, cut = made["model"], made.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or made.get("normalizer") or (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex")) != ("ByteLevel", False, True):
        return None
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [model["vocab"][a + b] for a, b in merges]
    if ids != sorted(ids) or model.get("ignore_merges") or model.get("dropout"):
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the others follow 255
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    special = {t["content"] for t in made.get("added_tokens", [])}
    return {bytes(map(byte.__getitem__, token)): i for token, i in model["vocab"].items() if token not in special}


class Ids:
    """Ids of a tokenizer file as the tokenizers library gives them, strings of special tokens being those tokens.

    A plain byte-level BPE runs on tiktoken, which gives the same ids in half the time; any other file on tokenizers.
    """

    def __init__(self, path: str, dtype: np.dtype):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        self.dtype = dtype
        ranks = byte_ranks(path)
        if ranks is None:
            tokenizer = Tokenizer.from_file(path)
            self.special, self.encode = (), lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        else:
            with open(path, encoding="utf-8") as file:
                special = {t["content"]: t["id"] for t in json.load(file).get("added_tokens", [])}
            fast = tiktoken.Encoding("ids", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
            self.special, self.encode = tuple(special), fast.encode_ordinary
            self.encode_special = lambda text: fast.encode(text, allowed_special="all")

    def __call__(self, text: str) -> np.ndarray:
        ids = self.encode_special(text) if any(s in text for s in self.special) else self.encode(text)
        ids.append(END_ID)
        return np.fromiter(ids, self.dtype, len(ids))


def id_type(path: str) -> np.dtype:
    """The narrowest type for the ids of a tokenizer file."""
    return np.dtype("<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4")


def layout_key(ids: np.ndarray) -> int:
    """Smallest hash of ``RUN`` ids in a row: likely equal for documents that share most of them.

    A run twice as long is the hash of two, so three rounds make runs of eight; a shorter document ends where it has one.
    """
    h, step = ids.astype(np.uint32), 1
    while step < RUN and len(h) > step:
        h = (h[:-step] * MIX[0] ^ h[step:]) * MIX[1]
        h ^= h >> np.uint32(15)
        step *= 2
    return int(h.min())


def tokenized(docs: DataFrame, tokenizer_path: str, dtype: np.dtype, key: str, text_col: str) -> DataFrame:
    """key, compressed ids, their count and the layout key; written once."""
    schema = StructType([StructField("doc", docs.schema[key].dataType), StructField("ids", BinaryType()),
                         StructField("layout", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = per_worker("ids", tokenizer_path, lambda: Ids(tokenizer_path, dtype))
        press = zstandard.ZstdCompressor(level=1, write_checksum=False)
        for batch in batches:
            blobs, layout = [], []
            for text in batch.column(1).to_pylist():
                ids = coder(text or "")
                layout.append(layout_key(ids))
                blobs.append(press.compress(ids.tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, pa.binary()), pa.array(layout, pa.int64())], schema.names)

    return staged(docs.select(F.col(f"`{key}`"), F.col(f"`{text_col}`")).mapInArrow(run, schema), "ids")


def statistics(coded: DataFrame, dtype: np.dtype) -> tuple[np.ndarray, int, float]:
    """Document frequency of each id, number of documents and mean length, over all documents.

    Each task sends one row for each id it met, so at most the vocabulary reaches the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        df, docs, total = np.zeros(1 << 8 * min(dtype.itemsize, 3), np.int64), 0, 0
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                ids = np.frombuffer(open_.decompress(blob), dtype)
                df[counted(ids)[0]] += 1
                docs, total = docs + 1, total + len(ids)
        met = np.flatnonzero(df)
        if docs:
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, -2, met]), pa.array(np.r_[docs, total, df[met]])], ["term", "n"])

    rows = coded.select("ids").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    counts = dict(zip(rows["term"], rows["n"]))
    n, total = int(counts.pop(-1, 0)), int(counts.pop(-2, 0))
    df = np.zeros(max(counts, default=0) + 1, np.int64)
    df[list(counts)] = list(counts.values())
    return df, n, total / max(n, 1)


def counted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids, rising, and how often each occurs; short integers are sorted by radix."""
    ids = np.sort(ids, kind="stable")
    at = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
    return ids[at], np.diff(at, append=len(ids))


class Shard:
    """Inverted index with BM25 weights over the documents of one shard.

    Terms in at least one of ``DENSE`` documents have a row of weights for all of them, the others a list of postings.
    """

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float):
        self.n = len(docs)
        found = [counted(ids) for ids in docs]
        self.begin = np.cumsum([0, *(len(terms) for terms, _ in found)])
        self.terms = np.concatenate([terms for terms, _ in found]).astype(np.int64)
        tf = np.concatenate([counts for _, counts in found]).astype(np.float32)
        owner = np.repeat(np.arange(self.n), np.diff(self.begin))
        length = np.array([len(ids) for ids in docs], np.float32)[owner]
        self.weight = idf[self.terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / np.float32(mean_length)))
        self.vocabulary, where, counts = np.unique(self.terms, return_inverse=True, return_counts=True)
        often = counts * DENSE >= self.n
        self.row = np.where(often, np.cumsum(often) - 1, -1)
        self.alive, self.rows = np.arange(self.n), np.zeros((int(often.sum()), self.n))
        many = often[where]
        self.rows[self.row[where[many]], owner[many]] = self.weight[many]
        order = np.flatnonzero(~many)[np.argsort(where[~many], kind="stable")]
        self.docs, self.weights = owner[order], self.weight[order].astype(np.float64)
        self.first = np.r_[0, np.cumsum(np.where(often, 0, counts))]

    def scores(self, doc: int) -> np.ndarray:
        """BM25 of every document of the shard for all terms of one; used ones may lack a part."""
        at = np.searchsorted(self.vocabulary, self.terms[self.begin[doc]:self.begin[doc + 1]])
        rows = self.row[at]
        at = at[rows < 0]
        spans = list(map(slice, self.first[at].tolist(), self.first[at + 1].tolist()))
        out = np.zeros(self.n)
        if spans:
            out += np.bincount(np.concatenate([self.docs[s] for s in spans]), np.concatenate([self.weights[s] for s in spans]), self.n)
        out[self.alive] += self.rows[rows[rows >= 0]].sum(0)
        return out

    def drop(self, unused: np.ndarray) -> None:
        """Take the postings of used documents out; the scores of the others stay the same."""
        kept, left = unused[self.docs], unused[self.alive]
        self.first = np.r_[0, np.cumsum(kept)][self.first]
        self.docs, self.weights = self.docs[kept], self.weights[kept]
        self.alive, self.rows = self.alive[left], self.rows[:, left]


def pack_shard(docs: list[np.ndarray], idf: np.ndarray, mean_length: float, window: int = WINDOW) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece, sequences counted from 0."""
    index, unused, next_unused = Shard(docs, idf, mean_length), np.ones(len(docs), bool), 0
    sequence = offset = 0
    seed, start, indexed = 0, 0, len(docs)
    unused[0] = False
    while True:
        if offset == window:
            sequence, offset = sequence + 1, 0
        # the seed, or what is left of it
        while start < len(docs[seed]):
            if offset == window:
                sequence, offset = sequence + 1, 0
            length = min(window - offset, len(docs[seed]) - start)
            yield seed, start, length, sequence, offset
            start, offset = start + length, offset + length
        scores, doc = None, seed
        while offset < window:  # neighbours in falling order; then whatever comes next
            if scores is None:
                if (left := np.count_nonzero(unused)) < 0.75 * indexed:
                    index.drop(unused)
                    indexed = left
                scores = np.where(unused, index.scores(seed), -1.0)
            doc = int(np.argmax(scores))
            if scores[doc] <= 0:
                while next_unused < len(docs) and not unused[next_unused]:
                    next_unused += 1
                if next_unused == len(docs):
                    return
                doc = next_unused
            unused[doc], scores[doc] = False, -1.0
            length = min(window - offset, len(docs[doc]))
            yield doc, 0, length, sequence, offset
            start, offset = length, offset + length
        seed = doc
        if start == len(docs[seed]):  # nothing was cut
            while next_unused < len(docs) and not unused[next_unused]:
                next_unused += 1
            if next_unused == len(docs):
                return
            seed, start = next_unused, 0
            unused[seed] = False


def pack(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row for each piece of each document: key, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    Each id of each document lies in exactly one piece. A null or empty text has the closing id alone; a null key stays
    null; repeated rows are packed as often as they occur; an empty table gives an empty table; further columns of
    ``docs`` are not read.
    """
    spark, dtype = docs.sparkSession, id_type(tokenizer_path)
    batches_of(spark)
    coded = tokenized(docs, tokenizer_path, dtype, key, text_col)
    df, n, mean_length = statistics(coded, dtype)
    shared = spark.sparkContext.broadcast((np.log1p((n - df + 0.5) / (df + 0.5)).astype(np.float32), mean_length))
    schema = StructType([StructField(key, docs.schema[key].dataType), *(StructField(c, LongType()) for c in (
        "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")), StructField("ids", BinaryType())])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray]]]:
        open_, keys, docs_, total = zstandard.ZstdDecompressor(), [], [], 0
        for batch in batches:
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys.append(k)
                docs_.append(np.frombuffer(open_.decompress(blob), dtype))
                total += len(docs_[-1])
                if len(docs_) >= SHARD_DOCS or total >= SHARD_IDS:
                    yield keys, docs_
                    keys, docs_, total = [], [], 0
        if docs_:
            yield keys, docs_

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (idf, mean), sequence = shared.value, TaskContext.get().partitionId() << 40
        for keys, ids in shards(batches):
            wide = [x.astype("<u4") for x in ids]
            rows, last = [], 0
            for doc, start, length, at, offset in pack_shard(ids, idf, mean, window):
                piece = wide[doc][start:start + length].tobytes()
                rows.append((keys[doc], start, length, zlib.crc32(piece), len(ids[doc]), sequence + at, offset, piece))
                last = at
            sequence += last + 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema.names)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    laid = coded.repartitionByRange(partitions(spark), "layout", "doc").sortWithinPartitions("layout", "doc").select("doc", "ids")
    return laid.mapInArrow(run, schema)
