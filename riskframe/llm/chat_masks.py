"""Chat formatting with loss masks aligned by token offsets.

A conversation is rendered as one text in which control strings mark the turns, and encoded once; the byte span of every
token follows from the lengths of the tokens before it. The spans of the turns are known from rendering; both lists are
sorted, so the tokens of a turn are found by binary search. The control strings are tokens of their own, therefore no token crosses the border of a turn.

Where a text holds a control string, or one that is escaped already, an escape character is put after its first character;
taking one away gives the text back. Conversations are read as a sorted stream. One that is longer than ``SEGMENT``
bytes is handed on in segments that end with a turn; as control strings are tokens, its ids are those of the whole.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from riskframe.llm.bm25_packing import byte_ranks
from riskframe.llm.common import per_worker

#: Bytes after which a conversation is handed on at the end of a turn.
SEGMENT = 1 << 22
#: Characters after which rendered conversations are handed on, and rows of a batch read back.
AT_ONCE, ROWS = 1 << 20, 1024


@dataclass(frozen=True)
class Template:
    """A turn is ``begin``, the role, ``middle``, the text and ``end``."""

    begin: str = "<s>[INST]"
    middle: str = "[/INST]"
    end: str = "</s>"
    #: Strings with a meaning of their own; each begins with a character that it does not hold a second time.
    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<|endoftext|>")
    escape: str = "\\"
    #: The role whose texts are learned.
    learned: str = "assistant"

    @cached_property
    def _patterns(self) -> tuple[re.Pattern, re.Pattern]:
        """Control strings with any number of escapes, and with at least one."""
        mark = re.escape(self.escape)
        return tuple(re.compile("|".join(re.escape(c[0]) + mark + least + re.escape(c[1:]) for c in self.controls)) for least in "*+")

    @cached_property
    def _firsts(self) -> frozenset[str]:
        return frozenset(c[0] for c in self.controls)

    def escaped(self, text: str) -> str:
        if not any(c in text for c in self._firsts):
            return text
        return self._patterns[0].sub(lambda m: m[0][0] + self.escape + m[0][1:], text)

    def unescaped(self, text: str) -> str:
        if self.escape not in text:
            return text
        return self._patterns[1].sub(lambda m: m[0][0] + m[0][2:], text)

    def turn(self, role: str, text: str) -> tuple[str, str, str]:
        """What stands before the text, the text, and what stands after it."""
        return self.begin + self.escaped(role) + self.middle, self.escaped(text), self.end

    def turns(self, rendered: str) -> Iterator[tuple[str, str]]:
        """Role and text of each turn of a rendered text."""
        for turn in rendered.split(self.end)[:-1]:
            role, _, text = turn.removeprefix(self.begin).partition(self.middle)
            yield self.unescaped(role), self.unescaped(text)


TEMPLATE = Template()


class Coder:
    """A plain byte-level BPE, given as a file of the tokenizers library, with the control strings of a template as tokens.

    Control strings that the file does not know get the ids after its last one.
    """

    def __init__(self, path: str, template: Template):
        ranks = byte_ranks(path)
        if ranks is None:
            raise ValueError("the tokenizer file holds no plain byte-level BPE")
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        known = {t["content"]: t["id"] for t in made.get("added_tokens", [])}
        free = max([*made["model"]["vocab"].values(), *known.values()]) + 1
        new = [c for c in template.controls if c not in known]
        self.controls = {c: known[c] for c in template.controls if c in known} | {c: free + i for i, c in enumerate(new)}
        self.encoding = tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self.controls)
        self.bytes = {i: token for token, i in ranks.items()} | {i: c.encode() for c, i in self.controls.items()}
        self.length = np.zeros(free + len(new), np.int64)
        self.length[list(self.bytes)] = [len(token) for token in self.bytes.values()]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a text, and the first and the end byte of each token."""
        ids = np.array(self.encoding.encode(text, allowed_special="all"), np.int32)
        ends = np.cumsum(self.length[ids])
        return ids, ends - self.length[ids], ends

    def text(self, ids: np.ndarray) -> str:
        return b"".join([self.bytes[i] for i in ids.tolist()]).decode()


def _coder(path: str, template: Template) -> Coder:
    return per_worker("chat", (path, template), lambda: Coder(path, template))


def inside(begins: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens share a byte with one of the spans; both are sorted, and spans do not touch."""
    if not spans:
        return np.zeros(len(begins), bool)
    first, last = np.array(spans, np.int64).T
    at = np.searchsorted(last, begins, side="right")  # the first span that ends after the token begins
    return (at < len(last)) & (first[np.minimum(at, len(last) - 1)] < ends)


def render(conversations: DataFrame, tokenizer_path: str, key: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", template: Template = TEMPLATE) -> DataFrame:
    """key, segment, formatted, ids, loss: the rendered text of each conversation, its ids and which of them are learned.

    Turns are in the order of ``turn_col``, null first, equal ones by role and text; repeated rows are turns of their own.
    A null role or text is empty. Rows without a key are one conversation. A conversation has one row, or several segments
    in a row of one partition if it is long. An empty table gives an empty table; further columns are not read.
    """
    schema = StructType([StructField(key, conversations.schema[key].dataType), *StructType.fromDDL(
        "segment int, formatted string, ids array<int>, loss array<boolean>").fields])

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(key, segment, text, spans of the learned texts)"""
        now, number, pieces, spans, at, begun = None, 0, [], [], 0, False
        for batch in batches:
            for conv, role, text in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if begun and (conv != now or at >= SEGMENT):
                    yield now, number, "".join(pieces), spans
                    number, pieces, spans, at = number + 1 if conv == now else 0, [], [], 0
                now, begun = conv, True
                before, body, after = template.turn(role or "", text or "")
                first = at + len(before.encode())
                end = first + len(body.encode())
                if role == template.learned and body:
                    spans.append((first, end))
                pieces += before, body, after
                at = end + len(after.encode())
        if begun:
            yield now, number, "".join(pieces), spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, held, size = _coder(tokenizer_path, template), [], 0
        for one in segments(batches):
            held.append(one)
            size += len(one[2])
            if size >= AT_ONCE:
                yield encoded(coder, held)
                held, size = [], 0
        if held:
            yield encoded(coder, held)

    def encoded(coder: Coder, held: list[tuple]) -> pa.RecordBatch:
        keys, numbers, texts, spans = zip(*held)
        ids, loss = [], []
        for text, turns in zip(texts, spans):
            one, begins, ends = coder.encode(text)
            ids.append(one)
            loss.append(inside(begins, ends, turns))
        first = pa.array([0, *accumulate(map(len, ids))], pa.int32())
        return pa.RecordBatch.from_arrays([
            pa.array(keys, arrow[0].type), pa.array(numbers, pa.int32()), pa.array(texts, pa.string()),
            pa.ListArray.from_arrays(first, pa.array(np.concatenate(ids))), pa.ListArray.from_arrays(first, pa.array(np.concatenate(loss)))], schema.names)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    rows = conversations.select(*[F.col(f"`{c}`").alias(a) for c, a in ((key, "conv"), (role_col, "role"), (text_col, "text"), (turn_col, "turn"))])
    laid = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    return laid.select("conv", "role", "text").mapInArrow(run, schema)


def read_back(rendered: DataFrame, tokenizer_path: str, key: str = "conv_id", template: Template = TEMPLATE) -> DataFrame:
    """Counts and digests of what ``render`` wrote, one row for each conversation, read from its texts, ids and masks alone.

    Segments of a conversation have to follow each other, as ``render`` leaves them. The turns come from the formatted
    text, the learned text from the ids under the mask.
    """
    schema = StructType([StructField(key, rendered.schema[key].dataType), *StructType.fromDDL(
        "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, rows = _coder(tokenizer_path, template), []
        for batch in batches:
            offsets = batch.column(3).offsets.to_numpy()
            ids, loss = batch.column(3).values.to_numpy(), batch.column(4).values.to_numpy(zero_copy_only=False)
            for i, (conv, segment, text) in enumerate(zip(*[batch.column(c).to_pylist() for c in range(3)])):
                if segment == 0:
                    if len(rows) > ROWS:
                        yield done(rows[:-1])
                        del rows[:-1]
                    rows.append([conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0])
                row = rows[-1]
                for role, said in template.turns(text):
                    row[1] += 1
                    row[2].update(f"{role}\n{said}\n".encode())
                mine, learned = ids[offsets[i]:offsets[i + 1]], loss[offsets[i]:offsets[i + 1]]
                edges = np.flatnonzero(np.diff(np.r_[False, learned, False]))
                for first, end in edges.reshape(-1, 2).tolist():
                    said = template.unescaped(coder.text(mine[first:end]))
                    row[3] += len(said)
                    row[4].update(said.encode())
                row[5] += len(text)
        if rows:
            yield done(rows)

    def done(rows: list[list]) -> pa.RecordBatch:
        columns = list(zip(*[(conv, n, turns.hexdigest(), chars, said.hexdigest(), total) for conv, n, turns, chars, said, total in rows]))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema.names)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return rendered.select(key, "segment", "formatted", "ids", "loss").mapInArrow(run, schema)
