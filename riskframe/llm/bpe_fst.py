"""Byte-level BPE by a lazily determinised finite-state transducer.

A sequence of tokens is what the merges make of its bytes exactly if every two neighbours hold: no merge across their
border comes before the merges that made them. So a prefix of the input can be cut in one way only, and what is open
after a prefix is where a token that has not ended may have begun. Tokens before the last place that all open readings
share are emitted. A state has, for each open reading, its bytes and what the token before it lets follow: the pieces at
that token's right edge that some merge could still take up. Tokens with equal edges are one and the same there, so
words share most of their states. States and their transitions are worked out when first met and kept (the tables are
emptied beyond ``MAX_STATES``). Tokens have a longest length, so the lookahead is bounded.

Decoding is streamed: ids become bytes in pieces, and an incremental UTF-8 machine turns bytes into text while holding
back the unfinished sequence at the end of a piece.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, islice

import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from riskframe.llm.common import per_worker, pieces

MAX_STATES = 250_000
MAX_PAIRS = 500_000
MAX_WORDS = 300_000
#: Ids decoded at a time.
PIECE = 4096
NEVER = 1 << 60
#: Bytes after which settled tokens are emitted; shorter input is emitted at its end.
LOOKBACK = 64
BYTES = [bytes((b,)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Transducer:
    """Encoder for one vocabulary, given as the rank of each token's bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.open_prefixes = {token[:k] for token in ranks for k in range(1, len(token))}
        self._halves: dict[bytes, tuple[bytes, bytes] | None] = {}
        self.proper = {token for token in ranks if len(token) == 1 or self.halves(token)}
        self._after: dict[bytes, list[tuple[bytes, int]]] = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                if token[:k] in ranks and token[k:] in ranks:
                    self._after.setdefault(token[:k], []).append((token[k:], rank))
        for pairs in self._after.values():
            pairs.sort()
        self._narrow: dict[tuple[tuple, bytes], tuple] = {}
        self._holds: dict[tuple[tuple, bytes], bool] = {}
        self._edges: dict[tuple[bytes, bool], list[tuple[bytes, int]]] = {}
        self._closed: dict[bytes, tuple] = {}
        self._clear()

    def _clear(self) -> None:
        self._numbers: dict[tuple, int] = {}
        self._states: list[tuple] = []
        self._next: list[dict[int, tuple[int, bytes | None]]] = []
        self._settled: list[int] = []
        self.start = self._state(((b"", ()),))

    def _state(self, readings: tuple) -> int:
        if readings not in self._numbers:
            self._numbers[readings] = len(self._states)
            self._states.append(readings)
            self._next.append({})
            self._settled.append(len(readings[0][0]) if len(readings) == 1 else -1)
        return self._numbers[readings]

    def halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens whose merge makes a token; None for one byte or for a token that no merge makes."""
        if token not in self._halves:
            parts, rank = [token[i:i + 1] for i in range(len(token))], self.ranks[token]
            while len(parts) > 2:
                best, at = min((self.ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
                if best >= rank:
                    break
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            self._halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[token]

    def _edge(self, token: bytes, right: bool) -> list[tuple[bytes, int]]:
        """The pieces at one edge of a token while it is made, each with the rank of the merge that takes it up."""
        key = (token, right)
        if key not in self._edges:
            pieces, taken, piece = [], NEVER, token
            while True:
                pieces.append((piece, taken))
                if len(piece) == 1:
                    break
                taken, piece = self.ranks[piece], self.halves(piece)[right]
            self._edges[key] = pieces
        return self._edges[key]

    def right(self, token: bytes) -> tuple[tuple[bytes, int], ...]:
        """What a border after a token depends on: the pieces at its right edge, each with the rank below which a merge
        with what follows comes first."""
        found = self._closed.get(token)
        if found is None:
            found = self._closed[token] = self.narrow(tuple(self._edge(token, True)), b"")
        return found

    def narrow(self, right: tuple[tuple[bytes, int], ...], begun: bytes) -> tuple[tuple[bytes, int], ...]:
        """What is left of an edge when the next token begins like this: pieces that no merge can still take up in time are
        left out, and the rank becomes the lowest that tells the merges still possible from the others."""
        found = self._narrow.get((right, begun))
        if found is None:
            edge, last = [], begun + b"\xff" * LOOKBACK
            for piece, below in right:
                pairs = self._after.get(piece, ())
                ranks = [self.ranks.get(piece + begun[:k], NEVER) for k in range(1, len(begun))]
                ranks += [rank for _, rank in pairs[bisect_left(pairs, (begun, -1)):bisect_left(pairs, (last, -1))]]
                early = [rank for rank in ranks if rank < below]
                if early:
                    edge.append((piece, max(early) + 1))
            found = self._narrow[right, begun] = tuple(edge)
        return found

    def holds(self, right: tuple[tuple[bytes, int], ...], token: bytes) -> bool:
        """Whether the border between an edge and the token after it stands: of equal merges the left one comes first."""
        found = self._holds.get((right, token))
        if found is None:
            found, ranks = True, self.ranks
            for p, below in right:
                for q, q_taken in self._edge(token, False):
                    rank = ranks.get(p + q)
                    if rank is not None and rank < below and rank <= q_taken:
                        found = False
            self._holds[right, token] = found
        return found

    def step(self, state: int, byte: int) -> tuple[int, bytes | None]:
        """The next state and the token that ends here if the input ends here; None where no cut into tokens does."""
        going, ended = [], None
        for begun, before in self._states[state]:
            piece = begun + BYTES[byte]
            if piece in self.open_prefixes:
                going.append((piece, self.narrow(before, piece) if before else before))
            if ended is None and piece in self.proper and (not before or self.holds(before, piece)):
                ended = piece
        if ended:
            going.append((b"", self.right(ended)))
        found = self._next[state][byte] = (self._state(tuple(going)), ended)
        return found

    def encode(self, data: bytes) -> tuple[int, ...]:
        """Ids of one match of the splitting pattern.

        Where only one reading is open, every token before its begin is settled and emitted.
        """
        if len(self._states) > MAX_STATES:
            self._clear()
        if len(self._holds) + len(self._narrow) > MAX_PAIRS:
            self._holds.clear()
            self._narrow.clear()
        state, out, ends, arcs, settled = self.start, [], [], self._next, self._settled
        if len(data) <= LOOKBACK:
            for byte in data:
                state, ended = arcs[state].get(byte) or self.step(state, byte)
                ends.append(ended)
            return tuple(self._emit(ends, len(ends)))
        for byte in data:
            state, ended = arcs[state].get(byte) or self.step(state, byte)
            ends.append(ended)
            if len(ends) > LOOKBACK and settled[state] >= 0 and len(ends) > settled[state]:
                keep = len(ends) - settled[state]
                out.extend(self._emit(ends, keep))
                del ends[:keep]
        out.extend(self._emit(ends, len(ends)))
        return tuple(out)

    def _emit(self, ends: list[bytes | None], at: int) -> list[int]:
        out = []
        while at > 0:
            token = ends[at - 1]
            out.append(self.ranks[token])
            at -= len(token)
        return out[::-1]


def stream_decode(ids: Iterable[int], table: Callable[[int], bytes], digest=None) -> str:
    """Text of a stream of ids; bytes that are no UTF-8 become U+FFFD. ``digest`` is fed the bytes."""
    machine, text, ids = codecs.getincrementaldecoder("utf-8")("replace"), [], iter(ids)
    while data := b"".join(map(table, islice(ids, PIECE))):
        if digest is not None:
            digest.update(data)
        text.append(machine.decode(data))
    text.append(machine.decode(b"", final=True))
    return "".join(text)


class Codec:
    """Encoder and decoder with the pieces that repeat between texts kept."""

    def __init__(self, path: str, pattern: str):
        self.fst = Transducer(read_ranks(path))
        self.split = regex.compile(pattern).findall
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.words: dict[str, tuple[int, ...]] = {}

    def encode(self, text: str) -> list[int]:
        parts = pieces(text, self.split)
        if len(self.known) > MAX_WORDS:  # those met again soon come back from the older half
            self.older, self.known = self.known, {}
        known, older, words, encode = self.known, self.older, self.words, self.fst.encode
        if len(words) > MAX_WORDS:
            words.clear()
        codes = list(map(known.get, parts))
        if None in codes:
            for i, (part, code) in enumerate(zip(parts, codes)):
                if code is None:
                    code = known.get(part) or older.get(part)  # it may have come twice
                    if code is None:
                        code = ()
                        for word in self.split(part):
                            ids = words.get(word)
                            if ids is None:
                                ids = words[word] = encode(word.encode("utf-8", "surrogatepass"))
                            code += ids
                    codes[i] = known[part] = code
        return list(chain.from_iterable(codes))


def _codec(path: str, pattern: str) -> Codec:
    return per_worker("bpe", (path, pattern), lambda: Codec(path, pattern))


def encode(docs: DataFrame, vocab_path: str, pattern: str = public_tokenizers.PATTERN, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``ids array<int>``; a column of that name is replaced. Null text: no ids. One pass, no shuffle."""
    keep = [f for f in docs.schema if f.name != "ids"]
    schema = StructType([*keep, StructField("ids", ArrayType(IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocab_path, pattern)
        for batch in batches:
            ids = [codec.encode(text or "") for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(ids, pa.list_(pa.int32()))], schema.names)

    return docs.select(F.col(f"`{text_col}`").alias("__text"), *[F.col(f"`{f.name}`") for f in keep]).mapInArrow(run, schema)


def decode(coded: DataFrame, vocab_path: str, pattern: str = public_tokenizers.PATTERN, ids_col: str = "ids") -> DataFrame:
    """All columns of ``coded`` and ``text`` decoded from the ids; a column of that name is replaced. Null ids: empty text."""
    keep = [f for f in coded.schema if f.name != "text"]
    schema = StructType([*keep, StructField("text", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _codec(vocab_path, pattern).fst.tokens
        for batch in batches:
            texts = [stream_decode(ids or (), tokens.__getitem__) for ids in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string())], schema.names)

    return coded.select(F.col(f"`{ids_col}`").alias("__ids"), *[F.col(f"`{f.name}`") for f in keep]).mapInArrow(run, schema)


def digests(docs: DataFrame, vocab_path: str, key: str = "doc_id", text_col: str = "text",
            pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Encode and decode each text in one pass and return counts and digests in place of ids and text.

    Null text counts as empty (no ids, digests of nothing). A null key stays null; repeated rows stay; an empty table
    gives an empty table; further columns are not carried.
    """
    schema = StructType([
        StructField(key, docs.schema[key].dataType), StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocab_path, pattern)
        tokens, digits = codec.fst.tokens, per_worker("bpe.digits", vocab_path, lambda: {i: str(i) for i in codec.fst.tokens})
        for batch in batches:
            counts, coded, decoded = [], [], []
            for text in batch.column(1).to_pylist():
                ids, bytes_digest = codec.encode(text or ""), hashlib.sha256()
                stream_decode(ids, tokens.__getitem__, bytes_digest)
                counts.append(len(ids))
                coded.append(hashlib.sha256(",".join(map(digits.__getitem__, ids)).encode()).hexdigest())
                decoded.append(bytes_digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())], schema.names)

    return docs.select(F.col(f"`{key}`"), F.col(f"`{text_col}`")).mapInArrow(run, schema)
