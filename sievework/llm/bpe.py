"""Encoding with a public byte-level BPE vocabulary by a lazily determinised transducer.

A text is cut into pieces by the vocabulary's split pattern; merges never cross a piece. Within a piece, the merges
are compiled into a finite-state transducer that reads bytes and writes token ids:

* The nondeterministic machine guesses where tokens end. It walks a trie of the vocabulary's byte strings and may
  leave it at a token only if this token and the one before stand side by side in a valid encoding, that is, if the
  merges applied to their joined bytes give back just these two tokens. A sequence all of whose neighbours are valid
  is the encoding of its bytes, so exactly one guess survives at each byte.
* It is determinised as bytes arrive. A state is the set of live trie positions, each with the ids it has guessed but
  not yet written; what all of them share is written on the step (bounded lookahead: no position outlives the longest
  token). States are interned and steps kept in a table, so text whose steps are known costs one look-up a byte.

``Utf8Machine`` decodes a stream of tokens piece by piece: bytes of an unfinished character wait for the next token,
and what can't become a character is replaced by U+FFFD.

Defined results: null and empty texts give an empty list; strings that look like special tokens are ordinary text;
lone surrogates, which UTF-8 can't hold, are encoded as U+FFFD. Very long texts are handled whole, in one pass; the
tables are emptied at a fixed number of entries and fill again, which changes speed and never the result.
"""

from __future__ import annotations

import base64
import json
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

#: Where the files of the public vocabularies lie; a parameter of every function that encodes.
TOKENIZER_DIR = os.environ.get("SIEVEWORK_TOKENIZERS", "/opt/tokenizers")
DEFAULT_VOCABULARY = "byte_bpe_50k"
#: The split of the public byte-level vocabularies. Fixed value.
SPLIT_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries at which a table is emptied.
MOST_STEPS, MOST_PIECES = 1_000_000, 300_000


def read_vocabulary(name: str = DEFAULT_VOCABULARY, folder: str = TOKENIZER_DIR) -> dict[bytes, int]:
    """Byte string -> id, from a .tiktoken file; ids follow the order of the merges."""
    with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Transducer:
    """Bytes of one piece in, ids out."""

    def __init__(self, vocabulary: dict[bytes, int]):
        self.vocabulary = vocabulary
        self.tokens = {i: t for t, i in vocabulary.items()}
        # the trie: (node, byte) -> node as node << 8 | byte, and the token that ends at a node
        self.trie: dict[int, int] = {}
        self.ends: list[int] = [-1]
        for token, i in vocabulary.items():
            node = 0
            for b in token:
                step = node << 8 | b
                if (to := self.trie.get(step)) is None:
                    to = self.trie[step] = len(self.ends)
                    self.ends.append(-1)
                node = to
            self.ends[node] = i
        self.sides: dict[tuple[int, int], bool] = {}
        self._reset()

    def _reset(self) -> None:
        #: state number -> its live positions (node, last id, ids not yet written); the start has one, at the root
        self.states: list[tuple] = [((0, -1, ()),)]
        self.numbers: dict[tuple, int] = {self.states[0]: 0}
        self.steps: dict[int, tuple[int, tuple[int, ...]]] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}

    def merged(self, data: bytes) -> list[int]:
        """The merges as they are defined: the lowest pair first, leftmost among equals."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranks = [self.vocabulary.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
            least = min(ranks)
            if least == 1 << 60:
                break
            at = ranks.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.vocabulary[p] for p in parts]

    def side_by_side(self, a: int, b: int) -> bool:
        """Whether the joined bytes of two tokens are encoded as these two."""
        if (known := self.sides.get((a, b))) is None:
            if len(self.sides) >= MOST_STEPS:
                self.sides.clear()
            known = self.sides[a, b] = self.merged(self.tokens[a] + self.tokens[b]) == [a, b]
        return known

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        live, ended = [], None
        for node, last, owed in self.states[state]:
            to = self.trie.get(node << 8 | byte)
            if to is None:
                continue
            live.append((to, last, owed))
            token = self.ends[to]
            if token >= 0 and ended is None and (last < 0 or self.side_by_side(last, token)):
                ended = (0, token, (*owed, token))
        live.append(ended)
        owed = [x[2] for x in live]
        shared = 0
        while all(len(o) > shared for o in owed) and len({o[shared] for o in owed}) == 1:
            shared += 1
        written = owed[0][:shared]
        key = tuple(sorted((node, last, o[shared:]) for node, last, o in live))
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.states)
            self.states.append(key)
        return number, written

    def piece(self, data: bytes) -> tuple[int, ...]:
        """Ids of one piece."""
        state, out, steps = 0, [], self.steps
        for byte in data:
            step = steps.get(state << 8 | byte)
            if step is None:
                step = steps[state << 8 | byte] = self._step(state, byte)
            state = step[0]
            if step[1]:
                out.extend(step[1])
        for node, _, owed in self.states[state]:
            if not node:  # the position at the root: a token ends at the last byte
                out.extend(owed)
        if len(steps) >= MOST_STEPS:
            self._reset()
        return tuple(out)


class Encoder:
    """Whole texts in, ids out; ``decode_stream`` back."""

    def __init__(self, name: str = DEFAULT_VOCABULARY, folder: str = TOKENIZER_DIR):
        self.machine = Transducer(read_vocabulary(name, folder))
        self.split = regex.compile(SPLIT_PATTERN)

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        machine, out = self.machine, []
        known = machine.pieces
        for piece in self.split.findall(text):
            ids = known.get(piece)
            if ids is None:
                ids = machine.piece(piece.encode("utf-8", "replace") if piece.isascii() else _utf8(piece))
                known = machine.pieces
                if len(known) >= MOST_PIECES:
                    known.clear()
                if len(piece) <= 64:
                    known[piece] = ids
            out.extend(ids)
        return out

    def decode_stream(self, ids: Iterable[int]) -> Iterator[str]:
        machine, tokens = Utf8Machine(), self.machine.tokens
        for i in ids:
            yield machine.feed(tokens[i])
        yield machine.close()

    def decode(self, ids: Iterable[int]) -> str:
        return "".join(self.decode_stream(ids))


def _utf8(text: str) -> bytes:
    return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace").encode("utf-8")


class Utf8Machine:
    """Bytes in, whole characters out: how many bytes are still awaited, and the range of the next one."""

    def __init__(self) -> None:
        self.held = bytearray()
        self.awaited, self.low, self.high = 0, 0x80, 0xBF

    def feed(self, data: bytes) -> str:
        if not self.awaited and data.isascii():
            return data.decode("ascii")
        out = []
        for b in data:
            if self.awaited:
                if self.low <= b <= self.high:
                    self.held.append(b)
                    self.awaited, self.low, self.high = self.awaited - 1, 0x80, 0xBF
                    if not self.awaited:
                        out.append(self.held.decode("utf-8"))
                        self.held.clear()
                    continue
                out.append("�")
                self._clear()
            out.append(self._first(b))
        return "".join(out)

    def _first(self, b: int) -> str:
        if b < 0x80:
            return chr(b)
        if 0xC2 <= b <= 0xDF:
            self.awaited = 1
        elif 0xE0 <= b <= 0xEF:
            self.awaited, self.low, self.high = 2, 0xA0 if b == 0xE0 else 0x80, 0x9F if b == 0xED else 0xBF
        elif 0xF0 <= b <= 0xF4:
            self.awaited, self.low, self.high = 3, 0x90 if b == 0xF0 else 0x80, 0x8F if b == 0xF4 else 0xBF
        else:
            return "�"
        self.held.append(b)
        return ""

    def _clear(self) -> None:
        self.held.clear()
        self.awaited, self.low, self.high = 0, 0x80, 0xBF

    def close(self) -> str:
        """What an unfinished character at the end of the stream becomes."""
        left = "�" if self.awaited else ""
        self._clear()
        return left


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(name: str = DEFAULT_VOCABULARY, folder: str = TOKENIZER_DIR) -> Encoder:
    """The encoder of this Python worker; its tables are filled once and serve all tasks of the worker."""
    if (name, folder) not in _ENCODERS:
        _ENCODERS[name, folder] = Encoder(name, folder)
    return _ENCODERS[name, folder]


def encode_documents(df: DataFrame, key: str = "doc_id", text: str = "text", name: str = DEFAULT_VOCABULARY, folder: str = TOKENIZER_DIR) -> DataFrame:
    """``key``, ``ids`` (array of int), one row for each row of ``df``. No shuffle: one narrow stage."""
    import pyspark.sql.types as T

    pairs = df.select(F.col(key).alias("k"), F.col(text).alias("t"))
    schema = T.StructType([T.StructField(key, pairs.schema["k"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(name, folder).encode
        for batch in batches:
            flat, ends = [], [0]
            for t in batch.column(1):
                flat.extend(encode(t.as_py()))
                ends.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(np.asarray(ends, dtype=np.int32)), pa.array(np.asarray(flat, dtype=np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=[key, "ids"])

    return pairs.mapInArrow(run, schema)


def token_counts(df: DataFrame, key: str = "doc_id", text: str = "text", out: str = "n_tokens", name: str = DEFAULT_VOCABULARY, folder: str = TOKENIZER_DIR) -> DataFrame:
    """``key``, ``out``: the number of tokens of each text; ids don't leave the worker. Null and empty texts have 0."""

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder(name, folder).encode
        for batch in batches:
            yield pd.Series([len(encode(t)) for t in batch], dtype="int32")

    return df.select(F.col(key), count(F.col(text)).alias(out))


def decode_documents(df: DataFrame, key: str = "doc_id", ids: str = "ids", name: str = DEFAULT_VOCABULARY, folder: str = TOKENIZER_DIR) -> DataFrame:
    """``key``, ``text``: the ids decoded as a stream. A null list gives null, an empty one ""."""

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decode = encoder(name, folder).decode
        for batch in batches:
            yield batch.map(decode, na_action="ignore")

    return df.select(F.col(key), decode(F.col(ids)).alias("text"))


def vocabulary_table(name: str = DEFAULT_VOCABULARY, folder: str = TOKENIZER_DIR) -> str:
    """JSON of the vocabulary's size and longest token, for reports."""
    v = read_vocabulary(name, folder)
    return json.dumps({"name": name, "tokens": len(v), "longest": max(map(len, v))})
