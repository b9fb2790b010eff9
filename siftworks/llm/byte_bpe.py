"""Byte-level BPE: texts to token ids by a file of ranks, and back.

A text is split by a pattern; each match is encoded for itself. Its bytes are read as Latin-1, a character a byte, so that an
Aho-Corasick automaton over the (reversed) tokens finds the longest token that starts at each place in one scan. A sequence of tokens
is what merging by rank gives if, and only if, each two neighbours are what merging gives of their own bytes: up to the first merge
across a border the neighbours develop as they would alone. So the encoder takes the longest token that is compatible with the one
before, falls back to shorter ones, and steps back where none is (a first token has to be what merging gives of its own bytes). A
place where it had to step back is never entered again, as the encoding of what stands before a place is unique. That makes it linear
in the length of the match, however long. Compatibility is computed by merging the two tokens' bytes and remembered; whole matches
that are short are remembered, too. Both memories are emptied when full: they bear on time alone.

The ranks are read by the driver, broadcast (about 1 MB), and made into an automaton once per worker.

Defined cases: a null text has no tokens, as the empty one; a match that is a token itself is that token, though merging might not
give it; special tokens don't exist, their strings are ordinary text; bytes that aren't UTF-8 are read as U+FFFD. In decoding a null
list is empty, and an id that is null or in no rank decodes to the bytes of U+FFFD. A vocabulary that lacks a single byte is an
error. Column names are arguments; a column of the name that is added is replaced, repeated rows are encoded each for itself, and an
empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftworks.llm.arrow import as_bytes, slices

REMEMBERED = 1 << 18  # matches (twice as many at times), and pairs of tokens, that a worker remembers
NEVER = 1 << 62
SHORT = 64
UNKNOWN = "�".encode()


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Lines of base64 and a number."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line.strip())}


class Pieces(dict):
    """Matches of the pattern and their ids (the bytes of int32), worked out when first asked for. What was asked for lately stays: when
    full, the matches before go, and those that are asked for again come back."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.before = vocabulary, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.before.get(piece)
        if found is None:
            found = array("i", self.vocabulary.merge(piece if piece.isascii() else piece.encode().decode("latin-1"))).tobytes()
        if len(piece) <= SHORT:
            if len(self) >= REMEMBERED:
                self.before = dict(self)
                self.clear()
            self[piece] = found
        return found


class Vocabulary:
    def __init__(self, raw: bytes, pattern: str):
        self.ids = {token.decode("latin-1"): i for token, i in read_ranks(raw).items()}
        if missing := [b for b in range(256) if chr(b) not in self.ids]:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes, the first is {missing[0]}")
        size = max(self.ids.values()) + 1
        self.text_of, self.length, self.shorter = [""] * size, [0] * size, [-1] * size  # shorter: the longest token that is a beginning of this one
        reversed_tokens = ahocorasick.Automaton()
        for token, i in self.ids.items():
            reversed_tokens.add_word(token[::-1], i)
            self.text_of[i], self.length[i] = token, len(token)
            self.shorter[i] = next((self.ids[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in self.ids), -1)
        reversed_tokens.make_automaton()
        self.automaton, self.pattern = reversed_tokens, regex.compile(pattern)
        self.pieces, self.pairs = Pieces(self), {}

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the bytes of a and b gives a and b again. a: -1 where b is the first."""
        if len(self.pairs) >= REMEMBERED:
            self.pairs.clear()
        found = self.pairs[a, b] = self.stays_apart(self.text_of[a] if a >= 0 else "", self.text_of[b])
        return found

    def stays_apart(self, a: str, b: str) -> bool:
        rank_of = self.ids.get
        parts, border = [*a, *b], len(a)
        ranks = [rank_of(x + y, NEVER) for x, y in zip(parts, parts[1:], strict=False)]
        while ranks and (best := min(ranks)) < NEVER:
            at = ranks.index(best)
            if sum(map(len, parts[: at + 1])) == border:
                return False
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            ranks.pop(at)
            if at:
                ranks[at - 1] = rank_of(parts[at - 1] + parts[at], NEVER)
            if at < len(ranks):
                ranks[at] = rank_of(parts[at] + parts[at + 1], NEVER)
        return parts == ([a, b] if a else [b])

    def merge(self, piece: str) -> list[int]:
        """The ids of one match, whose bytes are read as Latin-1."""
        if (whole := self.ids.get(piece)) is not None:
            return [whole]
        n, last = len(piece), -1
        longest = [-1] * (n + 1)
        for end, token in self.automaton.iter(piece[::-1]):  # of each end the longest comes first
            if end != last:
                longest[n - 1 - end], last = token, end
        closed, length, shorter, known = bytearray(n + 1), self.length, self.shorter, self.pairs.get
        out, before, at, token = [], -1, 0, longest[0]
        while at < n:
            while token >= 0:
                end = at + length[token]
                if not closed[end]:
                    fits = known((before, token))
                    if self.compatible(before, token) if fits is None else fits:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                before, at, token = token, end, longest[end]
            else:
                closed[at] = 1
                back = out.pop()
                at -= length[back]
                before, token = out[-1] if out else -1, shorter[back]
        return out

    def encode(self, text: str) -> bytes:
        """The ids as the bytes of int32."""
        found = self.pattern.findall(text) if len(text) < 1 << 20 else (m.group() for m in self.pattern.finditer(text))
        return b"".join(map(self.pieces.__getitem__, found))


_held: dict[str, Vocabulary] = {}


def vocabulary(raw: bytes, pattern: str) -> Vocabulary:
    """The vocabulary of a worker, made once."""
    key = hashlib.sha256(raw + pattern.encode()).hexdigest()
    if key not in _held:
        _held.clear()
        _held[key] = Vocabulary(raw, pattern)
    return _held[key]


def ranks_at(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", keep: tuple[str, ...] | None = None) -> DataFrame:
    """df with the column ids, the tokens of the whole text by the rank file at path (of the driver). keep: the columns to carry
    along, all by default."""
    names = [c for c in (df.columns if keep is None else keep) if c != ids]
    held = df.sparkSession.sparkContext.broadcast((ranks_at(path), pattern))
    schema = T.StructType([*(df.schema[c] for c in names), T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(*held.value)
        for batch in slices(batches):
            found = [own.encode(t.decode("utf-8", "replace")) for t in as_bytes(batch.column(len(names)))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], lists(found)], names=[*names, ids])

    placed = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)]
    return df.select(*placed, F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def lists(found: list[bytes]) -> pa.Array:
    """Arrow's list of each text's ids, over the bytes as they are."""
    offsets = np.concatenate(([0], np.cumsum([len(x) // 4 for x in found]))).astype(np.int32)
    flat = b"".join(found)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.Array.from_buffers(pa.int32(), len(flat) // 4, [None, pa.py_buffer(flat)]))


def decode(df: DataFrame, path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """df with the column to, the bytes that the ids stand for."""
    names = [c for c in df.columns if c != to]
    at, schema = names.index(ids), T.StructType([*(df.schema[c] for c in names), T.StructField(to, T.BinaryType())])
    held = df.sparkSession.sparkContext.broadcast(ranks_at(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = decoder(held.value)
        for batch in slices(batches):
            ids_of = batch.column(at).fill_null([])
            flat = ids_of.flatten().fill_null(-1).to_numpy(zero_copy_only=False).tolist()
            ends = np.cumsum(np.diff(ids_of.offsets.to_numpy())).tolist()
            tokens = list(map(own.__getitem__, flat))
            bytes_of = [b"".join(tokens[a:b]) for a, b in zip([0, *ends], ends, strict=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bytes_of, pa.binary())], names=[*names, to])

    return df.select(*names).mapInArrow(run, schema)


class Tokens(dict):
    """The bytes of each id."""

    def __missing__(self, _: int) -> bytes:
        return UNKNOWN


_decoders: dict[str, Tokens] = {}


def decoder(raw: bytes) -> Tokens:
    """Made once per worker."""
    key = hashlib.sha256(raw).hexdigest()
    if key not in _decoders:
        _decoders.clear()
        _decoders[key] = Tokens((i, token) for token, i in read_ranks(raw).items())
    return _decoders[key]
