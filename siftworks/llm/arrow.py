"""Arrow columns as bytes, and words as arrays of hashes, for the operators that run in Python."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_random = np.random.default_rng(20240229)
BYTE_MIX = _random.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
PLACE_MIX = _random.integers(1, 2**63, 1024, dtype=np.uint64) * U(2) + U(1)


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The UTF-8 bytes of each value, empty for null."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Few rows at a time, so that what is made of a batch stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def word_table(is_word: str) -> np.ndarray:
    """256 booleans: bytes from 0x80 and those of the string belong to words."""
    table = np.zeros(256, dtype=bool)
    table[128:] = True
    table[list(is_word.encode())] = True
    return table


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def words(text: bytes, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the words of a text."""
    raw = np.frombuffer(text, dtype=np.uint8)
    inside = table[raw]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return starts, ends, np.empty(0, dtype=np.uint64)
    letters = raw[inside]
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    return starts, ends, mix(np.add.reduceat(BYTE_MIX[letters] * PLACE_MIX[place & 1023], first))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of each run of size words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        total = total * U(0x9E3779B97F4A7C15) + hashes[k : k + n]
    return mix(total)
