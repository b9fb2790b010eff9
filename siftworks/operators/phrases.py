"""Rules as a table: which phrases are in which texts, for any number of phrases, and the first rule that matches.

A task goes through its texts once. A table has, by a hash of the first bytes of phrases (as many as a level of CHAINS says), which of
the lengths from there to the next level follow and whether longer ones do: a look for each place, another for each level that a place
gets to, not one for each length. Lengths that may follow are looked up whole, by a hash, in a bit filter of all phrases (those of more
than LONG bytes where their first LONG bytes may begin); what passes meets the phrases by an equi-join on the bytes themselves. So texts
aren't moved, no text is held against all phrases, table and filter only save work, and a text's length doesn't matter.

How often phrases occur grows with texts times phrases, but for one text not beyond its places. What passes is told apart in bulk, by hash
and then by its bytes; counts() adds up some thousand texts before it hands their counts out, which are added up again before they
move. first_rule() takes the rules in bands by priority, each sixteen times as many as the one before: texts that a band decides
aren't held against the next. Only hits() hands out all pairs.

Defined cases: a null text has no phrase in it; null and empty phrases match nothing; repeated phrases count once for each rule; rows
that share a key are one text in parts (counts() has no keys: there each row is a text); a null key is a key; other columns are ignored.
Priorities that are equal go by label.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftworks.operators.labelling import numbered
from siftworks.session import cut

LONG = 64
CHUNK = 1 << 17
BAND, WIDER = 1 << 14, 16
MAX_BROADCAST = 1 << 19
#: Strings that a task holds before it adds them up; bytes that it holds or hands out at once; bits of a filter and places of a table, by their logarithm.
HELD = 1 << 20
BYTES_HELD, BYTES_OUT = 1 << 25, 1 << 22
LEAST_BITS, MOST_BITS = 16, 28
LEAST_SLOTS, MOST_SLOTS = 16, 25
#: Lengths of the beginnings that are looked up. Each chain has the sizes from its first level to the next chain; a place gets to a level by those before in its chain.
CHAINS = ((1,), (4,), tuple(range(8, LONG + 1, 7)))
LONGER = 7
U = np.uint64
BYTES = np.random.default_rng(20240301).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
BASE = 0x9E3779B97F4A7C15
#: By how many bits a word goes up so that as many of its first bytes stay.
LOW = np.array([0, *range(56, -1, -8)], dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    out = []
    for x in (BASE, pow(BASE, -1, 1 << 64)):
        full = np.full(n, x, dtype=np.uint64)
        full[0] = 1
        out.append(np.multiply.accumulate(full))
    return out[0], out[1]


def mixed(hashes: np.ndarray, size: int) -> np.ndarray:
    """Codes for hashes of strings of a size."""
    return (hashes + U(size * 0x9FB21C651E98DF25 & (1 << 64) - 1)) * U(0xBF58476D1CE4E5B9)


def places(codes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places in a filter."""
    return first(codes, bits), first((codes ^ (codes >> U(29))) * U(0x94D049BB133111EB), bits)


def first(codes: np.ndarray, bits: int) -> np.ndarray:
    return (codes >> U(64 - bits)).view(np.int64)


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted. np.unique() hashes, which takes many times as long here."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def marked(at: np.ndarray, held: np.ndarray) -> np.ndarray:
    return (held[at >> 3] >> (at & 7).astype(np.uint8)) & np.uint8(1) != 0


def levels_of(size: int) -> list[tuple[int, int]]:
    """Levels at which phrases of a size are told of, and the bit that says so there: how much longer they are, or LONGER."""
    chain = next(c for c in reversed(CHAINS) if c[0] <= size)
    upto = [x for x in chain if x <= size]
    return [(x, LONGER) for x in upto[:-1]] + [(upto[-1], LONGER if size > LONG else size - upto[-1])]


class Scan:
    """Finds what may be a phrase, by the filter, the table and the sizes of phrases."""

    def __init__(self, held: np.ndarray, bits: int, sizes: list[int], chunk: int):
        self.held, self.table = held[: 1 << (bits - 3)], held[1 << (bits - 3) :]
        self.bits, self.slots, self.sizes, self.chunk = bits, len(self.table).bit_length() - 1, sizes, chunk
        self.up = self.down = np.empty(0, np.uint64)
        self.at_level: dict[int, list[int]] = {}
        for size in sizes:
            self.at_level.setdefault(levels_of(size)[-1][0], []).append(size)
        self.chains = [[x for x in chain if x <= max(self.at_level.keys() & set(chain))] for chain in CHAINS if self.at_level.keys() & set(chain)]

    def pieces(self, texts: list[bytes]) -> Iterator[tuple[bytes, list[int], list[int]]]:
        """Bytes of about a chunk, where the pieces in it begin, and which text each is of; pieces overlap by the longest phrase."""
        held: list[bytes] = []
        starts: list[int] = []
        whose: list[int] = []
        size = 0
        for i, text in enumerate(texts):
            for at in range(0, len(text), self.chunk):
                part = text[at : at + self.chunk + self.sizes[-1] - 1]
                held.append(part)
                starts.append(size)
                whose.append(i)
                size += len(part)
                if size >= self.chunk:
                    yield b"".join(held), starts, whose
                    held, starts, whose, size = [], [], [], 0
        if held:
            yield b"".join(held), starts, whose

    def may_be(self, texts: list[bytes]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Bytes of about a chunk, and where in them what the filter lets pass begins, its sizes, which texts it is in, and its codes."""
        for raw, starts, whose in self.pieces(texts):
            n = len(raw)
            if len(self.up) < n + 1:
                self.up, self.down = powers(2 * n + 1)
            upto = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(BYTES[np.frombuffer(raw, np.uint8)] * self.up[:n], out=upto[1:])
            found = [x for chain in self.chains for x in self.along(upto, n, chain) if len(x[0])]
            if not found:
                continue
            at, codes = np.concatenate([x[0] for x in found]), np.concatenate([x[2] for x in found])
            size = np.repeat([x[1] for x in found], [len(x[0]) for x in found])
            piece = np.searchsorted(np.array(starts), at, side="right") - 1
            inside = at + size <= np.array([*starts[1:], n])[piece]
            yield raw, at[inside], size[inside], np.array(whose)[piece[inside]], codes[inside]

    def along(self, upto: np.ndarray, n: int, chain: list[int]) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """Places, size and codes of what passes, for each size of a chain."""
        at = None
        for level in chain:
            if at is None:
                codes = mixed((upto[level:] - upto[: max(0, n + 1 - level)]) * self.down[: max(0, n + 1 - level)], level)
                follows = self.table[first(codes, self.slots)]
                at = np.flatnonzero(follows)
                follows = follows[at]
            else:
                at = at[at <= n - level]
                follows = self.table[first(self.codes(upto, at, level), self.slots)]
            longer = at[follows & np.uint8(1 << LONGER) != 0]
            for size in self.at_level.get(level, ()):
                yield self.passing(upto, n, longer if size > LONG else at[follows & np.uint8(1 << (size - level)) != 0], size)
            at = longer

    def codes(self, upto: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        return mixed((upto[at + size] - upto[at]) * self.down[at], size)

    def passing(self, upto: np.ndarray, n: int, at: np.ndarray, size: int) -> tuple[np.ndarray, int, np.ndarray]:
        at = at[at <= n - size]
        codes = self.codes(upto, at, size)
        one = marked(first(codes, self.bits), self.held)
        at, codes = at[one], codes[one]
        both = marked(places(codes, self.bits)[1], self.held)
        return at[both], size, codes[both]


def alike(raw: np.ndarray, at: np.ndarray, size: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of strings, equal ones alike, and for each number where one stands. By code, and each of a code is held against the
    bytes of the one before; eight bytes have to follow the last string."""
    order = np.argsort(codes)
    codes = codes[order]
    new = np.concatenate([[True], codes[1:] != codes[:-1]])
    begin, left = at[order], size[order]
    same = ~new[1:]
    differ = bool((left[1:] != left[:-1])[same].any())
    words = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
    while len(same) and not differ:
        part = words[begin] << LOW[np.minimum(left, 8)]
        differ = bool(((part[1:] != part[:-1]) & same).any())
        more = left > 8  # those of a code are of one size
        begin, left, same = begin[more] + 8, left[more] - 8, np.concatenate([[False], same])[more][1:]
    if not differ:
        out = np.empty(len(at), np.int64)
        out[order] = np.cumsum(new) - 1
        return out, order[new]
    known: dict[bytes, int] = {}
    out = np.array([known.setdefault(raw[i : i + k].tobytes(), len(known)) for i, k in zip(at.tolist(), size.tolist(), strict=True)])
    return out, np.unique(out, return_index=True)[1]


def strings(raw: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of strings one after the other, and where each begins, with the end."""
    starts = np.concatenate([[0], np.cumsum(size)])
    return raw[np.repeat(at - starts[:-1], size) + np.arange(starts[-1])], starts


class Held:
    """What passed in some texts, each string once for each text as soon as it is told apart."""

    def __init__(self, most: int):
        self.least, self.most = most, most
        self.empty()

    def empty(self) -> None:
        self.raw: list[bytes] = []
        self.rows: list[tuple[np.ndarray, ...]] = []
        self.n = self.size = self.texts = 0

    def add(self, scan: Scan, texts: list[bytes]) -> None:
        for raw, at, size, whose, codes in scan.may_be(texts):
            self.raw.append(raw)
            self.rows.append((at + self.size, size, whose + self.texts, codes))
            self.n, self.size = self.n + len(at), self.size + len(raw)
            if self.n >= self.most or self.size >= max(BYTES_HELD, 32 * self.most):
                raw, at, size, codes, gram, whose = self.distinct()
                kept, starts = strings(raw, at, size)
                self.raw, self.rows = [kept.tobytes()], [(starts[:-1][gram], size[gram], whose, codes[gram])]
                self.n, self.size = len(gram), len(kept)
                self.most = max(self.least, 2 * self.n, self.size // 16)
        self.texts += len(texts)

    def full(self) -> bool:
        return self.n >= self.least or self.size >= BYTES_HELD

    def distinct(self) -> tuple[np.ndarray, ...]:
        """Bytes; where distinct strings stand in them, their sizes and codes; which of them are in which text."""
        raw = np.frombuffer(b"".join([*self.raw, bytes(8)]), np.uint8)
        at, size, whose, codes = (np.concatenate(x) for x in zip(*self.rows, strict=True)) if self.n else (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
        gram, one = alike(raw, at, size, codes) if len(at) else (at, at)
        texts = int(whose.max(initial=0)) + 1
        both = distinct(gram * texts + whose)
        return raw, at[one], size[one], codes[one], both // texts, both % texts


def handed_out(raw: np.ndarray, at: np.ndarray, size: np.ndarray) -> Iterator[tuple[slice, pa.Array]]:
    """Strings as Arrow arrays, and which of them these are."""
    ends = np.cumsum(size)
    low = 0
    while low < len(at):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + BYTES_OUT, side="right")))
        data, starts = strings(raw, at[low:high], size[low:high])
        yield slice(low, high), pa.Array.from_buffers(pa.binary(), high - low, [None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(data)])
        low = high


def named(phrases: DataFrame) -> DataFrame:
    """phrases: phrase. phrase, gram: the distinct ones and their bytes."""
    rows = phrases.select(F.col("phrase").cast("string").alias("phrase")).where(F.length("phrase") > 0).distinct()
    return cut(rows.withColumn("gram", F.encode("phrase", "UTF-8")))


def scan_of(known: DataFrame) -> Broadcast | None:
    """Filter and table of the phrases, and their sizes. The driver gets their words (2^28 bits and 2^25 bytes at most) and the distinct sizes."""
    sizes = sorted(r[0] for r in known.select(F.octet_length("gram")).distinct().collect())
    if not sizes:
        return None
    n = known.count()
    bits = min(MOST_BITS, max(LEAST_BITS, (64 * n).bit_length()))
    slots = min(MOST_SLOTS, max(LEAST_SLOTS, (8 * n).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[int, list[bytes]] = {}
            for x in batch.column(0).to_pylist():
                by.setdefault(len(x), []).append(x)
            out = [np.empty(0, np.int64)]
            for size, grams in by.items():
                levels = dict(levels_of(size))
                up, _ = powers(size)
                raw = np.frombuffer(b"".join(grams), np.uint8).reshape(len(grams), size)
                hashes = np.zeros(len(grams), dtype=np.uint64)
                for k in range(size):
                    hashes += BYTES[raw[:, k]] * up[k]
                    if k + 1 in levels:
                        out.append((1 << bits) + first(mixed(hashes, k + 1), slots) * 8 + levels[k + 1])
                out += places(mixed(hashes, size), bits)
            yield pa.RecordBatch.from_arrays([pa.array(distinct(np.concatenate(out)))], names=["at"])

    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("at").bitwiseAND(F.lit(63)).cast("int"))
    words = known.select("gram").mapInArrow(run, "at bigint").groupBy(F.shiftright("at", 6).alias("w")).agg(F.bit_or(one).alias("b")).toArrow()
    held = np.zeros((1 << (bits - 6)) + (1 << (slots - 3)), dtype="<i8")
    held[words.column("w").to_numpy()] = words.column("b").to_numpy()
    return known.sparkSession.sparkContext.broadcast((held.view(np.uint8), bits, sizes))


def slices(batches: Iterator[pa.RecordBatch], text: int, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Rows of some megabytes of text at most, or one row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        low = 0
        while low < batch.num_rows:
            high = max(low + 1, min(low + rows, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + BYTES_OUT, side="right"))))
            yield batch.slice(low, high - low)
            low = high


def texts_of(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def meet(rows: DataFrame, known: DataFrame) -> DataFrame:
    """rows: gram. Those of phrases, by the bytes."""
    return rows.join(F.broadcast(known) if known.count() <= MAX_BROADCAST else known, "gram")


def pairs(texts: DataFrame, known: DataFrame, key: str, text: str) -> DataFrame:
    """known: gram and more. key and known's columns for each phrase in each row of texts."""
    rows = texts.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    scan, chunk, most = scan_of(known), CHUNK, HELD
    schema = T.StructType([T.StructField("key", rows.schema["key"].dataType), T.StructField("gram", T.BinaryType())])
    if scan is None:
        return rows.sparkSession.createDataFrame([], schema).join(known, "gram").drop("gram")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look, held = Scan(*scan.value, chunk), Held(most)
        for batch in slices(batches, 1):
            held.add(look, texts_of(batch.column(1)))
            raw, at, size, _, gram, whose = held.distinct()
            for part, grams in handed_out(raw, at[gram], size[gram]):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(whose[part])), grams], names=["key", "gram"])
            held.empty()

    return meet(rows.mapInArrow(run, schema), known).drop("gram")


def hits(texts: DataFrame, phrases: DataFrame, key: str = "key", text: str = "text") -> DataFrame:
    """phrases: phrase. key, phrase: each phrase that is in the text of a key, once."""
    return pairs(texts, named(phrases), key, text).distinct()


def counts(texts: DataFrame, phrases: DataFrame, text: str = "text") -> DataFrame:
    """phrases: phrase. phrase, n: how many rows of texts it is in; phrases that are in none have no row."""
    known = named(phrases)
    scan, chunk, most = scan_of(known), CHUNK, HELD
    if scan is None:
        return known.select("phrase", F.lit(0).cast("bigint").alias("n"))

    def out(held: Held) -> Iterator[pa.RecordBatch]:
        raw, at, size, _, gram, _ = held.distinct()
        n = np.bincount(gram, minlength=len(at))
        for part, grams in handed_out(raw, at, size):
            yield pa.RecordBatch.from_arrays([grams, pa.array(n[part].astype(np.int64))], names=["gram", "n"])
        held.empty()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look, held = Scan(*scan.value, chunk), Held(most)
        for batch in slices(batches, 0):
            held.add(look, texts_of(batch.column(0)))
            if held.full():
                yield from out(held)
        yield from out(held)

    found = texts.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "gram binary, n bigint")
    return meet(found.groupBy("gram").agg(F.sum("n").alias("n")), known).select("phrase", "n")


def first_rule(texts: DataFrame, rules: DataFrame, default: str | None, key: str = "key", text: str = "text") -> DataFrame:
    """rules: priority, label, phrase. key, label: of the rules with a phrase in the text that with the lowest priority, else default.
    One row for each key of texts."""
    every = rules.select(F.col("phrase").cast("string").alias("phrase"), F.struct("priority", "label").alias("rule")).where(F.length("phrase") > 0)
    wanted = cut(every.groupBy("phrase").agg(F.min("rule").alias("rule")).select(F.encode("phrase", "UTF-8").alias("gram"), "rule"))
    n, low, high = wanted.count(), 0, BAND
    if n > BAND:
        wanted = cut(numbered(wanted, F.col("rule.priority"), F.col("rule.label"), steady=True))
    rows = texts.select(F.col(key).alias("key"), F.col(text).alias("text"))
    found = rows.select("key", F.lit(None).cast(wanted.schema["rule"].dataType).alias("rule"))
    decided = None
    while low < n:
        band = wanted.select("gram", "rule") if n <= BAND else cut(wanted.where(F.col("place").between(low, high - 1)).select("gram", "rule"))
        left = rows
        if decided is not None:
            known = decided.select(F.col("key").alias("__key"))
            left = rows.join(F.broadcast(known) if known.count() <= MAX_BROADCAST else known, F.col("key").eqNullSafe(F.col("__key")), "left_anti")
        best = pairs(left, band, "key", "text").groupBy("key").agg(F.min("rule").alias("rule"))
        if high < n:
            best = cut(best)
        decided = best if decided is None else decided.unionByName(best)
        low, high = high, high * WIDER
    best = (found if decided is None else found.unionByName(decided)).groupBy("key").agg(F.min("rule").alias("rule"))  # null isn't taken into account
    return best.select("key", F.when(F.col("rule").isNull(), F.lit(default)).otherwise(F.col("rule.label")).alias("label"))
