"""Removal of repeated passages: every byte that a string of `least` bytes covers which also starts in an earlier document.

Suffix sorting, in pieces that fit a task. Any window of `least` bytes belongs to the smallest hash of its k-byte strings (its
minimizer), which depends on the window's bytes only; so equal windows meet wherever windows are dealt out by it. Each document
is cut into maximal runs of windows with one minimizer (a cut is about 67 bytes, 18 windows).

1. Documents are dealt into batches of bounded bytes by doc_id. A batch hands out its distinct minimizers, a few bytes each, one
   row for each bucket (by minimizer) that it has some of; the answer has three bits each: whether two documents have it,
   whether it is hot, and whether its windows are to be spread.
2. A batch hands out its distinct cuts of shared minimizers, each once with the smallest doc_id that has it (so a passage that
   fills a third of the documents costs a batch one cut), dealt out by minimizer again. The more documents, the more minimizers
   are hot, have more cuts than fit a block: cuts of these are cut again, by minimizers of twice as many bytes (some two for
   one), and dealt out by those. Only of minimizers with SPREAD times as many cuts it hands out the windows, dealt out by their own
   hash: no task is given more than so many cuts of one minimizer.
3. A task goes through its cuts in blocks of whole minimizers. It builds the Burrows-Wheeler transform of a block's distinct cuts;
   breadth-first backward extension derives the common prefixes of neighbours in suffix order by increasing value, from 28 bytes on
   (shorter ones the sort has found on its way): step l extends
   every interval of a string of l bytes that is still open (has two suffixes or more) by each byte before it, and where an
   extended interval ends a prefix of exactly l is found. It stops at `least`. Neighbours without a shorter common prefix share a
   window, whose smallest doc_id is that of its interval. What a smaller doc_id has goes back to the batches. Where one key alone
   has more than several blocks, its windows go through the transform by their hash, a block at a time.
4. A batch marks what starts in a smaller doc_id and removes it.

A batch never hands out more rows than it has distinct minimizers, so rows and bytes grow with the documents however many batches
there are. All cuts of shared minimizers go through the transform. Cuts are made anew in each of the three passes over a batch
(two seconds for 170 MB), which takes less than storing them would.

Defined cases: a null text is empty; texts shorter than `least` keep all; a null doc_id counts as the largest; rows that share a
doc_id, or have none, are documents with equal numbers, none of which removes from another (batches go by id and text, so that only rows
alike in both share one for certain); an empty table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.llm.arrow import BYTE_MIX, U, as_bytes, mix
from siftworks.llm.common import partitions

LEAST, KMER = 50, 16
BATCH_BYTES = 16 << 20
BLOCK_SYMBOLS = 1 << 18
HOT_CUTS = 4096
SPREAD = 256
CHUNK = 1 << 17
AT_ONCE = 1 << 14  # cuts whose windows are gone through together
LONGEST = 128  # windows in a cut
NONE = np.iinfo(np.int64).max
SENT = "bucket int, batch int, keys binary, ids binary, places binary, owners binary, sizes binary, strings binary"
TOLD = "batch int, ids binary, places binary, counts binary, owners binary"


# --- cuts ---------------------------------------------------------------------------------------------------------------


def pieces(texts: list[bytes], least: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes of up to CHUNK (and a document's rest), where pieces start and end in it, and which text and place each is of."""
    held: list[bytes] = []
    whose: list[int] = []
    where: list[int] = []
    size = 0

    def packed():
        ends = np.cumsum([len(x) for x in held])
        return b"".join(held), ends - [len(x) for x in held], ends, np.array([whose, where], dtype=np.int64)

    for i, text in enumerate(texts):
        if len(text) < least:
            continue
        for at in range(0, len(text) - least + 1, CHUNK):
            part = text[at : at + CHUNK + least - 1]
            held.append(part)
            whose.append(i)
            where.append(at)
            size += len(part)
            if size >= CHUNK:
                yield packed()
                held, whose, where, size = [], [], [], 0
    if held:
        yield packed()


def minimizers(raw: bytes, least: int, kmer: int) -> np.ndarray:
    """For each window of raw the smallest hash of its strings of kmer bytes (16 at least)."""
    n = len(raw)
    padded = raw + bytes(16)
    eight = np.empty(n, dtype=np.uint64)  # what starts at each byte
    for k in range(min(8, n)):
        eight[k::8] = np.frombuffer(padded, "<u8", count=-(-(n - k) // 8), offset=k)
    m = n - kmer + 1
    x = eight[:m] * U(0x9E3779B97F4A7C15)
    x ^= x >> U(32)
    for at in (*range(8, kmer - 8, 8), kmer - 8):
        x += eight[at : at + m]
        x *= U(0xBF58476D1CE4E5B9)
        x ^= x >> U(32)
    span, have = least - kmer + 1, 1
    while have < span:
        step = min(have, span - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    base = 0x9E3779B97F4A7C15
    out = []
    for x in (base, pow(base, -1, 1 << 64)):
        full = np.full(n, x, dtype=np.uint64)
        full[0] = 1
        out.append(np.multiply.accumulate(full))
    return out[0], out[1]


def cuts(texts: list[bytes], least: int, kmer: int) -> tuple[np.ndarray, ...]:
    """Of all cuts in order: minimizer, number of the text, first byte, number of windows, and a hash of the bytes."""
    out = []
    up = down = np.empty(0, np.uint64)
    for raw, starts, ends, source in pieces(texts, least):
        low = minimizers(raw, least, kmer)
        n = len(low)
        begin = np.zeros(n + 1, dtype=bool)
        begin[1:n] = low[1:] != low[:-1]
        begin[starts] = True
        stop = ends - least + 1  # windows from here cross into the next piece
        begin[stop[stop <= n]] = True
        at = np.flatnonzero(begin[:n])
        piece = np.searchsorted(starts, at, side="right") - 1
        windows = np.diff(np.append(at, n))
        windows = np.minimum(at + windows, stop[piece]) - at
        real = windows > 0
        at, piece, windows = at[real], piece[real], windows[real]
        parts = -(-windows // LONGEST)
        if (parts > 1).any():
            nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            at, piece, windows = (np.repeat(x, parts) for x in (at, piece, windows))
            at = at + nth * LONGEST
            windows = np.minimum(windows - nth * LONGEST, LONGEST)
        if len(up) <= len(raw):
            up, down = powers(2 * len(raw) + 1)
        upto = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(BYTE_MIX[np.frombuffer(raw, np.uint8)] * up[: len(raw)], out=upto[1:])
        content = mix((upto[at + windows + least - 1] - upto[at]) * down[at] + windows.astype(np.uint64))
        out.append((low[at], source[0][piece], at - starts[piece] + source[1][piece], windows, content))
    if not out:
        return np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(3)), np.empty(0, np.uint64)
    low, text, first, windows, content = (np.concatenate(x) for x in zip(*out, strict=True))
    return mix(low), text, first, windows, content


def recut(strings: list[bytes], least: int, kmer: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Cuts of strings by minimizers of kmer bytes (least: equal windows): minimizer, number of the string, place in it, and bytes."""
    low, which, first, windows, _ = cuts(strings, least, kmer)
    return low, which, first, [strings[i][a : a + n] for i, a, n in zip(which.tolist(), first.tolist(), (windows + least - 1).tolist(), strict=True)]


class Batch:
    """The documents of a batch in a fixed order, their cuts, and the distinct cuts (contents), numbered by their hash."""

    def __init__(self, table: pa.Table, bits: int, least: int, kmer: int):
        ids = table.column("doc_id")
        numbers = ids.cast(pa.int64()).fill_null(NONE).to_numpy()
        texts = as_bytes(table.column("text"))
        order = sorted(range(len(texts)), key=lambda i: (numbers[i], texts[i]))
        self.ids, self.numbers, self.texts = ids.take(pa.array(order, pa.int64())), numbers[order], [texts[i] for i in order]
        low, self.text, self.first, self.windows, content = cuts(self.texts, least, kmer)
        coded = pa.array(content).dictionary_encode()  # in the order in which they come
        self.content, self.example = coded.indices.to_numpy().astype(np.int64), np.empty(len(coded.dictionary), dtype=np.int64)
        self.example[self.content[::-1]] = np.arange(len(content))[::-1]
        if (low[self.example][self.content] != low).any():  # one hash of two contents
            both = np.lexsort((content, low))
            new = np.append(True, (np.diff(low[both]) != 0) | (np.diff(content[both]) != 0))
            self.example, self.content = both[new], np.empty(len(low), dtype=np.int64)
            self.content[both] = np.cumsum(new) - 1
        #: of each content: the minimizer's leading bits, and the smallest and largest number of a document that has it
        self.key = (low[self.example] >> U(64 - bits)).astype(np.int64)
        self.owner, self.other = np.full(len(self.example), NONE), np.full(len(self.example), -1)
        np.minimum.at(self.owner, self.content, self.numbers[self.text])
        np.maximum.at(self.other, self.content, self.text)
        self.lone = np.full(len(self.example), NONE)
        np.minimum.at(self.lone, self.content, self.text)

    def strings(self, which: np.ndarray, least: int) -> list[bytes]:
        """The bytes of contents."""
        at = self.example[which]
        return [self.texts[t][a : a + w] for t, a, w in zip(self.text[at].tolist(), self.first[at].tolist(), (self.windows[at] + least - 1).tolist(), strict=True)]


# --- the transform --------------------------------------------------------------------------------------------------------


def ahead(x: np.ndarray, k: int) -> np.ndarray:
    """What stands k places further."""
    return np.append(x[k:], np.zeros(min(k, len(x)), dtype=x.dtype))


def suffix_order(symbols: np.ndarray, reach: np.ndarray, depth: int) -> np.ndarray:
    """Positions by the order of what starts there, to depth symbols at least. reach: symbols up to the end mark (0) that follows,
    which is unlike any other."""
    return suffixes(symbols, reach, depth)[0]


def suffixes(symbols: np.ndarray, reach: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, int]:
    """suffix_order; and from the last step but one of the sort, below depth: where the common prefix with the one before is
    shorter than so many symbols, and how many these are."""
    n = len(symbols)
    one = symbols.astype(np.int64)
    two = one << 9 | ahead(one, 1)
    # seven symbols; what follows an end mark doesn't matter, as a suffix that has one is alone
    order = np.argsort(packed := (two << 18 | ahead(two, 2)) << 27 | ahead(two << 9 | ahead(one, 2), 4))
    ranked, done = packed[order], 7
    new = np.append(True, ranked[1:] != ranked[:-1])
    ended = reach[order] < done
    new |= ended
    new[1:] |= ended[:-1]
    rank = np.empty(n, dtype=np.int64)  # the first place of its group
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    short, sure = new, done
    while done < depth:
        short, sure = new.copy(), done
        alone = new & np.append(new[1:], True)
        places = np.flatnonzero(~alone)  # only groups of two or more are sorted further
        if not len(places):
            break
        at = order[places]
        packed = rank[at] * (n + 1) + rank[at + done] + 1  # what has not ended has more symbols than these
        by = np.argsort(packed)
        at, packed = at[by], packed[by]
        order[places] = at
        done *= 2
        ended = reach[at] < done
        fresh = np.append(True, packed[1:] != packed[:-1]) | ended
        fresh[1:] |= ended[:-1]
        new[places] |= fresh
        rank[at] = places[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
    return order, short, sure


def shared_windows(strings: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffix order of the strings and which neighbours share `least` bytes, by backward extension of the intervals that the
    sort has told apart on its way (28 bytes of 50).

    Returns, in suffix order: number of the string, place in it, and whether its common prefix with the one before is shorter.
    """
    sizes = np.array([len(x) for x in strings], dtype=np.int64)
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    symbols = np.frombuffer(b"\0".join(strings) + b"\0", dtype=np.uint8).astype(np.int16) + 1
    symbols[ends - 1] = 0
    whose = np.repeat(np.arange(len(strings)), sizes + 1)
    n = len(symbols)
    #: short: a common prefix below the step's value has been found
    order, short, sure = suffixes(symbols, ends[whose] - 1 - np.arange(n), least)
    before = symbols[order - 1]  # the transform (of position 0 it is the last end mark)
    column = np.argsort(before, kind="stable")  # place in the order -> place of what it extends
    left = np.flatnonzero(~short)  # places without a value so far
    low, high = column[left - 1], column[left]  # what these and their neighbours extend
    # places in open intervals, and where a place is among them
    kept, where = np.arange(n), np.arange(n, dtype=np.int32)
    for _ in range(sure, least):
        starting = short[kept]
        interval = np.cumsum(starting, dtype=np.int32)  # intervals of strings as long as the step
        now = interval[where[high]] != interval[where[low]]
        if not now.any():
            break  # no interval splits: nor will any later
        if len(left) < len(kept) // 4:
            # an interval of one suffix is closed: what has no value after this step extends others only
            opened = ~starting
            opened[:-1] |= ~starting[1:]
            kept = kept[opened]
            where[kept] = np.arange(len(kept), dtype=np.int32)
        short[left[now]] = True
        left, low, high = left[~now], low[~now], high[~now]
    return whose[order], order - starts[whose[order]], short


def smallest_owners(strings: list[bytes], owners: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest owner of a string that contains it, for each window of each string in turn; and where each string's begin."""
    counts = np.array([max(0, len(x) - least + 1) for x in strings], dtype=np.int64)
    whose, place, short = shared_windows(strings, least)
    bounds = np.flatnonzero(short)
    low = np.minimum.reduceat(owners[whose], bounds)
    value = np.repeat(low, np.diff(np.append(bounds, len(short))))
    first = np.cumsum(counts) - counts
    real = place < counts[whose]
    flat = np.full(counts.sum(), NONE)
    flat[first[whose[real]] + place[real]] = value[real]
    return flat, np.append(first, len(flat))


def distinct(strings: list[bytes], owners: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Which of the distinct strings each is, these, and the smallest owner of each."""
    known: dict[bytes, int] = {}
    which = np.array([known.setdefault(x, len(known)) for x in strings], dtype=np.int64)
    smallest = np.full(len(known), NONE)
    np.minimum.at(smallest, which, owners)
    return which, list(known), smallest


def smallest_in_blocks(strings: list[bytes], owners: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """smallest_owners of strings that are too many for one block: of their windows, equal ones together, up to `most` symbols at a time."""
    first = np.cumsum([0, *(max(0, len(x) - least + 1) for x in strings)])
    flat = np.full(first[-1], NONE)
    low, whose, place, parts = recut(strings, least, least)
    sizes = np.array([len(x) for x in parts], dtype=np.int64)
    order = np.argsort(low)
    for a, b in blocks(low[order], sizes[order], most):
        at = order[a:b]
        which, known, smallest = distinct([parts[i] for i in at.tolist()], owners[whose[at]])
        found, bounds = smallest_owners(known, smallest, least)
        windows = sizes[at] - least + 1
        flat[ranges(first[whose[at]] + place[at], windows)] = found[ranges(bounds[which], windows)]
    return flat, first


def blocks(keys: np.ndarray, sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of sorted keys, whole keys each, of up to `most` symbols where a key has no more."""
    ends = np.append(np.flatnonzero(np.diff(keys)) + 1, len(keys))
    upto = np.cumsum(sizes + 1)[ends - 1] if len(keys) else ends[:0]
    begin, k = 0, 0
    while k < len(ends) and begin < len(keys):
        base = upto[k - 1] if k else 0
        j = max(k, int(np.searchsorted(upto, base + most, side="right")) - 1)
        yield begin, int(ends[j])
        begin, k = int(ends[j]), j + 1


def packed(ascending: np.ndarray) -> bytes:
    """Ascending numbers by their differences, of four bytes where that is enough."""
    steps = np.diff(ascending)
    return ascending[:1].astype("<i8").tobytes() + (steps.astype("<u4") if not len(steps) or steps.max() < 1 << 32 else steps.astype("<i8")).tobytes()


def unpacked(raw: bytes, n: int) -> np.ndarray:
    steps = np.frombuffer(raw, "<i8" if len(raw) == 8 * n else "<u4", offset=8)
    return np.cumsum(np.append(np.frombuffer(raw, "<i8", count=1), steps.astype(np.int64)))


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start, as many as its count."""
    ends = np.cumsum(counts)
    return np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


def by_value(ascending: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each value and where it stands."""
    bounds = [0, *(np.flatnonzero(np.diff(ascending)) + 1).tolist(), len(ascending)]
    for a, b in zip(bounds, bounds[1:], strict=False):
        if b > a:
            yield int(ascending[a]), slice(a, b)


def taken(table: pa.Table, column: str, kind: str) -> np.ndarray:
    """A column of packed numbers, all rows' together."""
    return np.frombuffer(b"".join(table.column(column).to_pylist()), kind)


def matched(table: pa.Table, least: int, block: int) -> pa.Table:
    """Rows of SENT, all that have their keys. Rows of TOLD for those of which another document with a smaller number has some."""
    place, owner, size = taken(table, "places", "<i4"), taken(table, "owners", "<i8"), taken(table, "sizes", "<u4").astype(np.int64)
    number = taken(table, "ids", "<u4")
    counts = [len(x) // 4 for x in table.column("ids").to_pylist()]
    key = np.concatenate([unpacked(x, n) for x, n in zip(table.column("keys").to_pylist(), counts, strict=True)])
    batch = np.repeat(table.column("batch").to_numpy(), counts)
    raw = b"".join(table.column("strings").to_pylist())
    ends = np.cumsum(size)
    order = np.argsort(key, kind="stable")
    found: list[tuple[np.ndarray, np.ndarray, list[bytes]]] = []
    for a, b in blocks(key[order], size[order], block):
        at = order[a:b]
        which, known, owners = distinct([raw[i:j] for i, j in zip((ends[at] - size[at]).tolist(), ends[at].tolist(), strict=True)], owner[at])
        few = sum(map(len, known)) <= 4 * block
        flat, bounds = smallest_owners(known, owners, least) if few else smallest_in_blocks(known, owners, least, block)
        low, high = np.minimum.reduceat(flat, bounds[:-1]), np.maximum.reduceat(flat, bounds[:-1])
        tell = low[which] < owner[at]
        at, which = at[tell], which[tell]
        # one number where it is that of all windows of a whole cut
        n = np.where((low == high)[which] & (place[at] < 0), 1, np.diff(bounds)[which])
        found.append((at, n, [flat[i : i + k].tobytes() for i, k in zip(bounds[which].tolist(), n.tolist(), strict=True)]))
    at, n = (np.concatenate(x) for x in zip(*((x[0], x[1]) for x in found), strict=True))
    values = [v for x in found for v in x[2]]
    order = np.argsort(batch[at], kind="stable")
    rows = []
    for k, s in by_value(batch[at][order]):
        own = order[s]
        rows.append((k, number[at[own]].astype("<u4").tobytes(), place[at[own]].astype("<i4").tobytes(), n[own].astype("<u4").tobytes(), b"".join([values[i] for i in own.tolist()])))
    columns = list(zip(*rows, strict=True)) or [()] * 5
    return pa.table({"batch": pa.array(columns[0], pa.int32())} | {c: pa.array(x, pa.binary()) for c, x in zip(("ids", "places", "counts", "owners"), columns[1:], strict=True)})


# --- the operator -----------------------------------------------------------------------------------------------------------


def remove_repeats(docs: DataFrame, least: int = LEAST, kmer: int = KMER, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes) and spans (removed byte ranges)."""
    if not 16 <= kmer <= 24 or least < kmer:
        raise ValueError("kmer must be from 16 to 24, and least no smaller")
    spark = docs.sparkSession
    hot_cuts, block, spread_cuts = HOT_CUTS, BLOCK_SYMBOLS, HOT_CUTS * SPREAD
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(partitions(spark), -(-total // batch_bytes))
    # minimizers are told apart by so many bits that one in 100,000 or less is taken for another's
    bits = min(63, max(32, int(total).bit_length() + 14))
    # by the text as well: rows without an id, or with one that repeats, are dealt out like others
    dealt = texts.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int"))

    def bucket_of(keys: np.ndarray) -> np.ndarray:
        return (((keys.view(np.uint64) << U(64 - bits)) >> U(32)) * U(n) >> U(32)).astype(np.int32)

    def keys_of(own: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The batch's distinct keys in order; of each, twice the number of cuts and one more if two documents have it; and each content's key."""
        keys, which, kinds = np.unique(own.key, return_inverse=True, return_counts=True)
        first, last = np.full(len(keys), NONE), np.full(len(keys), -1)
        np.minimum.at(first, which, own.lone)
        np.maximum.at(last, which, own.other)
        return keys, np.minimum(kinds, 1 << 29) * 2 + (last > first), which

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        keys, marks, _ = keys_of(Batch(table, bits, least, kmer))
        rows = [(k, key[0].as_py(), packed(keys[s]), marks[s].astype("<u4").tobytes()) for k, s in by_value(bucket_of(keys))]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        return pa.table({"bucket": pa.array(columns[0], pa.int32()), "batch": pa.array(columns[1], pa.int32()), "keys": pa.array(columns[2], pa.binary()), "marks": pa.array(columns[3], pa.binary())})

    def answer(table: pa.Table) -> pa.Table:
        marks = [np.frombuffer(x, "<u4") for x in table.column("marks").to_pylist()]
        keys = np.concatenate([unpacked(x, len(m)) for x, m in zip(table.column("keys").to_pylist(), marks, strict=True)])
        bounds, mark = np.cumsum([0, *map(len, marks)]), np.concatenate(marks).astype(np.int64)
        order = np.argsort(keys)
        at = np.flatnonzero(np.append(True, np.diff(keys[order]) != 0))
        size = np.diff(np.append(at, len(keys)))
        shared, cuts_of = np.empty(len(keys), bool), np.empty(len(keys), np.int64)
        shared[order] = np.repeat((size > 1) | (np.add.reduceat(mark[order] & 1, at) > 0), size)
        cuts_of[order] = np.repeat(np.add.reduceat(mark[order] >> 1, at), size)
        bits_of = lambda x: pa.array([np.packbits(x[a:b]).tobytes() for a, b in zip(bounds, bounds[1:], strict=False)], pa.binary())
        return pa.table({"batch": table.column("batch"), "bucket": table.column("bucket"), "shared": bits_of(shared), "hot": bits_of(cuts_of > hot_cuts), "spread": bits_of(cuts_of > spread_cuts)})

    def send(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        own = Batch(table, bits, least, kmer)
        keys, _, which = keys_of(own)
        said = {x["bucket"]: x for x in answers.to_pylist()}
        shared, hot, spread = (np.zeros(len(keys), bool) for _ in range(3))
        for k, s in by_value(bucket_of(keys)):
            for flags, name in ((shared, "shared"), (hot, "hot"), (spread, "spread")):
                flags[s] = np.unpackbits(np.frombuffer(said[k][name], np.uint8), count=s.stop - s.start)
        whole = np.flatnonzero((shared & ~hot)[which])
        sets = [(bucket_of(own.key[whole]), own.key[whole], whole, np.full(len(whole), -1), own.owner[whole], own.strings(whole, least))]
        for some, longer in ((hot & ~spread, min(2 * kmer, least)), (spread, least)):
            parts = np.flatnonzero((shared & some)[which])
            strings = own.strings(parts, least)
            low, part, places, mine = recut(strings, least, longer)
            names = (low >> U(64 - bits)).astype(np.int64)
            # keys below 0, so that no minimizer's are taken for them
            sets.append((bucket_of(names), -1 - names, parts[part], places, own.owner[parts[part]], mine))
        rows: list[tuple] = []
        for buckets, keys, numbers, places, owners, strings in sets:
            order = np.lexsort((keys, buckets))
            for k, s in by_value(buckets[order]):
                at = order[s]
                mine = [strings[i] for i in at.tolist()]
                rows.append((k, key[0].as_py(), packed(keys[at]), numbers[at].astype("<u4").tobytes(), places[at].astype("<i4").tobytes(), owners[at].astype("<i8").tobytes(), np.array([len(x) for x in mine], "<u4").tobytes(), b"".join(mine)))
        columns = list(zip(*rows, strict=True)) or [()] * 8
        names = [x.split()[0] for x in SENT.split(", ")]
        return pa.table({c: pa.array(x, pa.int32() if c in ("bucket", "batch") else pa.binary()) for c, x in zip(names, columns, strict=True)})

    def each_task(made: Callable[[pa.Table], pa.Table]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """All that a task is given as one table; it is given the rows of one bucket."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [x for x in batches if x.num_rows]
            if held:
                yield from made(pa.Table.from_batches(held)).to_batches()

        return run

    def strip(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        own = Batch(table, bits, least, kmer)
        # of each content the smallest owner of all its windows where that is one, else (parted) its windows' in `each`, from `slot` on
        value = own.owner.copy()
        number, place, count = taken(answers, "ids", "<u4").astype(np.int64), taken(answers, "places", "<i4"), taken(answers, "counts", "<u4").astype(np.int64)
        owners, ends = taken(answers, "owners", "<i8"), np.cumsum(count)
        one = (place < 0) & (count == 1)
        value[number[one]] = owners[ends[one] - 1]
        parted = np.zeros(len(own.example), dtype=bool)
        parted[number[~one]] = True
        lengths = np.where(parted, own.windows[own.example], 0)
        slot = np.cumsum(lengths) - lengths
        each = np.repeat(own.owner, lengths)
        for k in np.split(rest := np.flatnonzero(~one), range(AT_ONCE, len(rest), AT_ONCE)):
            each[ranges(slot[number[k]] + np.maximum(place[k], 0), count[k])] = owners[ranges(ends[k] - count[k], count[k])]
        sizes = np.array([len(x) + 1 for x in own.texts], dtype=np.int64)
        base = np.cumsum(sizes) - sizes
        diff = np.zeros(int(sizes.sum()) + 1, dtype=np.int32)
        me = own.numbers[own.text]
        parted = parted[own.content]
        begin = base[own.text] + own.first
        gone = np.flatnonzero(~parted & (value[own.content] < me))
        np.add.at(diff, begin[gone], 1)
        np.add.at(diff, begin[gone] + own.windows[gone] + least - 1, -1)
        for c in np.split(rest := np.flatnonzero(parted), range(AT_ONCE, len(rest), AT_ONCE)):
            windows = own.windows[c]
            hit = ranges(begin[c], windows)[each[ranges(slot[own.content[c]], windows)] < np.repeat(me[c], windows)]
            np.add.at(diff, hit, 1)
            np.add.at(diff, hit + least, -1)
        covered = np.cumsum(diff, dtype=np.int32) > 0
        out = []
        for text, a in zip(own.texts, base.tolist(), strict=True):
            lost = covered[a : a + len(text)]
            if not lost.any():
                out.append((len(text), 0, 0, hashlib.sha256(text).hexdigest(), text, []))
                continue
            edges = np.flatnonzero(np.diff(lost.view(np.int8), prepend=np.int8(0), append=np.int8(0))).reshape(-1, 2)
            kept = np.frombuffer(text, np.uint8)[~lost].tobytes()
            out.append((len(text), int(lost.sum()), len(edges), hashlib.sha256(kept).hexdigest(), kept, [{"start": x, "end": y} for x, y in edges.tolist()]))
        columns = list(zip(*out, strict=True))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"]
        return pa.table({"doc_id": own.ids} | {c: pa.array(x, t) for c, x, t in zip(names, columns, types, strict=True)})

    by_batch = dealt.groupBy("batch")
    asked = by_batch.applyInArrow(ask, "bucket int, batch int, keys binary, marks binary")
    # one bucket for each task: by hashes some tasks would have several and others none
    answered = asked.repartitionById(n, F.col("bucket")).mapInArrow(each_task(answer), "batch int, bucket int, shared binary, hot binary, spread binary")
    sent = by_batch.cogroup(answered.groupBy("batch")).applyInArrow(send, SENT)
    told = sent.repartitionById(n, F.col("bucket")).mapInArrow(each_task(lambda table: matched(table, least, block)), TOLD)
    return by_batch.cogroup(told.groupBy("batch")).applyInArrow(strip, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary, spans array<struct<start: bigint, end: bigint>>")
