"""Near-duplicates by SimHash: fingerprints at a Hamming distance of 3 or less are linked.

Fingerprints: 64 bits, each set if over half the shingles' XXH64 (seed 42) have it. Equal fingerprints are one point from then
on. A point's coordinates are the bit counts (0, 1, 2) of its 32 segments of two bits. The Manhattan distance of two points is
never above the Hamming distance of their fingerprints, so links are found by a range join on the grid of the coordinates:

1. Of two points within 3, one half of the coordinates is within 1. So each point resides in its cell of either half's grid and
   visits the cells that are one step up along one axis; of a pair within 1 in a half, one resides where the other resides or
   visits. A cell holds points by the sum of the coordinates that are left (the free ones).
2. Within a cell a window slides over that sum: points further apart than 3 there are never looked at. The Manhattan distance
   over all coordinates sorts out most others, then the Hamming distance decides.
3. Cells above a number of points are dealt out again before they reach a task, in the same way by halves of their free
   coordinates, until they are small or no coordinates are left.

A cell yields links that connect what is near, never all pairs; they join to components by stars.

Defined cases: a null or wordless text has fingerprint 0, linked like any other; a null doc_id gets a fingerprint and a
component but never names one unless its whole component is null; repeated rows are alike; an empty table gives no rows; other
columns, whatever their names, are ignored (one_of_each() hands all of them on).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftworks.llm.arrow import U, as_bytes, mix, slices
from siftworks.llm.common import bounded, cut, forget, join_groups, partitions, scratch
from siftworks.llm.components import components

DISTANCE = 3
AXES = 32
HOT_CELL = 20_000
LOW = U(0x5555555555555555)


def shingle_hashes(text: bytes, width: int = 3) -> list[int]:
    """XXH64 (seed 42) of each shingle; fewer words than width are one, none are none."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return []
    joined, n = b" ".join(words), max(1, len(words) - width + 1)
    if n == 1:
        return [xxh64_intdigest(joined, 42)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    return [xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)]


def fingerprint(text: bytes, width: int = 3) -> int:
    return majority(shingle_hashes(text, width))


def majority(hashes: list[int]) -> int:
    """The bits that over half the hashes have."""
    n = len(hashes)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 8192):
        bits = np.unpackbits(np.array(hashes[at : at + 8192], dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([fingerprint(x, width) for x in as_bytes(batch.column(1))], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id bigint, fp bigint")


# --- the grid -------------------------------------------------------------------------------------------------------------


def embed(fp: np.ndarray) -> np.ndarray:
    """The coordinates, two bits each: of a count of 1 the low bit is set, of 2 both. So the Manhattan distance of two points is
    the number of bits in which they differ, and the sum of coordinates the number of bits set."""
    half = fp >> U(1)
    return ((fp | half) & LOW) | (((fp & half) & LOW) << U(1))


def cells_of(codes: np.ndarray, at: int, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Cells of the grid over the n axes from bit `at` on: which points, their cells, and 0 for residents or 1 for visitors."""
    own = codes & U(((1 << 2 * n) - 1) << at)
    yield np.arange(len(codes)), own, 0
    for axis in range(at, at + 2 * n, 2):
        low, high = (codes >> U(axis)) & U(1), (codes >> U(axis + 1)) & U(1)
        up = np.flatnonzero(high == 0)
        yield up, own[up] | ((low[up] + U(1)) << U(axis)), 1


def deal(rows: DataFrame) -> DataFrame:
    """rows: cell, at, free (the axes from bit `at` on that the cell leaves free), role, level and fp. Their cells by either
    half of the free axes, and far, the sum of the coordinates that are free then. role has a bit for each level's visitors."""
    names = ["cell", "at", "free", "far", "role", "level", "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            cell, at, free, role, level, fp = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "at", "free", "role", "level", "fp"))
            out = []
            for first, axes in sorted(set(zip(at.tolist(), free.tolist(), strict=True))):
                own = np.flatnonzero((at == first) & (free == axes))
                codes, half = embed(fp[own].astype(np.int64).view(np.uint64)), axes // 2
                for mine, other in ((first, first + 2 * half), (first + 2 * half, first)):
                    far = np.bitwise_count(codes & U(((1 << 2 * half) - 1) << other))
                    for which, keys, visits in cells_of(codes, mine, half):
                        w = own[which]
                        # cells are told apart by hashes; two that share one only bring more pairs together
                        name = mix(mix(cell[w].astype(np.int64).view(np.uint64) + U(mine + 1)) ^ keys)
                        out.append((name.view(np.int64), np.full(len(w), other, np.int32), np.full(len(w), half, np.int32), far[which].astype(np.int32), role[w] | (visits << level[w]), level[w] + 1, fp[w]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=names)

    return rows.select("cell", "at", "free", "role", "level", "fp").mapInArrow(run, "cell bigint, at int, free int, far int, role int, level int, fp bigint")


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each the number of a row of its group) after the groups of a and b are joined."""
    while True:
        x, y = label[a], label[b]
        if np.array_equal(x, y):
            return label
        low = np.minimum(x, y)
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        while not np.array_equal(label, label[label]):
            label = label[label]


def window_links(cell: np.ndarray, far: np.ndarray, role: np.ndarray, fp: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows sorted by cell and far. Links (pairs of arrays) that connect what is near within each cell."""
    n, codes = len(fp), embed(fp)
    label, out = np.arange(n), []
    i, step = np.arange(n - 1), 1
    while len(i):
        j = i + step
        inside = (cell[i] == cell[j]) & (far[j] - far[i] <= DISTANCE)
        i, j = i[inside], j[inside]  # the window of what fell out has ended
        pair = ((role[i] & role[j]) == 0) & (label[i] != label[j])
        a, b = i[pair], j[pair]
        for x in (codes, fp):  # the lower bound, then the distance itself
            near = np.bitwise_count(x[a] ^ x[b]) <= DISTANCE
            a, b = a[near], b[near]
        if len(a):
            out.append((fp[a], fp[b]))
            label = join_labels(label, a, b)
        step += 1
        i = i[i + step < n]
    return out


def links_in_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, far, role, fp) sorted by cell and far; a cell's points may run over batches."""
    held: list[np.ndarray] = []

    def links(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for a, b in window_links(*columns):
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        columns[3] = columns[3].astype(np.int64).view(np.uint64)
        held = [np.concatenate(x) for x in zip(held, columns, strict=True)] if held else columns
        changes = np.flatnonzero(np.diff(held[0]) != 0)
        if len(changes):
            end = changes[-1] + 1
            yield from links([c[:end] for c in held])
            held = [c[end:] for c in held]
    if held:
        yield from links(held)


def near_links(points: DataFrame) -> DataFrame:
    """points: distinct fp. Links a, b that connect whatever is within the distance."""
    whole = [F.lit(0).cast("bigint").alias("cell"), *(F.lit(x).alias(c) for c, x in (("at", 0), ("free", AXES), ("role", 0), ("level", 0)))]
    cells, ready = deal(points.select(*whole, "fp")), []
    while True:
        hot = cut(cells.groupBy("cell").count().where(F.col("count") > HOT_CELL).select("cell"))
        if hot.isEmpty():
            ready.append(cells)
            break
        ready.append(cells.join(bounded(hot), "cell", "left_anti"))
        over = cells.join(bounded(hot), "cell", "left_semi")
        ready.append(over.where("free < 2"))
        cells = cut(deal(over.where("free >= 2")))
    found = ready[0]
    for more in ready[1:]:
        found = found.unionByName(more.select(found.columns))
    dealt = found.select("cell", "far", "role", "fp").repartition(partitions(points.sparkSession), "cell").sortWithinPartitions("cell", "far")
    return dealt.mapInArrow(links_in_cells, "a bigint, b bigint")


def near_dedup(docs: DataFrame, width: int = 3) -> DataFrame:
    """Per document: doc_id, fp, component_id (the smallest doc_id that can be reached, itself included)."""
    prints = cut(fingerprints(docs, width))
    points = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("rows")))
    roots = components(near_links(points.select("fp")))
    of_point = cut(points.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    named = cut(of_point.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("points")))
    classes = cut(join_groups(of_point, named, "root", "points").select("fp", "component_id", "rows"))
    return join_groups(prints, classes, "fp", "rows").select("doc_id", "fp", "component_id")


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --- by similarity ---------------------------------------------------------------------------------------------------------
#
# At a similarity of 0.8 fingerprints of 64 bits differ in about ten, so links within three bits find few such pairs. The
# pipeline's stage therefore adds links by an exact join over sets of shingles. In any one order of all shingles, two sets that
# are similar share one among the first n - ceil(0.8 n) + 1 of each (n: its size; its prefix), and where the first that they
# share stands, and how many of the prefixes they share, bounds what they can have in common. The order is by the shingles'
# hashes, with those that are common in a sample of the documents last: the sample decides how many candidates there are, never
# which pairs are found.

SIMILARITY = 0.8
#: One text in SAMPLE is looked through for shingles that COMMON of them have at least; not more than LISTED are told apart.
SAMPLE, COMMON, LISTED = 16, 4, 1 << 20
#: Shingles that so many texts of the sample have are hot: their rows are aggregated before they are shuffled. A hot one's rows, and
#: the pairs of one row, are dealt out in parts of so many.
HOT_TOKEN, PART = 1024, 1 << 14
SLACK = 1e-9
Common = tuple[np.ndarray, np.ndarray]
NONE: Common = (np.empty(0, np.uint64), np.empty(0, np.int64))


def ranks(hashes: np.ndarray, common: Common) -> np.ndarray:
    """How often the sample has each (0: it isn't common): the first key of the order, before the hash."""
    keys, often = common
    if not len(keys) or not len(hashes):
        return np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    return np.where(keys[at] == hashes, often[at], 0)


def prefix_of(hashes: np.ndarray, common: Common = NONE, similarity: float = SIMILARITY) -> np.ndarray:
    """The first shingles in the order. hashes: sorted, distinct."""
    n = len(hashes)
    return hashes[np.argsort(ranks(hashes, common), kind="stable")[: n - int(np.ceil(similarity * n - SLACK)) + 1]] if n else hashes


def most_shared(x: np.ndarray, n: int, y: np.ndarray, m: int, common: Common = NONE) -> int:
    """What sets of n and m shingles with prefixes x and y have in common at most.

    Up to the end of the prefix that ends first both are known; of what comes behind, the shorter rest may be shared."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    p, q = ranks(x, common), ranks(y, common)
    if (p[-1], x[-1]) > (q[-1], y[-1]):
        x, n, y, m, p, q = y, m, x, n, q, p
    known = int(((q < p[-1]) | ((q == p[-1]) & (y <= x[-1]))).sum())
    return both + min(n - len(x), m - known)


def needed(n: int, m: int, similarity: float) -> float:
    """What sets of n and m have in common at this similarity."""
    return (n + m) * (similarity / (1 + similarity)) - SLACK


def common_shingles(docs: DataFrame, width: int) -> Common:
    """Sorted hashes of shingles that are common in a sample of the texts, and how often each stands there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [np.unique(np.array(shingle_hashes(x, width), dtype=np.uint64)) for x in as_bytes(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["hash"])

    texts = docs.select(F.col("text").cast("string").alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0)
    counts = cut(texts.mapInArrow(run, "hash bigint").groupBy("hash").agg(F.count(F.lit(1)).cast("int").alias("n")).where(F.col("n") >= COMMON))
    least = COMMON
    while counts.where(F.col("n") >= least).count() > LISTED:
        least *= 2
    found = counts.where(F.col("n") >= least).toArrow()
    keys, often = found.column("hash").to_numpy().astype(np.int64).view(np.uint64), found.column("n").to_numpy().astype(np.int64)
    order = np.argsort(keys)
    return keys[order], often[order]


def digest_of(hashes: np.ndarray) -> bytes:
    """A set of shingles as 16 bytes. hashes: sorted, distinct."""
    return hashlib.blake2b(hashes.astype("<u8").tobytes(), digest_size=16).digest()


def prefixes(docs: DataFrame, width: int, similarity: float, common: Broadcast) -> DataFrame:
    """doc_id, fp, digest (of the set of shingles), n (their number) and prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [np.array(shingle_hashes(x, width), dtype=np.uint64) for x in as_bytes(batch.column(1))]
            prints = np.array([majority(x) for x in found], dtype=np.uint64).view(np.int64)
            found = [np.unique(x) for x in found]
            columns = [batch.column(0), pa.array(prints), pa.array([digest_of(x) for x in found], pa.binary()), pa.array([len(x) for x in found], pa.int32()), pa.array([prefix_of(x, common.value, similarity).view(np.int64) for x in found], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "fp", "digest", "n", "prefix"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, fp bigint, digest binary, n int, prefix array<bigint>")


def fits(n: Column, at: Column, other_n: Column, other_at: Column, similarity: float) -> Column:
    """Whether sets that first agree at these places can be similar: the shingle and the shorter rest are all they may share."""
    return 1 + F.least(n - 1 - at, other_n - 1 - other_at) >= (n + other_n) * (similarity / (1 + similarity)) - SLACK


def of_pairs(pairs: DataFrame) -> DataFrame:
    """The distinct rows (numbers) that pairs a, b name."""
    return cut(pairs.select(F.col("a").alias("row")).union(pairs.select("b")).distinct())


def meet(pairs: DataFrame, held: DataFrame, key: str) -> DataFrame:
    """pairs with what held has of the rows that key names. A row that more than PART pairs name goes to several tasks, a part of
    its pairs to each."""
    many = cut(pairs.groupBy(key).agg(F.count(F.lit(1)).alias("parts")).where(F.col("parts") > PART))
    if many.isEmpty():
        return pairs.join(held, key)
    many = bounded(many.withColumn("parts", F.ceil(F.col("parts") / PART).cast("int")))
    parts = F.coalesce("parts", F.lit(1))
    other = "b" if key == "a" else "a"
    dealt = pairs.join(many, key, "left").withColumn("part", F.pmod(F.xxhash64(other), parts).cast("int")).drop("parts")
    copied = held.join(many, key, "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    return dealt.join(copied, [key, "part"]).drop("part")


def possible(pairs: DataFrame, sets: DataFrame, similarity: float, common: Broadcast) -> DataFrame:
    """Those of the pairs a, b that can be similar by their whole prefixes. sets: row, n, prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keep = []
            for n, x, m, y in zip(batch.column(2).to_pylist(), batch.column(3), batch.column(4).to_pylist(), batch.column(5), strict=True):
                x, y = (v.values.to_numpy().view(np.uint64) for v in (x, y))
                keep.append(most_shared(x, n, y, m, common.value) >= needed(n, m, similarity))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    held = sets.join(bounded(of_pairs(pairs)), "row", "left_semi").select("row", "n", "prefix")
    both = meet(meet(pairs, held.toDF("b", "m", "of_b"), "b"), held.toDF("a", "n", "of_a"), "a")
    return cut(both.select("a", "b", "n", "of_a", "m", "of_b").mapInArrow(run, "a bigint, b bigint"))


def similar_pairs(docs: DataFrame, sets: DataFrame, pairs: DataFrame, width: int, similarity: float, common: Broadcast) -> DataFrame:
    """Those of the pairs a, b (numbers of rows of sets) that are similar, each set of shingles made once."""
    pairs = possible(pairs, sets, similarity, common)
    wanted = cut(sets.join(bounded(of_pairs(pairs)), "row", "left_semi").select("row", "doc_id", "digest"))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # rows may repeat a doc_id, with the same text or another
    texts = texts.join(bounded(wanted), "doc_id").select("row", "digest", "text").dropDuplicates()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [np.unique(np.array(shingle_hashes(x, width), dtype=np.uint64)) for x in as_bytes(batch.column(2))]
            own = pa.array([digest_of(x) == k for x, k in zip(found, batch.column(1).to_pylist(), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64()))], names=["row", "hashes"]).filter(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= needed(len(x), len(y), similarity))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    found = texts.mapInArrow(made, "row bigint, hashes array<bigint>")
    both = meet(meet(pairs, found.toDF("b", "of_b"), "b"), found.toDF("a", "of_a"), "a")
    return cut(both.select("a", "b", "of_a", "of_b").mapInArrow(run, "a bigint, b bigint").distinct())


def hot_tokens(spark: SparkSession, common: Common) -> DataFrame | None:
    """token: the shingles that HOT_TOKEN texts of the sample have, LISTED at most."""
    keys = common[0][common[1] >= HOT_TOKEN]
    return spark.createDataFrame(pa.table({"token": keys.view(np.int64)})) if len(keys) else None


def over_tokens(rows: DataFrame, hot: DataFrame | None, columns: dict[str, Column], of_hot: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """rows (with token) and, as columns, aggregates over all rows with the same token.

    Rows of a hot token never meet in one task: of_hot aggregates them (by default as columns says), and the result, a row for
    each hot token, is brought to them."""
    same = Window.partitionBy("token")
    cold = rows if hot is None else rows.join(F.broadcast(hot), "token", "left_anti")
    cold = cold.withColumns({name: x.over(same) for name, x in columns.items()})
    if hot is None:
        return cold
    own = rows.join(F.broadcast(hot), "token", "left_semi")
    found = of_hot(own) if of_hot else own.groupBy("token").agg(*(x.alias(name) for name, x in columns.items()))
    return cold.unionByName(own.join(F.broadcast(found), "token"))


def roots_of_hot(rows: DataFrame) -> DataFrame:
    """For each token the smallest, the largest and the most frequent root. Counts by root come first, so none is gathered."""
    counts = rows.groupBy("token", "root").agg(F.count(F.lit(1)).alias("rows"))
    return counts.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max_by("root", "rows").alias("most"))


def pairs_apart(mixed: DataFrame, similarity: float) -> DataFrame:
    """a, b: rows that share a token, may be similar by it, and have other roots. mixed: token, row, root, n, at, most, many.

    Of each token the rows outside its most frequent root are held against all; rows within that aren't held against each other.
    So a large group and a few others cost few times the group. All rows are dealt out in parts, the few go to each part."""
    parts = F.ceil(F.col("many") / PART).cast("int")
    every = mixed.select("token", F.pmod(F.xxhash64("row"), parts).cast("int").alias("part"), F.col("row").alias("b"), F.col("root").alias("other"), F.col("n").alias("m"), F.col("at").alias("bt"))
    few = mixed.where("root <> most").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    once = (F.col("root") != F.col("other")) & ((F.col("other") == F.col("most")) | (F.col("row") < F.col("b")))
    met = few.join(every, ["token", "part"]).where(once & fits(F.col("n"), F.col("at"), F.col("m"), F.col("bt"), similarity))
    return met.select(F.least("row", "b").alias("a"), F.greatest("row", "b").alias("b")).distinct()


def similar_links(docs: DataFrame, sets: DataFrame, near: DataFrame, width: int, similarity: float, common: Broadcast) -> DataFrame:
    """a, b: links that, with near, connect all sets (row, doc_id, digest, n, prefix) that are similar.

    First each is compared with one head of each shingle it shares: that whose own shingles are shared most, as the base of many
    variants is. Then any two that share one and are not connected yet are compared, so none is left out; groups of copies
    are connected by then and make no pairs."""
    hot = hot_tokens(docs.sparkSession, common.value)
    tokens = sets.select("row", "n", F.posexplode("prefix").alias("at", "token"))
    tokens = cut(over_tokens(tokens, hot, {"many": F.count(F.lit(1))}).where("many > 1"))
    weights = tokens.groupBy("row").agg(F.sum("many").alias("weight"))
    heads = over_tokens(tokens.join(weights, "row"), hot, {"head": F.max(F.struct("weight", "row", "n", "at"))})
    heads = heads.where((F.col("head.row") != F.col("row")) & fits(F.col("n"), F.col("at"), F.col("head.n"), F.col("head.at"), similarity))
    first = cut(heads.select(F.least("head.row", "row").alias("a"), F.greatest("head.row", "row").alias("b")).distinct())
    links = similar_pairs(docs, sets, first, width, similarity, common)
    roots = components(near.union(links)).withColumnRenamed("node", "row")
    rooted = tokens.join(roots, "row", "left").withColumn("root", F.coalesce("root", "row"))
    mixed = over_tokens(rooted, hot, {"low": F.min("root"), "high": F.max("root"), "most": F.mode("root")}, roots_of_hot)
    mixed = cut(mixed.where("low <> high").select("token", "row", "root", "n", "at", "most", "many"))
    rest = cut(pairs_apart(mixed, similarity).join(first, ["a", "b"], "left_anti"))
    return links.union(similar_pairs(docs, sets, rest, width, similarity, common))


def one_of_each(docs: DataFrame, width: int = 5, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs that name their group, with all their columns: one document of each group, the smallest doc_id.

    A group holds what is linked by fingerprints within the distance, or by a share of common shingles of at least similarity.
    Rows without a doc_id have no name to be dropped by and stay; so do rows that repeat the doc_id of a document that stays.
    """
    spark = docs.sparkSession
    common = spark.sparkContext.broadcast(common_shingles(docs, width))  # bounded by LISTED
    path = scratch(spark, "prefixes")
    prefixes(docs, width, similarity, common).withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    named = spark.read.parquet(path).where("doc_id is not null")
    # rows with equal sets of shingles are one: that with the smallest number; of each fingerprint one stands for the others
    kinds = cut(named.groupBy("digest").agg(F.min("row").alias("node"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows")))
    twins = join_groups(named.select("row", "digest"), kinds.where("rows > 1"), "digest", "rows").where("row <> node").select("row")
    sets = named.join(bounded(cut(twins)), "row", "left_anti")
    prints = cut(named.select("digest", "fp").distinct().join(kinds, "digest").select("fp", "node"))
    points = cut(prints.groupBy("fp").agg(F.min("node").alias("first")))
    roots = components(near_links(points.select("fp")))
    of_point = points.join(roots.withColumnRenamed("node", "fp"), "fp").select("first", F.col("root").alias("fp"))
    near = of_point.join(points.withColumnRenamed("first", "other"), "fp").select(F.col("first").alias("a"), F.col("other").alias("b"))
    equal = prints.join(points, "fp").select(F.col("node").alias("a"), F.col("first").alias("b"))
    near = cut(near.union(equal).where("a <> b"))
    groups = components(near.union(similar_links(docs, sets, near, width, similarity, common)))
    rooted = cut(kinds.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node")))
    keep = cut(rooted.groupBy("root").agg(F.min("least").alias("keep"), F.count(F.lit(1)).alias("nodes")))
    kept = cut(join_groups(rooted, keep, "root", "nodes").select("digest", "keep", "rows"))
    gone = cut(join_groups(named.select("doc_id", "digest"), kept, "digest", "rows").where("doc_id <> keep").select("doc_id").distinct())
    forget(spark, path)
    return docs.join(bounded(gone), "doc_id", "left_anti")
