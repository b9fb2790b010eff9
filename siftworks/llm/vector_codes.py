"""Vector compression: each part of a vector becomes the number of its nearest codebook entry (product quantization).

Components become whole numbers, floor(scale * x), and vectors are cut into equal consecutive parts. Each part position has a
codebook of up to 256 entries, which starts as that part of the vectors with the smallest ids. Rounds assign every part to its
nearest entry (squared Euclidean distance, exact, ties to the lower number) and replace each entry by the floor of its parts'
mean; unused entries stay. Then parts are assigned once more.

Vectors lie in columnar blocks in the shared folder (see vectors), which every round reads once. Distances of a block accumulate
dimension by dimension. Sums and counts of a task's blocks are int64 tensors filled by np.add.at; an RDD's treeAggregate merges
them, so neither a task nor the driver gets more than about the square root of their number. The codebook (256 entries at most) is
broadcast each round. A lost executor's tasks read their blocks again.

Defined cases: vectors that are null, empty or hold null or non-finite components are dropped, and so are those whose length isn't
the commonest one among the rest of which the parts are a divisor (of equally common lengths the smaller counts). Rows without an
id stand last among the starting entries; of equal ids the smaller vector comes first; repeated rows count each for itself. With
fewer vectors than entries the codebook is that short. An empty table gives no rows. A component so large that squared distances
don't fit into 64 bits is an error. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.llm.common import cut, join_groups
from siftworks.llm.vectors import blocks, finite, ints_of, joined, whole

Tensors = tuple[np.ndarray, np.ndarray]


def nearest(ints: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ints: dims x n; book: parts x entries x width. The numbers of the nearest entries and their squared distances: parts x n."""
    parts, entries, width = book.shape
    codes, far = np.empty((parts, ints.shape[1]), np.int64), np.empty((parts, ints.shape[1]), np.int64)
    for p in range(parts):
        total = np.zeros((ints.shape[1], entries), np.int64)
        for j in range(width):
            apart = ints[p * width + j][:, None] - book[p, :, j][None, :]
            apart *= apart
            total += apart
        codes[p] = total.argmin(axis=1)
        far[p] = total[np.arange(len(total)), codes[p]]
    return codes, far


def added(total: Tensors | None, ints: np.ndarray, book: np.ndarray) -> Tensors:
    """total with the sums and counts of a block's parts by entry."""
    parts, entries, width = book.shape
    sums, counts = total if total is not None else (np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64))
    codes, _ = nearest(ints, book)
    for p in range(parts):
        np.add.at(counts[p], codes[p], 1)
        np.add.at(sums[p], codes[p], ints[p * width : (p + 1) * width].T)
    return sums, counts


def merged(a: Tensors | None, b: Tensors | None) -> Tensors | None:
    if a is None or b is None:
        return b if a is None else a
    return a[0] + b[0], a[1] + b[1]


def moved(book: np.ndarray, total: Tensors | None) -> np.ndarray:
    """The codebook with each used entry at the floor of its parts' mean."""
    if total is None:
        return book
    sums, counts = total
    return np.where(counts[..., None] > 0, sums // np.maximum(counts, 1)[..., None], book)


def usual_length(kept: DataFrame, vector: str, parts: int) -> int:
    """The commonest length that parts divide, or 0 if there is none."""
    size = F.size(vector)
    found = kept.where((size > 0) & (size % parts == 0)).groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").first()
    return found[0] if found else 0


def train(held: DataFrame, book: np.ndarray, rounds: int, depth: int = 2) -> np.ndarray:
    """The codebook after the rounds. held: blocks."""
    parts, _, width = book.shape
    rdd, context = held.select("ints").rdd.map(lambda r: bytes(r[0])), held.sparkSession.sparkContext
    for _ in range(rounds):
        now = context.broadcast(book)
        total = rdd.treeAggregate(None, lambda t, raw, now=now: added(t, ints_of(raw, parts * width), now.value), merged, depth)
        book = moved(book, total)
        now.unpersist()
    return book


def compress(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> tuple[DataFrame, np.ndarray]:
    """Per vector: its id, label, codes (an array of numbers by part), error (squared distance over all parts) and label_error (summed
    over equal labels, nulls together); and the codebook, parts x entries x width."""
    rows = df.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"), F.col(label).alias("label")).where(finite(F.col("vector")))
    dims = usual_length(rows, "vector", parts)
    rows = rows.where(F.size("vector") == dims) if dims else rows.limit(0)
    first = [r[0] for r in rows.orderBy(F.asc_nulls_last("vec_id"), "vector").select("vector").limit(entries).collect()]
    width = dims // parts
    book = whole(np.array(first, np.float64).reshape(len(first), dims), scale, dims).astype(np.int64).reshape(len(first), parts, width).transpose(1, 0, 2)
    if not len(first):
        return rows.select("vec_id", "label", F.array().cast("array<int>").alias("codes"), F.lit(0).cast("bigint").alias("error"), F.lit(0).cast("bigint").alias("label_error")), book
    held = blocks(rows, "vector", dims, scale, ["vec_id", "label"])
    book = train(held, book, rounds)
    last = df.sparkSession.sparkContext.broadcast(book)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                codes, far = nearest(ints_of(batch.column(2)[k].as_py(), dims), last.value)
                offsets = pa.array(np.arange(0, codes.size + 1, parts), pa.int32())
                out = [batch.column(0)[k].values, batch.column(1)[k].values, pa.ListArray.from_arrays(offsets, pa.array(codes.T.ravel(), pa.int32())), pa.array(far.sum(axis=0))]
                yield pa.RecordBatch.from_arrays(out, names=["vec_id", "label", "codes", "error"])

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    found = held.select("vec_id", "label", "ints").mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, codes array<int>, error bigint")
    found = cut(found.withColumn("__key", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("null"))))
    sums = cut(found.groupBy("__key").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("__rows")))
    return join_groups(found, sums, "__key", "__rows").select("vec_id", "label", "codes", "error", "label_error"), book


def restore(codes: DataFrame, book: np.ndarray, scale: int = 1024) -> DataFrame:
    """codes with a column vector: the codebook's entries, as components again (each at its floor)."""
    listed = F.array(*[F.array(*[F.array(*[F.lit(float(x) / scale) for x in entry]) for entry in part]) for part in book])
    return codes.withColumn("vector", F.flatten(F.transform("codes", lambda code, place: F.get(F.get(listed, place), code))))


def sha256_of(book: np.ndarray) -> str:
    """Of all components by part, entry and position, as decimal numbers joined by commas."""
    return hashlib.sha256(joined(book).encode()).hexdigest()
