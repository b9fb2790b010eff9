"""Vectors as whole numbers in columnar blocks, for the operators that compare them exactly.

A block holds some thousand vectors as one array of int32 by dimension, so that a task goes through them dimension by dimension.
Blocks are made where the rows are read: nothing is moved by a key, so vectors alike never meet in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.llm.arrow import slices
from siftworks.llm.common import cut, partitions

BLOCK = 1024


def finite(vector: Column) -> Column:
    """True where a vector is there and none of its components is null, NaN or infinite."""
    x = vector.cast("array<double>")
    return F.coalesce(vector.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))), F.lit(False))


def whole(values: np.ndarray, scale: int, dims: int) -> np.ndarray:
    """floor(scale * x) of each component. Beyond what squared distances can hold in 64 bits it is an error."""
    found = np.floor(values.astype(np.float64) * scale)
    most = int(np.sqrt(2.0**63 / (4 * max(dims, 1)))) - 1
    if len(found) and np.abs(found).max() > min(most, 2**31 - 1):
        raise ValueError(f"a component of {np.abs(values).max()} is too large: squared distances over {dims} components wouldn't fit into 64 bits")
    return found.astype(np.int32)


def spread(rows: DataFrame) -> DataFrame:
    """rows in as many tasks as a shuffle has at least: small files (of long computations) would leave most cores idle."""
    n = partitions(rows.sparkSession)
    return rows if rows.rdd.getNumPartitions() >= n else rows.repartition(n)


def blocks(rows: DataFrame, vector: str, dims: int, scale: int, keep: list[str], more: tuple[str, Callable[[np.ndarray], np.ndarray]] | None = None) -> DataFrame:
    """rows (whose vectors are finite and have dims components) as checkpointed blocks.

    Columns: each of keep as an array, n, ints (int32 by dimension) and, if more is given, a column of that name with the bytes of
    what its function makes of the whole numbers (dims x n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BLOCK):
            if not batch.num_rows:
                continue
            column = batch.column(len(keep))
            ints = whole(column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dims), scale, dims).T
            offsets = pa.array([0, batch.num_rows], pa.int32())
            out = [pa.ListArray.from_arrays(offsets, batch.column(k)) for k in range(len(keep))]
            out += [pa.array([batch.num_rows], pa.int32()), pa.array([np.ascontiguousarray(ints).tobytes()], pa.binary())]
            if more:
                out.append(pa.array([np.ascontiguousarray(more[1](ints.astype(np.int64))).tobytes()], pa.binary()))
            yield pa.RecordBatch.from_arrays(out, names=names)

    names = [*keep, "n", "ints", *([more[0]] if more else [])]
    kinds = [f"`{c}` array<{rows.schema[c].dataType.simpleString()}>" for c in keep]
    schema = ", ".join([*kinds, "n int", "ints binary", *([f"{more[0]} binary"] if more else [])])
    return cut(spread(rows.select(*keep, vector)).mapInArrow(run, schema))


def ints_of(raw: bytes, dims: int) -> np.ndarray:
    """The whole numbers of a block: dims x n."""
    return np.frombuffer(raw, dtype=np.int32).reshape(dims, -1).astype(np.int64)


def joined(numbers: np.ndarray) -> str:
    return ",".join(map(str, numbers.ravel().tolist()))
