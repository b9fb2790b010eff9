"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

Features of a text are its words and their first 4 to 8 bytes (for languages that inflect), hashed to 2^20 numbers; the value
is log(1 + occurrences per hundred words), so that long texts don't gather more than short ones. The model has one weight for
each feature, shared by all thresholds, and ordered thresholds: P(grade > k) = sigmoid(score - threshold_k). It puts out the
expected severity, the sum of these over k.

It is fitted on at most MAX_TRAIN labelled rows, those with the smallest hash of doc_id. Only features with clear evidence
get a weight (log odds between toxic and other rows by two standard errors above MARGIN). Grades (0, 1, 2) come from the labels
alone, by an expression over their columns: by default 0 for rows that aren't toxic, 1 for toxic rows and 2 for those that are
of low quality (0), too, where labels tell quality. Whole texts are read, in training and application. A document is toxic
if P(grade > 0) is at least 0.5.

Defined cases: null or wordless texts have no features; labels whose grade is null, or of no document, are left out; of repeated
labels of a document the largest grade counts; without labelled toxic rows, or any evidence, every severity is the base rate's;
without rows of grade 2 the second threshold only rises from a rate of 1 in 10,000; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.llm.arrow import BYTE_MIX, PLACE_MIX, U, as_bytes, mix, slices, word_table
from siftworks.llm.common import cut

MAX_TRAIN = 16_000
BITS = 20
PREFIXES = range(4, 9)
MARGIN = 2.0
RIDGE = 3e-5
LETTERS = word_table("abcdefghijklmnopqrstuvwxyz")


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct feature numbers and their values."""
    raw = np.frombuffer(text.lower(), dtype=np.uint8)
    inside = LETTERS[raw]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0)
    letters = raw[inside]
    first = np.cumsum(lengths) - lengths
    coded = BYTE_MIX[letters] * PLACE_MIX[(np.arange(len(letters)) - np.repeat(first, lengths)) & 1023]
    whole, at, often = np.unique(np.add.reduceat(coded, first), return_index=True, return_counts=True)
    first, lengths = first[at], lengths[at]
    upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum(coded)))
    found, counts = [mix(whole)], [often]
    for n in PREFIXES:
        long = lengths >= n
        found.append(mix((upto[first[long] + n] - upto[first[long]]) ^ U(n)))
        counts.append(often[long])
    numbers, which = np.unique(np.concatenate(found) >> U(64 - BITS), return_inverse=True)
    return numbers.astype(np.int64), np.log1p(np.bincount(which, weights=np.concatenate(counts)) * (100 / len(starts)))


@dataclass
class Model:
    """weights: feature number -> weight; thresholds ascend."""

    numbers: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, found: np.ndarray, values: np.ndarray) -> float:
        if not len(self.numbers):
            return 0.0
        at = np.minimum(np.searchsorted(self.numbers, found), len(self.numbers) - 1)
        same = self.numbers[at] == found
        return float((self.weights[at[same]] * values[same]).sum())

    def above(self, score: float) -> np.ndarray:
        return sigmoid(score - self.thresholds)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


@dataclass
class Rows:
    """Labelled rows: grades (0, 1, 2) of n rows, and which of m features are set in which row (rows, columns, values)."""

    rows: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    grades: np.ndarray
    m: int

    def loss(self, p: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
        """Mean negative log likelihood and ridge, and their gradient. p: m weights, the first threshold, and the logarithm of the
        gap to the second."""
        m, n, grades = self.m, len(self.grades), self.grades
        score = np.bincount(self.rows, weights=p[self.columns] * self.values, minlength=n) if len(self.rows) else np.zeros(n)
        gap = np.exp(p[m + 1])
        a, b = sigmoid(score - p[m]), sigmoid(score - p[m] - gap)
        middle = np.maximum(a - b, 1e-12)
        chance = np.where(grades == 0, 1 - a, np.where(grades == 1, middle, b))
        # d(-log chance) by the score through each threshold
        ga = np.where(grades == 0, a, np.where(grades == 1, -a * (1 - a) / middle, 0.0))
        gb = np.where(grades == 2, b - 1, np.where(grades == 1, b * (1 - b) / middle, 0.0))
        slope = np.bincount(self.columns, weights=(ga + gb)[self.rows] * self.values, minlength=m)[:m] if len(self.rows) else np.zeros(m)
        loss = -np.log(np.maximum(chance, 1e-300)).mean() + ridge / 2 * (p[:m] ** 2).sum()
        return float(loss), np.concatenate((slope / n + ridge * p[:m], [-(ga + gb).mean(), -gb.mean() * gap]))


def fit_ordinal(data: Rows, ridge: float = RIDGE, rounds: int = 500) -> tuple[np.ndarray, np.ndarray]:
    """Weights and two thresholds by maximum likelihood with a ridge, by steps along running means of the gradient."""
    rate = np.clip([(data.grades > 0).mean(), (data.grades > 1).mean()], 1e-4, 1 - 1e-4)
    low = -np.log(rate[0] / (1 - rate[0]))
    gap = max(-np.log(rate[1] / (1 - rate[1])) - low, 1e-2)
    m = data.m
    p = np.concatenate((np.zeros(m), [low, np.log(gap)]))
    first, second = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, rounds + 1):
        g = data.loss(p, ridge)[1]
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        p = p - 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return p[:m], np.array([p[m], p[m] + np.exp(p[m + 1])])


def grade_of(labels: DataFrame) -> Column:
    """The grade that labels give: 0 not toxic, 1 toxic, 2 toxic and of low quality."""
    worse = F.coalesce(F.col("quality") == 0, F.lit(False)).cast("int") if "quality" in labels.columns else F.lit(0)
    return F.when(F.col("toxic") > 0, 1 + worse).when(F.col("toxic").isNotNull(), 0)


def train(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAIN, grade: Column | None = None) -> Model:
    """A model from at most `most` labelled rows of docs. grade: an expression over labels, 0 to 2."""
    graded = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), (grade_of(labels) if grade is None else grade).cast("int").alias("grade"))
    marked = graded.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.max("grade").alias("grade"))
    marked = marked.join(docs.select(F.col("doc_id").cast("bigint").alias("doc_id")), "doc_id", "left_semi")  # labels of other documents take no place
    sample = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)  # bounded, so it may be broadcast
    wanted = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")

    rows = cut(wanted.select("text", "grade"))  # bounded by the sample

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, 1 << BITS), dtype=np.int64)
        for batch in slices(batches):
            for text, bad in zip(as_bytes(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                totals[int(bad > 0), features(text)[0]] += 1
        at = np.flatnonzero(totals.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(totals[1, at]), pa.array(totals[0, at])], names=["number", "a", "b"])

    seen = rows.mapInArrow(count, "number bigint, a bigint, b bigint").groupBy("number").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).where("a >= 2").toPandas().sort_values("number")
    p, n = rows.agg(F.count_if(F.col("grade") > 0), F.count(F.lit(1))).first()
    numbers = evident(*(seen[c].to_numpy(np.int64) for c in ("number", "a", "b")), p, n - p)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [chosen(features(x), numbers) for x in as_bytes(batch.column(0))]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([x.tolist() for x, _ in found], pa.list_(pa.int64())), pa.array([x.tolist() for _, x in found], pa.list_(pa.float64()))], names=["grade", "at", "vals"])

    got = sorted((r[0], tuple(r[1]), tuple(r[2])) for r in rows.mapInArrow(pick, "grade int, at array<bigint>, vals array<double>").collect())
    return fit(numbers, [np.array(r[1], np.int64) for r in got], [np.array(r[2]) for r in got], np.array([r[0] for r in got], dtype=np.int64))


def evident(numbers: np.ndarray, a: np.ndarray, b: np.ndarray, p: int, q: int) -> np.ndarray:
    """Features whose log odds between p toxic and q other rows (a and b of which have them) are clearly above the margin."""
    odds = np.log((a + 0.5) / (p - a + 0.5)) - np.log((b + 0.5) / (q - b + 0.5))
    return numbers[odds - 2 * np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)) > MARGIN]


def chosen(found: tuple[np.ndarray, np.ndarray], numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in numbers of the features that are among them, and their values."""
    at = np.flatnonzero(np.isin(found[0], numbers, assume_unique=True))
    return np.searchsorted(numbers, found[0][at]), found[1][at]


def fit(numbers: np.ndarray, found: list[np.ndarray], values: list[np.ndarray], grades: np.ndarray) -> Model:
    """found: of each row the places in numbers of its features."""
    if not found:
        return Model(np.empty(0, np.int64), np.empty(0), np.array([0.0, 1.0]))
    rows = np.repeat(np.arange(len(found)), [len(x) for x in found])
    weights, thresholds = fit_ordinal(Rows(rows, np.concatenate(found).astype(np.int64), np.concatenate(values), grades, len(numbers)))
    return Model(numbers, weights, thresholds)


def grade(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, severity (expected grade, six places), grade (the largest that is at least even) and toxic."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded by 2^20 weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            above = [held.value.above(held.value.score(*features(x))) for x in as_bytes(batch.column(1))]
            grades = [int((x >= 0.5).sum()) for x in above]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([round(float(x.sum()), 6) for x in above], pa.float64()), pa.array(grades, pa.int32()), pa.array([x > 0 for x in grades])], names=["doc_id", "severity", "grade", "toxic"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {id_type}, severity double, grade int, toxic boolean")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs that the model doesn't call toxic, with all their columns."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    at, names = docs.columns.index("text"), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keep = [held.value.score(*features(x)) < held.value.thresholds[0] for x in as_bytes(batch.column(at))]
            yield pa.RecordBatch.from_arrays(batch.columns, names=names).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
