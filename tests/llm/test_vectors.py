"""Vector compression and clustering against plain loops over Python's integers."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftworks.llm import centroids, vector_codes, vectors

SCHEMA = "vec_id long, embedding array<float>, label int"
rng = random.Random(5)


def vector(dims, spread=1.0):
    return [float(np.float32(rng.gauss(0, spread))) for _ in range(dims)]


def table(dims):
    hot = vector(dims)
    rows = [(i, vector(dims), rng.choice([None, 1, 2, 3])) for i in range(60)]
    rows += [(100 + i, hot, 2) for i in range(40)] + [(100, hot, None), (None, vector(dims), 3), (None, hot, 1), (7, vector(dims), 1)]
    rows += [(200, None, 1), (201, [None] * dims, 1), (202, [math.nan] * dims, 1), (203, [*vector(dims - 1), math.inf], None), (204, [*vector(dims - 1), -math.inf], None), (205, vector(dims + 1), 1), (206, [], 1), (207, vector(dims // 2), 1)]
    rng.shuffle(rows)
    return rows


def kept(rows, dims):
    return [r for r in rows if r[1] is not None and len(r[1]) == dims and all(x is not None and math.isfinite(x) for x in r[1])]


def distance(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def moved(points, entries, which):
    for e in range(len(entries)):
        own = [p for p, w in zip(points, which, strict=True) if w == e]
        if own:
            entries[e] = [sum(x) // len(own) for x in zip(*own, strict=True)]


def slow_codes(rows, dims, parts, entries, rounds, scale):
    rows = sorted(kept(rows, dims), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ints, width, books, codes = [[math.floor(scale * x) for x in r[1]] for r in rows], dims // parts, [], []
    for p in range(parts):
        points = [v[p * width : (p + 1) * width] for v in ints]
        book = [list(x) for x in points[:entries]]
        near = lambda x, book=book: min(range(len(book)), key=lambda e: (distance(x, book[e]), e))
        for _ in range(rounds):
            moved(points, book, [near(x) for x in points])
        books.append(book)
        codes.append([(near(x), distance(x, book[near(x)])) for x in points])
    found = [(r[0], r[2], [c[k][0] for c in codes], sum(c[k][1] for c in codes)) for k, r in enumerate(rows)]
    sums = defaultdict(int)
    for r in found:
        sums[r[1]] += r[3]
    return Counter((r[0], r[1], tuple(r[2]), r[3], sums[r[1]]) for r in found), books


def slow_clusters(rows, dims, k, rounds, scale):
    def order(r):
        return (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])

    rows = sorted(kept(rows, dims), key=order)
    ints = [[math.floor(scale * x) for x in r[1]] for r in rows]
    middle = [list(x) for x in ints[:k]]
    near = lambda x: min(range(len(middle)), key=lambda e: (distance(x, middle[e]), e))
    for _ in range(rounds):
        moved(ints, middle, [near(x) for x in ints])
    which = [near(x) for x in ints]
    far = [distance(x, middle[w]) for x, w in zip(ints, which, strict=True)]
    inertia = Counter()
    for w, d in zip(which, far, strict=True):
        inertia[w] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return Counter((r[0], w, d, inertia[w], sum(far), sha[w]) for r, w, d in zip(rows, which, far, strict=True))


def odd(df):
    return df.withColumns({c: F.lit("x") for c in ("vector", "ints", "n", "codes", "error", "cluster", "distance", "__key", "__rows", "norms")})


@pytest.mark.parametrize(("dims", "entries", "rounds"), [(8, 16, 4), (16, 256, 2), (8, 5, 0)])
def test_codes(spark, monkeypatch, dims, entries, rounds):
    monkeypatch.setattr(vectors, "BLOCK", 7)
    rows = table(dims)
    want, books = slow_codes(rows, dims, 4, entries, rounds, 1024)
    got, book = vector_codes.compress(odd(spark.createDataFrame(rows, SCHEMA)).repartition(3), entries=entries, rounds=rounds)
    assert Counter((r["vec_id"], r["label"], tuple(r["codes"]), r["error"], r["label_error"]) for r in got.collect()) == want
    assert book.tolist() == books
    assert vector_codes.sha256_of(book) == hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def test_restored_vectors_are_as_far_as_the_error_says(spark):
    rows = [(i, vector(8), 1) for i in range(300)]
    got, book = vector_codes.compress(spark.createDataFrame(rows, SCHEMA), entries=32)
    of = {r[0]: [math.floor(1024 * x) for x in r[1]] for r in rows}
    for r in vector_codes.restore(got, book).collect():
        assert distance(of[r["vec_id"]], [round(1024 * x) for x in r["vector"]]) == r["error"]


@pytest.mark.parametrize(("dims", "k", "rounds"), [(10, 4, 3), (64, 16, 3), (10, 200, 2), (3, 4, 0)])
def test_clusters(spark, monkeypatch, dims, k, rounds):
    monkeypatch.setattr(vectors, "BLOCK", 7)
    rows = table(dims)
    got, middle = centroids.cluster(odd(spark.createDataFrame(rows, SCHEMA)).repartition(3), dims=dims, k=k, rounds=rounds)
    assert Counter(tuple(r[c] for c in ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")) for r in got.collect()) == slow_clusters(rows, dims, k, rounds, 64)
    assert len(middle) == min(k, len(kept(rows, dims)))


def test_nothing_to_go_by(spark):
    for rows in ([], [(1, None, 1), (2, [], 1), (3, [math.nan] * 64, None)]):
        df = spark.createDataFrame(rows, SCHEMA)
        assert vector_codes.compress(df)[0].collect() == [] and centroids.cluster(df)[0].collect() == []


def test_components_that_are_too_large_are_told(spark):
    df = spark.createDataFrame([(1, [1e30] * 64, 1), (2, [0.0] * 64, 1)], SCHEMA)
    for run in (vector_codes.compress, centroids.cluster):
        with pytest.raises(Exception, match="too large"):
            run(df)[0].collect()


def test_bounds_are_lower_and_spare_distances():
    """Among vectors in groups most centroids are screened out, and none that is nearest."""
    r = np.random.default_rng(3)
    middle = r.integers(-3000, 3000, (16, 64)) * r.integers(0, 2, (16, 64))
    ints = (middle[r.integers(0, 16, 3000)] + r.integers(-200, 200, (3000, 64))).T.astype(np.int64)
    norms = centroids.segment_norms(ints)
    exact = ((ints.T[:, None, :] - middle[None]) ** 2).sum(axis=2)
    assert (centroids.lower_bounds(norms, centroids.segment_norms(middle.T)) <= exact).all()
    which, far, tried = centroids.assign(ints, norms, middle)
    assert (which == exact.argmin(axis=1)).all() and (far == exact.min(axis=1)).all()
    assert tried < 0.2 * exact.size
    same = np.repeat(middle[:1], 5, axis=0)  # ties go to the first
    assert set(centroids.assign(ints, norms, same)[0]) == {0}


def test_sums_merge_in_any_order():
    r = np.random.default_rng(4)
    book = r.integers(-50, 50, (4, 9, 2))
    parts = [r.integers(-50, 50, (8, n)) for n in (5, 1, 30)]
    whole = vector_codes.added(None, np.concatenate(parts, axis=1), book)
    each = [vector_codes.added(None, x, book) for x in parts]
    for a, b, c in ((0, 1, 2), (2, 0, 1)):
        got = vector_codes.merged(vector_codes.merged(None, each[a]), vector_codes.merged(each[b], vector_codes.merged(each[c], None)))
        assert all((x == y).all() for x, y in zip(got, whole, strict=True))
