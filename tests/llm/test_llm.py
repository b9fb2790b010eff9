"""The corpus operators against brute force, on small tables with nulls, empty and long texts, ties, repeats and odd columns."""

import base64
import gzip
import hashlib
import io
import itertools
import json
import math
import random
import re
import zipfile
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siftworks.llm import chat, common, components, decontaminate, exact_dedup, licences, mixing, repeats, sharding, simhash, toxicity, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
rng = random.Random(7)
VOCABULARY = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rng.randint(2, 9))) for _ in range(400)]


def prose(n: int) -> str:
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


PASSAGE = prose(60)
BASE = prose(300)


def edited(text: str, n: int) -> str:
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
    return " ".join(words)


TEXTS = [prose(40), None, "", "  \t\n ", "one", "two words", PASSAGE, f"{prose(20)} {PASSAGE} {prose(30)}", BASE, BASE, BASE, edited(BASE, 1), edited(BASE, 2), edited(BASE, 8), "ab" * 400, "x" * 49, "x" * 50, "x" * 51, "é" * 60, "NUL\0" * 40, prose(6000), f"{prose(10)}\n{PASSAGE}", None, "", "For " * 200, "For " * 150, *[prose(30) for _ in range(30)]]
ROWS = [(i, t, "en", [None, "b", "a", "é", "Z"][i % 5], None) for i, t in enumerate(TEXTS)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def odd(df):
    """The same with columns that clash with those the operators make."""
    return df.withColumns({c: F.lit("x") for c in ("digest", "fp", "batch", "size", "target", "shard", "depth", "count", "__key", "items", "licence")})


def data(value):
    return (value or "").encode()


# --- 1 --------------------------------------------------------------------------------------------------------------------


def without_repeats(rows, least=50):
    first, out = {}, {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        t, n = data(t), 0
        gone = bytearray(len(t))
        for a in range(len(t) - least + 1):
            if first.setdefault(t[a : a + least], i) < i:
                gone[a : a + least] = b"\1" * least
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        n = len(re.findall(b"\1+", bytes(gone)))
        out[i] = (len(t), sum(gone), n, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize(("kmer", "hot", "block"), [(16, repeats.HOT_CUTS, repeats.BLOCK_SYMBOLS), (24, 2, 500)])
def test_repeats(spark, docs, monkeypatch, kmer, hot, block):
    """With minimizers that are dealt out by windows and small blocks, too."""
    monkeypatch.setattr(repeats, "HOT_CUTS", hot)
    monkeypatch.setattr(repeats, "BLOCK_SYMBOLS", block)
    got = {r[0]: tuple(r)[1:5] for r in repeats.remove_repeats(odd(docs), kmer=kmer).collect()}
    assert got == without_repeats([(r[0], r[1]) for r in ROWS])
    assert sum(x[1] for x in got.values()) > 1000


def test_repeats_edges(spark, empty):
    assert repeats.remove_repeats(empty).count() == 0
    same = spark.createDataFrame([(1, PASSAGE), (1, PASSAGE), (None, PASSAGE), (0, "short")], "doc_id long, text string")
    got = sorted((r["doc_id"] is None, r["n_removed"]) for r in repeats.remove_repeats(same).collect())
    assert got == [(False, 0), (False, 0), (False, 0), (True, len(PASSAGE.encode()))]


@pytest.mark.parametrize("ids", ["null", "one", "few"])
def test_ids_that_repeat_are_several_batches(spark, monkeypatch, ids):
    """All rows without an id, or with one of few: judged as ever, and no task has them all."""
    texts = [prose(120) + " " + PASSAGE * (k % 3) for k in range(120)]
    number = lambda k: None if ids == "null" else 1 if ids == "one" else k % 4
    rows = [(number(k), t) for k, t in enumerate(texts)] + [(-5, PASSAGE)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeats.remove_repeats(df, batch_bytes=16 << 10).collect())
    first = defaultdict(lambda: 10**9)
    for i, t in rows:
        t = data(t)
        for a in range(len(t) - 49):
            first[t[a : a + 50]] = min(first[t[a : a + 50]], 10**8 if i is None else i)
    want = Counter()
    for i, t in rows:
        t = data(t)
        gone = bytearray(len(t))
        for a in range(len(t) - 49):
            if first[t[a : a + 50]] < (10**8 if i is None else i):
                gone[a : a + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        want[i, len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()] += 1
    assert got == want
    n = max(common.partitions(spark), -(-sum(len(data(t)) for _, t in rows) // (16 << 10)))
    shares = df.groupBy(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).alias("batch")).count().agg(F.max("count")).first()[0]
    assert n >= 7 and shares < 60


def test_kept_bytes_and_spans_round_trip(spark, docs):
    for r in repeats.remove_repeats(docs).collect():
        text = data(TEXTS[r["doc_id"]])
        cut = [text[s["start"] : s["end"]] for s in r["spans"]]
        assert len(cut) == r["n_spans"] and sum(map(len, cut)) == r["n_removed"]
        assert len(r["kept"]) + r["n_removed"] == len(text)


@pytest.mark.parametrize("n", [6, 60, 400])
def test_backward_extension(n):
    """The smallest owner of each window, from windows counted one by one; strings alike in part, in all, and within themselves."""
    strings = [prose(30).encode()[:120] for _ in range(n)]
    strings += [strings[0][10:90], strings[1][:70] + strings[2][:70], b"ab" * 60, b"ba" * 50, strings[3] + b"z", b"short", b"", b"x" * 177, b"x" * 50]
    strings += [s[:40] + prose(3).encode() + s[40:] for s in strings[:: max(1, n // 9)]]
    owners = np.array([rng.randrange(100) for _ in strings])
    low = defaultdict(lambda: 10**9)
    for s, o in zip(strings, owners.tolist(), strict=True):
        for a in range(len(s) - 49):
            low[s[a : a + 50]] = min(low[s[a : a + 50]], o)
    flat, bounds = repeats.smallest_owners(strings, owners, 50)
    assert [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == [[low[s[a : a + 50]] for a in range(len(s) - 49)] for s in strings]


def test_suffix_order():
    strings = [prose(8).encode() for _ in range(50)] + [b"aaaaaaaaaa" * 4, b"aaaaaaaaaa" * 3]
    strings += strings[:9]
    symbols = np.concatenate([np.array([*(c + 1 for c in s), 0]) for s in strings])
    ends = np.cumsum([len(s) + 1 for s in strings])
    reach = np.concatenate([np.arange(len(s), -1, -1) for s in strings])
    texts = [s[a:] for s in strings for a in range(len(s) + 1)]
    order = repeats.suffix_order(symbols, reach, 10**6).tolist()
    assert sorted(order) == list(range(len(symbols))) and ends[-1] == len(symbols)
    got = [texts[i] for i in order]
    assert got == sorted(texts)


def test_the_sort_tells_what_the_extension_starts_from():
    """Common prefixes below 28 of 50 bytes are known from the sort, so that the extension has 22 steps at most."""
    strings = [prose(12).encode() for _ in range(40)]
    strings += [s[10:] + b"!" for s in strings[:20]] + strings[:5] + [b"ab" * 40]
    symbols = np.concatenate([np.array([*(c + 1 for c in s), 0]) for s in strings])
    reach = np.concatenate([np.arange(len(s), -1, -1) for s in strings])
    texts = [s[a:] for s in strings for a in range(len(s) + 1)]
    order, short, sure = repeats.suffixes(symbols, reach, 50)
    assert sure == 28 and not short.all()
    got = [texts[i] for i in order.tolist()]
    assert short.tolist() == [True] + [len(a) < sure or a[:sure] != b[:sure] for a, b in zip(got, got[1:], strict=False)]


def test_hot_cuts_are_cut_again_not_told_by_windows():
    """A common beginning in many contexts: each window once, in a few pieces of each cut and not one for each window; equal windows have one key."""
    middle = b"of the common words "
    strings = [x[-34:] + middle[:16] + y[:34] for x, y in ((prose(20).encode(), prose(20).encode()) for _ in range(300))]
    strings += [strings[0][5:] + b"z", strings[1][:60]]
    low, which, place, parts = repeats.recut(strings, 50, 32)
    windows, key = Counter(), {}
    for k, i, a, x in zip(low.tolist(), which.tolist(), place.tolist(), parts, strict=True):
        for j in range(len(x) - 49):
            windows[i, a + j] += 1
            assert strings[i][a + j : a + j + 50] == x[j : j + 50] and key.setdefault(x[j : j + 50], k) == k
    assert windows == Counter((i, a) for i, s in enumerate(strings) for a in range(len(s) - 49))
    assert sum(map(len, parts)) < sum(windows.values()) * 50 / 4


@pytest.mark.parametrize("most", [60, 500, 5000])
def test_windows_of_a_key_by_blocks(most):
    strings = [prose(30).encode()[:120] for _ in range(40)]
    strings += [strings[0][10:90], strings[1][:70] + strings[2][:70], b"ab" * 60, b"short", b"", b"x" * 177, strings[5]]
    owners = np.array([rng.randrange(100) for _ in strings])
    want, bounds = repeats.smallest_owners(strings, owners, 50)
    got, at = repeats.smallest_in_blocks(strings, owners, 50, most)
    assert got.tolist() == want.tolist() and at.tolist() == bounds.tolist()


@pytest.mark.parametrize(("spread", "block"), [(1, 500), (10**6, 100)])
def test_repeats_of_hot_minimizers(spark, docs, monkeypatch, spread, block):
    """Dealt out by windows, and as keys with more cuts than several blocks hold."""
    monkeypatch.setattr(repeats, "HOT_CUTS", 1)
    monkeypatch.setattr(repeats, "SPREAD", spread)
    monkeypatch.setattr(repeats, "BLOCK_SYMBOLS", block)
    got = {r[0]: tuple(r)[1:5] for r in repeats.remove_repeats(docs).collect()}
    assert got == without_repeats([(r[0], r[1]) for r in ROWS])


def test_blocks_hold_whole_keys():
    keys = np.sort(np.array([rng.randrange(20) for _ in range(200)]))
    sizes = np.array([rng.randrange(1, 50) for _ in range(200)])
    found = list(repeats.blocks(keys, sizes, 300))
    assert found[0][0] == 0 and found[-1][1] == 200 and all(a[1] == b[0] for a, b in zip(found, found[1:], strict=False))
    for a, b in found:
        assert (a == 0 or keys[a] != keys[a - 1]) and (sizes[a:b].sum() + b - a <= 300 or len(set(keys[a:b].tolist())) == 1)
    assert list(repeats.blocks(keys[:0], sizes[:0], 300)) == []


# --- 2 --------------------------------------------------------------------------------------------------------------------


def classes(prints, distance=3):
    found = {}
    for i in sorted(prints):
        if i in found:
            continue
        todo, found[i] = [i], i
        while todo:
            a = todo.pop()
            for b in prints:
                if b not in found and (prints[a] ^ prints[b]).bit_count() <= distance:
                    found[b] = i
                    todo.append(b)
    return found


def slow_print(text, width=3):
    import xxhash

    words = re.findall(rb"[^\x20\x09-\x0D]+", data(text).lower())
    shingles = [b" ".join(words[k : k + width]) for k in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, docs, monkeypatch):
    prints = {i: slow_print(t) for i, t in enumerate(TEXTS)}
    want = {i: (prints[i], c) for i, c in classes(prints).items()}
    for hot in (simhash.HOT_CELL, 1):
        monkeypatch.setattr(simhash, "HOT_CELL", hot)
        got = {r["doc_id"]: (r["fp"] % 2**64, r["component_id"]) for r in simhash.near_dedup(odd(docs)).collect()}
        assert got == want
    assert len({c for _, c in want.values()}) < len(TEXTS)
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] % 2**64 == simhash.shingle_hashes(b"A b  c")[0]


def test_xxh64_in_sql():
    duckdb = pytest.importorskip("duckdb")
    import xxhash

    from siftworks.llm.xxh64_sql import xxh64

    texts = ["", "a", "abcd", "ab cd é", "abcdefgh", "x" * 31, "é" * 16, "y" * 45, prose(40), *[prose(3) for _ in range(40)]]
    con = duckdb.connect()
    con.execute("create table t(s varchar)")
    con.executemany("insert into t values (?)", [[x] for x in texts])
    data_of = "select s, octet_length(encode(s)) as n, list_transform(range(0, octet_length(encode(s))), lambda i: ('0x' || substr(hex(encode(s)), (2 * i + 1)::INT, 2))::UHUGEINT) as b from t"
    for seed in (0, 42, 2**64 - 1):
        got = dict(con.execute(f"select s, {xxh64('b', 'n', seed)}::UBIGINT from ({data_of})").fetchall())
        assert got == {x: xxhash.xxh64_intdigest(x.encode(), seed) for x in texts}


def test_simhash_of_nothing(spark, empty):
    assert simhash.near_dedup(empty).count() == 0
    got = simhash.near_dedup(spark.createDataFrame([(None, "a b"), (2, None), (1, "")], "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} >= {(2, 1), (1, 1)}


@pytest.mark.parametrize("hot", [simhash.HOT_CELL, 100, 20])
def test_range_join_over_the_grid(spark, monkeypatch, hot):
    """Points around two centres, many in one cell: all that are near are connected and nothing else is linked."""
    monkeypatch.setattr(simhash, "HOT_CELL", hot)
    points = {(0x0123456789ABCDEF ^ (1 << a) ^ (1 << b)) for a in range(64) for b in range(0, 64, 5)} | {3, 2**63, 2**63 + 1}
    points |= {0xFFFF0000FFFF0000 ^ sum(1 << b for b in rng.sample(range(64), 6)) for _ in range(300)}
    frame = spark.createDataFrame([(p - (p >> 63 << 64),) for p in points], "fp long").repartition(3)
    links, parent = simhash.near_links(frame).collect(), {p: p for p in points}
    for a, b in links:
        a, b = a % 2**64, b % 2**64
        assert 0 < (a ^ b).bit_count() <= 3
        while parent[a] != a:
            a = parent[a]
        while parent[b] != b:
            b = parent[b]
        parent[max(a, b)] = min(a, b)
    got = {}
    for p in points:
        q = p
        while parent[q] != q:
            q = parent[q]
        got[p] = q
    assert got == classes({p: p for p in points}) and len(set(got.values())) > 10


def test_cells_bring_all_near_points_together():
    """Of pairs at each distance up to 3: in one half of the axes one resides where the other resides or visits."""
    for distance in (1, 2, 3):
        a = np.array([rng.getrandbits(64) for _ in range(400)], dtype=np.uint64)
        b = np.array([int(x) ^ sum(1 << k for k in rng.sample(range(64), distance)) for x in a], dtype=np.uint64)
        met = np.zeros(400, dtype=bool)
        for at in (0, 32):
            cells = []
            for codes in (simhash.embed(a), simhash.embed(b)):
                own = [set() for _ in range(400)], [set() for _ in range(400)]
                for which, keys, visits in simhash.cells_of(codes, at, 16):
                    for i, k in zip(which.tolist(), keys.tolist(), strict=True):
                        own[visits][i].add(k)
                cells.append(own)
            met |= [bool(cells[0][0][i] & (cells[1][0][i] | cells[1][1][i]) or cells[0][1][i] & cells[1][0][i]) for i in range(400)]
        assert met.all()


def test_manhattan_distance_is_a_lower_bound():
    a, b = (np.array([rng.getrandbits(64) for _ in range(500)], dtype=np.uint64) for _ in range(2))
    assert (np.bitwise_count(simhash.embed(a) ^ simhash.embed(b)) <= np.bitwise_count(a ^ b)).all()


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 50), (50, 100), (7, 7), (60, 61), (61, 62)]
    got = {r[0]: r[1] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {100: 50, 61: 60, 62: 60}


def test_one_of_each(spark, docs, empty):
    got = {r["doc_id"] for r in simhash.one_of_each(odd(docs)).collect()}
    assert 8 in got and not got & {9, 10, 11, 12}
    assert {0, 4, 5, 20, 30} <= got
    assert simhash.one_of_each(empty).count() == 0


@pytest.mark.parametrize(("n", "m"), [(1, 1), (4, 5), (10, 10), (60, 60), (172, 215), (300, 300), (688, 860), (765, 765)])
def test_no_similar_pair_is_lost_by_its_prefixes(n, m):
    """At 0.8 or just above: all share a shingle of their prefixes and pass the bound, with and without common shingles."""
    rng = np.random.default_rng(n)
    both = int(np.ceil(0.8 / 1.8 * (n + m) - 1e-9))
    for k in range(600):
        h = rng.choice(np.unique(rng.integers(0, 2**64 - 1, 2 * m, dtype=np.uint64)), n + m - both, replace=False)
        x, y = np.sort(h[:n]), np.sort(h[n - both :])
        often = np.sort(h[k % 2 :: 2])
        for order in (simhash.NONE, (often, rng.integers(4, 9, len(often)))):
            p, q = simhash.prefix_of(x, order), simhash.prefix_of(y, order)
            assert set(p.tolist()) & set(q.tolist())
            assert simhash.most_shared(p, n, q, m, order) >= both >= simhash.needed(n, m, 0.8)
            assert simhash.most_shared(q, m, p, n, order) >= both


def test_sets_that_only_share_a_passage_are_sorted_out_by_their_prefixes():
    rng = np.random.default_rng(1)
    h = np.unique(rng.integers(0, 2**64 - 1, 1000, dtype=np.uint64))
    h = rng.permutation(h)
    x, y = np.sort(h[:500]), np.sort(h[400:900])
    p, q = simhash.prefix_of(x), simhash.prefix_of(y)
    assert simhash.most_shared(p, 500, q, 500) < simhash.needed(500, 500, 0.8)


def test_variants_of_a_base_that_is_not_first(spark):
    """Each variant is similar to the base, hardly any two are to each other."""
    rng = random.Random(3)
    base = [f"w{k}" for k in range(304)]
    rows = [(1000, " ".join(base))]
    for i in range(200):
        words = list(base)
        for j in range(i % 59, 304, 60):
            words[j] = f"v{i}_{j}"
        rows.append((i + 1, " ".join(words)))
    rng.shuffle(rows)
    sets = {i: set(simhash.shingle_hashes(t.encode(), 5)) for i, t in rows}
    assert all(len(sets[i] & sets[1000]) >= 0.8 * len(sets[i] | sets[1000]) for i in sets)
    assert sum(len(sets[1] & sets[i]) >= 0.8 * len(sets[1] | sets[i]) for i in sets) < 60
    assert [r[0] for r in simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id").collect()] == [1]


def slow_groups(rows, similarity=0.8):
    """doc_ids that stay, by all pairs: linked by fingerprints within three bits or by their sets of shingles."""
    sets = {i: set(simhash.shingle_hashes(t.encode(), 5)) for i, t in rows}
    prints = {i: simhash.fingerprint(t.encode(), 5) for i, t in rows}
    root = {i: i for i, _ in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(sorted(sets), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 3 or len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) - 1e-9:
            x, y = sorted((top(i), top(j)))
            root[y] = x
    return {i for i in root if top(i) == i}


@pytest.mark.parametrize(("hot", "part"), [(1024, 1 << 14), (2, 7), (2, 1)])
def test_hot_shingles_are_dealt_out(spark, monkeypatch, hot, part):
    """Groups that share most of their shingles with each other and others that share only a passage: the same with and without parts."""
    monkeypatch.setattr(simhash, "HOT_TOKEN", hot)
    monkeypatch.setattr(simhash, "PART", part)
    rng = random.Random(11)
    passage = [f"p{k}" for k in range(60)]
    rows = []
    for i in range(240):
        words = list(passage)
        if i % 3:  # variants of one text and of another that has most of it
            for _ in range(rng.choice([0, 1, 2, 3])):
                words[rng.randrange(60)] = f"v{rng.randrange(40)}"
        else:  # the passage is a share of the text, small or large
            words += [f"u{i // 30}_{k}" for k in range(rng.choice([2, 8, 14, 16, 30, 100]))]
        rows.append((i + 1, " ".join(words)))
    want = slow_groups(rows)
    assert 3 < len(want) < 120
    got = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(8))
    assert {r["doc_id"] for r in got.collect()} == want


def test_pairs_apart_are_all_pairs_of_other_roots(spark, monkeypatch):
    """Against all pairs, whatever the parts; rows of the most frequent root don't meet."""
    rng = random.Random(5)
    rows = [(t, r, 0 if r % 4 else r // 8, 10, 0) for t in range(5) for r in rng.sample(range(200), 60)]
    many = [(*x, 0, 60) for x in rows]
    want = {(x[1], y[1]) for x, y in itertools.permutations(rows, 2) if x[0] == y[0] and x[1] < y[1] and x[2] != y[2]}
    table = spark.createDataFrame(many, "token long, row long, root long, n int, at int, most long, many long")
    for part in (1 << 14, 7):
        monkeypatch.setattr(simhash, "PART", part)
        got = [tuple(r) for r in simhash.pairs_apart(table, 0.8).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_texts_that_share_a_fingerprint_are_compared_each(spark):
    """The shingle that is most of a text makes the fingerprint of 1 and 2; 3 is similar to 2 only."""
    words = [" ".join(f"{x}{k}" for k in range(30)) for x in "ab"]
    rows = [(1, "for " * 200 + words[0]), (2, "for " * 200 + words[1]), (3, "for " * 8 + words[1])]
    a, b, c = (simhash.fingerprint(t.encode(), 5) for _, t in rows)
    assert a == b and (a ^ c).bit_count() > 3
    assert [r["doc_id"] for r in simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()] == [1]


# --- 3 --------------------------------------------------------------------------------------------------------------------

TOOLS = {"f": {"x": ("integer", True), "y": ("string", False), "l": ("array", False)}}


def linked(spark, calls, results):
    c = spark.createDataFrame(calls, "conv_id long, turn long, place int, call_id string, name string, arguments string, after array<string>")
    r = spark.createDataFrame(results, "conv_id long, turn long, place int, call_id string, content string")
    return {(x["conv_id"], x["call_id"], x["status"]): x for x in chat.link(odd(c), r, TOOLS).collect()}


def test_calls_and_results(spark):
    calls = [(1, 0, 0, "a", "f", '{"y": "é", "x": 1}', None), (1, 1, 0, "b", "f", '{"x": "1"}', ["a"]), (1, 2, 0, "c", "g", "{}", ["b", "gone"]), (1, 3, 0, "d", "f", "nonsense", []), (1, 4, 0, "e", "f", None, None), (1, 5, 0, None, "f", '{"x": 2, "l": [1]}', None), (1, 6, 0, "h", "f", "[1]", None)]
    got = linked(spark, calls, [(1, 9, 1, "a", "second"), (1, 9, 0, "a", "first"), (1, 9, 2, "zz", "lost"), (2, 0, 0, "a", "other"), (1, 9, 3, None, "none")])
    a = got[1, "a", "linked"]
    assert a["json"] == '{"arguments":{"x":1,"y":"é"},"id":"a","name":"f","result":"first"}' and a["valid"]
    assert got[1, "b", "unanswered"]["faults"] == "x is not integer" and got[1, "c", "unanswered"]["faults"] == "unknown tool"
    assert [got[1, k, "unanswered"]["faults"] for k in "deh"] == ["not JSON", "not JSON", "not an object"]
    assert got[1, None, "unanswered"]["valid"] and {k for k in got if k[2] == "orphan"} == {(1, "zz", "orphan"), (2, "a", "orphan"), (1, None, "orphan")}
    assert {x["rank"] for x in got.values()} == {0}


def slow_ranks(calls):
    """Ways of waits, one by one; calls that reach themselves are cyclic, and those of one circle are one call."""
    place, needs = {}, defaultdict(set)
    for conv, turn, at, call, _, _, after in calls:
        place[conv, call] = min(place.get((conv, call), (turn, at)), (turn, at))
    for conv, turn, at, call, _, _, after in calls:
        needs[conv, call] |= {(n, int(place[conv, n] >= (turn, at))) for n in after or [] if (conv, n) in place}
    back = {k: {n: max(b for m, b in v if m == n) for n, _ in v} for k, v in needs.items()}

    def reach(key):
        seen, left = set(), [key]
        while left:
            conv, call = left.pop()
            new = {(conv, n) for n in back.get((conv, call), {})} - seen
            seen |= new
            left += new
        return seen

    to = {k: reach(k) for k in place}
    circle = {k: frozenset(n for n in to[k] if k in to[n]) for k in place if k in to[k]}
    group = {k: circle.get(k, frozenset([k])) for k in place}

    def rank(g):
        ways = [rank(group[k[0], n]) + b for k in g for n, b in back.get(k, {}).items() if (k[0], n) not in g]
        return max(ways, default=0)

    return {k: (rank(group[k]), k in circle) for k in place}


def test_topological_order_and_circles(spark):
    calls = [(1, 0, 0, "a", "f", '{"x":1}', ["b"]), (1, 1, 0, "b", "f", '{"x":1}', ["c"]), (1, 2, 0, "c", "f", '{"x":1}', None), (2, 0, 0, "p", "f", '{"x":1}', ["q"]), (2, 1, 0, "q", "f", '{"x":1}', ["p"]), (2, 2, 0, "r", "f", '{"x":1}', None), (3, 0, 0, "a", "f", '{"x":1}', None), (3, 1, 0, "s", "f", "{}", ["s"]), (3, 2, 0, "t", "f", "{}", ["s", "a"])]
    got = {(k[0], k[1]): (x["rank"], x["cyclic"]) for k, x in linked(spark, calls, []).items()}
    assert got == {(1, "a"): (2, False), (1, "b"): (1, False), (1, "c"): (0, False), (2, "p"): (0, True), (2, "q"): (0, True), (2, "r"): (0, False), (3, "a"): (0, False), (3, "s"): (0, True), (3, "t"): (0, False)}
    assert got == slow_ranks(calls)


def test_what_is_behind_a_circle_is_in_order(spark):
    """p and q wait for each other, x for p, and y, which stands first, for x; two circles, one behind the other, and what lies between."""
    call = lambda conv, turn, name, *after: (conv, turn, 0, name, "f", '{"x":1}', list(after))
    calls = [call(1, 0, "y", "x"), call(1, 1, "x", "p"), call(1, 2, "p", "q"), call(1, 3, "q", "p")]
    calls += [call(2, 0, "a", "b"), call(2, 1, "b", "c"), call(2, 2, "c", "b", "m"), call(2, 3, "m", "u"), call(2, 4, "u", "v"), call(2, 5, "v", "w"), call(2, 6, "w", "u", "z"), call(2, 7, "z")]
    got = {(k[0], k[1]): (x["rank"], x["cyclic"]) for k, x in linked(spark, calls, []).items()}
    assert got == slow_ranks(calls)
    assert [got[1, k] for k in "pqxy"] == [(1 - 1, True), (0, True), (1, False), (2, False)]
    assert [got[2, k] for k in "zuvwmbca"] == [(0, False), *[(1, True)] * 3, (2, False), *[(3, True)] * 2, (4, False)]


@pytest.mark.parametrize("small", [1 << 16, 0])
def test_order_of_random_calls(spark, monkeypatch, small):
    """Each call comes after what it waits for, by rank, turn and place, with broadcasts and without."""
    monkeypatch.setattr(chat.ranks, "__defaults__", (small,))
    own = random.Random(5)
    calls = []
    for conv in range(30):
        n = own.randint(2, 12)
        where = own.sample(range(n), n) if conv % 3 else list(range(n))
        for k in range(n):  # waits lead from larger to smaller numbers, but for some circles
            after = [str(own.randrange(k)) for _ in range(own.randint(0, 2)) if k] + ([str(n - 1)] if own.random() < 0.05 else [])
            calls.append((conv, where[k], 0, str(k), "f", '{"x":1}', after))
    got = {(k[0], k[1]): x for k, x in linked(spark, calls, []).items()}
    assert {k: (x["rank"], x["cyclic"]) for k, x in got.items()} == slow_ranks(calls)
    assert any(x["cyclic"] for x in got.values()) and max(x["rank"] for x in got.values()) > 2
    for conv, _, _, call, _, _, after in calls:
        if not got[conv, call]["cyclic"]:  # behind a circle, too
            assert all((got[conv, n]["rank"], got[conv, n]["turn"]) < (got[conv, call]["rank"], got[conv, call]["turn"]) for n in after)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(chat.Held, "keep", lambda *x, keep=chat.Held.keep: rounds.append(1) or keep(*x))
    calls = [(1, 600 - k, 0, str(k), "f", '{"x":1}', [str(k - 1)]) for k in range(600)]
    got = linked(spark, calls, [])
    assert {int(k[1]): x["rank"] for k, x in got.items()} == {k: k for k in range(600)} and len(rounds) <= 17


def test_no_calls_or_no_results(spark):
    assert linked(spark, [], []) == {}
    assert {k[2] for k in linked(spark, [], [(1, 0, 0, "a", "x")])} == {"orphan"}
    turns = spark.createDataFrame([(1, 0, None, "who"), (1, 1, "USER", None), (1, 2, "tool", "t"), (1, 3, "system", "")], "conv_id int, turn int, role string, text string")
    got = {x["turn"]: x for x in chat.link(*chat.from_turns(odd(turns)), chat.TURNS).collect()}
    assert {t: (x["status"], x["valid"]) for t, x in got.items()} == {0: ("unanswered", True), 1: ("linked", False), 3: ("unanswered", True)}


# --- 4 --------------------------------------------------------------------------------------------------------------------


def test_exact_dedup(spark, docs, empty):
    groups = defaultdict(list)
    for i, t in enumerate(TEXTS):
        groups[t or ""].append(i)
    want = {i: (max(g), len(g), i == max(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g}
    assert {r[0]: tuple(r)[1:] for r in exact_dedup.exact_dedup(odd(docs)).collect()} == want
    assert exact_dedup.exact_dedup(empty).count() == 0


def plan_of(df):
    """The plan without what the joins' statistics may change while it runs."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_index_keeps_over_batches(spark, tmp_path):
    path = f"file://{tmp_path}/it's an index"
    index = exact_dedup.DigestIndex(spark, path, 6)
    first = spark.createDataFrame([(1, "a"), (2, "a"), (None, None)], "doc_id long, text string")
    assert {(r["doc_id"], r["kept"]) for r in exact_dedup.deduplicate(first, index).collect()} == {(1, False), (2, True), (None, True)}
    index.close()
    again = exact_dedup.DigestIndex(spark, path, 6)
    second = spark.createDataFrame([(9, "a"), (8, "b"), (7, "")], "doc_id long, text string")
    assert {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.deduplicate(second, again).collect()} == {(9, 2, 2, False), (8, 8, 1, True), (7, None, 1, False)}
    assert again.entries().count() == 3
    groups = exact_dedup.cut(exact_dedup.groups_of(second.select("doc_id", exact_dedup.digest_of(F.col("text")).alias("digest"))))
    for plan, kind in ((plan_of(again.unseen(groups)), "LeftAnti"), (plan_of(again.found(groups)), "LeftOuter")):
        # one shuffle, of the groups; the index is read as it lies
        assert "SortMergeJoin" in plan and kind in plan and "Bucketed: true" in plan
        assert plan.count("Exchange") == 1 and re.search(r"Exchange hashpartitioning\(digest#\w+, 6\).*\n.*Scan ExistingRDD", plan)
    again.close()


@pytest.mark.parametrize("buckets", [2, 16, 32])
def test_index_keeps_its_buckets(spark, tmp_path, buckets):
    """Opened with fewer or more, the same texts are no news; nor after a compaction."""
    path, texts = f"file://{tmp_path}/index", spark.createDataFrame([(k, f"text {k}") for k in range(200)], "doc_id long, text string")
    for k, n in enumerate((8, buckets, buckets)):
        index = exact_dedup.DigestIndex(spark, path, n)
        more = spark.createDataFrame([(9000 + k, f"more {k}")], "doc_id long, text string")
        found = exact_dedup.deduplicate(texts.withColumn("doc_id", F.col("doc_id") + 1000 * k).unionByName(more), index)
        assert index.buckets == 8 and found.where("kept").count() == (1 if k else 201) and index.entries().count() == 201 + k
        if k == 1:
            files = len(index.entries().inputFiles())
            index.compact()
            assert len(index.entries().inputFiles()) < files and index.entries().count() == 202
        index.close()
    spark.range(1).write.parquet(f"{tmp_path}/other")
    with pytest.raises(ValueError, match="index.json"):
        exact_dedup.DigestIndex(spark, f"file://{tmp_path}/other", 4)


def test_index_leaves_no_name_behind(spark, docs):
    before = {t.name for t in spark.catalog.listTables()}
    assert exact_dedup.exact_dedup(docs).count() == len(TEXTS)
    assert {t.name for t in spark.catalog.listTables()} == before


# --- 5 --------------------------------------------------------------------------------------------------------------------


def dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b)) if a else 0


def slow_scan(rows, templates=None):
    """All runs of words of admitted length, one by one."""
    out = {}
    for name, text in (templates or licences.TEMPLATES).items():
        own = licences.plain_words(text)
        grams, most = set(licences.pairs(own)), licences.most_words(len(own), licences.THRESHOLD)
        for i, t in rows:
            b = licences.pairs(licences.plain_words(t or ""))
            if len(set(b) & grams) < licences.fewest(len(grams), licences.THRESHOLD):
                continue
            for s in range(len(b)):
                have = set()
                for e in range(s, min(len(b), s + most - 1)):
                    have.add(b[e])
                    score = 2 * len(have & grams) / (len(have) + len(grams)) if b[e] in grams else 0
                    if score >= licences.THRESHOLD:
                        out[i, name] = max(out.get((i, name), (0,)), (score, -s, -e - 2))
    return {k: (v[0], -v[1], -v[2]) for k, v in out.items()}


def wrapped(text, width, mark=""):
    lines, now = [], ""
    for w in text.split():
        if len(now) + len(w) >= width:
            lines.append(mark + now)
            now = ""
        now = f"{now} {w}".strip()
    return "\n".join([*lines, mark + now])


def test_licence_scan(spark, docs, empty):
    mit, gpl = licences.TEMPLATES["MIT"], licences.TEMPLATES["GPL-3.0-header"]
    code = "\n".join(f"x{k} = f({prose(6)})" for k in range(60))
    more = [
        (100, f"{prose(5)}\nReleased under the MIT License.\n{prose(5)}"),
        (101, mit.replace(". ", ".\n")),
        (102, mit + " " + prose(10)),
        (103, "Licensed under the\nApache License, Version 2.0."),
        (104, "ALL RIGHTS RESERVED\n" * 3),
        (105, None),
        (106, wrapped(mit, 70, "# ") + "\n" + code),
        (107, f"{prose(30)} released under the MIT license. {prose(30)}"),
        (108, f"{code}\n{wrapped(gpl, 60, ' * ')}\n{code}"),
        (109, prose(20) + " This work is licensed under the terms of the GNU General Public License, version 3. " + prose(20)),
        (110, " ".join(mit.split()[20:])),
        (111, " ".join(mit.split()[:60]) + " " + prose(25) + " " + " ".join(mit.split()[60:]) + prose(100)),
        (112, f"{prose(400)} distributed under the MIT license, {prose(400)}"),
        (113, "available under the MIT license"),
        (114, "Released under the MIT License. " * 300),
    ]
    frame = odd(docs.unionByName(spark.createDataFrame([(i, t, None, None, None) for i, t in more], SCHEMA)))
    got = {(r["doc_id"], r["licence"]): (r["score"], r["start"], r["end"]) for r in licences.scan(frame).collect()}
    assert got == slow_scan([*enumerate(TEXTS), *more])
    n = len(licences.plain_words(mit))
    for i in (101, 102, 106):  # its last two words end a pair that was there before
        assert got[i, "MIT"] == (1.0, 0, n - 2)
    assert got[107, "MIT-notice"][0] == 1.0 and got[108, "GPL-3.0-header"][0] == 1.0 and (108, "AGPL-3.0-header") in got
    assert {(100, "MIT-notice"), (103, "Apache-2.0-notice"), (104, "all-rights-reserved"), (109, "GPL-3.0-notice"), (110, "MIT"), (111, "MIT")} <= set(got)
    assert not [k for k in got if k[0] < 100 or k[0] == 105]
    assert {(112, "MIT-notice"), (113, "MIT-notice"), (114, "MIT-notice")} <= set(got)
    assert licences.scan(empty).count() == 0 and licences.scan(frame, {"word": "one", "x": ""}).count() == 0


def test_no_edited_licence_is_lost(spark):
    """Copies with words left out, put in and changed, in other text: whichever has a run of words at the threshold is found, with its
    best run."""
    own, rows = random.Random(2), []
    for name in ("MIT-notice", "Apache-2.0-notice", "BSD-3-Clause-notice", "GPL-3.0-notice", "MPL-2.0-header", "CC0-1.0-notice", "ISC"):
        for k in range(24):
            words = licences.TEMPLATES[name].split()
            for _ in range(1 + k % (2 + len(words) // 9)):
                at, kind = own.randrange(len(words)), own.randrange(3)
                words[at : at + (kind < 2)] = [] if kind == 0 else [own.choice(VOCABULARY)]
            rows.append((len(rows), " ".join([prose(own.randint(0, 40)), *words, prose(own.randint(0, 40))])))
    want = slow_scan(rows)
    got = {(r["doc_id"], r["licence"]): (r["score"], r["start"], r["end"]) for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want and 80 < len({i for i, _ in want}) < len(rows)


def test_a_unit_that_reaches_the_threshold_has_an_anchor():
    for name, text in licences.TEMPLATES.items():
        grams = set(licences.pairs(licences.plain_words(text)))
        own = {g for k, g in licences.anchors(licences.TEMPLATES, 0.8) if k == name}
        assert own and dice(grams - own, grams) < 0.8  # the best set without an anchor
        assert len(own) <= len(grams) / 3 + 1


# --- 6 --------------------------------------------------------------------------------------------------------------------


def test_warc_round_trip(spark):
    html = ["<p>é</p>", None, "", "<p>é</p>", "a\r\n\r\nb", "x" * 300_000, "same", "same", "same"]
    rows = [(i + 1, f"http://h/{i}\nx", h, "z") for i, h in enumerate(html)] + [(None, None, "same", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(2)
    got = {r["page_id"]: r for r in warc.archive_and_read(spark, pages).collect()}
    assert len(got) == len(rows)
    first = {}
    for i, _, h, _ in rows[:-1]:
        f, raw = first.setdefault(h or "", i), data(h)
        r = got[i]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        assert (r["record_type"], r["refers_to"]) == (("response", None) if f == i else ("revisit", f))
        assert bytes(r["payload"]) == raw if f == i else r["payload"] is None
        assert r["url"] == f"http://h/{i - 1}%0Ax"
    assert got[None]["refers_to"] == 7
    assert warc.archive_and_read(spark, pages.limit(0)).count() == 0
    assert {r["record_type"] for r in warc.archive_and_read(spark, pages, least_bytes=1 << 30).collect()} == {"response"}


def test_paths_without_a_store_are_sparks(spark, tmp_path):
    assert warc.in_store("/a/b", "hdfs://host:8020") == "hdfs://host:8020/a/b" and warc.in_store("/a", "file:") == "file:///a"
    assert warc.in_store("file:/a", "hdfs://host") == "file:///a" and warc.in_store("s3a://b/c", "hdfs://host") == "s3a://b/c"
    pages = spark.createDataFrame([(1, "http://a", "x"), (2, "http://b", "x")], "page_id long, url string, html string")
    packages = warc.write_packages(warc.plan_records(pages), str(tmp_path / "archives"))
    assert all(r["path"].startswith("file:///") for r in packages.collect())
    plain = packages.withColumn("path", F.replace("path", F.lit("file://"), F.lit("")))
    assert warc.read_packages(plain).count() == 2


def test_payloads_are_reduced_before_they_are_moved(spark):
    """The html column enters shuffles only as the partial result of one payload per digest."""
    pages = spark.createDataFrame([(i, "u", "same") for i in range(9)] + [(99, "u", None)], "page_id long, url string, html string")
    planned = warc.plan_records(pages)
    plan = plan_of(planned)
    moved = [line for line in plan.split("\n") if "Exchange" in line]
    assert moved and not any("html" in line for line in moved) and "partial_first(html" in plan
    assert sorted((r["page_id"], r["kind"], r["html"] is None) for r in planned.collect()) == [(0, "response", False), *[(i, "revisit", True) for i in range(1, 9)], (99, "response", False)]


@pytest.mark.parametrize("zip64", [False, True])
def test_members_of_a_zip(zip64, monkeypatch):
    if zip64:
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED) as z:
        for name, body in (("a/b.txt", b"one"), ("é.bin", bytes(range(256)) * 9)):
            with z.open(name, "w", force_zip64=zip64) as f:
                f.write(body)
        z.writestr("packed", b"0" * 100, zipfile.ZIP_DEFLATED)
        z.comment = b"PK\x05\x06 in a comment"
    size = len(buffer.getvalue())
    found = warc.members(buffer, size)
    assert set(found) == {"a/b.txt", "é.bin"}
    start, n = found["é.bin"]
    assert buffer.getvalue()[start : start + n] == bytes(range(256)) * 9
    assert (b"PK\x06\x07" in buffer.getvalue()) == zip64
    with pytest.raises(ValueError):
        warc.members(io.BytesIO(b"no zip here"), 11)


@pytest.mark.parametrize("packed", [False, True])
def test_package_from_elsewhere(spark, tmp_path, packed):
    """Two archives with names of their own, one of them not gzipped, two indexes of CDXJ lines with keys and timestamps."""
    path = f"{tmp_path}/other.wacz"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        for k, name in enumerate(("one.warc.gz", "two.warc")):
            body, lines = b"", []
            for i in range(3):
                html = f"{k}-{i}".encode()
                raw = warc.record(10 * k + i, f"http://h.x/{i}", "response", base64.b32encode(hashlib.sha1(html).digest()).decode(), None, len(html), html)
                raw = raw.replace(b"urn:page:2>", b"urn:uuid:ab-2>") if i == 2 else raw
                raw = raw if k else gzip.compress(raw)
                lines.append(f"x,h)/{i} 20240101000000 " + json.dumps({"offset": str(len(body)), "length": str(len(raw)), "filename": name}))
                body += raw
            z.writestr(f"archive/{name}", body)
            index = "\n".join(lines).encode()
            z.writestr(f"indexes/{k}.cdx.gz" if packed else f"indexes/{k}.cdxj", gzip.compress(index) if packed else index)
    got = warc.read_packages(spark.createDataFrame([(path,)], "path string")).collect()
    assert sorted((r["url"][-1], bytes(r["payload"])) for r in got) == sorted((str(i), f"{k}-{i}".encode()) for k in range(2) for i in range(3))
    assert {r["page_id"] for r in got} == {0, 1, None, 10, 11, 12}


def test_damaged_payload_is_told():
    raw = warc.record(1, None, "response", "A" * 32, None, 1, b"x")
    with pytest.raises(ValueError):
        warc.parse(raw)
    assert gzip.decompress(gzip.compress(raw)) == raw


# --- 7 --------------------------------------------------------------------------------------------------------------------


def test_shards_fit(spark, docs, empty):
    for limit in (1 << 26, 4000, 300):
        got = sharding.shard(odd(docs), limit, 0).collect()
        assert len(got) == len(TEXTS)
        sums, counts = Counter(), Counter()
        for r in got:
            assert r["n_bytes"] == len(data(r["text"]))
            sums[r["shard"]] += r["n_bytes"]
            counts[r["shard"]] += 1
        for r in got:
            assert r["shard_bytes"] == sums[r["shard"]] and r["oversize"] == (sums[r["shard"]] > limit)
            assert not r["oversize"] or r["n_bytes"] > limit
        names = sorted(x.split(".")[0] for x in sums)
        assert not any(b.startswith(a) and a != b for a, b in zip(names, names[1:], strict=False))  # no leaf below a leaf
    assert sharding.shard(empty).count() == 0


def test_shards_split_only_when_too_large(spark, docs):
    duckdb = pytest.importorskip("duckdb")
    from siftworks.llm.queries import sharding_sql

    frame = docs.select("doc_id", "text").toPandas()
    con = duckdb.connect()
    con.register("documents", frame)
    want = {tuple(r) for r in con.execute(sharding_sql(2000, fewest=0)).fetchall()}
    got = {(r["doc_id"], r["n_bytes"], r["depth"], r["shard"], r["shard_bytes"], r["oversize"]) for r in sharding.shard(docs, 2000, 0).collect()}
    assert got == want


def test_rows_alike_are_dealt_out(spark):
    rows = spark.createDataFrame([(1, "x" * 10)] * 25 + [(None, None)] * 3, "doc_id long, text string").repartition(4)
    got = sharding.shard(rows, 40, 0).collect()
    sums = Counter()
    for r in got:
        sums[r["shard"]] += r["n_bytes"]
    assert len(got) == 28 and max(sums.values()) <= 40 and sum(sums.values()) == 250
    assert all(r["shard_bytes"] == sums[r["shard"]] for r in got)


@pytest.mark.parametrize("few", [True, False])
def test_a_third_of_the_rows_alike_meet_in_no_task(spark, monkeypatch, few):
    """By either way to the leaves, with adaptive execution off: no task of the shuffles gets the rows that are alike."""
    monkeypatch.setattr(sharding, "BROADCAST_DEPTHS", 99 if few else 0)
    rows = spark.createDataFrame([(1, "y" * 20)] * 500 + [(k, "z" * (k % 50)) for k in range(1000)], "doc_id long, text string").repartition(6)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = sharding.shard(rows, 400, 0)
        got = found.withColumn("p", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    sums = Counter()
    for r in got:
        sums[r["shard"]] += r["n_bytes"]
    assert len(got) == 1500 and max(sums.values()) <= 400 and all(r["shard_bytes"] == sums[r["shard"]] for r in got)
    assert len({len(r["shard"].split(".")[0]) for r in got}) > 3


def test_small_tables_are_split_too(spark, docs):
    got = sharding.shard(docs).collect()
    total = sum(r["n_bytes"] for r in got)
    assert len({r["shard"] for r in got}) >= 10 and all(r["shard_bytes"] <= -(-total // sharding.FEWEST) or r["oversize"] for r in got)


# --- 8 --------------------------------------------------------------------------------------------------------------------


def labelled(n):
    bad = ["rotten", "vileness", "vilely", "horrid"]
    rows = []
    for i in range(n):
        words = prose(40).split(" ")
        if i % 5 == 0:
            for _ in range(1 + i % 3):
                words[rng.randrange(40)] = rng.choice(bad)
        rows.append((i, " ".join(words), int(i % 5 == 0)))
    return rows


def test_toxicity_on_held_out_rows(spark):
    rows = labelled(800)
    frame = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(9000, None), (9001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows[:500]] + [(None, 1), (3, None), (77777, 1), (1, 0)], "doc_id long, toxic int")
    model = toxicity.train(odd(frame), labels)
    again = toxicity.train(frame.repartition(5), labels)
    assert np.allclose(model.weights, again.weights) and model.thresholds[0] < model.thresholds[1]
    got = {r["doc_id"]: r for r in toxicity.grade(odd(frame), model).collect()}
    held = rows[500:]
    caught = [got[i]["toxic"] for i, _, y in held if y]
    assert sum(caught) >= 0.9 * len(caught) and not any(got[i]["toxic"] for i, _, y in held if not y)
    assert not got[9000]["toxic"] and got[9000]["severity"] == got[9001]["severity"] < 0.5
    assert all(0 <= r["severity"] <= 2 for r in got.values())
    kept = {r["doc_id"] for r in toxicity.without_toxic(frame, model).collect()}
    assert kept == {i for i, r in got.items() if not r["toxic"]}


def test_labels_of_absent_documents_take_no_place(spark):
    rows = [(k, "awful stupid words" if k % 3 == 0 else f"kind words number {k}") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    own = [(k, int(k % 3 == 0), 1) for k in range(60)]
    labels = lambda more: spark.createDataFrame(own + more, "doc_id long, toxic int, quality int")
    want = toxicity.train(docs, labels([]), most=60)
    got = toxicity.train(docs, labels([(1000 + k, k % 2, 1) for k in range(3000)]), most=60)
    assert len(want.numbers) and (got.numbers == want.numbers).all() and np.allclose(got.weights, want.weights)


def test_toxicity_without_labels(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(docs, none)
    assert toxicity.grade(docs, model).count() == len(TEXTS) and toxicity.grade(empty, model).count() == 0


def small_rows(n=60, m=4):
    own = np.random.default_rng(3)
    dense = own.random((n, m)) * (own.random((n, m)) < 0.5)
    score = dense @ np.array([4.0, -1.0, 2.0, 0.0]) + own.logistic(size=n)
    grades = (score > 1.5).astype(int) + (score > 3.0)
    rows, columns = np.nonzero(dense)
    return dense, toxicity.Rows(rows, columns, dense[rows, columns], grades, m)


def slow_loss(dense, grades, weights, thresholds, ridge):
    """From the definition, row by row: the chance of a grade is the difference of neighbouring P(grade > k)."""
    total = 0.0
    for x, g in zip(dense, grades, strict=True):
        above = [1.0, *(1 / (1 + math.exp(-(sum(w * v for w, v in zip(weights, x, strict=True)) - t))) for t in thresholds), 0.0]
        total -= math.log(above[g] - above[g + 1])
    return total / len(grades) + ridge / 2 * sum(w * w for w in weights)


def test_ordinal_loss_and_gradient():
    dense, data = small_rows()
    p = np.array([0.7, -0.4, 0.2, 0.1, 0.9, -0.3])
    loss, gradient = data.loss(p, 0.01)
    slow = lambda p: slow_loss(dense, data.grades, p[:4], (p[4], p[4] + math.exp(p[5])), 0.01)
    assert abs(loss - slow(p)) < 1e-9
    for k in range(len(p)):
        step = np.zeros(len(p))
        step[k] = 1e-5
        assert abs((slow(p + step) - slow(p - step)) / 2e-5 - gradient[k]) < 1e-6


def test_fit_is_the_best_there_is():
    """No step in any direction is better, by the definition; and a search that knows no gradient ends in the same place."""
    dense, data = small_rows()
    weights, thresholds = toxicity.fit_ordinal(data, ridge=0.01, rounds=3000)
    best = np.array([*weights, thresholds[0], math.log(thresholds[1] - thresholds[0])])
    slow = lambda p: slow_loss(dense, data.grades, p[:4], (p[4], p[4] + math.exp(p[5])), 0.01)
    p, width = np.zeros(6), 1.0
    while width > 1e-5:  # along one axis at a time
        moved = False
        for k in range(6):
            for d in (width, -width):
                q = p.copy()
                q[k] += d
                if slow(q) < slow(p):
                    p, moved = q, True
        width = width if moved else width / 2
    assert abs(slow(best) - slow(p)) < 1e-4 and np.allclose(best, p, atol=0.05)


def test_severity_against_brute_force(spark):
    """Features counted word by word, and the sum over thresholds of sigmoids."""
    texts = ["rotten Rotten day", "a vilely VILENESS, and a day", "", None, "é rottené 12 rot", prose(50)]
    numbers = np.unique(np.concatenate([toxicity.features(x)[0] for x in (b"rotten", b"vileness", b"day")]))
    model = toxicity.Model(numbers, np.linspace(-1, 2, len(numbers)), np.array([0.1, 1.3]))
    of = dict(zip(numbers.tolist(), model.weights.tolist(), strict=True))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in toxicity.grade(odd(frame), model).collect():
        words = re.findall(rb"[a-z\x80-\xff]+", data(texts[r["doc_id"]]).lower())
        counts = Counter(k for w in words for k in toxicity.features(w)[0].tolist())
        score = sum(of.get(k, 0) * math.log1p(n * 100 / len(words)) for k, n in counts.items())
        above = [1 / (1 + math.exp(-(score - t))) for t in (0.1, 1.3)]
        assert abs(r["severity"] - sum(above)) < 2e-6
        assert r["grade"] == sum(x >= 0.5 for x in above) and r["toxic"] == (above[0] >= 0.5)
    assert len(toxicity.features(b"vileness")[0]) == 6 and len(toxicity.features(b"day")[0]) == 1


def test_grades_come_from_the_labels(spark):
    rows = [(1, 1, 0, 0), (2, 1, 1, 1), (3, 0, 0, 2), (4, None, 0, None), (5, 1, None, 1), (6, 1, 0, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, toxic int, quality int, severity int")
    assert [r[0] for r in labels.orderBy("doc_id").select(toxicity.grade_of(labels)).collect()] == [2, 1, 0, None, 1, 2]
    bare = labels.drop("quality")
    assert [r[0] for r in bare.orderBy("doc_id").select(toxicity.grade_of(bare)).collect()] == [1, 1, 0, None, 1, 1]
    texts = spark.createDataFrame([(i, f"{['mild', 'bad', 'vile'][i % 3]} words {prose(5)}") for i in range(300)], "doc_id long, text string")
    graded = spark.createDataFrame([(i, i % 3) for i in range(300)], "doc_id long, severity int")
    model = toxicity.train(texts, graded, grade=F.col("severity"))
    got = {r["doc_id"]: r["grade"] for r in toxicity.grade(texts, model).collect()}
    assert sum(got[i] == i % 3 for i in got) >= 290


# --- 9 --------------------------------------------------------------------------------------------------------------------

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def slow_hits(rows, items, window=10):
    windows = defaultdict(set)
    for k, t in items:
        w = WORD.findall(data(t).lower())
        for a in range(max(1, len(w) - window + 1) if w else 0):
            windows[tuple(w[a : a + window])].add(k)
    sizes, out = {len(w) for w in windows}, {}
    for i, t in rows:
        w, hit, found = WORD.findall(data(t).lower()), set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                if named := windows.get(tuple(w[a : a + n])):
                    hit.update(range(a, a + n))
                    found |= named
        out[i] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(str(x) for x in found if x is not None)).encode()).hexdigest(), bool(hit))
    return out


@pytest.mark.parametrize(("bits", "most"), [(24, 1 << 17), (3, 1 << 17), (24, 0)])
def test_decontamination(spark, docs, empty, monkeypatch, bits, most):
    """With a bitmap that tells nothing apart, and with windows too many to be broadcast, too."""
    monkeypatch.setattr(decontaminate, "MOST", most)
    items = [(1, PASSAGE), (2, "one"), (3, " ".join(PASSAGE.split()[30:42]).upper()), (4, None), (5, "?!"), (6, "two, Words!"), (7, prose(40)), (7, prose(12)), (None, " ".join(BASE.split()[5:30])), (10, "For for for for")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.decontaminate(odd(docs), benchmark, bits=bits)
    got = {r[0]: tuple(r)[1:6] for r in found.collect()}
    assert got == slow_hits(enumerate(TEXTS), items) and sum(x[4] for x in got.values()) >= 8
    kept = decontaminate.without_contaminated(odd(docs), benchmark, bits=bits)
    assert kept.columns == odd(docs).columns and {r["doc_id"] for r in kept.collect()} == {i for i, x in got.items() if not x[4]}
    assert decontaminate.decontaminate(empty, benchmark).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.decontaminate(docs, benchmark.limit(0)).collect())


# --- 10 -------------------------------------------------------------------------------------------------------------------


def slow_targets(sizes, most=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    capped = set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        total = sum(w for s, w in weight.items() if s not in capped)
        over = {s for s in sizes if s not in capped and most * sizes[s] < left * weight[s] / max(total, 1) - 1e-9}
        if not over:
            return {s: most * sizes[s] if s in capped else left * weight[s] / max(total, 1) for s in sizes}
        capped |= over


def test_mixing(spark, docs, empty):
    rows = [(i, prose(rng.randint(0, 30)) if i % 11 else None, "en", "abcdefgh"[min(7, int(rng.expovariate(0.7)))], None) for i in range(400)] + [(None, "a b", "en", None, None)] * 2
    frame = odd(spark.createDataFrame(rows, SCHEMA).repartition(3))
    count = lambda t: len(re.findall(rb"[^\x20\x09-\x0D]+", data(t)))
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += count(t)
    want = slow_targets(sizes)
    got = mixing.mix(frame).collect()
    taken, largest = Counter(), Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert len(got) == len(rows) and abs(sum(want.values()) - sum(sizes.values())) < 1e-6
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6 for s in sizes)
    assert any(want[s] == 3 * sizes[s] for s in sizes)
    again = mixing.mix(frame.repartition(7)).collect()
    assert Counter((r["doc_id"], r["taken"]) for r in got) == Counter((r["doc_id"], r["taken"]) for r in again)
    carried = mixing.mix(frame, carry=("text", "lang"))
    assert Counter((r["doc_id"], r["taken"]) for r in carried.collect()) == Counter((r["doc_id"], r["taken"]) for r in got)
    assert mixing.mix(empty).count() == 0
    assert {r["taken"] for r in mixing.mix(docs.withColumn("text", F.lit(None).cast("string"))).collect()} == {0}


@pytest.mark.parametrize("kind", ["repeated", "nulls", "both", "empty"])
def test_mixing_of_rows_alike(spark, kind):
    """Each source within half a document of its target, however many of its rows are alike; the same in any order of rows."""
    row = {"repeated": lambda s, k: (7, f"{s} " * 10), "nulls": lambda s, k: (None, f"{s}{k} " * 10), "both": lambda s, k: ((None, f"{s} " * 9) if k % 2 else (k // 3, f"{s} " * 11)), "empty": lambda s, k: (None, None if k % 2 else f"{s} " * 10)}[kind]
    rows = [(*row(s, k)[:1], row(s, k)[1], "en", s, k) for s in ("a", "b", None) for k in range(100)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len((t or "").split())
    want = slow_targets(sizes)
    first = None
    for n in (5, 7):
        got = mixing.mix(frame.repartition(n), carry=("text",)).collect()
        taken = Counter()
        for r in got:
            assert r["size"] == len((r["text"] or "").split()) and r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
            taken[r["source"]] += r["taken"]
        assert len(got) == 300 and all(abs(taken[s] - want[s]) <= 11 / 2 for s in sizes)
        found = Counter((r["doc_id"], r["text"], r["source"], r["copies"]) for r in got)
        assert first in (None, found)
        first = found
    assert Counter((r["doc_id"], r["source"], r["taken"]) for r in mixing.mix(frame).collect()) == Counter((r["doc_id"], r["source"], r["taken"]) for r in got)


def test_carried_columns_that_clash_are_left_out(spark, docs):
    clashing = docs.withColumns({c: F.lit("x") for c in (*mixing.ADDED, "__key", "__more")})
    got = mixing.mix(clashing, carry=("text", "lang", "lang", *mixing.ADDED, "__key", "__more"))
    assert got.columns == ["doc_id", "source", "text", "lang", "size", "source_size", "target", "copies", "taken"]
    plain = {r["doc_id"]: (r["size"], r["taken"]) for r in mixing.mix(docs).collect()}
    assert {r["doc_id"]: (r["size"], r["taken"]) for r in got.collect()} == plain


def test_weights_go_round_in_order(spark):
    names = sorted({prose(1) for _ in range(60)} | {"Z", "é", ""}, key=str.encode) + [None]
    sources = spark.createDataFrame([(x,) for x in rng.sample(names, len(names))], "source string").repartition(5)
    got = {r["source"]: r["weight"] for r in mixing.cycle_weights(sources).collect()}
    assert got == {x: k % 3 + 1 for k, x in enumerate(names)}
    assert mixing.cycle_weights(sources.limit(0)).count() == 0


# --- what they share --------------------------------------------------------------------------------------------------------


def test_rows_meet_their_groups(spark, empty):
    rows = [("hot", i) for i in range(900)] + [(f"k{i % 50}", i) for i in range(300)] + [(None, 1)]
    frame = spark.createDataFrame(rows, "key string, i int").repartition(3)
    groups = common.cut(frame.where("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("i").alias("top")))
    for share in (4, 1024):
        joined = common.join_groups(frame, groups, "key", "n", share)
        got = Counter((r["key"], r["i"], r["n"], r["top"]) for r in joined.collect())
        tops = {k: (sum(a == k for a, _ in rows), max(i for a, i in rows if a == k)) for k in {a for a, _ in rows} - {None}}
        assert got == Counter((k, i, *tops[k]) for k, i in rows if k is not None)
    assert common.join_groups(frame.limit(0), groups.limit(0), "key", "n").count() == 0


def test_only_counted_tables_are_broadcast(spark):
    small = common.cut(spark.range(10))
    joined = lambda most: plan_of(spark.range(100).join(common.bounded(small, most), "id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in joined(10) and "BroadcastHashJoin" not in joined(9)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tables_are_written_and_forgotten(spark):
    df, path = common.settle(spark.createDataFrame([(1, "a"), (None, None)], "x int, y string"))
    assert sorted(map(tuple, df.collect()), key=repr) == [(1, "a"), (None, None)] and df.columns == ["x", "y"]
    assert common.settle(df.limit(0))[0].count() == 0
    common.forget(spark, path)
    assert not Path(path.removeprefix("file://")).exists()
    assert [tuple(r) for r in common.listed(spark, [(1, ["a", None]), (2, None)], {"n": pa.int32(), "l": pa.list_(pa.string())}).collect()] == [(1, ["a", None]), (2, None)]


# --- the queries and the pipeline -----------------------------------------------------------------------------------------

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    import os

    if not os.path.isdir(SF):
        pytest.skip("the driver's tables are not here")
    return SF


def test_queries_say_what_their_sql_says(spark, tables):
    duckdb = pytest.importorskip("duckdb")
    from siftworks.llm import queries

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"create view {t} as select * from '{tables}/{t}.parquet'")
    for name, sql in queries.ORACLE_SQL.items():
        df = queries.QUERIES[name](spark, tables)
        columns = sorted(df.columns)
        found = con.execute(sql)
        names = [d[0] for d in found.description]
        assert sorted(names) == columns, name
        plain = lambda v: round(v, 9) if isinstance(v, float) else v
        want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=repr)
        assert sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr) == want, name


def test_native_queries_stay_in_the_jvm(spark, tables):
    from siftworks.llm import queries

    for name in ("op3_tool_call_linking", "op4_exact_dedup", "op5_licence_scan", "op7_extendible_sharding"):
        plan = queries.QUERIES[name](spark, tables)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan), name


def test_pipeline_against_brute_force(spark, tables):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{tables}/documents.parquet")
    steps, now = [], docs
    for _, stage in pipeline.STAGES:
        now = stage(spark, now, tables).cache()
        steps.append([r.asDict() for r in now.collect()])
        assert len(steps) == len(pipeline.STAGES) or now.columns == docs.columns
    clean, unique, fair, mixed, sharded = steps
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{tables}/labels.parquet").collect()}
    gone = set(text) - {r["doc_id"] for r in clean}
    assert all(labels.get(i, 1) for i in gone)
    # near-duplicates: nothing that stays is similar to a smaller one, and what went has a partner
    shingles = lambda t: set(simhash.shingle_hashes(data(t), 5))
    before, after = {r["doc_id"] for r in clean}, {r["doc_id"] for r in unique}
    sets = {i: shingles(text[i]) for i in before}
    similar = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    pairs = [(a, b) for a in before for b in before if a < b and similar(a, b)]
    assert not [(a, b) for a, b in pairs if a in after and b in after]
    prints = {i: simhash.fingerprint(data(text[i]), 5) for i in before}
    for b in before - after:
        assert any(a != b and (similar(a, b) or (prints[a] ^ prints[b]).bit_count() <= 3) for a in before)
    items = [tuple(r) for r in spark.read.parquet(f"{tables}/benchmark.parquet").select("item_id", "text").collect()]
    hits = slow_hits([(i, text[i]) for i in after], items)
    assert {r["doc_id"] for r in fair} == {i for i, x in hits.items() if not x[4]}
    copies = Counter(r["doc_id"] for r in mixed)
    assert set(copies) <= {r["doc_id"] for r in fair} and max(copies.values()) <= 3
    sizes = Counter()
    for r in fair:
        sizes[r["source"]] += len(re.findall(rb"[^\x20\x09-\x0D]+", data(r["text"])))
    targets = slow_targets(sizes)
    for s, target in targets.items():
        own = [(len(re.findall(rb"[^\x20\x09-\x0D]+", data(r["text"]))), copies[r["doc_id"]]) for r in fair if r["source"] == s]
        assert abs(sum(n * c for n, c in own) - target) <= max((n for n, _ in own), default=0) / 2 + 1e-6
    assert Counter(r["doc_id"] for r in sharded) == copies
    got = pipeline.run(spark, tables)
    assert Counter(r["doc_id"] for r in got.collect()) == copies
