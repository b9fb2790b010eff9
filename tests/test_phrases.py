"""Rules as a table against plain searches."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftworks import rules
from siftworks.functions import classify
from siftworks.operators import membership, phrases

rng = random.Random(3)
LETTERS = "abcdeé漢🙂 .\n"


def word(least, most):
    return "".join(rng.choice(LETTERS) for _ in range(rng.randint(least, most)))


def test_hits_against_searches(spark):
    texts = [(k, word(0, 80)) for k in range(60)] + [(100, word(3000, 3000)), (101, None), (102, ""), (103, "🙂" * 700 + "needle" + "é" * 700), (None, word(40, 40)), (104, "abc"), (104, word(30, 30))]
    wanted = [word(1, 6) for _ in range(300)] + ["needle", "🙂n", "eé", "🙂" * 600, "a", "", None, "needle", texts[60][1][500:1900], "\n", "🙂"]
    df = spark.createDataFrame(texts, "key long, text string").withColumn("piece", F.lit("x")).repartition(3)
    found = phrases.hits(df, spark.createDataFrame([(w,) for w in wanted], "phrase string"))
    want = {(k, w) for k, t in texts for w in wanted if w and t is not None and w in t}
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert not re.search("NestedLoop|Cartesian", found._jdf.queryExecution().toString())


def test_counts_and_bands_against_searches(spark, monkeypatch):
    """Phrases of all lengths and texts above a chunk; counts in parts; rules in several bands."""
    for name, value in (("CHUNK", 256), ("BAND", 16), ("WIDER", 2), ("HELD", 50)):
        monkeypatch.setattr(phrases, name, value)
    texts = [(k, word(0, 60)) for k in range(150)] + [(200, None), (None, word(40, 40)), (201, word(900, 900)), (202, "a" * 800), (203, word(30, 30)), (203, word(30, 30))]
    wanted = list(dict.fromkeys([word(1, 5) for _ in range(250)] + [texts[152][1][100:400], texts[152][1][250:700], "a" * 300, "a" * 65, "\U0001f642" * 70]))
    df = spark.createDataFrame(texts, "key long, text string").repartition(3)
    named = spark.createDataFrame([(w,) for w in [*wanted, "", None]], "phrase string")
    want = {w: n for w in wanted if (n := sum(t is not None and w in t for _, t in texts))}
    assert dict(map(tuple, phrases.counts(df, named).collect())) == want
    rules_ = [(rng.randint(0, 60), rng.choice("xyz"), w) for w in [*wanted, *wanted[:40]]]
    first = {k: min(((p, x) for p, x, w in rules_ for key, t in texts if key == k and t is not None and w in t), default=(0, "else"))[1] for k, _ in texts}
    got = phrases.first_rule(df, spark.createDataFrame(rules_, "priority int, label string, phrase string"), "else")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(first.items(), key=str)


def test_places_are_not_looked_up_for_each_length(spark, monkeypatch):
    """Phrases of 40 lengths, of which few beginnings are in the texts: fewer looks into the filter than there are places."""
    plain = random.Random(5)
    wanted = ["".join(plain.choice("abcdefgh") for _ in range(5 + k % 40)) for k in range(2000)]
    texts = ["".join(plain.choice("abcdefghijklmnop") for _ in range(3000)) + w for w in wanted[:20]]
    looks, marked = [], phrases.marked
    scan = phrases.Scan(*phrases.scan_of(phrases.named(spark.createDataFrame([(w,) for w in wanted], "phrase string"))).value, phrases.CHUNK)
    monkeypatch.setattr(phrases, "marked", lambda at, held: looks.append(len(at)) or marked(at, held))
    list(scan.may_be([t.encode() for t in texts]))
    assert 0 < sum(looks) < sum(map(len, texts))


@pytest.mark.parametrize("codes", [1, 40, 1 << 60])
def test_strings_of_one_code_are_told_apart(codes):
    """Equal strings always have one code; others may share it, of one size or several."""
    plain = random.Random(codes)
    raw = "".join(plain.choice("ab") for _ in range(400)).encode()
    where = [(plain.randrange(350), plain.choice([3, 8, 9, 17, 30])) for _ in range(600)]
    grams = [raw[i : i + k] for i, k in where]
    code = [hash(g) % codes for g in grams]
    at, size = (np.array(x) for x in zip(*where, strict=True))
    number, one = phrases.alike(np.frombuffer(raw + bytes(8), np.uint8), at, size, np.array(code, dtype=np.uint64))
    assert [grams[one[k]] for k in number] == grams and len(one) == len(set(grams)) and sorted(set(number.tolist())) == list(range(len(one)))
    kept, starts = phrases.strings(np.frombuffer(raw, np.uint8), at, size)
    assert kept.tobytes() == b"".join(grams) and starts[-1] == len(kept)


def test_given_rules_as_a_table(spark):
    table = spark.createDataFrame([(k, label, w) for k, (label, words) in enumerate(rules.PRODUCT) for w in words], "priority int, label string, phrase string")
    words = [w for _, ws in rules.PRODUCT for w in ws]
    texts = [(k, " ".join(rng.choice([*words, "plain", "and"]) for _ in range(rng.randint(0, 3)))) for k in range(200)] + [(500, None)]
    df = spark.createDataFrame(texts, "key long, text string")
    want = {tuple(r) for r in df.select("key", classify.product_category(F.coalesce("text", F.lit("")))).collect()}
    assert {tuple(r) for r in phrases.first_rule(df, table, rules.PRODUCT_ELSE).collect()} == want


def test_a_hundred_thousand_phrases(spark):
    """Each is found where it stands, all in one join."""
    n = 100_000
    named = spark.range(n).select(F.concat(F.substring(F.md5(F.col("id").cast("string")), 1, 9), F.lit("-"), F.col("id").cast("string")).alias("phrase"))
    placed = named.withColumn("key", F.crc32("phrase") % 50).where("key > 0")
    texts = placed.groupBy("key").agg(F.array_join(F.collect_list("phrase"), " ").alias("text"))
    found = phrases.hits(texts, named).cache()
    assert found.count() == placed.count() and placed.select("key", "phrase").exceptAll(found).count() == 0


@pytest.mark.parametrize("table", [[], [(1, "x", None), (2, "y", "")]])
def test_no_rules_and_no_texts(spark, table):
    named = spark.createDataFrame(table, "priority int, label string, phrase string")
    texts = spark.createDataFrame([(1, "a"), (2, None)], "key long, text string")
    assert phrases.hits(texts, named).count() == 0
    assert sorted(map(tuple, phrases.first_rule(texts, named, "else").collect())) == [(1, "else"), (2, "else")]
    rule = spark.createDataFrame([(1, "x", "a"), (1, "w", "a"), (0, "z", "b")], "priority int, label string, phrase string")
    assert phrases.first_rule(texts.limit(0), rule, "else").count() == 0
    assert sorted(map(tuple, phrases.first_rule(texts, rule, None).collect())) == [(1, "w"), (2, None)]


def test_filters_let_all_members_pass(spark):
    keys = spark.range(5000).select((F.col("id") * 7).cast("string").alias("k"))
    test = membership.membership(keys, "k")
    assert keys.where(test(F.col("k"))).count() == 5000
    assert spark.range(100_000).select(F.concat(F.lit("other"), "id").alias("k")).where(test(F.col("k"))).count() < 3000
    assert membership.membership(spark.range(membership.MOST_BITS).select(F.col("id").cast("string").alias("k")), "k") is None
    none = membership.membership(keys.limit(0), "k")
    assert keys.where(none(F.col("k"))).count() == 0
