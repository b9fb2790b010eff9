"""Benchmark decontamination by a prefix-filtered set join over item-sized windows.

A window is a run of consecutive item words (an item with fewer words is one window). As a set it is its shingles of five words
(an item with fewer words: the whole of it). A document that contains a window contains all its shingles, so with the shingles
ordered by rarity over all documents the necessary prefix is one token: the rarest.

1. One scan of the documents counts the benchmark's shingles in all of them. A join with the windows' shingles gives each window
   its rarest one.
2. A second scan, for the whole benchmark at once, hands out where documents have such a token, with the few words around it.
   These are joined with the windows by token; where the token stands in its window bounds where the window would start
   (positional bound) and whether it fits the document (length bound); what is left is compared word for word.
3. What was found is reduced to one row per text, which goes back to the documents that have it.

Documents are read in place; only tokens that may be the benchmark's leave a scan. Which those are is told by a bitmap of
2^FILTER_BITS leading bits of hashes (2 MiB): a larger benchmark fills it and lets more pass, but loses none. Windows, tokens and
items are tables throughout; the driver holds nothing but the bitmaps.

Defined cases: null texts have no words; items without words have no windows; an empty benchmark hits nothing; an item without
an item_id marks words and counts as one item but has no name in the list; rows that repeat an item_id are one item; documents
are judged by their texts, repeated ones alike; empty tables give no rows, or no hits; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.llm.arrow import U, as_bytes, shingles, slices, word_table, words
from siftworks.llm.common import bounded, cut, scratch, text_or_empty

LETTERS = word_table("0123456789abcdefghijklmnopqrstuvwxyz")
WINDOW, SHINGLE = 10, 5
FILTER_BITS = 24
#: Rows of windows, a few hundred bytes each, that are broadcast; more are joined by a shuffle.
MOST = 1 << 17
CANDIDATE = pa.struct([("size", pa.int32()), ("token", pa.int64()), ("at", pa.int32()), ("first", pa.int32()), ("context", pa.string())])


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """item_id (as text) and window (its words joined by blanks), each pair once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for item_id, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
                low = text.lower()
                starts, ends, _ = words(low, LETTERS)
                own = [low[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                found = sorted({" ".join(own[at : at + window]) for at in range(max(1, len(own) - window + 1))}) if own else []
                yield pa.RecordBatch.from_arrays([pa.array([item_id] * len(found), pa.string()), pa.array(found, pa.string())], names=["item_id", "window"])

    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return cut(rows.mapInArrow(run, "item_id string, window string").distinct())


def window_tokens(windows: DataFrame, shingle: int) -> DataFrame:
    """Per shingle of each window: window, n (its words), size (words of a shingle), place and token (the shingle's hash)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows: list[tuple] = []
            for window in batch.column(0).to_pylist():
                hashes = words(window.encode(), LETTERS)[2]
                size = min(shingle, len(hashes))
                rows += [(window, len(hashes), size, k, x) for k, x in enumerate(shingles(hashes, size).view(np.int64).tolist())]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], names=["window", "n", "size", "place", "token"])

    return cut(windows.mapInArrow(run, "window string, n int, size int, place int, token bigint"))


def bitmap(tokens: DataFrame, bits: int) -> Broadcast:
    """Which leading bits the tokens have, and their sizes. 2^bits numbers at most come to the driver."""
    leading = F.shiftrightunsigned("token", 64 - bits).cast("int").alias("k")
    held = np.zeros(1 << bits, dtype=bool)
    held[tokens.select(leading).distinct().toArrow().column(0).to_numpy()] = True
    sizes = sorted(r[0] for r in tokens.select("size").distinct().collect())  # as many as a shingle has words
    return tokens.sparkSession.sparkContext.broadcast((np.packbits(held), sizes))


def passing(hashes: np.ndarray, held: np.ndarray, bits: int) -> np.ndarray:
    """Places of the hashes whose leading bits are marked."""
    k = (hashes >> U(64 - bits)).astype(np.int64)
    return np.flatnonzero((held[k >> 3] >> (7 - (k & 7))) & 1)


def token_counts(docs: DataFrame, tokens: DataFrame, bits: int) -> DataFrame:
    """size, token and n: how often each of the tokens stands in the documents, and maybe others."""
    marked = bitmap(tokens, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sizes = marked.value
        for batch in slices(batches):
            found: list[list[np.ndarray]] = [[] for _ in sizes]
            for text in as_bytes(batch.column(0)):
                hashes = words(text.lower(), LETTERS)[2]
                for own, size in zip(found, sizes, strict=True):
                    every = shingles(hashes, size)
                    own.append(every[passing(every, held, bits)])
            for own, size in zip(found, sizes, strict=True):
                token, n = np.unique(np.concatenate(own), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(token), size, np.int32)), pa.array(token.view(np.int64)), pa.array(n.astype(np.int64))], names=["size", "token", "n"])

    texts = docs.select(F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "size int, token bigint, n bigint").groupBy("size", "token").agg(F.sum("n").alias("often"))


def window_prefixes(docs: DataFrame, tokens: DataFrame, bits: int) -> DataFrame:
    """window, n, size, place, token: the shingle of each window that is rarest in the documents (ties: the smaller hash)."""
    counts = token_counts(docs, tokens, bits)
    ranked = tokens.join(counts, ["size", "token"], "left").withColumn("often", F.coalesce("often", F.lit(0).cast("bigint")))
    chosen = ranked.groupBy("window").agg(F.min(F.struct("often", "token", "place", "size", "n")).alias("c"))
    return cut(chosen.select("window", "c.n", "c.size", "c.place", "c.token"))


def key_of() -> Column:
    """What stands for a text."""
    return F.md5(text_or_empty())


def look(docs: DataFrame, prefixes: DataFrame, window: int, bits: int) -> DataFrame:
    """Per document: doc_id, key, n_words, and candidates: tokens that may be a prefix, where they stand, and the words around."""
    marked = bitmap(prefixes, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sizes = marked.value
        for batch in slices(batches):
            counts, found = [], []
            for text in as_bytes(batch.column(2)):
                low = text.lower()
                starts, ends, hashes = words(low, LETTERS)
                n, own = len(starts), []
                for size in sizes:
                    every = shingles(hashes, size)
                    at = passing(every, held, bits)
                    for k, token in zip(at.tolist(), every[at].view(np.int64).tolist(), strict=True):
                        first, last = max(0, k - (window - size)), min(n, k + window)
                        context = b" ".join(low[a:b] for a, b in zip(starts[first:last].tolist(), ends[first:last].tolist(), strict=True))
                        own.append({"size": size, "token": token, "at": k, "first": first, "context": context.decode()})
                counts.append(n)
                found.append(own)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(found, pa.list_(CANDIDATE))], names=["doc_id", "key", "n_words", "candidates"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, key string, n_words bigint, candidates array<struct<size: int, token: bigint, at: int, first: int, context: string>>"
    return docs.select("doc_id", key_of().alias("key"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def occurrences(looked: DataFrame, prefixes: DataFrame) -> DataFrame:
    """key, start, end (words) and window of each window in each text, once."""
    found = looked.where(F.size("candidates") > 0).select("key", "n_words", F.explode("candidates").alias("c")).select("key", "n_words", "c.*")
    start = (F.col("at") - F.col("place")).cast("bigint")
    joined = found.join(bounded(prefixes, MOST), ["size", "token"]).withColumn("start", start).withColumn("end", start + F.col("n"))
    inside = joined.where("start >= 0 and end <= n_words")
    here = F.array_join(F.slice(F.split("context", " "), (F.col("start") - F.col("first") + 1).cast("int"), F.col("n")), " ")
    return inside.where(here == F.col("window")).select("key", "start", "end", "window").distinct()


def merged(spans: Column) -> Column:
    """Sorted spans without overlaps."""
    last = lambda acc: F.element_at(acc, -1)
    grown = lambda acc, x: F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last(acc)["start"].alias("start"), F.greatest(last(acc)["end"], x["end"]).alias("end"))))
    empty = F.array().cast("array<struct<start: bigint, end: bigint>>")
    return F.reduce(spans, empty, lambda acc, x: F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] >= x["start"]), grown(acc, x)).otherwise(F.concat(acc, F.array(x))))


def judged(looked: DataFrame, prefixes: DataFrame, named: DataFrame) -> DataFrame:
    """Of each text with a window: key, spans (word ranges, merged), n_items, items (sorted)."""
    hits = cut(occurrences(looked, prefixes))
    spans = hits.groupBy("key").agg(merged(F.array_sort(F.collect_set(F.struct("start", "end")))).alias("spans"))
    items = hits.select("key", "window").distinct().join(bounded(named, MOST), "window").select("key", "item_id").distinct()
    items = items.groupBy("key").agg(F.count(F.lit(1)).alias("n_items"), F.array_sort(F.collect_set("item_id")).alias("items"))
    return spans.join(items, "key")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, bits: int | None = None) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans (word ranges) and items."""
    bits = bits or FILTER_BITS
    named = item_windows(benchmark, window)
    prefixes = window_prefixes(docs, window_tokens(named.select("window").distinct(), shingle), bits)
    path = scratch(docs.sparkSession, "looked")
    look(docs, prefixes, window, bits).write.parquet(path)
    looked = docs.sparkSession.read.parquet(path)
    found = cut(judged(looked, prefixes, named))
    none = F.array().cast("array<string>")
    items, spans = F.coalesce("items", none), F.coalesce("spans", F.array().cast("array<struct<start: bigint, end: bigint>>"))
    n_hit = F.reduce(spans, F.lit(0).cast("bigint"), lambda n, x: n + x["end"] - x["start"])
    rows = looked.select("doc_id", "key", "n_words").join(bounded(found, MOST), "key", "left")
    return rows.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), F.col("spans").isNotNull().alias("contaminated"), spans.alias("spans"), items.alias("items"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, bits: int | None = None) -> DataFrame:
    """The rows of docs that no window hits, with all their columns. Rows without a doc_id are judged by their text alone."""
    bits = bits or FILTER_BITS
    named = item_windows(benchmark, window)
    prefixes = window_prefixes(docs, window_tokens(named.select("window").distinct(), shingle), bits)
    hits = cut(occurrences(look(docs, prefixes, window, bits), prefixes).select("key").distinct())
    name = next(c for c in (f"__text_key{k}" for k in range(len(docs.columns) + 1)) if c not in docs.columns)
    return docs.withColumn(name, key_of()).join(bounded(hits.withColumnRenamed("key", name)), name, "left_anti").select(docs.columns)
