"""Histories of keys, late rows by date, streams that let a key pass once, and counters over runs."""

import datetime
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siftworks.operators import counters
from siftworks.operators.history import History
from siftworks.streaming import keyed, upsert

rng = random.Random(9)
DAY = datetime.date(2024, 1, 1)


def test_history_over_runs(spark, tmp_path):
    path, seen = f"file://{tmp_path}/history", {}
    before = {t.name for t in spark.catalog.listTables()}  # queries over histories, run by other tests, leave theirs
    for run in range(4):
        keys = [f"k{rng.randrange(60)}" for _ in range(40)] + ["hot"] * 300 + [None, "", "é"]
        history = History(spark, path, buckets=3 + run)  # the first counts
        assert history.buckets == 3
        rows = spark.createDataFrame([(k, j) for j, k in enumerate(keys)], "domain string, n int")
        new = {k for k in keys if k is not None and k not in seen}
        assert sorted(r[0] for r in history.pending(rows, "domain").collect()) == sorted(new)
        assert Counter(r["domain"] for r in history.rows_pending(rows, "domain").collect()) == Counter(k for k in keys if k in new)
        history.add(rows, "domain", f"run{run}")
        seen |= {k: f"run{run}" for k in new}
        assert {r["key"]: r["run"] for r in history.keys().collect()} == seen and history.keys().count() == len(seen)
        if run == 2:
            files = len(history.keys().inputFiles())
            history.compact()
            assert len(history.keys().inputFiles()) < files
            assert {r["key"]: r["run"] for r in history.keys().collect()} == seen
        assert history.name in {t.name for t in spark.catalog.listTables()}
        history.close()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_history_is_read_as_it_lies(spark, tmp_path):
    history = History(spark, f"file://{tmp_path}/history", buckets=5)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        history.add(spark.range(1000).withColumn("id", F.col("id").cast("string")), "id", "first")
        plan = history.pending(spark.range(990, 1100).withColumn("id", F.col("id").cast("string")), "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    right = plan[plan.index("FileScan parquet") - 400 :]
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 1 and plan.index("Exchange") < plan.index("FileScan parquet")  # the candidates' side only
    assert re.search("Filter.*shiftright", right) and "Bucketed: true" in right
    history.close()


SCHEMA = "id long, dt date, at int, value string"


def merge(held, rows, order):
    for r in rows:
        k = (r[0], r[1])
        rank = lambda x, new: ((x[2] if x[2] is not None else -1) if order else 0, new)
        if k not in held or rank(r, 1) > rank(held[k], 0):
            held[k] = r


@pytest.mark.parametrize("order", ["at", None])
def test_late_rows_are_merged(spark, tmp_path, order):
    schema = spark.createDataFrame([], SCHEMA).schema
    table, held = upsert.DatedTable(spark, f"file://{tmp_path}/dated", schema, ["id"], order), {}
    assert table.rows().count() == 0
    for number in range(4):
        keys = rng.sample(range(40), 25)
        rows = [(k, rng.choice([None, DAY, DAY + datetime.timedelta(1 + number)]), rng.choice([None, 1, 2, 3]), f"{number}-{k}") for k in keys] if number != 2 else []
        merge(held, rows, order)
        batch = spark.createDataFrame(rows, SCHEMA).repartition(3)
        for _ in range(2):  # the same batch once more changes nothing
            table.upsert(batch, number)
            assert sorted(map(tuple, table.rows().collect()), key=repr) == sorted(held.values(), key=repr)
    before = Counter(map(tuple, table.rows().collect()))
    assert table.vacuum() > 0 and table.vacuum() == 0
    assert Counter(map(tuple, table.rows().collect())) == before


def test_a_batch_that_failed_half_way_comes_again(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    table = upsert.DatedTable(spark, f"file://{tmp_path}/dated", schema, ["id"])
    table.upsert(spark.createDataFrame([(1, DAY, 1, "a"), (1, DAY, 1, "b")], SCHEMA), 0)
    assert [r["value"] for r in table.rows().collect()] == ["b"]
    spark.createDataFrame([(9, 1, "half", DAY)], "id long, at int, value string, dt date").write.partitionBy("dt").parquet(f"file://{tmp_path}/dated/data/batch=1")
    assert [r["value"] for r in table.rows().collect()] == ["b"]
    table.upsert(spark.createDataFrame([(2, DAY, 1, "c")], SCHEMA), 1)
    assert sorted(r["value"] for r in table.rows().collect()) == ["b", "c"]


def test_other_dates_are_not_written(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    table = upsert.DatedTable(spark, f"file://{tmp_path}/dated", schema, ["id"])
    table.upsert(spark.createDataFrame([(1, DAY, 1, "a"), (2, DAY + datetime.timedelta(1), 1, "b")], SCHEMA), 0)
    table.upsert(spark.createDataFrame([(3, DAY, 1, "c")], SCHEMA), 1)
    assert sorted((r["dt"].day, r["batch"]) for r in table.versions().collect()) == [(1, 1), (2, 0)]


def test_late_files_of_a_stream(spark, tmp_path):
    """Rows 1 and 2, then a late 3 of the same day: all stay."""
    schema = spark.createDataFrame([], SCHEMA).schema
    source, state = f"file://{tmp_path}/in", f"file://{tmp_path}/state"
    table = upsert.DatedTable(spark, f"file://{tmp_path}/dated", schema, ["id"])
    for rows in ([(1, DAY, 1, "a"), (2, DAY, 1, "b")], [(3, DAY, 1, "c"), (2, DAY, 1, "B")]):
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(source)
        upsert.run_upserts(spark, source, schema, lambda df: df, table, state)
    assert sorted((r["id"], r["value"]) for r in table.rows().collect()) == [(1, "a"), (2, "B"), (3, "c")]


def test_each_key_passes_once(spark, tmp_path):
    schema = spark.createDataFrame([], "k long, ts timestamp").schema
    source, out, state = (f"file://{tmp_path}/{x}" for x in ("in", "out", "state"))
    for k in range(3):
        spark.range(k * 10, k * 10 + 25).select(F.col("id").alias("k"), F.lit(datetime.datetime(2024, 1, 1, k)).alias("ts")).write.mode("append").parquet(source)
        keyed.run_new_keys(spark, source, schema, ["k"], out, state)
        assert spark.read.parquet(out).count() == spark.read.parquet(out).distinct().count() == 25 + 10 * k
    late = f"file://{tmp_path}/late"
    for k in (0, 5):  # after an hour a key is forgotten
        spark.range(3).select(F.col("id").alias("k"), F.lit(datetime.datetime(2024, 1, 1, k)).alias("ts")).write.mode("append").parquet(f"{source}2")
        spark.range(3).select((F.col("id") + 100).alias("k"), F.lit(datetime.datetime(2024, 1, 1, k + 3)).alias("ts")).write.mode("append").parquet(f"{source}2")
        keyed.run_new_keys(spark, f"{source}2", schema, ["k"], late, f"{state}2", "ts", "1 hour")
    assert spark.read.parquet(late).where("k < 100").count() == 6


def test_counters_merge_run_by_run(spark):
    rows = spark.range(20_000).select((F.col("id") % 3).alias("day"), (F.col("id") % 7000).alias("user"), F.lit(2).alias("value"))
    parts = [rows.where(F.col("user") % 4 == k) for k in range(4)]
    each = [counters.summary(p, ["day"], {"value": F.col("value")}, {"users": F.col("user")}) for p in parts]
    together = each[0]
    for x in each[1:]:
        together = counters.merged(together.unionByName(x), ["day"], ["value"], ["users"])
    exact = {r[0]: r for r in rows.groupBy("day").agg(F.count(F.lit(1)), F.sum("value"), F.countDistinct("user")).collect()}
    for r in counters.estimated(together, ["users"]).collect():
        want = exact[r["day"]]
        assert (r["rows"], r["value"]) == (want[1], want[2]) and abs(r["users"] - want[3]) <= counters.error_of() * want[3]
