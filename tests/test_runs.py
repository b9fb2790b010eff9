"""Runs that stop and go on."""

import datetime

import pytest
from pyspark.sql import functions as F

from siftworks import session
from siftworks.operators import labelling, leads, runs
from siftworks.streaming.incremental import run_once


def test_days_are_done_oldest_first_until_time_is_up(spark):
    days = spark.createDataFrame([(datetime.date(2024, 1, k),) for k in (3, 1, 2, 1)], "dt date")
    done, times = [], iter([0, 0, 50, 100])
    assert runs.run_days(days, done.append, max_runtime=100, clock=lambda: next(times)) == done == [datetime.date(2024, 1, 1), datetime.date(2024, 1, 2)]

    def fails(one):
        if one.day == 2:
            raise RuntimeError
        done.append(one)

    done.clear()
    with pytest.raises(RuntimeError):
        runs.run_days(days, fails)
    assert done == [datetime.date(2024, 1, 1)]
    assert runs.run_days(days.limit(0), done.append) == []


def test_a_day_that_fails_is_tried_again(spark):
    days = spark.createDataFrame([(datetime.date(2024, 1, k),) for k in (1, 2)], "dt date")
    tried, waits = [], []

    def step(one):
        tried.append(one.day)
        if one.day == 1 and len(tried) < 3 or one.day == 2:
            raise OSError

    with pytest.raises(OSError):
        runs.run_days(days, step, tries=3, sleep=waits.append)
    assert tried == [1, 1, 1, 2, 2, 2] and waits == [5, 10, 5, 10]


@pytest.mark.parametrize("steady", [True, False])
def test_rows_with_one_key_are_numbered_by_many_tasks(spark, steady):
    """Half of the rows have one key, and all of those are alike: no range has more than a small share."""
    rows = spark.range(0, 4000, numPartitions=3).selectExpr("if(id % 2 = 0, 'hot', cast(id as string)) as k", "1 as x")
    seen = labelling.numbered(rows, "k", ranges=16, steady=steady)
    assert sorted(r["place"] for r in seen.collect()) == list(range(4000))
    ordered = [r["k"] for r in seen.orderBy("place").collect()]
    assert ordered == sorted(ordered)
    told = rows.withColumn("t", F.monotonically_increasing_id()).repartitionByRange(16, "k", "t").withColumn("p", F.spark_partition_id())
    assert told.groupBy("p").count().agg(F.max("count")).first()[0] < 4000 / 8


def test_todays_day_is_last_and_done_anew(spark):
    days = spark.createDataFrame([(datetime.date(2024, 1, k),) for k in (1, 2, 3, 9)], "dt date")
    archive = spark.createDataFrame([(datetime.date(2024, 1, 2), "x" * 60), (datetime.date(2024, 1, 3), "y" * 60)], "dt date, head string")
    got = [r[0].day for r in runs.due(days, archive, datetime.date(2024, 1, 3)).collect()]
    assert got == [1, 3]
    assert [r[0].day for r in runs.due(days, archive, datetime.date(2024, 1, 3), first_only=True).collect()] == [1]
    assert spark.range(1).select(runs.run_day() == F.current_date()).first()[0]


def test_settings(spark):
    assert runs.settings(spark, {}) == runs.Settings(None, None, 19800)
    spark.conf.set("siftworks.model", "of the session")
    try:
        assert runs.settings(spark, {"SIFTWORKS_MODEL": "of the environment"}).model == "of the session"
    finally:
        spark.conf.unset("siftworks.model")
    with pytest.raises(ValueError):
        runs.settings(spark, {"SIFTWORKS_MAX_RUNTIME": "soon"})


def test_a_scan_of_nothing_and_a_broken_one(spark, tmp_path):
    base = f"file://{tmp_path}/scan"
    none = spark.createDataFrame([], "domain string")
    runs.scan(spark, none, base, lambda url: (200, ""))
    assert runs.tried_in(spark, base).count() == 0
    some = spark.createDataFrame([("a.com",), (" a.com ",), ("b.com",), (None,)], "domain string")
    enrich = leads.enrich
    leads.enrich = None  # the run ends once the domains are tried
    try:
        with pytest.raises(TypeError):
            runs.scan(spark, some, base, lambda url: (200, f"shopify {url}"))
    finally:
        leads.enrich = enrich
    assert runs.tried_in(spark, base).count() == 2

    def never(url):
        raise AssertionError

    runs.scan(spark, some, base, never)
    assert sorted(r["Domain"] for r in spark.read.parquet(f"{base}/leads").collect()) == ["a.com", "b.com"]
    assert runs.tried_in(spark, base).count() == 2


def test_translation_is_asked_for_foreign_texts_only(spark):
    pages = spark.createDataFrame([("a.com", "<p>ééééééééééé ééééééééééé ééééé</p><meta name='description' content='ééééééééééééé'>"), ("b.com", "<p>plain words that stay as they are</p>")], "domain string, html string")
    asked = lambda c: F.when(c.startswith("é"), F.concat(F.lit("english: "), c))
    got = {r["Domain"]: r for r in leads.enrich(pages, translate=asked).collect()}
    assert got["a.com"]["Page_Text"].startswith("english: é") and got["a.com"]["Meta_Description"].startswith("english: é")
    assert got["b.com"]["Page_Text"] == "plain words that stay as they are"
    assert not {r["Domain"]: r for r in leads.enrich(pages).collect()}["a.com"]["Page_Text"].startswith("english")


def test_class_order(spark):
    rows = spark.createDataFrame([("b", "ai"), ("a", "ai"), ("c", "parked"), ("d", "prelaunch"), ("e", "no_content")], "Domain string, lead_class string")
    assert [r[0] for r in labelling.in_class_order(rows).collect()] == ["d", "c", "e", "a", "b"]


def test_the_shared_folder_has_to_be_named_on_a_cluster(spark):
    class Conf:
        def get(self, *_):
            return None

    class Held:
        def sc(self):
            return self

        def getCheckpointDir(self):
            return self

        def isEmpty(self):
            return True

    class Context:
        master, _jsc = "spark://host:7077", Held()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        session.shared_dir(Session())
    assert session.shared_dir(spark).startswith("file:")


def test_a_stream_with_a_time_limit_goes_on_later(spark, tmp_path):
    source, out, state = (f"{tmp_path}/{x}" for x in ("in", "out", "state"))
    spark.range(10).write.parquet(source)
    schema = spark.read.parquet(source).schema
    run_once(spark, source, schema, lambda df: df, out, state, timeout=120)
    run_once(spark, source, schema, lambda df: df, out, state, timeout=120)
    assert spark.read.parquet(out).count() == 10


def test_packed_runs_are_read_once(spark, tmp_path):
    """A run in its own folder and in the packed one at once counts once; an open run isn't packed."""
    base = f"file://{tmp_path}/scan"
    domains = lambda *names: spark.createDataFrame([(x,) for x in names], "domain string")
    get = lambda url: (200, f"shopify {url}")
    runs.scan(spark, domains("a.com", "b.com"), base, get)
    runs.scan(spark, domains("b.com", "c.com"), base, get)
    runs.fetch.attempts(domains("d.com"), get).withColumn("run", F.lit("open")).write.mode("append").partitionBy("run").parquet(f"{base}/tried")
    want = sorted(map(tuple, runs.tried_in(spark, base).select("domain", "run").collect()))
    first = runs.compact(spark, base)
    assert sorted(map(tuple, runs.tried_in(spark, base).select("domain", "run").collect())) == want and len(want) == 4
    assert [r[0] for r in runs.open_runs(spark, base).collect()] == ["open"]
    runs.vacuum(spark, base)
    assert sorted(map(tuple, runs.tried_in(spark, base).select("domain", "run").collect())) == want
    runs.scan(spark, domains("a.com", "e.com"), base, get)  # finishes the open run, too
    assert sorted(r["Domain"] for r in runs.leads_in(spark, base).collect()) == ["a.com", "b.com", "c.com", "d.com", "e.com"]
    assert runs.compact(spark, base) != first
    runs.vacuum(spark, base)
    assert sorted(r["Domain"] for r in runs.leads_in(spark, base).collect()) == ["a.com", "b.com", "c.com", "d.com", "e.com"]
    assert len(runs.tried_in(spark, base).inputFiles()) == 1 and session.folders_in(spark, base).count(first) == 0


def test_urls_that_differ_in_their_scheme_only(spark, tmp_path):
    from siftworks.plans import runs as plans

    rows = [(1, "http://a.com/x", ""), (3, "https://a.com/x", ""), (5, "http://b.com", ""), (7, None, ""), (2, "http://c.com", "")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert [tuple(r) for r in plans.open_runs(spark, str(tmp_path)).collect()] == [("broken-off", 3)]
