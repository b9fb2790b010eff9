"""Runs: settings, days, what a day's run takes, and scans that go on where they stopped."""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks import rules
from siftworks.operators import incremental, leads
from siftworks.session import bytes_in, cut, folders_in, read_small, remove, there, write_small
from siftworks.sources import fetch

DAY = "yyyy-MM-dd"


@dataclass(frozen=True)
class Settings:
    """What is set from outside: for the model, and for how many seconds a run may take."""

    model: str | None = None
    key: str | None = None
    max_runtime: float = rules.MAX_RUNTIME


def settings(spark: SparkSession, environ: Mapping[str, str] = os.environ) -> Settings:
    """From siftworks.model, siftworks.key and siftworks.max_runtime of the session, else from SIFTWORKS_MODEL, SIFTWORKS_KEY and
    SIFTWORKS_MAX_RUNTIME of the environment, else the defaults. Blank values count as unset; a runtime that is no number is an error."""
    found = {k: (spark.conf.get(f"siftworks.{k}", None) or environ.get(f"SIFTWORKS_{k.upper()}") or "").strip() or None for k in ("model", "key", "max_runtime")}
    return Settings(found["model"], found["key"], float(found["max_runtime"] or rules.MAX_RUNTIME))


def day(c: Column) -> Column:
    """A date or time as a day's name."""
    return F.date_format(c, DAY)


def run_day(today: date | None = None) -> Column:
    """The run's day: as given, so that a run can be repeated, else the current one."""
    return F.current_date() if today is None else F.lit(today)


def missing_files(links: DataFrame, files: DataFrame) -> DataFrame:
    """links: dt (a day's name) and href; files: dt (date). Links of days that no file has, the oldest first."""
    have = files.select(day(F.col("dt")).alias("dt")).distinct()
    return links.join(have, "dt", "left_anti").orderBy("dt", "href")


def file_of(files: DataFrame, wanted: Column) -> DataFrame:
    """files: name. The first file, by name, whose name has the day in it: one row, or none."""
    return files.where(F.contains("name", wanted)).orderBy("name").limit(1)


def acquire(index: DataFrame, root: str, files: DataFrame, out: str, get: Callable[[str], tuple[int, str, bytes]] = fetch.http_file) -> DataFrame:
    """Fetches what an index page lists and no file has: lines of each archive's first member, a folder for each day below out.

    index: value (the page); files: dt of those at hand. Returns dt, href, lines and error, a row for each link that was missing."""
    from siftworks.sources import files as sources

    got = cut(fetch.downloads(missing_files(sources.links_in(index, root), files), get))
    members = cut(sources.first_members(got.where("error is null")).withColumnRenamed("error", "broken"))
    lines = members.where("broken is null").join(got.select("path", "dt"), "path").select("value", F.to_date("dt").alias("dt"))
    sources.write_dates(lines, out)
    counts = members.groupBy("path").agg(F.count("value").alias("lines"), F.max("broken").alias("broken"))
    return got.join(counts, "path", "left").select("dt", F.col("path").alias("href"), F.coalesce("lines", F.lit(0).cast("bigint")).alias("lines"), F.coalesce("error", "broken").alias("error"))


def due(dates: DataFrame, archive: DataFrame, today: date | None = None, first_only: bool = False) -> DataFrame:
    """The days to do: those of backlog(), the oldest first, and today's last, done or not. first_only: one of them."""
    old = incremental.backlog(dates.where(F.col("dt") < run_day(today)), archive).select("dt")
    every = old.unionByName(dates.sparkSession.range(1).select(run_day(today).alias("dt"))).orderBy("dt")
    return every.limit(1) if first_only else every


def patiently(step: Callable[[date], None], one: date, tries: int, sleep: Callable[[float], None]) -> None:
    """A step that fails is done again, with growing waits; the last failure is raised. Steps replace what they write, so a half-done
    one leaves nothing behind."""
    for n in range(1, tries + 1):
        try:
            return step(one)
        except Exception:
            if n == tries:
                raise
            sleep(rules.BACK_OFF * n)


def run_days(days: DataFrame, step: Callable[[date], None], max_runtime: float = rules.MAX_RUNTIME, clock: Callable[[], float] = time.monotonic, tries: int = 1, sleep: Callable[[float], None] = time.sleep) -> list[date]:
    """Does one day after the other, the oldest first, and returns those done. Time is looked at between days only. A day that fails
    is tried again, `tries` times in all, then ends the run; the days before it are done. The driver holds the days (some thousands
    at most), not their rows."""
    began, done = clock(), []
    for (one,) in days.select("dt").distinct().orderBy("dt").collect():
        if clock() - began >= max_runtime:
            break
        patiently(step, one, tries, sleep)
        done.append(one)
    return done


def scan(spark: SparkSession, candidates: DataFrame, base: str, get: fetch.Get = fetch.http_get, tries: int = 1, sleep: Callable[[float], None] = time.sleep) -> str:
    """Fetches the candidates (domain) that no run has tried yet and adds their leads. Returns the run's name.

    <base>/tried has every attempt, got or not; it is written before anything is made of it, so no domain is tried twice even
    if the run ends there: the next run makes the leads of runs that have none yet from the pages in that table. <base>/leads has
    the useful leads, a folder for each run that is replaced as a whole; <base>/done names the runs that are through. Many small runs
    are packed by compact(); tried_in() and leads_in() read either.
    """
    run = f"{time.strftime('%Y%m%d%H%M%S')}-{uuid.uuid4().hex[:8]}"
    todo = incremental.clean_keys(candidates, "domain")
    if there(spark, f"{base}/tried") or packed(spark, base):
        todo = incremental.pending(todo, tried_in(spark, base), "domain")
    fetch.attempts(todo, get, tries=tries, sleep=sleep).withColumn("run", F.lit(run)).write.mode("append").partitionBy("run").parquet(f"{base}/tried")
    finish(spark, base)
    return run


def table_of(spark: SparkSession, base: str, name: str) -> DataFrame | None:
    """tried or leads of all runs: what compact() has packed, and the folders of the runs that it hasn't. None if there is nothing."""
    loose, held = None, packed(spark, base)
    if there(spark, f"{base}/{name}") and any(x.startswith("run=") for x in folders_in(spark, f"{base}/{name}")):
        loose = spark.read.schema(f"{fetch.ATTEMPT}, run string") if name == "tried" else spark.read
        loose = loose.parquet(f"{base}/{name}").withColumn("run", F.col("run").cast("string"))
    if held is None:
        return loose
    whole = spark.read.parquet(f"{base}/{held}/{name}")
    if loose is None:
        return whole
    runs_ = spark.read.parquet(f"{base}/{held}/runs")  # a row for each run
    return whole.unionByName(loose.join(F.broadcast(runs_), "run", "left_anti"), allowMissingColumns=True)


def packed(spark: SparkSession, base: str) -> str | None:
    """The folder that the manifest names."""
    held = read_small(spark, f"{base}/packed.json")
    return json.loads(held)["folder"] if held else None


def tried_in(spark: SparkSession, base: str) -> DataFrame:
    found = table_of(spark, base, "tried")
    return spark.createDataFrame([], f"{fetch.ATTEMPT}, run string") if found is None else found


def leads_in(spark: SparkSession, base: str) -> DataFrame:
    return table_of(spark, base, "leads")


def compact(spark: SparkSession, base: str, file_bytes: int = 128 << 20) -> str:
    """Packs what all runs that are through have left into files of about file_bytes, instead of a folder or more for each run, and
    returns the folder's name.

    The new folder is written beside, then the manifest (packed.json) is replaced in one step: readers take a run from its own folder
    before and from the packed one after, never from both. vacuum() removes what is no longer read. One writer at a time."""
    folder = f"packed-{uuid.uuid4().hex}"
    through = cut(spark.read.schema("run string").parquet(f"{base}/done").distinct())
    for name in ("tried", "leads"):
        rows = table_of(spark, base, name)
        if rows is not None:
            size = sum(bytes_in(spark, f"{base}/{x}") for x in (name, f"{packed(spark, base) or folder}/{name}"))
            rows.join(F.broadcast(through), "run", "left_semi").repartition(-(-max(size, 1) // file_bytes)).write.parquet(f"{base}/{folder}/{name}")
    through.coalesce(1).write.parquet(f"{base}/{folder}/runs")
    write_small(spark, f"{base}/packed.json", json.dumps({"folder": folder}))
    return folder


def vacuum(spark: SparkSession, base: str) -> None:
    """Removes the folders of runs that are packed, and packed ones that are no longer named, for when no reader holds them."""
    held = packed(spark, base)
    for name in folders_in(spark, base):
        if name.startswith("packed-") and name != held:
            remove(spark, f"{base}/{name}")
    if held:
        for (run,) in spark.read.parquet(f"{base}/{held}/runs").collect():  # a row for each run
            for name in ("tried", "leads"):
                remove(spark, f"{base}/{name}/run={run}")


def open_runs(spark: SparkSession, base: str) -> DataFrame:
    """run: those that have tried domains and aren't through, as they ended before."""
    every = tried_in(spark, base).select("run").distinct()
    return every.join(spark.read.schema("run string").parquet(f"{base}/done"), "run", "left_anti") if there(spark, f"{base}/done") else every


def finish(spark: SparkSession, base: str) -> None:
    """Makes the leads of all open runs."""
    todo = cut(open_runs(spark, base))
    if todo.isEmpty():
        return
    pages = fetch.live(tried_in(spark, base).join(F.broadcast(todo), "run"), "run")
    found = leads.useful(leads.enrich(pages, keep=("run",)))
    found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(f"{base}/leads")
    todo.write.mode("append").parquet(f"{base}/done")
