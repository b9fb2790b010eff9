"""Registered queries over runs that go on from what runs before have left: histories, late rows, states and counters."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.operators import counters, labelling, runs
from siftworks.operators.history import History
from siftworks.plans import fixtures as fx
from siftworks.plans.catalogue import CLASSED, ITEM_SQL, doc_leads, query, read
from siftworks.session import scratch
from siftworks.sources import files
from siftworks.streaming import keyed, upsert

#: Which of three runs brings an event: the days go round.
RUN = "(dayofyear(ts) % 3)"


def run_of(ts: str = "ts"):
    return F.dayofyear(ts) % 3


@query(f"SELECT user_id::VARCHAR AS key, 'run-' || min({RUN}) AS run FROM events WHERE user_id IS NOT NULL GROUP BY user_id")
def history_of_keys(spark, sf_dir):
    """Three runs over the events of other days each: every user is kept with the first that brought them, compacted after the second."""
    events, history = read(spark, sf_dir, "events"), History(spark, scratch(spark, "history"), buckets=8)
    for run in range(3):
        history.add(events.where(run_of() == run), "user_id", f"run-{run}")
        if run == 1:
            history.compact()
    return history.keys()


@query(f"SELECT event_id, user_id, event_type FROM events WHERE {RUN} = 2 AND user_id NOT IN (SELECT user_id FROM events WHERE {RUN} < 2 AND event_type = 'error' AND value < 5 AND user_id IS NOT NULL)")
def history_rows_pending(spark, sf_dir):
    """The last run's events of users without a small error in the runs before."""
    events, history = read(spark, sf_dir, "events"), History(spark, scratch(spark, "history"), buckets=8)
    for run in range(2):
        history.add(events.where((run_of() == run) & (F.col("event_type") == "error") & (F.col("value") < 5)), "user_id", f"run-{run}")
    return history.rows_pending(events.where(run_of() == 2), "user_id").select("event_id", "user_id", "event_type")


@query("SELECT doc_id, source FROM documents ANTI JOIN labels USING (doc_id)")
def lead_resume_history(spark, sf_dir):
    """Documents that aren't labelled yet, against a history of those that are."""
    history = History(spark, scratch(spark, "history"), buckets=8)
    history.add(read(spark, sf_dir, "labels"), "doc_id", "labelled")
    return history.rows_pending(read(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")


LATE = "CASE WHEN event_id % 10 = 0 THEN -1 ELSE 1 END * round(value * 100)::BIGINT"


@query(f"SELECT ts::DATE AS dt, event_type, count(*) AS n, sum({LATE})::BIGINT AS cents FROM events GROUP BY ALL")
def late_rows(spark, sf_dir):
    """Events of a date that come in three files: early, late, and every tenth once more with its value turned. All rows stay, each in its
    last version."""
    base = scratch(spark, "late")
    cents = F.round(F.col("value") * 100).cast("bigint")
    events = read(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("dt"), "event_type", cents.alias("cents"), F.lit(1).alias("version"))
    early = F.coalesce(F.col("event_type").isin("signup", "view"), F.lit(False))
    table = upsert.DatedTable(spark, f"{base}/table", events.schema, ["event_id"], "version")
    for part in (events.where(early), events.where(~early), events.where("event_id % 10 = 0").withColumns({"cents": -F.col("cents"), "version": F.lit(2)}), events.where("event_id % 10 = 0")):
        part.write.mode("append").parquet(f"{base}/in")
        upsert.run_upserts(spark, f"{base}/in", events.schema, lambda df: df, table, f"{base}/state")
    return table.rows().groupBy("dt", "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))


@query("SELECT user_id, event_type FROM events GROUP BY ALL")
def stream_new_keys(spark, sf_dir):
    """Events as files of three runs: each user's kind of event passes once."""
    base = scratch(spark, "keyed")
    events = read(spark, sf_dir, "events").select("user_id", "event_type", run_of().alias("run"))
    for run in range(3):
        events.where(F.col("run") == run).write.mode("append").parquet(f"{base}/in")
        keyed.run_new_keys(spark, f"{base}/in", events.schema, ["user_id", "event_type"], f"{base}/out", f"{base}/state")
    return spark.read.parquet(f"{base}/out").select("user_id", "event_type")


@query(f"SELECT ts::DATE AS dt, count(*) AS rows, sum(round(value * 100)::BIGINT)::BIGINT AS cents, count(DISTINCT {RUN}) AS runs, true AS users_within FROM events GROUP BY ALL")
def run_counters(spark, sf_dir):
    """Each run leaves a summary of its events, by day; merged, the sums are exact and the users counted within three standard errors."""
    base, events = scratch(spark, "counters"), read(spark, sf_dir, "events").withColumn("dt", F.to_date("ts"))
    for run in range(3):
        one = counters.summary(events.where(run_of() == run), ["dt"], {"cents": F.round(F.col("value") * 100).cast("bigint")}, {"users": F.col("user_id")})
        one.withColumn("runs", F.lit(1).cast("bigint")).write.mode("append").parquet(base)
    found = counters.estimated(counters.merged(spark.read.parquet(base), ["dt"], ["cents", "runs"], ["users"]), ["users"])
    exact = events.groupBy("dt").agg(F.countDistinct("user_id").alias("exact"))
    within = F.abs(F.col("users") - F.col("exact")) <= F.greatest(F.lit(1.0), F.lit(counters.error_of()) * F.col("exact"))
    return found.join(exact, "dt").select("dt", "rows", "cents", "runs", within.alias("users_within"))


DAYS = "SELECT ts::DATE AS dt, count(*) AS n, dense_rank() OVER (ORDER BY ts::DATE) AS k FROM events WHERE ts IS NOT NULL GROUP BY ts::DATE"


@query(f"SELECT dt, n, CASE WHEN k <= 3 THEN 1 ELSE 2 END::BIGINT AS run FROM ({DAYS})")
def days_within_time(spark, sf_dir):
    """A run whose time is up after three days; the next does the others."""
    base = scratch(spark, "days")
    events = read(spark, sf_dir, "events").withColumn("dt", F.to_date("ts")).where("dt is not null")
    days, done = events.select("dt").distinct(), []
    for run, most in ((1, 4), (2, 10**9)):  # the clock moves on by one whenever it is looked at
        ticks = iter(range(10**6))
        step = lambda one, run=run: files.write_dates(events.where(F.col("dt") == F.lit(one)).withColumn("run", F.lit(run).cast("bigint")), base)
        done += runs.run_days(days.where(~F.col("dt").isin(done)) if done else days, step, most, lambda ticks=ticks: next(ticks))
    return spark.read.parquet(base).groupBy(F.col("dt").cast("date").alias("dt"), "run").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT dt, n, CASE WHEN day(dt) % 2 = 1 THEN 3 ELSE 1 END::BIGINT AS attempt FROM ({DAYS})")
def days_tried_again(spark, sf_dir):
    """Odd days fail twice, once with half of their rows written; what stays is the last attempt's."""
    base, tried = scratch(spark, "days"), {}
    events = read(spark, sf_dir, "events").withColumn("dt", F.to_date("ts")).where("dt is not null")

    def step(one: date) -> None:
        n = tried[one] = tried.get(one, 0) + 1
        rows = events.where(F.col("dt") == F.lit(one)).withColumn("attempt", F.lit(n).cast("bigint"))
        if one.day % 2 and n < 3:
            files.write_dates(rows.where("event_id % 2 = 0"), base)
            raise OSError("half-way")
        files.write_dates(rows, base)

    runs.run_days(events.select("dt").distinct(), step, tries=3, sleep=lambda s: None)
    return spark.read.parquet(base).groupBy(F.col("dt").cast("date").alias("dt"), "attempt").agg(F.count(F.lit(1)).alias("n"))


ASKED = "Label every item of the list. Answer with one JSON object whose items repeat each item's index and domain."


@query(f"""{CLASSED}, n AS (SELECT classed.*, content.content, row_number() OVER (ORDER BY Domain) - 1 AS r FROM classed JOIN content ON content.k = classed.Domain WHERE lead_class = 'ai'),
  i AS (SELECT *, r // 5 AS batch, (r % 5)::INT AS index FROM n), q AS (SELECT batch, to_json(list({ITEM_SQL} ORDER BY index))::VARCHAR AS request FROM i GROUP BY batch)
  SELECT batch, 'chosen' AS model, {fx.literal(ASKED)} AS system, request AS user, 0.1::DOUBLE AS temperature, 'json_object' AS format FROM q""")
def model_envelopes(spark, sf_dir):
    """What a chat service gets for each batch, read back from its JSON."""
    todo = labelling.split_classes(doc_leads(spark, sf_dir)).where("lead_class = 'ai'")
    sent = labelling.envelopes(labelling.requests(labelling.number_batches(todo, "Domain")), "chosen", ASKED, 0.1)
    kind = "model string, messages array<struct<role: string, content: string>>, temperature double, response_format struct<type: string>"
    read_back = sent.select("batch", F.from_json("request", kind).alias("x"))
    said = lambda role: F.element_at(F.filter("x.messages", lambda m: m["role"] == role), 1)["content"]
    return read_back.select("batch", "x.model", said("system").alias("system"), said("user").alias("user"), "x.temperature", F.col("x.response_format.type").alias("format"))


def hot_rows(df: DataFrame) -> DataFrame:
    """A third of the rows under one key."""
    return df.withColumn("k", F.when(F.col("doc_id") % 3 == 0, F.lit("hot")).otherwise(F.col("doc_id").cast("string")))


@query("SELECT batch, count(*) AS n, min(CASE WHEN doc_id % 3 = 0 THEN 'hot' ELSE doc_id::VARCHAR END) AS low, max(CASE WHEN doc_id % 3 = 0 THEN 'hot' ELSE doc_id::VARCHAR END) AS high FROM (SELECT doc_id, (row_number() OVER (ORDER BY CASE WHEN doc_id % 3 = 0 THEN 'hot' ELSE doc_id::VARCHAR END) - 1) // 5 AS batch FROM documents) GROUP BY batch")
def batches_of_a_hot_key(spark, sf_dir):
    """Batches where one key has a third of the rows: which of them are in a batch is left open, its keys aren't."""
    found = labelling.number_batches(hot_rows(read(spark, sf_dir, "documents").select("doc_id")), "k", steady=True)
    return found.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("low"), F.max("k").alias("high"))
