"""Registered queries over files and runs: each writes below the shared folder what it then reads, and is compared with SQL over the
tables that it was made of."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks import rules
from siftworks.functions.domains import host
from siftworks.operators import incremental, labelling, leads, progress, runs
from siftworks.plans import fixtures as fx
from siftworks.plans.catalogue import CLASSED, HOST, LEAD, doc_leads, handed_out, pages, query, read
from siftworks.session import scratch
from siftworks.sources import fetch, files


# --- days and settings ------------------------------------------------------------------------------------------------------


@query("SELECT DISTINCT strftime(ts::DATE, '%Y-%m-%d') AS day, ts::DATE = DATE '2024-01-09' AS today FROM events")
def day_names(spark, sf_dir):
    day = F.to_date("ts")
    return read(spark, sf_dir, "events").select(runs.day(day).alias("day"), (day == runs.run_day(date(2024, 1, 9))).alias("today")).distinct()


DUE = f"""SELECT DISTINCT e.dt FROM (SELECT DISTINCT ts::DATE AS dt FROM events) e LEFT JOIN (SELECT dt::DATE AS dt, head FROM ({fx.sql(fx.ARCHIVE)})) a ON a.dt = e.dt
  WHERE e.dt < DATE '2024-01-09' AND (head IS NULL OR contains(substr(head, 1, 200), 'NO_DATA') OR length(substr(head, 1, 200)) < 50)"""


def due(spark, sf_dir, first_only=False):
    dates = read(spark, sf_dir, "events").select(F.to_date("ts").alias("dt"))
    return runs.due(dates, fx.frame(spark, fx.ARCHIVE).withColumn("dt", F.to_date("dt")), date(2024, 1, 9), first_only)


@query(f"SELECT dt FROM ({DUE}) UNION SELECT DATE '2024-01-09'")
def days_due(spark, sf_dir):
    return due(spark, sf_dir)


@query(f"SELECT min(dt) AS dt FROM (SELECT dt FROM ({DUE}) UNION SELECT DATE '2024-01-09')")
def first_day_due(spark, sf_dir):
    return due(spark, sf_dir, True)


@query("SELECT dt, n, 'chosen' AS model, 'k' AS key, 3.0::DOUBLE AS max_runtime FROM (SELECT ts::DATE AS dt, count(*) AS n, dense_rank() OVER (ORDER BY ts::DATE) AS k FROM events WHERE ts IS NOT NULL GROUP BY ts::DATE) WHERE k < 3")
def run_settings(spark, sf_dir):
    """A run over the events' days that ends when the time that is set from outside is up; the clock moves on with each look at it."""
    found = runs.settings(spark, {"SIFTWORKS_MODEL": " chosen ", "SIFTWORKS_MAX_RUNTIME": "3", "SIFTWORKS_KEY": "k"})
    base, ticks = scratch(spark, "set"), iter(range(10**6))
    events = read(spark, sf_dir, "events").withColumn("dt", F.to_date("ts")).where("dt is not null")
    told = events.withColumns({"model": F.lit(found.model), "key": F.lit(found.key), "max_runtime": F.lit(found.max_runtime)})
    runs.run_days(events.select("dt").distinct(), lambda one: files.write_dates(told.where(F.col("dt") == F.lit(one)), base), found.max_runtime, lambda: next(ticks))
    return spark.read.parquet(base).groupBy(F.col("dt").cast("date").alias("dt"), "model", "key", "max_runtime").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT dt, 2::BIGINT AS nth_write, count(*) AS n FROM (SELECT ts::DATE AS dt FROM events) WHERE dt IN ({DUE}) GROUP BY 1 UNION ALL SELECT dt, 1, count(*) FROM (SELECT ts::DATE AS dt FROM events) WHERE dt NOT IN ({DUE}) GROUP BY 1")
def days_done_anew(spark, sf_dir):
    """All days are written, then those that are due once more, one by one, the oldest first: only these are replaced."""
    base = scratch(spark, "days")
    events = read(spark, sf_dir, "events").withColumn("dt", F.to_date("ts"))
    files.write_dates(events.withColumn("nth_write", F.lit(1).cast("bigint")), base)
    step = lambda one: files.write_dates(events.where(F.col("dt") == F.lit(one)).withColumn("nth_write", F.lit(2).cast("bigint")), base)
    runs.run_days(due(spark, sf_dir).where(F.col("dt") < F.lit(date(2024, 1, 9))), step)
    return spark.read.parquet(base).groupBy(F.col("dt").cast("date").alias("dt"), "nth_write").agg(F.count(F.lit(1)).alias("n"))


# --- files ------------------------------------------------------------------------------------------------------------------


#: The events as lists of lines, a file for each day: every seventh day's is a .csv, every second day's ends in capitals.
LINE = "'u' || user_id || '-' || event_id || '.com'"
NAME = "'events-' || strftime(dt, '%Y-%m-%d') || CASE WHEN day(dt) % 7 = 0 THEN '.csv' WHEN day(dt) % 2 = 0 THEN '.TXT' ELSE '.txt' END"
LISTED = f"SELECT dt, {NAME} AS name, event_id, {LINE} AS line FROM (SELECT ts::DATE AS dt, * FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL)"


def event_lines(spark, sf_dir) -> DataFrame:
    line = F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("-"), F.col("event_id").cast("string"), F.lit(".com"))
    return read(spark, sf_dir, "events").select(F.to_date("ts").alias("dt"), "event_id", line.alias("line")).where("dt is not null and line is not null")


def lists(spark, sf_dir) -> str:
    """Writes the lists by Spark, a file for each day in order of event_id, and gives the files their names."""
    base = scratch(spark, "lists")
    event_lines(spark, sf_dir).repartition("dt").sortWithinPartitions("dt", "event_id").select("line", "dt").write.partitionBy("dt").text(f"{base}/made")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    store = path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(path(f"{base}/lists"))
    for folder in store.globStatus(path(f"{base}/made/dt=*")):  # one for each day
        day = date.fromisoformat(folder.getPath().getName().removeprefix("dt="))
        for n, part in enumerate(store.globStatus(path(f"{folder.getPath().toString()}/part-*"))):
            kind = ".csv" if day.day % 7 == 0 else ".TXT" if day.day % 2 == 0 else ".txt"
            store.rename(part.getPath(), path(f"{base}/lists/events-{day}{f'-{n}' if n else ''}{kind}"))
    return f"{base}/lists"


#: The index page's rows, one for each day of the events: cells, and a link that is elsewhere, none, or one that is denied.
INDEX = """SELECT strftime(dt, '%Y-%m-%d') || CASE WHEN day(dt) % 2 = 0 THEN ' 10:00' ELSE '' END AS dt, CASE WHEN day(dt) % 5 = 0 THEN 2 ELSE 3 END AS cells,
  CASE WHEN day(dt) % 11 = 0 THEN '/Contact-us' WHEN day(dt) % 13 = 0 THEN '/whois-database-download' WHEN day(dt) % 8 = 0 THEN '' WHEN day(dt) % 3 = 0 THEN 'http://elsewhere.example/list/' || strftime(dt, '%Y-%m-%d') || '.zip' ELSE '/list/' || strftime(dt, '%Y-%m-%d') || '.zip' END AS href
  FROM (SELECT DISTINCT ts::DATE AS dt FROM events WHERE ts IS NOT NULL)"""
LINKS = f"SELECT substr(dt, 1, 10) AS dt, CASE WHEN starts_with(href, 'http') THEN href ELSE 'http://root' || href END AS href FROM ({INDEX}) WHERE cells >= 3 AND href <> '' AND NOT contains(lower(href), 'whois-database-download') AND NOT contains(lower(href), 'contact')"


def index_html(spark, sf_dir) -> DataFrame:
    """value: one page, made of the events' days."""
    day, dt = F.dayofmonth("dt"), F.date_format("dt", "yyyy-MM-dd")
    link = F.when(day % 11 == 0, "/Contact-us").when(day % 13 == 0, "/whois-database-download").when(day % 8 == 0, "").when(day % 3 == 0, F.concat(F.lit("http://elsewhere.example/list/"), dt, F.lit(".zip"))).otherwise(F.concat(F.lit("/list/"), dt, F.lit(".zip")))
    cells = F.concat(F.lit("<tr><td> "), dt, F.when(day % 2 == 0, " 10:00").otherwise(""), F.lit(" </td>"), F.when(day % 5 == 0, "").otherwise("<td>1 MB</td>"))
    last = F.concat(F.lit("<td>"), F.when(link == "", "none").otherwise(F.concat(F.lit("<a href='"), link, F.lit("'>get</a> <a href='/second'>no</a>"))), F.lit("</td></tr>"))
    rows = event_lines(spark, sf_dir).select("dt").distinct().select("dt", F.concat(cells, last).alias("row"))
    table = rows.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("dt", "row"))), lambda x: x["row"]), "").alias("t"))  # a row for each day
    return table.select(F.concat(F.lit("<p>Lists</p><table><tr><th>day</th></tr>"), "t", F.lit("</table><table><tr><td>2024-03-01</td><td></td><td><a href='/x'>x</a></td></tr></table>")).alias("value"))


@query(LINKS)
def index_links(spark, sf_dir):
    """The page is saved and read again."""
    base = scratch(spark, "index")
    index_html(spark, sf_dir).coalesce(1).write.text(base)
    return files.index_links(spark, base, "http://root")


#: Days whose list is at hand: those of .txt files.
DATED = f"SELECT DISTINCT dt FROM ({LISTED}) WHERE ends_with(lower(name), '.txt')"
MISSING = f"SELECT dt, href, day(dt::DATE) AS k FROM ({LINKS}) WHERE dt::DATE NOT IN ({DATED})"


@query(f"SELECT dt, href FROM ({MISSING})")
def missing_files(spark, sf_dir):
    return runs.missing_files(files.links_in(index_html(spark, sf_dir), "http://root"), files.file_dates(spark, lists(spark, sf_dir)))


def served(folder: str):
    """Stands in for the network: a site that packs the lines of the day that is asked for. Every fourth day's comes as a page, the 9th's
    is no archive, the 3rd's is gone and the 2nd's never comes."""

    def get(url: str) -> tuple[int, str, bytes]:
        import io
        import zipfile

        import pyarrow.dataset as ds
        from pyarrow import fs

        day = date.fromisoformat(url.rsplit("/", 1)[1].removesuffix(".zip"))
        if day.day == 2:
            raise TimeoutError
        store, path = fs.FileSystem.from_uri(f"{folder}/dt={day}")
        lines = sorted(ds.dataset(path, filesystem=store, format="parquet").to_table(columns=["line"])["line"].to_pylist())
        with zipfile.ZipFile(archive := io.BytesIO(), "w") as z:
            z.writestr("list.txt", "\r\n".join(lines))
            z.writestr("more.txt", "no.com")
        return 404 if day.day == 3 else 200, "text/html; charset=utf-8" if day.day % 4 == 0 else "application/zip", b"nothing" if day.day == 9 else archive.getvalue()

    return get


#: Links of days that aren't at hand: all but the 7th, 17th and 27th.
WANTED = f"SELECT dt, href, day(dt::DATE) AS k FROM ({LINKS}) WHERE day(dt::DATE) % 10 <> 7"


@query(f"""SELECT m.dt, href, coalesce(error, 'written') AS outcome, CASE WHEN error IS NULL THEN n ELSE 0 END::BIGINT AS lines
  FROM (SELECT *, CASE WHEN k = 2 THEN 'TimeoutError' WHEN k = 3 THEN '404' WHEN k % 4 = 0 THEN 'HtmlPage' WHEN k = 9 THEN 'BadZipFile' END AS error FROM ({WANTED})) m JOIN (SELECT dt, count(*) AS n FROM ({LISTED}) GROUP BY dt) d ON d.dt = m.dt::DATE""")
def acquired_lists(spark, sf_dir):
    """From the index page to a folder of lines for each day that was missing; counted as they are read again."""
    out, site = scratch(spark, "acquired"), scratch(spark, "site")
    event_lines(spark, sf_dir).write.partitionBy("dt").parquet(site)
    have = event_lines(spark, sf_dir).select("dt").distinct().where(F.dayofmonth("dt") % 10 == 7)
    told = runs.acquire(index_html(spark, sf_dir), "http://root", have, out, served(site))
    found = spark.read.parquet(out).groupBy(F.date_format("dt", "yyyy-MM-dd").alias("dt")).agg(F.count(F.lit(1)).alias("written"))
    outcome = F.coalesce("error", F.when(F.col("lines") > 0, "written").otherwise("empty"))
    return told.join(found, "dt", "left").select("dt", "href", outcome.alias("outcome"), F.coalesce("written", F.lit(0).cast("bigint")).alias("lines"))


@query(f"""SELECT dt, CASE WHEN k THEN NULL ELSE 'first.txt' END AS member, CASE WHEN k THEN NULL ELSE line END AS value, CASE WHEN day(dt) % 5 = 0 THEN 'BadZipFile' WHEN day(dt) % 7 = 0 THEN 'HtmlPage' END AS error
  FROM (SELECT DISTINCT dt, day(dt) % 5 = 0 OR day(dt) % 7 = 0 AS k, CASE WHEN day(dt) % 5 = 0 OR day(dt) % 7 = 0 THEN NULL ELSE line END AS line FROM ({LISTED}))""")
def zip_source(spark, sf_dir):
    """Each day's lines as an archive of two members, some broken, some pages; read again, the first member's lines and what is wrong."""
    import io
    import zipfile

    import pandas as pd

    def packed(frame: pd.DataFrame) -> pd.DataFrame:
        day = frame["dt"].iloc[0]
        with zipfile.ZipFile(good := io.BytesIO(), "w") as z:
            z.writestr("first.txt", "\n".join(frame["line"]) + "\n")
            z.writestr("second.txt", "c.com\n")
        return pd.DataFrame([(str(day), b"no zip" if day.day % 5 == 0 else b" <!DOCTYPE html><p>Not found</p>" if day.day % 7 == 0 else good.getvalue())], columns=["path", "content"])

    archives = event_lines(spark, sf_dir).groupBy("dt").applyInPandas(packed, "path string, content binary")
    return files.first_members(archives).select(F.to_date("path").alias("dt"), "member", "value", "error")


@query(DATED)
def file_dates(spark, sf_dir):
    return files.file_dates(spark, lists(spark, sf_dir))


@query(f"SELECT min(name) AS name FROM ({LISTED}) WHERE contains(name, '2024-01-05')")
def file_of_day(spark, sf_dir):
    return runs.file_of(spark.read.format("binaryFile").load(lists(spark, sf_dir)).select(F.element_at(F.split("path", "/"), -1).alias("name")), F.lit("2024-01-05"))


@query(f"SELECT dt, substr(string_agg(line, chr(10) ORDER BY event_id) || chr(10), 1, 200) AS head FROM ({LISTED}) GROUP BY dt")
def file_heads(spark, sf_dir):
    return files.heads(spark, lists(spark, sf_dir))


@query(f"SELECT line AS value, dt FROM ({LISTED})")
def file_lines(spark, sf_dir):
    return files.domain_lines(spark, lists(spark, sf_dir))


@query(f"SELECT DISTINCT {HOST.format('url')} AS value FROM pages")
def key_lines(spark, sf_dir):
    """Lines are written, one of them blank and each twice, written over, and read as a set."""
    base = scratch(spark, "keys")
    hosts = read(spark, sf_dir, "pages").select(host(F.col("url")).alias("value"))
    files.write_lines(hosts.select(F.lit("replaced").alias("value")), base)
    padded = hosts.select(F.concat(F.lit(" "), F.col("value"), F.lit("\t")).alias("value"))
    files.write_lines(hosts.unionByName(padded).unionByName(spark.createDataFrame([(" ",)], "value string")), base)
    return files.key_set(spark, base)


@query(f"WITH {LEAD} SELECT {handed_out(rules.LEAD_COLUMNS)} FROM lead")
def csv_leads(spark, sf_dir):
    """Records are appended in two runs and read as they were."""
    base = scratch(spark, "csv")
    found = leads.egress(leads.enrich(pages(spark, sf_dir), keep=("page_id",)))
    for part in (0, 1):
        files.append_csv(found.where(F.pmod("page_id", F.lit(2)) == part).drop("page_id"), base)
    return files.leads_csv(spark, base)


@query(f"SELECT page_id FROM pages WHERE {HOST.format('url')} NOT IN (SELECT {HOST.format('url')} FROM pages WHERE page_id % 3 = 0)")
def csv_resume_anti(spark, sf_dir):
    """What is left when the finished output is a CSV of which only the key is read."""
    base = scratch(spark, "csv")
    rows = read(spark, sf_dir, "pages").select("page_id", host(F.col("url")).alias("Domain"))
    files.append_csv(rows.where("page_id % 3 = 0").select("Domain", F.lit("x").alias("Title")), base)
    return incremental.pending(rows, files.leads_csv(spark, base, ["Domain", "Title"]), "Domain").select("page_id")


# --- runs -------------------------------------------------------------------------------------------------------------------


def half_dead(url: str) -> tuple[int, str]:
    """Stands in for the network: some sites never answer, some have no page."""
    if "7" in url or "ou" in url:
        raise ConnectionError
    return (404, "") if "an" in url else (200, f"<title>{url}</title> shopify" if "e" in url.split("//")[1][:4] else "<p>nothing</p>")


H = f"(SELECT DISTINCT {HOST.format('url')} AS h FROM pages)"
DEAD = "(contains(h, '7') OR contains(h, 'ou'))"


@query(f"""SELECT h AS domain, 1::BIGINT AS n, CASE WHEN {DEAD} THEN 2 ELSE 1 END AS tries, CASE WHEN {DEAD} THEN 'ConnectionError' END AS error, CASE WHEN {DEAD} THEN NULL WHEN contains(h, 'an') THEN 404 ELSE 200 END AS status,
  NOT {DEAD} AND NOT contains(h, 'an') AND contains(substr(h, 1, 4), 'e') AS lead FROM {H}""")
def scan_resume(spark, sf_dir):
    """Three runs: over some domains, one that ends before its leads are made, and over all. No domain is tried twice."""
    base = scratch(spark, "scan")
    hosts = incremental.clean_keys(read(spark, sf_dir, "pages").select(host(F.col("url")).alias("domain")), "domain")
    scan = lambda rows: runs.scan(spark, rows, base, half_dead, tries=2, sleep=lambda s: None)
    scan(hosts.where(F.contains("domain", F.lit("a"))))
    lost = incremental.pending(hosts.where(F.contains("domain", F.lit("e"))), runs.tried_in(spark, base), "domain")
    fetch.attempts(lost, half_dead, tries=2, sleep=lambda s: None).withColumn("run", F.lit("broken-off")).write.mode("append").partitionBy("run").parquet(f"{base}/tried")
    scan(hosts)
    scan(hosts)
    tried = runs.tried_in(spark, base).groupBy("domain").agg(F.count(F.lit(1)).alias("n"), F.max("tries").alias("tries"), F.max("error").alias("error"), F.max("status").alias("status"))
    found = spark.read.parquet(f"{base}/leads").select(F.col("Domain").alias("domain"), F.lit(True).alias("lead"))
    return tried.join(found, "domain", "left").withColumn("lead", F.coalesce("lead", F.lit(False)))


@query(f"""SELECT h AS domain, 1::BIGINT AS n, CASE WHEN {DEAD} THEN NULL WHEN contains(h, 'an') THEN 404 ELSE 200 END AS status, NOT {DEAD} AND NOT contains(h, 'an') AND contains(substr(h, 1, 4), 'e') AS lead, true AS fewer_files FROM {H}""")
def runs_compacted(spark, sf_dir):
    """Three runs, packed after the second and at the end: the same rows in fewer files."""
    base = scratch(spark, "scan")
    hosts = incremental.clean_keys(read(spark, sf_dir, "pages").select(host(F.col("url")).alias("domain")), "domain")
    for n in range(3):  # each brings about a third of the hosts
        runs.scan(spark, hosts.where(F.crc32("domain") % 3 <= n), base, half_dead)
        if n:
            before = len(runs.tried_in(spark, base).inputFiles())
            runs.compact(spark, base)
            runs.vacuum(spark, base)
    fewer = len(runs.tried_in(spark, base).inputFiles()) < before
    tried = runs.tried_in(spark, base).groupBy("domain").agg(F.count(F.lit(1)).alias("n"), F.max("status").alias("status"))
    found = runs.leads_in(spark, base).select(F.col("Domain").alias("domain"), F.lit(True).alias("lead"))
    return tried.join(found, "domain", "left").select("domain", "n", "status", F.coalesce("lead", F.lit(False)).alias("lead"), F.lit(fewer).alias("fewer_files"))


@query("SELECT 'broken-off' AS run, count(DISTINCT url) AS urls FROM pages WHERE page_id % 2 = 1")
def open_runs(spark, sf_dir):
    """A run that ended once its pages were there; the one before it is through. URLs that differ in their scheme only are two."""
    base = scratch(spark, "scan")
    urls = read(spark, sf_dir, "pages").select(F.regexp_replace("url", "(?s)^([a-z]+)://(.*)$", "$2#$1").alias("domain"), "page_id")
    runs.scan(spark, urls.where("page_id % 2 = 0"), base, half_dead)
    fetch.attempts(urls.where("page_id % 2 = 1").distinct(), half_dead).withColumn("run", F.lit("broken-off")).write.mode("append").partitionBy("run").parquet(f"{base}/tried")
    left = runs.open_runs(spark, base)
    return left.join(runs.tried_in(spark, base), "run").groupBy("run").agg(F.countDistinct("domain").alias("urls"))


def moody(request: str) -> str:
    """Stands in for a model: what it does hangs on the first domain's number."""
    import json

    n = int(json.loads(request)[0]["domain"].strip("d.com") or 0) % 4 if json.loads(request)[0]["domain"].startswith("d") else 3
    if n == 0:
        raise TimeoutError
    if n == 1:
        raise labelling.RateLimited(0)
    return "no json" if n == 2 else "[]"


@query(f"""{CLASSED}, n AS (SELECT classed.*, content.content, row_number() OVER (ORDER BY Domain) - 1 AS r FROM classed JOIN content ON content.k = classed.Domain WHERE lead_class = 'ai'),
  f AS (SELECT r // 5 AS batch, min_by(Domain, r) AS d FROM n GROUP BY 1), m AS (SELECT batch, CASE WHEN regexp_matches(d, '^d[0-9]+[.]com$') THEN regexp_extract(d, '[0-9]+')::INT % 4 ELSE 3 END AS k FROM f)
  SELECT batch, CASE k WHEN 0 THEN 'TIMEOUT' WHEN 1 THEN 'RATE_LIMITED' WHEN 2 THEN 'JSON_ERROR' END AS error, CASE WHEN k < 3 THEN 3 ELSE 1 END AS tries, CASE WHEN k = 3 THEN '[]' END AS raw FROM m""")
def model_attempts(spark, sf_dir):
    todo = labelling.split_classes(doc_leads(spark, sf_dir)).where("lead_class = 'ai'")
    return labelling.ask(labelling.requests(labelling.number_batches(labelling.told(todo), "Domain")), moody, sleep=lambda s: None)


@query("SELECT doc_id, round(doc_id / 1000.0 * 100, 1)::DOUBLE AS percent, CASE WHEN doc_id > 0 THEN floor(n_chars::DOUBLE / doc_id * (1000 - doc_id))::BIGINT END AS seconds_left FROM documents")
def run_pace(spark, sf_dir):
    pace = progress.pace(F.col("doc_id"), F.lit(1000), F.col("n_chars").cast("double"))
    return read(spark, sf_dir, "documents").select("doc_id", pace.alias("p")).select("doc_id", "p.*")


@query("SELECT count(*) AS rows, count(*) FILTER (toxic > 0) AS toxic FROM labels")
def counted_rows(spark, sf_dir):
    """Counts taken while rows pass to another place."""
    rows, seen = progress.counted(read(spark, sf_dir, "labels"), toxic=F.col("toxic") > 0)
    rows.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(seen.get["rows"], seen.get["toxic"])], "rows bigint, toxic bigint")
