"""Registered queries over the driver's tables, and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks import rules
from siftworks.functions import classify, html, text
from siftworks.functions.domains import host, reject_reason
from siftworks.operators import incremental, labelling, leads, phrases, progress
from siftworks.plans import fixtures as fx
from siftworks.session import scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").unionByName(fx.frame(spark, fx.PAGES))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", "text").unionByName(fx.frame(spark, fx.TEXTS))


def domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select(host(F.col("url")).alias("domain")).unionByName(fx.frame(spark, fx.DOMAINS))


def doc_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as leads: one domain each, the first line as title."""
    docs = read(spark, sf_dir, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".com")).alias("Domain"), F.lit("Live").alias("Brand_Stage"), F.substring(F.split_part("text", F.lit("\n"), F.lit(1)), 1, 60).alias("Title"), F.lit(None).cast("string").alias("Meta_Description"), F.lower("text").alias("Page_Text"))
    return docs.unionByName(fx.frame(spark, fx.LEADS))


# --- SQL parts --------------------------------------------------------------------------------------------------------------

P = f"(SELECT page_id, url, html FROM pages UNION ALL {fx.sql(fx.PAGES)})"
T = f"(SELECT doc_id, text FROM documents UNION ALL {fx.sql(fx.TEXTS)})"
HOST = "regexp_extract({}, '^[a-z]+://([^/:?#]+)', 1)"
D = f"(SELECT {HOST.format('url')} AS domain FROM pages UNION ALL {fx.sql(fx.DOMAINS)})"
L = f"(SELECT 'd' || doc_id || '.com' AS Domain, 'Live' AS Brand_Stage, substr(split_part(text, chr(10), 1), 1, 60) AS Title, NULL::VARCHAR AS Meta_Description, lower(text) AS Page_Text FROM documents UNION ALL {fx.sql(fx.LEADS)})"


def has(column: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, {fx.literal(w)})" for w in words) + ")"


def first(column: str, rules_: list, default: str | None) -> str:
    return "CASE " + " ".join(f"WHEN {has(column, words)} THEN {fx.literal(label)}" for label, words in rules_) + f" ELSE {fx.literal(default)} END"


def every(column: str, rules_: list, separator: str) -> str:
    parts = ", ".join(f"CASE WHEN {' AND '.join(has(column, w) for w in lists)} THEN {fx.literal(label)} END" for label, lists in rules_)
    return f"nullif(array_to_string(list_filter([{parts}], lambda x: x IS NOT NULL), '{separator}'), '')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def printable(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '[\\p{{C}}\\p{{Zl}}\\p{{Zp}}\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]', '', 'g'), '[\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')"


def missing(x: str) -> str:
    return f"coalesce(lower({strip(x)}), '') IN ('', 'none')"


def clean(x: str, most: int = 250) -> str:
    whole = strip(f"replace(replace({printable(x)}, chr(92), ' '), '\"', '''')")
    return f"CASE WHEN {missing(x)} THEN '' ELSE substr({whole}, 1, {most}) END"


def content_sql(source: str, key: str, column: str, domain: str) -> str:
    """CTEs ending in `content` (key, content): two windows over unnested words."""
    stops = ", ".join(map(fx.literal, rules.STOP_WORDS))
    return f"""cw0 AS (SELECT {key} AS k, regexp_replace(lower(split_part(coalesce({domain}, ''), '.', 1)), '[^a-z0-9]', '', 'g') AS own,
    CASE WHEN {missing(column)} THEN [] ELSE regexp_extract_all({printable(column)}, '[a-zA-Z]{{3,}}') END AS ws FROM {source}),
cw1 AS (SELECT k, own, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM cw0),
cw2 AS (SELECT k, w, i, row_number() OVER (PARTITION BY k, lower(w) ORDER BY i) AS nth FROM cw1 WHERE lower(w) NOT IN ({stops}) AND lower(w) <> own),
cw3 AS (SELECT k, w, i, row_number() OVER (PARTITION BY k ORDER BY i) AS n FROM cw2 WHERE nth <= {rules.MAX_REPEATS}),
cw4 AS (SELECT k, string_agg(w, ' ' ORDER BY i) AS c FROM cw3 WHERE n <= {rules.MAX_WORDS} GROUP BY k),
content AS (SELECT cw0.k, coalesce(c, '') AS content FROM cw0 LEFT JOIN cw4 USING (k))"""


# --- domains ----------------------------------------------------------------------------------------------------------------


@query(f"SELECT {HOST.format('url')} AS domain, count(*) AS n FROM pages GROUP BY 1")
def domain_hosts(spark, sf_dir):
    return read(spark, sf_dir, "pages").groupBy(host(F.col("url")).alias("domain")).agg(F.count(F.lit(1)).alias("n"))


SUFFIXED = "(" + " OR ".join(f"ends_with(d, {fx.literal(s)})" for s in rules.DOMAIN_SUFFIXES) + ")"
REASON = f"""SELECT domain, CASE WHEN d IS NULL OR NOT contains(d, '.') THEN 'no_dot' WHEN length(root) NOT BETWEEN 3 AND 22 THEN 'length'
  WHEN length(root) - length(replace(root, '-', '')) > 1 OR length(root) - length(regexp_replace(root, '[0-9]', '', 'g')) > 3 THEN 'format'
  WHEN NOT ({SUFFIXED} OR {has("root", rules.DOMAIN_KEYWORDS)}) THEN 'no_signal' END AS reason
  FROM (SELECT domain, d, split_part(d, '.', 1) AS root FROM (SELECT domain, lower({strip("domain")}) AS d FROM {D}))"""


@query(f"SELECT domain FROM ({REASON}) WHERE reason IS NULL")
def domain_premium(spark, sf_dir):
    return leads.premium(domains(spark, sf_dir))


@query(REASON)
def domain_reject_reason(spark, sf_dir):
    return domains(spark, sf_dir).select("domain", reject_reason(F.col("domain")).alias("reason"))


@query(f"SELECT count(*) AS scanned, count(*) FILTER (reason IS NULL) AS kept FROM ({REASON})")
def domain_filter_counts(spark, sf_dir):
    return domains(spark, sf_dir).agg(F.count(F.lit(1)).alias("scanned"), F.count_if(reject_reason(F.col("domain")).isNull()).alias("kept"))


# --- what is still to be done -----------------------------------------------------------------------------------------------


@query(f"SELECT DISTINCT {HOST.format('url')} AS domain FROM pages WHERE {HOST.format('url')} NOT IN (SELECT {HOST.format('url')} FROM pages WHERE url LIKE 'https:%')")
def scan_pending_anti(spark, sf_dir):
    rows = read(spark, sf_dir, "pages").withColumn("domain", host(F.col("url")))
    return incremental.pending(incremental.clean_keys(rows, "domain"), rows.where("url like 'https:%'"), "domain")


@query(f"""WITH c AS (SELECT DISTINCT {HOST.format('url')} AS d FROM pages), t AS (SELECT DISTINCT {HOST.format('url')} AS d FROM pages WHERE url LIKE 'https:%')
  SELECT (SELECT count(d) FROM c) AS total, (SELECT count(d) FROM t) AS tried, (SELECT count(d) FROM c ANTI JOIN t USING (d)) AS left""")
def scan_cardinalities(spark, sf_dir):
    rows = read(spark, sf_dir, "pages").withColumn("domain", host(F.col("url")))
    return progress.cardinalities(rows, rows.where("url like 'https:%'"), "domain")


def canned_get(url: str) -> tuple[int, str]:
    """Stands in for the network: some sites time out, some have no page."""
    if "7" in url:
        raise TimeoutError
    return (404, "") if "4" in url else (200, f"<p>{url}</p>")


@query(f"SELECT DISTINCT h AS domain, 'http://' || h AS url, '<p>http://' || h || '</p>' AS html FROM (SELECT {HOST.format('url')} AS h FROM pages) WHERE h NOT LIKE '%7%' AND h NOT LIKE '%4%'")
def page_fetch(spark, sf_dir):
    from siftworks.sources import fetch

    hosts = incremental.clean_keys(read(spark, sf_dir, "pages").select(host(F.col("url")).alias("domain")), "domain")
    return fetch.live(fetch.attempts(hosts, canned_get))


@query("SELECT doc_id, source FROM documents ANTI JOIN labels USING (doc_id)")
def lead_resume_anti(spark, sf_dir):
    return incremental.pending(read(spark, sf_dir, "documents").select("doc_id", "source"), read(spark, sf_dir, "labels"), "doc_id").select("doc_id", "source")


@query(f"""SELECT d.dt FROM (SELECT DISTINCT ts::DATE AS dt FROM events) d LEFT JOIN (SELECT dt::DATE AS dt, head FROM ({fx.sql(fx.ARCHIVE)})) a ON a.dt = d.dt
  WHERE head IS NULL OR contains(substr(head, 1, 200), 'NO_DATA') OR length(substr(head, 1, 200)) < 50""")
def date_backlog(spark, sf_dir):
    archive = fx.frame(spark, fx.ARCHIVE).withColumn("dt", F.to_date("dt"))
    return incremental.backlog(read(spark, sf_dir, "events").select(F.to_date("ts").alias("dt")), archive)


NAMES = "'list-2024-' || lpad((event_id % 14)::VARCHAR, 2, '0') || '-' || lpad((event_id % 33)::VARCHAR, 2, '0') || coalesce(event_type, '') || CASE user_id % 3 WHEN 0 THEN '.txt' WHEN 1 THEN '.TXT' ELSE '.csv' END"


@query(f"SELECT name, try_cast(regexp_extract(name, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AS DATE) AS dt, count(*) AS n FROM (SELECT {NAMES} AS name FROM events) WHERE ends_with(lower(name), '.txt') GROUP BY ALL")
def file_date_parse(spark, sf_dir):
    """Names made of the events, some with days that there aren't."""
    two = lambda n: F.lpad((F.col("event_id") % n).cast("string"), 2, "0")
    kind = F.when(F.col("user_id") % 3 == 0, ".txt").when(F.col("user_id") % 3 == 1, ".TXT").otherwise(".csv")
    names = read(spark, sf_dir, "events").select(F.concat(F.lit("list-2024-"), two(14), F.lit("-"), two(33), F.coalesce("event_type", F.lit("")), kind).alias("name"))
    names = names.where(F.endswith(F.lower("name"), F.lit(".txt")))
    return names.groupBy("name", incremental.file_date(F.col("name")).alias("dt")).agg(F.count(F.lit(1)).alias("n"))


# --- pages ------------------------------------------------------------------------------------------------------------------


def parsed(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", html.parse_html("html").alias("p"))


def unescape(x: str) -> str:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{char}')"
    return x


TITLE = f"nullif({unescape('regexp_extract(html, ' + chr(39) + '(?is)<title[^>]*>(.*?)</title>' + chr(39) + ', 1)')}, '')"
HREFS = f"list_transform(regexp_extract_all(html, '<a href=[\"'']([^\"'']*)[\"'']', 1), lambda h: {unescape('h')})"


@query(f"SELECT page_id, substr({strip(TITLE)}, 1, 60) AS title FROM {P}")
def html_title(spark, sf_dir):
    title = F.substring(text.strip(F.nullif(F.col("p.title"), F.lit(""))), 1, 60)
    return parsed(spark, sf_dir).select("page_id", title.alias("title"))


@query(f"SELECT page_id, href, count(*) AS n FROM (SELECT page_id, unnest({HREFS}) AS href FROM {P}) GROUP BY ALL")
def html_links(spark, sf_dir):
    found = html.page_nodes(pages(spark, sf_dir).select("page_id", "html"), "html", "href")
    return found.groupBy("page_id", F.col("value").alias("href")).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT page_id, nullif(array_to_string(list_sort(list_distinct(list_filter(list_transform({HREFS}, lambda h: {first('lower(h)', rules.SOCIALS, None)}), lambda x: x IS NOT NULL))), ' + '), '') AS socials FROM {P}")
def html_socials(spark, sf_dir):
    return parsed(spark, sf_dir).select("page_id", html.socials(F.col("p.hrefs")).alias("socials"))


@query(f"SELECT page_id, {every('lower(html)', rules.STAGES, ' | ')} AS stage FROM {P}")
def html_stage(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", html.brand_stage(F.col("html")).alias("stage"))


@query(f"SELECT page_id, {every('lower(html)', rules.TECH, ' + ')} AS tech FROM {P}")
def html_tech(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", html.tech_stack(F.col("html")).alias("tech"))


@query(f"SELECT page_id, {every('lower(html)', rules.INTENT, ' | ')} AS intent FROM {P}")
def html_intent(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", html.intent(F.col("html")).alias("intent"))


@query(f"""SELECT page_id, coalesce(nullif(substr(regexp_extract(html, '<meta name=[\"'']description[\"''] content=[\"'']([^\"'']*)', 1), 1, 300), ''),
  nullif(substr(regexp_extract(html, '<meta property=[\"'']og:description[\"''] content=[\"'']([^\"'']*)', 1), 1, 300), '')) AS meta FROM {P}""")
def html_meta(spark, sf_dir):
    cut = lambda c: F.nullif(F.substring(c, 1, 300), F.lit(""))
    return parsed(spark, sf_dir).select("page_id", F.coalesce(cut("p.description"), cut("p.og_description")).alias("meta"))


NAV = f"list_transform(regexp_extract_all(html, '(?s)<(?:a|button) href=[^>]*>([^<]*)</(?:a|button)>', 1), lambda x: lower({strip(unescape('x'))}))"


@query(f"SELECT page_id, CASE WHEN k = 'nav' THEN i - 1 ELSE 0 END::INT AS at, k AS kind, value FROM (SELECT page_id, 'nav' AS k, unnest(range(1, len(n) + 1)) AS i, unnest(n) AS value FROM (SELECT page_id, list_filter({NAV}, lambda x: length(x) BETWEEN 1 AND 39) AS n FROM {P}) UNION ALL SELECT page_id, 'title', 1, {TITLE} FROM {P} WHERE {TITLE} IS NOT NULL)")
def page_node_rows(spark, sf_dir):
    """A page's title and what its links and buttons say, as rows."""
    found = html.page_nodes(pages(spark, sf_dir).select("page_id", "html"), "html", "nav", "title")
    return found.where("value <> ''").select("page_id", "at", "kind", "value")


@query(f"SELECT page_id, list_filter({NAV}, lambda x: length(x) BETWEEN 1 AND 39) AS nav FROM {P}")
def html_nav(spark, sf_dir):
    return parsed(spark, sf_dir).select("page_id", F.col("p.nav").alias("nav"))


PHRASES = f"""WITH s AS (SELECT doc_id, 'd' AS own, coalesce(text, '') AS text FROM {T}),
a AS (SELECT doc_id, own, regexp_split_to_array(text, '[.!?\n|•·]') AS parts FROM s),
b AS (SELECT doc_id, own, {strip("unnest(parts)")} AS part, generate_subscripts(parts, 1) AS i FROM a),
c AS (SELECT doc_id, lower(part) AS part, min(i) AS i FROM b WHERE length(part) > 20 AND NOT starts_with(lower(part), own) GROUP BY doc_id, lower(part))
SELECT doc_id, substr(coalesce(string_agg(part, ' ' ORDER BY i), ''), 1, 600) AS page_text FROM s LEFT JOIN c USING (doc_id) GROUP BY doc_id"""


@query(PHRASES)
def page_text(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", html.page_text(F.coalesce("text", F.lit("")), F.lit("d")).alias("page_text"))


EMAILS = f"list_filter(list_distinct(regexp_extract_all(text, {fx.literal(rules.EMAIL)})), lambda e: NOT {has('e', rules.EMAIL_DENIED)})"


@query(f"SELECT doc_id, nullif(array_to_string(list_sort({EMAILS}), ' | '), '') AS emails FROM {T}")
def emails(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", html.emails(F.col("text")).alias("emails"))


@query(f"SELECT e AS email, {has('e', rules.EMAIL_DENIED)} AS denied, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, {fx.literal(rules.EMAIL)})) AS e FROM {T}) GROUP BY ALL")
def emails_denylist(spark, sf_dir):
    found = texts(spark, sf_dir).select(F.explode(F.regexp_extract_all("text", F.lit(rules.EMAIL), 0)).alias("email"))
    return found.groupBy("email", text.any_of(F.col("email"), rules.EMAIL_DENIED).alias("denied")).agg(F.count(F.lit(1)).alias("n"))


PHONES = f"list_filter(list_distinct(regexp_extract_all(text, {fx.literal(rules.PHONE)})), lambda p: length(regexp_replace(p, '\\D', '', 'g')) BETWEEN 10 AND 15)"


@query(f"SELECT doc_id, nullif(array_to_string(list_slice(list_sort({PHONES}), 1, 2), ' | '), '') AS phones FROM {T}")
def phones_top2(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", html.phones(F.col("text")).alias("phones"))


@query(f"SELECT doc_id, coalesce(length({strip('text')}) >= 10 AND length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g')) / length(text) <= 0.85::DOUBLE, false) AS translate FROM {T}")
def ascii_gate(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", text.needs_translation(F.col("text")).alias("translate"))


# --- labels by rule ---------------------------------------------------------------------------------------------------------


@query(f"SELECT doc_id, {first('lower(text)', rules.BUSINESS, rules.BUSINESS_ELSE)} AS business FROM {T}")
def business_type(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", classify.business_type(F.lower("text")).alias("business"))


CATEGORY = first("lower(text)", rules.PRODUCT, rules.PRODUCT_ELSE)


@query(f"SELECT doc_id, {CATEGORY} AS category FROM {T}")
def product_category(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", classify.product_category(F.lower("text")).alias("category"))


@query(f"SELECT {CATEGORY} AS category, count(*) AS n, ceil(count(*) / 5)::BIGINT AS batches FROM {T} GROUP BY 1")
def category_histogram(spark, sf_dir):
    n = F.count(F.lit(1))
    return texts(spark, sf_dir).groupBy(classify.product_category(F.lower("text")).alias("category")).agg(n.alias("n"), F.ceil(n / rules.BATCH_SIZE).alias("batches"))


def rule_table(spark, named: list) -> DataFrame:
    """Rules as rows: priority, label, phrase."""
    return spark.createDataFrame([(k, label, w) for k, (label, words) in enumerate(named) for w in words], "priority bigint, label string, phrase string")


@query(f"SELECT doc_id FROM documents WHERE {has('lower(text)', rules.PRODUCT[3][1])}")
def keyword_semijoin(spark, sf_dir):
    """The texts in which one of a table's words is."""
    docs = read(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("low"))
    found = phrases.hits(docs, rule_table(spark, rules.PRODUCT[3:4]), "doc_id", "low")
    return found.select(F.col("key").alias("doc_id")).distinct()


@query(f"SELECT doc_id, {CATEGORY} AS category FROM documents")
def product_category_by_table(spark, sf_dir):
    """The given rules as rows of a table instead of a CASE."""
    docs = read(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("low"))
    return phrases.first_rule(docs, rule_table(spark, rules.PRODUCT), rules.PRODUCT_ELSE, "doc_id", "low").select(F.col("key").alias("doc_id"), F.col("label").alias("category"))


#: Three phrases of each document, at different places of it, each a rule with the document's source as label.
PHRASE_TABLE = """SELECT DISTINCT CASE WHEN k = 0 THEN doc_id ELSE 1000000000 - doc_id END AS priority, source AS label, trim(substr(text, (1 + (doc_id * 37 + k * 101) % 900)::INT, (9 + 7 * k)::INT), ' ') AS phrase
  FROM (SELECT *, unnest([0, 1, 2]) AS k FROM documents) WHERE source IS NOT NULL AND length(trim(substr(text, (1 + (doc_id * 37 + k * 101) % 900)::INT, (9 + 7 * k)::INT), ' ')) > 4"""


def phrase_table(spark, sf_dir) -> DataFrame:
    rows = read(spark, sf_dir, "documents").where("source is not null").withColumn("k", F.explode(F.array(*map(F.lit, range(3)))))
    phrase = F.trim(F.substring("text", (F.lit(1) + (F.col("doc_id") * 37 + F.col("k") * 101) % 900).cast("int"), F.lit(9) + F.col("k") * 7))
    priority = F.when(F.col("k") == 0, F.col("doc_id")).otherwise(F.lit(1_000_000_000) - F.col("doc_id"))
    return rows.select(priority.alias("priority"), F.col("source").alias("label"), phrase.alias("phrase")).where(F.length("phrase") > 4).distinct()


@query(f"WITH p AS (SELECT DISTINCT phrase FROM ({PHRASE_TABLE})) SELECT phrase, count(*) AS documents FROM p JOIN documents d ON contains(d.text, phrase) GROUP BY phrase")
def phrase_hits(spark, sf_dir):
    """A table of phrases that grows with the documents, against all of them."""
    return phrases.counts(read(spark, sf_dir, "documents"), phrase_table(spark, sf_dir)).withColumnRenamed("n", "documents")


@query(f"""WITH p AS ({PHRASE_TABLE}), h AS (SELECT doc_id, min({{'a': priority, 'b': label}}) AS r FROM p JOIN documents d ON contains(d.text, phrase) GROUP BY doc_id)
  SELECT doc_id, coalesce((r).b, 'none') AS label FROM documents LEFT JOIN h USING (doc_id)""")
def phrase_first_rule(spark, sf_dir):
    """Of a table's rules the first that matches, for each document."""
    return phrases.first_rule(read(spark, sf_dir, "documents"), phrase_table(spark, sf_dir), "none", "doc_id").select(F.col("key").alias("doc_id"), "label")


@query(f"SELECT doc_id, {clean('text')} AS cleaned FROM {T}")
def clean_field(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", text.clean_field(F.col("text")).alias("cleaned"))


@query(f"WITH {content_sql(T, 'doc_id', 'text', chr(39) + 'glow.com' + chr(39))} SELECT k AS doc_id, content FROM content")
def content_words(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", text.content_words(F.col("text"), F.lit("glow.com")).alias("content"))


# --- lead records -----------------------------------------------------------------------------------------------------------


META = """coalesce(nullif(substr(regexp_extract(html, '<meta name=["'']description["''] content=["'']([^"'']*)', 1), 1, 300), ''),
  nullif(substr(regexp_extract(html, '<meta property=["'']og:description["''] content=["'']([^"'']*)', 1), 1, 300), ''))"""
#: CTEs ending in `lead`: the record of each page, null where nothing is found. Markup by patterns: tags part texts.
LEAD = f"""h AS (SELECT page_id, html, {strip(HOST.format("url"))} AS Domain, {META} AS meta FROM {P} WHERE html IS NOT NULL AND {strip(HOST.format("url"))} <> ''),
t AS (SELECT page_id, split_part(Domain, '.', 1) AS own, array_to_string(list_filter(list_transform(regexp_split_to_array(
    regexp_replace(html, '(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', '<x>', 'g'), '<[^>]*>'), lambda x: {strip(unescape("x"))}), lambda x: x <> ''), ' ') AS body FROM h),
a AS (SELECT page_id, own, regexp_split_to_array(body, '[.!?\n|•·]') AS parts FROM t),
b AS (SELECT page_id, own, {strip("unnest(parts)")} AS part, generate_subscripts(parts, 1) AS i FROM a),
c AS (SELECT page_id, lower(part) AS part, min(i) AS i FROM b WHERE length(part) > 20 AND NOT starts_with(lower(part), own) GROUP BY page_id, lower(part)),
body AS (SELECT t.page_id, substr(coalesce(string_agg(part, ' ' ORDER BY i), ''), 1, 600) AS body FROM t LEFT JOIN c USING (page_id) GROUP BY t.page_id),
lead AS (SELECT page_id, Domain, {every('lower(html)', rules.STAGES, ' | ')} AS Brand_Stage, substr({strip(TITLE)}, 1, 60) AS Title, substr({strip('meta')}, 1, 300) AS Meta_Description, substr(body, 1, 500) AS Page_Text,
  nullif(array_to_string(list_sort({EMAILS.replace('(text,', '(html,')}), ' | '), '') AS Emails, nullif(array_to_string(list_slice(list_sort({PHONES.replace('(text,', '(html,')}), 1, 2), ' | '), '') AS Phones,
  nullif(array_to_string(list_sort(list_distinct(list_filter(list_transform({HREFS}, lambda h: {first('lower(h)', rules.SOCIALS, None)}), lambda x: x IS NOT NULL))), ' + '), '') AS Socials_Found,
  {every('lower(html)', rules.TECH, ' + ')} AS Tech_Stack_Ads, {every('lower(html)', rules.INTENT, ' | ')} AS Intent_Trust,
  {first("(lower(coalesce(meta, '') || ' ' || body) || ' ' || array_to_string(list_filter(" + NAV + ", lambda x: length(x) BETWEEN 1 AND 39), ' '))", rules.BUSINESS, rules.BUSINESS_ELSE)} AS Business_Type,
  {first("lower(coalesce(meta, '') || ' ' || body)", rules.PRODUCT, rules.PRODUCT_ELSE)} AS Product_Category FROM h JOIN body USING (page_id))"""


def handed_out(columns: list[str]) -> str:
    return ", ".join(f"coalesce({c}, '{rules.LIVE if c == 'Brand_Stage' else rules.MISSING}') AS {c}" for c in columns)


@query(f"WITH {LEAD} SELECT page_id, {handed_out(rules.LEAD_COLUMNS)} FROM lead")
def lead_record(spark, sf_dir):
    return leads.egress(leads.enrich(pages(spark, sf_dir), keep=("page_id",)))


def marked(c):
    """A stand-in for a translation."""
    return F.concat(F.lit("[en] "), text.capitals(c))


@query(f"SELECT doc_id, CASE WHEN coalesce(length({strip('text')}) >= 10 AND length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g')) / length(text) <= 0.85::DOUBLE, false) THEN '[en] ' || upper(text) ELSE text END AS english FROM {T}")
def translated(spark, sf_dir):
    """The hook for a translation: only texts that are long enough and not mostly ASCII go through it, whole."""
    return texts(spark, sf_dir).select("doc_id", leads.in_english(F.col("text"), marked).alias("english"))


RAW = f"""SELECT page_id, {every('lower(html)', rules.STAGES, ' | ')} AS stage, {every('lower(html)', rules.TECH, ' + ')} AS tech,
  nullif(array_to_string(list_sort({EMAILS.replace('(text,', '(html,')}), ' | '), '') AS emails,
  list_sort(list_distinct(list_filter(list_transform({HREFS}, lambda h: {first('lower(h)', rules.SOCIALS, None)}), lambda x: x IS NOT NULL))) AS s FROM {P}"""


@query(f"SELECT page_id, coalesce(stage, 'Live') AS stage, coalesce(tech, 'None') AS tech, coalesce(emails, 'None') AS emails, CASE WHEN len(s) = 0 THEN 'None' ELSE array_to_string(s, ' + ') END AS socials FROM ({RAW}) WHERE stage IS NOT NULL OR tech IS NOT NULL OR emails IS NOT NULL OR len(s) > 0")
def lead_useful(spark, sf_dir):
    kept = leads.egress(leads.useful(leads.enrich(pages(spark, sf_dir), keep=("page_id",))))
    return kept.select("page_id", F.col("Brand_Stage").alias("stage"), F.col("Tech_Stack_Ads").alias("tech"), F.col("Emails").alias("emails"), F.col("Socials_Found").alias("socials"))


WHOLE = "lower(coalesce(Title, '') || ' ' || coalesce(Page_Text, ''))"
CLASSED = f"""WITH {content_sql(L, 'Domain', 'Page_Text', 'Domain')},
classed AS (SELECT l.*, CASE WHEN {has(WHOLE, rules.PARKED)} THEN 'parked' WHEN lower(coalesce(Brand_Stage, '')) = 'pre-launch' OR {has(WHOLE, rules.PRELAUNCH)} THEN 'prelaunch'
  WHEN length({clean('Title')} || {clean('Meta_Description')} || content.content) < 10 THEN 'no_content' ELSE 'ai' END AS lead_class FROM {L} l JOIN content ON content.k = l.Domain)"""


@query(f"{CLASSED} SELECT Domain, lead_class FROM classed")
def lead_class(spark, sf_dir):
    return labelling.split_classes(doc_leads(spark, sf_dir)).select("Domain", "lead_class")


@query(f"{CLASSED} SELECT lead_class, count(*) AS n FROM classed GROUP BY 1")
def lead_class_counts(spark, sf_dir):
    return labelling.split_classes(doc_leads(spark, sf_dir)).groupBy("lead_class").agg(F.count(F.lit(1)).alias("n"))


INSTANT = "CASE lead_class " + " ".join("WHEN {} THEN [{}]".format(fx.literal(k), ", ".join(map(fx.literal, v))) for k, v in rules.INSTANT.items()) + " END"


@query(f"{CLASSED} SELECT Domain, x[1] AS Pitch_Category, x[2] AS Business_Type, x[3] AS Product_Category FROM (SELECT Domain, {INSTANT} AS x FROM classed) WHERE x IS NOT NULL")
def instant_labels(spark, sf_dir):
    return labelling.instant(labelling.split_classes(doc_leads(spark, sf_dir))).select("Domain", *rules.LABEL_COLUMNS)


@query("SELECT doc_id, (n - 1) // 5 AS batch, ((n - 1) % 5)::INT AS index FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS n FROM documents)")
def batch_index(spark, sf_dir):
    return labelling.number_batches(read(spark, sf_dir, "documents").select("doc_id"), "doc_id", steady=True).select("doc_id", "batch", "index")


ITEM_SQL = f"{{'index': index, 'domain': Domain, 'title': {clean('Title', 150)}, 'meta': {clean('Meta_Description', 300)}, 'content': content}}"


@query(f"{CLASSED}, n AS (SELECT classed.*, content.content, row_number() OVER (ORDER BY Domain) - 1 AS r FROM classed JOIN content ON content.k = classed.Domain WHERE lead_class = 'ai'), i AS (SELECT *, r // 5 AS batch, (r % 5)::INT AS index FROM n) SELECT batch, to_json(list({ITEM_SQL} ORDER BY index))::VARCHAR AS request FROM i GROUP BY batch")
def batch_request_json(spark, sf_dir):
    todo = labelling.split_classes(doc_leads(spark, sf_dir)).where("lead_class = 'ai'")
    return labelling.requests(labelling.number_batches(labelling.told(todo), "Domain"))


@query(f"""WITH r AS (SELECT (row_number() OVER (ORDER BY doc_id) - 1) // 5 AS batch FROM documents)
  SELECT count(*) AS processed, count(*) FILTER (a.error IS NOT NULL) AS skipped, (SELECT sum(CASE WHEN error IS NULL THEN tries - 1 ELSE tries END)::BIGINT FROM ({fx.sql(fx.ANSWERED)})) AS retries
  FROM r LEFT JOIN ({fx.sql(fx.ANSWERED)}) a USING (batch)""")
def run_outcome(spark, sf_dir):
    numbered = labelling.number_batches(read(spark, sf_dir, "documents").select("doc_id"), "doc_id")
    return labelling.outcome(numbered, fx.frame(spark, fx.ANSWERED))


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN NULL ELSE coalesce(text, '') END AS raw FROM documents")
def response_content(spark, sf_dir):
    """Documents in the envelopes of a chat service, every fourth without an answer."""
    message = F.struct(F.struct(F.lit("assistant").alias("role"), F.coalesce("text", F.lit("")).alias("content")).alias("message"))
    there = F.when(F.col("doc_id") % 4 == 3, F.array().cast(f"array<{message_type()}>")).otherwise(F.array(message))
    sent = read(spark, sf_dir, "documents").select("doc_id", F.to_json(F.struct(there.alias("choices"))).alias("response"))
    return sent.select("doc_id", labelling.message_content(F.col("response")).alias("raw"))


def message_type() -> str:
    return "struct<message: struct<role: string, content: string>>"


def normalised(pitch: str, domain: str, biz: str, prod: str) -> str:
    """A label put into form, as an expression over others."""
    fixed = "CASE " + " ".join(f"WHEN starts_with({pitch}, {fx.literal(w)}) THEN {fx.literal(r)} || substr({pitch}, {len(w) + 1})" for w, r in rules.LEADING_EMOJI.items()) + f" ELSE {pitch} END"
    role = " OR ".join(f"starts_with(f.low, '{w}') OR contains(substr(f.low, 1, 15), ' {w}')" for w in rules.INVENTED_ROLES)
    own = f"CASE WHEN coalesce({domain}, '') = '' THEN 'General' ELSE array_to_string(list_transform(regexp_extract_all(lower(split_part({domain}, '.', 1)), '[a-z]+|[^a-z]+'), lambda x: upper(x[1]) || x[2:]), '') END"
    niche = f"coalesce({first('f.hint', rules.NICHES, None)}, {own})"
    named = f"CASE WHEN {role} THEN {strip(fx.literal(rules.AGENCIES + ' ') + ' || regexp_extract(f.x, ' + chr(39) + '[(].*?[)]' + chr(39) + ')')} ELSE f.x END"
    inner = f"SELECT {fixed} AS x, lower({fixed}) AS low, lower(coalesce({biz}, '') || ' ' || coalesce({prod}, '')) AS hint"
    return f"CASE WHEN coalesce({pitch}, '') = '' THEN '{rules.GENERAL}' ELSE (SELECT regexp_replace({named}, '[(]niche[)]', '(' || {niche} || ')', 'gi') FROM ({inner}) f) END"


#: What a model answers about the documents, in batches of five by doc_id. The shape goes by the batch: a list, below `items`, in a fence,
#: below another key (without domains), the first item alone, cut off, or each item twice (the last counts).
ANSWERS = f"""SELECT batch, index, 'd' || doc_id || '.com' AS Domain, source, lang, batch % 7 AS shape, count(*) OVER (PARTITION BY batch) AS n
  FROM (SELECT *, (r // 5) AS batch, (r % 5)::INT AS index FROM (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS r FROM documents))"""
ITEMS = f"""WITH a AS ({ANSWERS}),
b AS (SELECT *, unnest(CASE WHEN shape = 6 THEN [0, 1] ELSE [0] END) AS again FROM a WHERE shape <> 5 AND (shape <> 4 OR index = 0)),
c AS (SELECT batch, (index + again * n)::INT AS pos, index, CASE WHEN shape = 3 THEN '' ELSE Domain END AS domain, '🤖 2. SaaS/Tech (NICHE)' AS p, coalesce(source, '') AS q, CASE WHEN again = 1 THEN 'Again' ELSE coalesce(lang, '') END AS z FROM b),
items AS (SELECT batch, NULL::VARCHAR AS error, pos, index, domain, {normalised("p", "domain", "q", "z")} AS pitch, coalesce(nullif(q, 'Unknown'), '') AS biz, coalesce(nullif(z, 'Unknown'), '') AS prod FROM c
  UNION ALL SELECT DISTINCT batch, 'JSON_ERROR', NULL::INT, NULL::INT, '', NULL, NULL, NULL FROM a WHERE shape = 5)"""


def answered(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The documents in their batches, and an answer for each batch."""
    rows = labelling.number_batches(read(spark, sf_dir, "documents").select("doc_id", "source", "lang"), "doc_id", steady=True)
    rows = rows.withColumn("Domain", F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".com"))).withColumn("shape", F.col("batch") % 7)
    domain = F.when(F.col("shape") != 3, F.col("Domain"))

    def item(prod):
        return F.struct(F.col("index"), domain.alias("domain"), F.lit("🤖 2. SaaS/Tech (NICHE)").alias("pitch_category"), F.col("source").alias("true_business_type"), prod.alias("true_product_category"))

    each = rows.select("batch", "shape", item(F.col("lang")).alias("item"), item(F.lit("Again")).alias("again"))
    lists_ = each.groupBy("batch", "shape").agg(F.array_sort(F.collect_list("item")).alias("l"), F.array_sort(F.collect_list("again")).alias("m"))  # five rows each
    whole, text_of = F.to_json("l"), lambda name: F.to_json(F.struct(F.lit("x").alias("note"), F.col("l").alias(name)))
    shape = F.col("shape")
    raw = (
        F.when(shape == 0, whole)
        .when(shape == 1, text_of("items"))
        .when(shape == 2, F.concat(F.lit("```json\n"), text_of("items"), F.lit("\n```")))
        .when(shape == 3, text_of("found"))
        .when(shape == 4, F.to_json(F.col("l")[0]))
        .when(shape == 5, F.substring(whole, 1, 40))
        .otherwise(F.to_json(F.concat("l", "m")))
    )
    return rows.select("batch", "index", "Domain"), lists_.select("batch", raw.alias("raw"))


@query(f"{ITEMS} SELECT * FROM items")
def response_parse(spark, sf_dir):
    return labelling.parse_answers(answered(spark, sf_dir)[1])


@query(f"{ITEMS} SELECT batch, domain, max(pos)::INT AS pos FROM items WHERE error IS NULL AND domain <> '' GROUP BY ALL")
def response_last_wins(spark, sf_dir):
    items = labelling.parse_answers(answered(spark, sf_dir)[1])
    last = labelling.last_by(items.withColumn("pitch", F.col("pos").cast("string")), "domain")
    return last.select("batch", "domain", F.col("found.pitch").cast("int").alias("pos"))


LOOK = f"""{ITEMS}, rows AS (SELECT batch, index, Domain FROM a),
d AS (SELECT batch, domain, max_by({{'p': pitch, 'b': biz, 'q': prod}}, pos) AS x FROM items WHERE error IS NULL AND domain <> '' GROUP BY ALL),
i AS (SELECT batch, index, max_by({{'p': pitch, 'b': biz, 'q': prod}}, pos) AS x FROM items WHERE error IS NULL AND index IS NOT NULL GROUP BY ALL)
SELECT r.batch, r.index, r.Domain, coalesce(coalesce(d.x, i.x).p, '{rules.GENERAL}') AS Pitch_Category, coalesce(nullif(coalesce(d.x, i.x).b, ''), '{rules.REVIEW}') AS Business_Type,
  coalesce(nullif(coalesce(d.x, i.x).q, ''), '{rules.REVIEW}') AS Product_Category
FROM rows r LEFT JOIN d ON d.batch = r.batch AND d.domain = r.Domain LEFT JOIN i ON i.batch = r.batch AND i.index = r.index"""


@query(LOOK)
def label_lookup(spark, sf_dir):
    rows, answers = answered(spark, sf_dir)
    return labelling.look_up(rows, labelling.parse_answers(answers))


FLAT = "translate(text, chr(10) || chr(13) || chr(133) || chr(8232) || chr(8233), '     ')"


@query(f"SELECT pitch, domain, biz, {normalised('pitch', 'domain', 'biz', 'prod')} AS category FROM ({fx.sql(fx.PITCHES)} UNION ALL SELECT CASE doc_id % 4 WHEN 0 THEN '🤖 2. SaaS/Tech (NICHE)' WHEN 1 THEN {FLAT} WHEN 2 THEN '🏠 ' || {FLAT} || ' (Niche)' ELSE 'a writer (' || source || ')' END, lang || '-' || doc_id || '.com', {FLAT}, source FROM documents)")
def normalize_category(spark, sf_dir):
    """Rows for each branch, and whole documents as labels, domains and hints."""
    flat = F.translate("text", "\n\r\x85\u2028\u2029", " " * 5)
    kind = F.pmod("doc_id", F.lit(4))
    pitch = F.when(kind == 0, "🤖 2. SaaS/Tech (NICHE)").when(kind == 1, flat).when(kind == 2, F.concat(F.lit("🏠 "), flat, F.lit(" (Niche)"))).otherwise(F.concat(F.lit("a writer ("), F.col("source"), F.lit(")")))
    docs = read(spark, sf_dir, "documents").select(pitch.alias("pitch"), F.concat("lang", F.lit("-"), F.col("doc_id").cast("string"), F.lit(".com")).alias("domain"), flat.alias("biz"), F.col("source").alias("prod"))
    rows = fx.frame(spark, fx.PITCHES).unionByName(docs)
    return rows.select("pitch", "domain", "biz", classify.normalise_category(*(F.col(c) for c in ("pitch", "domain", "biz", "prod"))).alias("category"))


@query("SELECT 'p' AS Pitch_Category, source AS Business_Type, lang AS Product_Category, doc_id, n_chars FROM documents")
def final_columns(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("Business_Type"), "n_chars", F.col("lang").alias("Product_Category"), F.lit("p").alias("Pitch_Category"))
    return labelling.final_columns(rows)


TOLD = f"lower({clean('Title', 150)} || ' ' || {clean('Meta_Description', 300)} || ' ' || content)"
OWN = "CASE WHEN coalesce(Domain, '') = '' THEN 'General' ELSE array_to_string(list_transform(regexp_extract_all(lower(split_part(Domain, '.', 1)), '[a-z]+|[^a-z]+'), lambda x: upper(x[1]) || x[2:]), '') END"
#: The final table: rows that the model is asked for in batches of five, where the last answer for a domain counts.
LABELLED = f"""WITH {LEAD}, {content_sql('lead', 'page_id', 'Page_Text', 'Domain')},
classed AS (SELECT l.*, content, CASE WHEN {has(WHOLE, rules.PARKED)} THEN 'parked' WHEN lower(coalesce(Brand_Stage, '')) = 'pre-launch' OR {has(WHOLE, rules.PRELAUNCH)} THEN 'prelaunch'
  WHEN length({clean('Title')} || {clean('Meta_Description')} || content) < 10 THEN 'no_content' ELSE 'ai' END AS lead_class FROM lead l JOIN content ON content.k = l.page_id),
n AS (SELECT *, row_number() OVER (ORDER BY Domain NULLS FIRST, Title NULLS FIRST, Meta_Description NULLS FIRST, Page_Text NULLS FIRST) - 1 AS r, {first(TOLD, rules.BUSINESS, 'Unknown')} AS biz, {first(TOLD, rules.PRODUCT, 'Unknown')} AS prod FROM classed WHERE lead_class = 'ai'),
m AS (SELECT *, '🤖 2. SaaS/Tech (' || coalesce({first("lower(biz || ' ' || prod)", rules.NICHES, None)}, {OWN}) || ')' AS pitch FROM n),
w AS (SELECT *, last_value({{'p': pitch, 'b': biz, 'q': prod}}) OVER (PARTITION BY r // 5, Domain ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS x FROM m),
labelled AS (SELECT * EXCLUDE (Business_Type, Product_Category, content, r, biz, prod, pitch, x), x.p AS Pitch_Category, coalesce(nullif(x.b, 'Unknown'), '{rules.REVIEW}') AS Business_Type, coalesce(nullif(x.q, 'Unknown'), '{rules.REVIEW}') AS Product_Category FROM w
  UNION ALL BY NAME SELECT * EXCLUDE (Business_Type, Product_Category, content, x), x[1] AS Pitch_Category, x[2] AS Business_Type, x[3] AS Product_Category FROM (SELECT *, {INSTANT} AS x FROM classed) WHERE x IS NOT NULL)"""
OTHERS = [c for c in rules.LEAD_COLUMNS if c not in rules.LABEL_COLUMNS]


@query(f"{LABELLED} SELECT {', '.join(rules.LABEL_COLUMNS)}, {handed_out(OTHERS)} FROM labelled")
def labelled_leads(spark, sf_dir):
    """Pages to the final table, with the rule-based stand-in for a model."""
    return labelling.final_columns(leads.egress(labelling.label(leads.enrich(pages(spark, sf_dir)), labelling.rule_model)))


@query(f"""{LABELLED} SELECT page_id, lead_class, row_number() OVER (ORDER BY list_position({rules.CLASS_ORDER}, lead_class), page_id) AS nth FROM labelled""")
def class_order(spark, sf_dir):
    """The order in which rows are handed out: instant classes first, then the model's."""
    labelled = labelling.label(leads.enrich(pages(spark, sf_dir), keep=("page_id",)), labelling.rule_model, keep_class=True)
    found = labelling.numbered(labelled.select("page_id", "lead_class"), labelling.class_rank(), "page_id")
    return found.select("page_id", "lead_class", (F.col("place") + 1).alias("nth"))


# --- streams and files ------------------------------------------------------------------------------------------------------


@query("SELECT ts::DATE AS dt, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_incremental(spark, sf_dir):
    """Events as a stream of files, processed once; then the table that the stream wrote, counted."""
    from siftworks.streaming.incremental import run_once

    base = scratch(spark, "stream")
    events = read(spark, sf_dir, "events")
    early = F.coalesce(F.col("event_type").isin("signup", "view"), F.lit(False))
    source = f"{base}/in"
    events.where(early).write.parquet(source)
    daily = lambda df: df.withColumn("dt", F.to_date("ts"))
    run_once(spark, source, events.schema, daily, f"{base}/out", f"{base}/state", "dt")
    events.where(~early).write.mode("append").parquet(source)
    for _ in range(2):  # the second finds nothing new
        run_once(spark, source, events.schema, daily, f"{base}/out", f"{base}/state", "dt")
    return spark.read.parquet(f"{base}/out").groupBy("dt", "event_type").agg(F.count(F.lit(1)).alias("n"))
